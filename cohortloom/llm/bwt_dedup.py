"""Suffix-array dedup: common prefixes by interval expansion on a Burrows-Wheeler transform.

Every byte covered by ``threshold`` bytes that also start in a document with a smaller id is
removed. Equal windows of that length are brought together first, then decided:

* **Copies.** A text that a smaller id has as a whole loses all its windows, and is not looked at again.
* **Anchors.** The least hash among the 24-byte strings of a window is its anchor, so equal
  windows have equal anchors. One shuffle of (anchor, id) pairs finds the anchors that stand in
  several documents; only windows with these go on. Consecutive windows of one anchor travel as one
  context, their bytes.
* **Blocks.** Contexts are dealt out by anchor, so equal windows meet in one block of bounded size.
  Copies of a context collapse to one, with the least id, within a task and
  again within a block. An anchor with very many contexts is split: its windows are dealt out one by
  one by their own hash, where only copies of one window can meet.
* **Interval expansion.** The suffixes of a block's contexts are put in order by prefix
  doubling, no further than ``threshold`` bytes, which gives the Burrows-Wheeler transform. Breadth-first
  backward extension starts from the interval of all suffixes; extending an interval of
  strings of length l by each character before it gives those of length l + 1, and an interval's
  start that no shorter string had set gets common prefix l. So common prefixes appear by increasing
  value, and the expansion stops at ``threshold``: starts that are unset by then lie inside an
  interval of suffixes that share ``threshold`` bytes. The least document of each such interval decides
  about its windows.

An interval is expanded through the first occurrence of each character in it (last-to-first
mapping), so no rank tables are needed. The order beyond ``threshold`` bytes is left open, which is enough:
only counts of shorter prefixes enter. Hashes only choose what is compared, and bytes decide, but for whole
texts: these are copies if their length and 128 bits of hash agree.

No pair of documents is made. A passage with a million copies sends its bytes to its block only a few
times per task: where a task has met them with a smaller id they are known to be covered, and
they bypass the block, whole runs of them as one row.

Defined cases: null and empty texts and texts shorter than the threshold lose nothing; documents
with a null id neither remove nor lose anything; equal ids never remove each other's bytes;
repeated rows give repeated result rows; very long texts are read in overlapping pieces;
bytes that are not UTF-8 are bytes like any other; an empty table gives no rows. Only
the id and text columns are read, so other columns may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.common import modest_batches
from cohortloom.operators.materialize import settle
from cohortloom.operators.sizing import broadcast_small

THRESHOLD = 50
ANCHOR = 24
CHUNK = 1 << 18  # bytes that are looked at together
RUN = 64  # windows of one context at most
BLOCK = 1 << 19  # bytes whose suffixes are put in order together
SEEN = 100_000  # contexts that a task remembers with their least id
CROWD = 1 << 16  # texts with an anchor beyond which its windows are dealt out one by one

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_UNSET = 255


@cache
def _powers(base: int) -> np.ndarray:
    steps = np.full(CHUNK + THRESHOLD, base, np.uint64)
    steps[0] = 1
    return np.cumprod(steps)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _U(29))) * _U(0xBF58476D1CE4E5B9)
    return x ^ (x >> _U(32))


def _spans(text: np.ndarray, length: int) -> np.ndarray:
    """Hash of the ``length`` bytes from every place on."""
    n = len(text)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((text.astype(np.uint64) + _U(1)) * _powers(_BASE)[:n], out=sums[1:])
    return _mix((sums[length:] - sums[:-length]) * _powers(_INVERSE)[: n - length + 1])


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of ``width`` values from every place on."""
    done = 1
    while done < width:
        step = min(done, width - done)
        values = np.minimum(values[:-step], values[step:])
        done += step
    return values


class Contexts:
    """Runs of windows with one anchor, of several texts."""

    @classmethod
    def of(cls, texts: list[bytes], threshold: int) -> Iterator[Contexts]:
        """Contexts of a bounded number of bytes at a time."""
        pieces, size = [], 0
        for own, text in enumerate(texts):
            for begin in range(0, max(len(text) - threshold + 1, 0), CHUNK - threshold):
                piece = text[begin : begin + CHUNK - 1]
                if pieces and size + len(piece) > CHUNK:
                    yield cls._found(pieces, threshold)
                    pieces, size = [], 0
                pieces.append((own, begin, piece))
                size += len(piece)
        if pieces:
            yield cls._found(pieces, threshold)

    @classmethod
    def _found(cls, pieces: list[tuple[int, int, bytes]], threshold: int) -> Contexts:
        found = cls()
        found.threshold = threshold
        found.text = b"".join(piece for _, _, piece in pieces)
        sizes = [len(piece) for _, _, piece in pieces]
        of = np.repeat(np.arange(len(pieces)), sizes)
        grams = _spans(np.frombuffer(found.text, np.uint8), ANCHOR)
        anchor = _least(grams, threshold - ANCHOR + 1)
        place = np.flatnonzero(of[: len(anchor)] == of[threshold - 1 :])
        anchor = anchor[place]
        new = np.ones(len(place), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (place[1:] != place[:-1] + 1)
        runs = np.flatnonzero(new)
        within = np.arange(len(place)) - np.repeat(runs, np.diff(np.append(runs, len(place))))
        runs = np.flatnonzero(within % RUN == 0)
        begins = np.array([begin for _, begin, _ in pieces])
        first_byte = np.cumsum(sizes) - sizes
        piece = of[place[runs]]
        # 48 bits are sent: more of them would only save a few comparisons.
        found.anchor = (_mix(anchor[runs]) >> _U(16)).view(np.int64)
        found.windows = np.diff(np.append(runs, len(place)))
        found.at = place[runs]  # in the joined text
        found.own = np.array([own for own, _, _ in pieces])[piece]
        found.start = found.at - first_byte[piece] + begins[piece]  # in its own text
        return found

    def bodies(self, chosen: np.ndarray) -> list[bytes]:
        ends = (self.at + self.windows + self.threshold - 1)[chosen].tolist()
        return [self.text[a:b] for a, b in zip(self.at[chosen].tolist(), ends)]


# States of an anchor's row: to be resolved, known to be repeated, a repeat's one witness.
OPEN, KNOWN, WITNESS = 0, 1, 2


def _anchors(threshold: int):
    """(id, anchor, state): each once per batch. In a batch that repeats an anchor, its rows are
    known, and one witness tells the other batches."""

    def emit(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy()
            texts = batch.column(1).to_pylist()
            found = [(c.anchor, ids[c.own]) for c in Contexts.of(texts, threshold)]
            if not found:
                continue
            anchor, own = map(np.concatenate, zip(*found))
            order = np.lexsort((own, anchor))
            anchor, own = anchor[order], own[order]
            new_anchor = np.ones(len(anchor), bool)
            new_anchor[1:] = anchor[1:] != anchor[:-1]
            new = new_anchor.copy()
            new[1:] |= own[1:] != own[:-1]
            anchor, own, new_anchor = anchor[new], own[new], new_anchor[new]
            first = np.flatnonzero(new_anchor)
            several = np.diff(np.append(first, len(anchor))) > 1
            state = np.where(np.repeat(several, np.diff(np.append(first, len(anchor)))), KNOWN, OPEN)
            witness = first[several]
            yield pa.record_batch(
                [
                    pa.array(np.concatenate([own, own[witness]])),
                    pa.array(np.concatenate([anchor, anchor[witness]])),
                    pa.array(np.concatenate([state, np.full(len(witness), WITNESS)]), pa.int32()),
                ],
                names=["id", "anchor", "state"],
            )

    return emit


def _repeated(batches):
    """From rows sorted by anchor, (id, anchor) of anchors that stand under several ids.

    One row is carried from batch to batch: the last anchor's first row if that anchor is still
    open, or a witness of it.
    """
    carried = None
    for batch in batches:
        anchor, own, state = (batch.column(c).to_numpy() for c in ("anchor", "id", "state"))
        if not len(anchor):
            continue
        if carried is not None:
            anchor, own, state = (np.append(c, x) for c, x in zip(carried, (anchor, own, state)))
        first = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
        several = np.minimum.reduceat(own, first) != np.maximum.reduceat(own, first)
        several |= np.maximum.reduceat(state, first) > OPEN
        sure = np.repeat(several, np.diff(np.append(first, len(anchor))))
        last = anchor == anchor[-1]
        emitted = sure & (state != WITNESS)
        carried = anchor[-1], own[first[-1]], WITNESS if several[-1] else OPEN
        if not several[-1]:  # one id so far, perhaps on several rows
            emitted &= ~last
        yield pa.record_batch([pa.array(own[emitted]), pa.array(anchor[emitted])], names=["id", "anchor"])


_CONTEXT = "anchor long, body binary, id long, mark int, start int, windows int"


def _covered(ids: np.ndarray, bodies: list[bytes], least: dict[bytes, int]) -> np.ndarray:
    """Whether the same body is there with a smaller id, now or before in the same task."""
    if len(least) > SEEN:
        least.clear()
    for own, body in zip(ids.tolist(), bodies):
        if own < least.setdefault(body, own):
            least[body] = own
    return ids > np.fromiter(map(least.__getitem__, bodies), np.int64, len(bodies))


def _rows(anchor, bodies, ids, marks, starts, windows, least: dict[bytes, int] | None = None) -> pa.RecordBatch:
    """Rows of contexts, as they follow each other in their texts.

    Those that are covered already (all, without ``least``) need no body any more, and a run of
    them becomes one row.
    """
    covered = np.ones(len(ids), bool) if least is None else _covered(ids, bodies, least)
    joins = np.zeros(len(ids), bool)
    joins[1:] = (
        covered[1:] & covered[:-1] & (ids[1:] == ids[:-1]) & (marks[1:] == marks[:-1])
        & (starts[1:] == starts[:-1] + windows[:-1])
    )
    first = np.flatnonzero(~joins)
    windows = np.add.reduceat(windows, first) if len(first) else windows
    sent = pa.array([None if gone else bodies[i] for i, gone in zip(first.tolist(), covered[first].tolist())], pa.binary())
    numbers = [pa.array(x, pa.int32()) for x in (marks[first], starts[first], windows)]
    return pa.record_batch(
        [pa.array(anchor[first]), sent, pa.array(ids[first]), *numbers],
        names=["anchor", "body", "id", "mark", "start", "windows"],
    )


def _contexts(threshold: int):
    """The contexts of every text whose anchor is one of its repeated ones; a copy is one row."""

    def emit(batches):
        least: dict[bytes, int] = {}
        for batch in batches:
            sizes = batch.column(3).value_lengths().fill_null(0).to_numpy()
            copy = [mark in (copied or ()) for mark, copied in zip(batch.column(1).to_pylist(), batch.column(4).to_pylist())]
            copies = batch.filter(pa.array(copy))
            windows = np.array([len(text) - threshold + 1 for text in copies.column(2).to_pylist()], np.int64)
            long = np.flatnonzero(windows > 0)
            ids, marks = (copies.column(i).to_numpy()[long] for i in (0, 1))
            yield _rows(ids, [b""] * len(long), ids, marks, np.zeros(len(long), np.int64), windows[long])
            marked = np.flatnonzero((sizes > 0) & ~np.array(copy, bool))
            some = batch.take(pa.array(marked))
            ids, marks = some.column(0).to_numpy(), some.column(1).to_numpy()
            own = np.repeat(np.arange(len(marked)), sizes[marked])
            listed = _mix(some.column(3).flatten().to_numpy().view(np.uint64) + own.astype(np.uint64) * _U(_BASE))
            listed.sort()
            found = []
            for c in Contexts.of(some.column(2).to_pylist(), threshold):
                key = _mix(c.anchor.view(np.uint64) + c.own.astype(np.uint64) * _U(_BASE))
                place = np.minimum(np.searchsorted(listed, key), len(listed) - 1)
                chosen = np.flatnonzero(listed[place] == key)
                if len(chosen):
                    found.append((c.anchor[chosen], c.bodies(chosen), c.own[chosen], c.start[chosen], c.windows[chosen]))
            if found:
                anchor, bodies, own, start, windows = zip(*found)
                own = np.concatenate(own)
                yield _rows(
                    np.concatenate(anchor), [b for some in bodies for b in some], ids[own], marks[own],
                    np.concatenate(start), np.concatenate(windows), least,
                )

    return emit


def _split(threshold: int):
    """The same rows, but those of crowded anchors are cut into windows, each under its own hash."""

    def emit(batches):
        least: dict[bytes, int] = {}
        for batch in batches:
            crowded = batch.column("crowded").fill_null(False).to_numpy(zero_copy_only=False)
            crowded &= batch.column("body").is_valid().to_numpy(zero_copy_only=False)
            kept = batch.select(batch.schema.names[:-1])
            yield kept.filter(pa.array(~crowded))
            batch = kept.filter(pa.array(crowded))
            windows = batch.column("windows").to_numpy()
            of = np.repeat(np.arange(len(windows)), windows)
            within = np.arange(len(of)) - np.repeat(np.cumsum(windows) - windows, windows)
            ids, marks, starts = (batch.column(c).to_numpy()[of] for c in ("id", "mark", "start"))
            bodies = batch.column("body").to_pylist()
            cut = [bodies[i][j : j + threshold] for i, j in zip(of.tolist(), within.tolist())]
            hashes = [int.from_bytes(hashlib.blake2b(b, digest_size=8).digest(), "little", signed=True) for b in cut]
            if cut:
                yield _rows(np.array(hashes, np.int64), cut, ids, marks, starts + within, np.ones(len(of), np.int64), least)

    return emit


def suffix_order(text: np.ndarray, threshold: int) -> np.ndarray:
    """All suffixes of ``text``, the empty one first, in the order of their first ``threshold`` bytes."""
    size = len(text) + 1
    width = size.bit_length()
    used = np.flatnonzero(np.bincount(text, minlength=256))
    bits = max(1, len(used).bit_length())
    codes = np.zeros(256, np.uint64)
    codes[used] = np.arange(1, len(used) + 1)
    known = min(threshold, max(1, (64 - width) // bits))
    padded = np.zeros(size + known, np.uint64)  # zero behind the end
    padded[: size - 1] = codes[text]
    key = np.zeros(size, np.uint64)
    for j in range(known):
        key = key << _U(bits) | padded[j : size + j]
    bits *= known
    while True:
        order, new = _ordered(key, bits, width)
        if known >= threshold:
            return order
        rank = np.empty(size, np.uint64)
        rank[order] = np.cumsum(new)
        step = min(known, threshold - known)
        key = rank << _U(width)
        key[:-step] |= rank[step:]
        bits, known = 2 * width, known + step


def _ordered(key: np.ndarray, bits: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in the order of their keys, and where a key differs from the one before."""
    if bits + width <= 64:  # key and place fit in one word, and sorting words is much faster
        packed = np.sort(key << _U(width) | np.arange(len(key), dtype=np.uint64))
        order, ordered = (packed & _U((1 << width) - 1)).astype(np.int32), packed >> _U(width)
    else:
        order = np.argsort(key).astype(np.int32)
        ordered = key[order]
    return order, np.append(True, ordered[1:] != ordered[:-1])


def common_prefixes(text: np.ndarray, order: np.ndarray, threshold: int) -> np.ndarray:
    """Common prefix of every suffix in ``order`` with the one before, ``_UNSET`` if it is
    ``threshold`` or more; by breadth-first backward extension, in increasing order."""
    size = len(order)
    before = text[order - 1].copy()  # the transform; the whole text has no character before it
    none = int(np.flatnonzero(order == 0)[0])
    rows = np.argsort(before, kind="stable").astype(np.int32)
    rows = rows[rows != none]
    to_first = np.zeros(size, np.int32)
    to_first[rows] = np.arange(1, size, dtype=np.int32)  # row 0 is the empty suffix
    earlier = np.full(size, -1, np.int32)  # the last row before with the same character
    same = before[rows[1:]] == before[rows[:-1]]
    earlier[rows[1:][same]] = rows[:-1][same]
    earlier[none] = size  # never the first of an interval
    prefix = np.full(size + 1, _UNSET, np.uint8)
    prefix[[0, size]] = 0
    begins, widths = np.zeros(1, np.int32), np.array([size], np.int32)
    for length in range(threshold):
        begin = np.repeat(begins, widths)
        row = np.arange(len(begin), dtype=np.int32)
        row += np.repeat(begins - (np.cumsum(widths) - widths).astype(np.int32), widths)
        extended = to_first[row[earlier[row] < begin]]
        fresh = np.zeros(size, bool)
        fresh[extended[prefix[extended] == _UNSET]] = True
        begins = np.flatnonzero(fresh).astype(np.int32)
        if not len(begins):
            break
        prefix[begins] = length
        bounds = np.flatnonzero(prefix != _UNSET).astype(np.int32)
        widths = bounds[np.searchsorted(bounds, begins, "right")] - begins
    return prefix[:-1]


def least_documents(bodies: list[bytes], ids: np.ndarray, threshold: int) -> list[np.ndarray]:
    """For every window of each body, the least id of those whose bodies have that window."""
    text = np.frombuffer(b"".join(bodies), np.uint8)
    sizes = np.array([len(body) for body in bodies])
    order = suffix_order(text, threshold)
    prefix = common_prefixes(text, order, threshold)
    first = np.cumsum(sizes) - sizes
    place = np.arange(len(text)) - np.repeat(first, sizes)
    whole = np.append(place <= np.repeat(sizes - threshold, sizes), False)  # windows inside their body
    own = np.append(np.repeat(ids, sizes), 0)
    far = np.iinfo(np.int64).max
    interval = np.flatnonzero(prefix != _UNSET)
    least = np.minimum.reduceat(np.where(whole, own, far)[order], interval)
    of_suffix = np.empty(len(order), np.int64)
    of_suffix[order] = np.repeat(least, np.diff(np.append(interval, len(order))))
    return [of_suffix[a : a + n - threshold + 1] for a, n in zip(first.tolist(), sizes.tolist())]


def _block(threshold: int, bodies: list[bytes], ids, marks, starts) -> pa.RecordBatch:
    """Spans that a block of whole anchor groups removes."""
    least: dict[bytes, int] = {}
    for own, body in zip(ids.tolist(), bodies):
        if own < least.setdefault(body, own):
            least[body] = own
    found = dict(zip(least, least_documents(list(least), np.fromiter(least.values(), np.int64, len(least)), threshold)))
    every = [found[body] for body in bodies]
    sizes = np.array([len(x) for x in every])
    of = np.repeat(np.arange(len(bodies)), sizes)
    gone = np.concatenate(every) < ids[of]
    within = np.arange(len(of)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    opens = gone & np.append(True, ~gone[:-1] | (of[1:] != of[:-1]))
    closes = gone & np.append(~gone[1:] | (of[1:] != of[:-1]), True)
    row, begin, end = of[opens], within[opens], within[closes] + threshold
    return _span_rows(ids[row], marks[row], starts[row] + begin, starts[row] + end)


def _span_rows(ids, marks, begins, ends) -> pa.RecordBatch:
    numbers = [pa.array(x, pa.int32()) for x in (marks, begins, ends)]
    return pa.record_batch([pa.array(ids, pa.int64()), *numbers], names=["id", "mark", "begin", "end"])


def _blocks(threshold: int):
    """Rows sorted by anchor, cut into blocks of whole groups; known ones are spans already."""

    def emit(batches):
        held: list[tuple] = []
        size = 0
        for batch in batches:
            ids, marks, starts, windows = (batch.column(c).to_numpy() for c in ("id", "mark", "start", "windows"))
            missing = batch.column("body").is_null().to_numpy(zero_copy_only=False)
            if missing.any():
                yield _span_rows(ids[missing], marks[missing], starts[missing], starts[missing] + windows[missing] + threshold - 1)
            bodies, anchors = batch.column("body").to_pylist(), batch.column("anchor").to_pylist()
            for i in np.flatnonzero(~missing).tolist():
                if size >= BLOCK and anchors[i] != held[-1][0]:
                    yield _held(threshold, held)
                    held, size = [], 0
                held.append((anchors[i], bodies[i], ids[i], marks[i], starts[i]))
                size += len(bodies[i])
        if held:
            yield _held(threshold, held)

    return emit


def _held(threshold: int, held: list[tuple]) -> pa.RecordBatch:
    _, bodies, ids, marks, starts = zip(*held)
    return _block(threshold, list(bodies), *(np.array(x, np.int64) for x in (ids, marks, starts)))


def _cut(batches):
    """What is left of every text without its spans."""
    for batch in batches:
        sizes, gone, runs, kept, digests = [], [], [], [], []
        marks, texts, lists = (batch.column(i).to_pylist() for i in (1, 2, 3))
        for mark, text, spans in zip(marks, texts, lists):
            left, end, count = [], 0, 0
            for own, first, last in sorted((s["mark"], s["begin"], s["end"]) for s in spans or ()):
                if own == mark:
                    if first > end or not count:
                        left.append(text[end:first])
                        count += 1
                    end = max(end, last)
            left.append(text[end:])
            rest = b"".join(left)
            sizes.append(len(text))
            gone.append(len(text) - len(rest))
            runs.append(count)
            kept.append(rest)
            digests.append(hashlib.sha256(rest).hexdigest())
        numbers = [pa.array(x, pa.int64()) for x in (sizes, gone, runs)]
        yield pa.record_batch(
            [batch.column(0), *numbers, pa.array(kept, pa.binary()), pa.array(digests, pa.string())],
            names=["id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"],
        )


def _copies(texts: DataFrame) -> DataFrame:
    """(id, copied): the marks of an id's texts that a smaller id has too, as a whole.

    Texts are compared by their length and 128 bits of hash.
    """
    key = ["size", "h1", "h2"]
    hashed = texts.select(
        "id", "mark", F.octet_length("body").alias("size"), F.xxhash64("body").alias("h1"), F.xxhash64(F.lit(1), "body").alias("h2")
    )
    hashed = settle(hashed.distinct(), free_shuffles=True)
    firsts = hashed.groupBy(*key).agg(F.min("id").alias("first"), F.max("id").alias("last")).filter("first < last")
    # Both sides are written, so that AQE can split the key of very many copies.
    later = hashed.join(settle(firsts.drop("last"), free_shuffles=True), key).filter("first < id")
    return settle(later.groupBy("id").agg(F.collect_set("mark").alias("copied")), free_shuffles=True)


def remove_repeats(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", threshold: int = THRESHOLD
) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept, kept_sha256) of every row; ``kept`` is binary.

    ``threshold`` must be more than the anchor's 24 bytes, and at most 254.
    """
    if not ANCHOR < threshold < _UNSET:
        raise ValueError("the threshold must be more than an anchor's bytes, and less than 255")
    modest_batches(docs.sparkSession)
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    # The mark keeps texts apart that have the same id.
    texts = docs.select(
        F.col(id_column).cast("long").alias("id"),
        F.pmod(F.xxhash64(body), F.lit(1 << 24)).cast("int").alias("mark"),
        body.alias("body"),
    )
    known_ids = texts.filter("id is not null").select("id", "body")
    found = known_ids.mapInArrow(_anchors(threshold), "id long, anchor long, state int")
    route = F.when(F.col("state") == KNOWN, F.xxhash64("id")).otherwise(F.col("anchor"))
    sorted_anchors = found.repartition(route).sortWithinPartitions("anchor")
    repeated = sorted_anchors.mapInArrow(_repeated, "id long, anchor long")
    lists = settle(repeated.groupBy("id").agg(F.collect_set("anchor").alias("anchors")), free_shuffles=True)
    copies = _copies(texts.filter("id is not null"))
    # Outer joins, so that all read the same shuffle of the texts.
    wanted = texts.join(lists, "id", "left").join(copies, "id", "left")
    wanted = wanted.select("id", "mark", "body", "anchors", "copied")
    contexts = wanted.mapInArrow(_contexts(threshold), _CONTEXT)
    crowded = settle(
        lists.select(F.explode("anchors").alias("anchor")).groupBy("anchor").count().filter(F.col("count") > CROWD).select("anchor"),
        free_shuffles=True,
    )
    if crowded.head(1):
        many = broadcast_small(crowded.withColumn("crowded", F.lit(True)))[0]
        told = contexts.join(many, "anchor", "left").select(*contexts.columns, "crowded")
        contexts = told.mapInArrow(_split(threshold), _CONTEXT)
    route = F.when(F.col("body").isNull(), F.xxhash64("id")).otherwise(F.col("anchor"))
    dealt = contexts.repartition(route).sortWithinPartitions("anchor")
    spans = dealt.mapInArrow(_blocks(threshold), "id long, mark int, begin int, end int")
    listed = spans.groupBy("id").agg(F.collect_set(F.struct("mark", "begin", "end")).alias("spans"))
    marked = texts.join(listed, "id", "left").select("id", "mark", "body", "spans")
    return marked.mapInArrow(
        _cut, "id long, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string"
    )
