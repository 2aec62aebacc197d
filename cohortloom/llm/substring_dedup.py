"""Substring dedup: winnowed anchors are the seeds, extended both ways to maximal repeats.

Of any ``threshold`` consecutive words, the 5-word anchor of smallest hash is selected, so two
texts that share so many words share an anchor at the same place of them (winnowing). The
windows that select one anchor make up its context, the furthest it can be extended to both
sides without meeting another anchor. One shuffle brings equal anchors together:

* an anchor seen in one context only, in one document only, is dropped;
* occurrences whose whole context also is in a smaller document are repeats as they are;
* where an anchor has several contexts, the first document of each context is extended window
  by window: windows are matched in a second, much smaller shuffle.

Overlapping repeats make up the maximal ones, and their words are removed. No pair of documents
is made: each occurrence is only compared with its group's smallest document, so a passage with
a million copies costs a million rows. Copies that a batch of rows already shows to be
larger than another one bypass the group (they are dealt out by document), so that a hot passage
sends one row per batch to its task; groups are read as sorted streams, never held.

Keys are two independent 64-bit hashes of words and place, 128 bits in all.

Defined cases: null, empty and short texts have no windows, so nothing is removed; documents
with a null id neither remove nor lose anything; equal ids never remove each other's
words; repeated rows give repeated result rows; an empty table gives no rows; a very long text is
looked at by itself, as a whole. Only the id and text columns are read.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
import xxhash
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.common import word_chunks
from cohortloom.operators.materialize import settle

THRESHOLD = 13
ANCHOR = 5
CHUNK_WORDS = 100_000  # words that are looked at together, besides one longer text
CACHED_WORDS = 300_000

_BASE = 0x9E3779B97F4A7C1B
_INVERSE = pow(_BASE, -1, 2**64)
_ODD = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)
_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _U(29))) * _U(0xBF58476D1CE4E5B9)
    return x ^ (x >> _U(32))


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, np.uint64)
    if n:
        steps[0] = 1
    return np.cumprod(steps)


class Words:
    """Words of some documents in a row, as hashes, with the document each belongs to."""

    def __init__(self, texts: list[list[bytes]], cache: dict[bytes, int]):
        if len(cache) > CACHED_WORDS:
            cache.clear()
        for words in texts:
            for word in set(words).difference(cache):
                cache[word] = xxhash.xxh64_intdigest(word)
        self.hashes = np.fromiter((cache[w] for words in texts for w in words), np.uint64)
        self.doc = np.repeat(np.arange(len(texts)), [len(words) for words in texts])
        n = len(self.hashes)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.hashes * _powers(_BASE, n), out=self.sums[1:])
        self.back = _powers(_INVERSE, n)

    def span(self, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of the words from first up to end, wherever they stand."""
        return (self.sums[end] - self.sums[first]) * self.back[first]

    def occurrences(self, threshold: int) -> tuple[np.ndarray, ...]:
        """Anchor hash, context hash, first and last window of every selected anchor."""
        n = len(self.hashes) - threshold + 1
        if n < 1:
            return (np.empty(0, np.uint64),) * 2 + (np.empty(0, np.int64),) * 2
        grams = len(self.hashes) - ANCHOR + 1
        anchors = np.zeros(grams, np.uint64)
        for j, factor in enumerate(_ODD):
            anchors += self.hashes[j : grams + j] * factor
        anchors = _mix(anchors)
        start = np.flatnonzero(self.doc[:n] == self.doc[threshold - 1 :])
        near = sliding_window_view(anchors, threshold - ANCHOR + 1)
        chosen = np.argmin(near, axis=1)[start] + start
        new = np.ones(len(start), bool)
        new[1:] = (chosen[1:] != chosen[:-1]) | (start[1:] != start[:-1] + 1)
        first, at = start[new], chosen[new]
        last = start[np.append(new[1:], True)] if len(start) else start
        context = _mix(
            _mix(self.span(first, last + threshold) + (at - first).astype(np.uint64))
            + (last - first).astype(np.uint64) * _U(_BASE)
        )
        return anchors[at], context, first, last

    def window(self, start: np.ndarray, threshold: int) -> np.ndarray:
        return _mix(self.span(start, start + threshold))


_FIELDS = "route long, part long, id long, mark int, known boolean"


def _rows(route, part, ids, marks) -> pa.RecordBatch:
    """Rows to shuffle, with those that already have a smaller document in this batch known."""
    order = np.lexsort((marks, ids, part, route))
    route, part, ids, marks = route[order], part[order], ids[order], marks[order]
    new = np.ones(len(route), bool)
    new[1:] = (route[1:] != route[:-1]) | (part[1:] != part[:-1])
    twice = ~new
    twice[1:] &= (ids[1:] == ids[:-1]) & (marks[1:] == marks[:-1])
    least = ids[np.flatnonzero(new)][np.cumsum(new) - 1] if len(ids) else ids
    known = ids > least
    route = np.where(known, _mix(ids.astype(np.uint64)), route)
    keep = ~twice
    columns = (route.view(np.int64), part.view(np.int64), ids, marks, known)
    return pa.record_batch([pa.array(c[keep]) for c in columns], names=["route", "part", "id", "mark", "known"])


def _anchors(threshold: int):
    def emit(batches):
        cache: dict[bytes, int] = {}
        for batch in batches:
            ids, marks = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            found = []
            for first, texts in word_chunks(batch.column(2).to_pylist(), CHUNK_WORDS):
                words = Words(texts, cache)
                anchor, context, start, _ = words.occurrences(threshold)
                found.append((anchor, context, first + words.doc[start]))
            if found:
                anchor, context, doc = map(np.concatenate, zip(*found))
                yield _rows(anchor, context, ids[doc], marks[doc])

    return emit


def _resolve(batches):
    """Sorted rows in; out come rows with a smaller document (covered), and the first documents
    of every part of a route that has several parts (not covered).

    ``held`` are the first documents of the only part that the last route has had so far.
    """
    route = part = least = None
    several, held = False, None
    for batch in batches:
        r, p, ids, marks, known = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(5))
        out = [(p[known], ids[known], marks[known], np.ones(np.count_nonzero(known), bool))]
        r, p, ids, marks = (x[~known] for x in (r, p, ids, marks))
        if len(r):
            new_route = np.ones(len(r), bool)
            new_route[1:] = r[1:] != r[:-1]
            new_part = np.ones(len(r), bool)
            new_part[1:] = new_route[1:] | (p[1:] != p[:-1])
            new_route[0] = r[0] != route
            new_part[0] = new_route[0] or p[0] != part
            run, piece = np.cumsum(new_route), np.cumsum(new_part)  # 0: goes on from before
            leasts = np.concatenate([[least if least is not None else 0], ids[new_part]])[piece]
            pieces = np.bincount(run[new_part], minlength=run[-1] + 1)
            pieces[0] += 0 if route is None else 1 + several
            many = pieces[run] > 1
            above = ids > leasts
            if held is not None and pieces[0] > 1:
                out.append((*held, np.zeros(len(held[0]), bool)))
                held = None
            first = ~above & many
            for chosen, covered in ((above, True), (first, False)):
                out.append((p[chosen], ids[chosen], marks[chosen], np.full(np.count_nonzero(chosen), covered)))
            last = ~above & (run == run[-1])
            if run[-1] > 0:
                held = None
            if many[-1]:
                held = None
            else:
                now = p[last], ids[last], marks[last]
                held = now if held is None else tuple(map(np.concatenate, zip(held, now)))
                held = tuple(x[np.unique(held[2], return_index=True)[1]] for x in held)
            route, part, least, several = r[-1], p[-1], leasts[-1], bool(many[-1])
        part_out, ids_out, marks_out, covered = map(np.concatenate, zip(*out))
        yield pa.record_batch(
            [pa.array(x) for x in (part_out, ids_out, marks_out, covered)],
            names=["part", "id", "mark", "covered"],
        )


def _matched(rows: DataFrame) -> DataFrame:
    """(part, id, mark, covered) after bringing equal routes together in sorted streams."""
    order = ["known", "route", "part", "id", "mark"]
    dealt = rows.repartition("route").sortWithinPartitions(*order)
    return dealt.mapInArrow(_resolve, "part long, id long, mark int, covered boolean")


def _windows(threshold: int):
    """Rows for the windows of those contexts of each document that are to be extended."""

    def emit(batches):
        cache: dict[bytes, int] = {}
        for batch in batches:
            # Null ids have no lists, so no rows come of them.
            ids, marks = (batch.column(i).fill_null(0).to_numpy(zero_copy_only=False) for i in (0, 1))
            wanted = batch.column(3)
            listed = _lengths(wanted) > 0
            bodies = [t.as_py() if has else None for t, has in zip(batch.column(2), listed)]
            found = []
            for at, texts in word_chunks(bodies, CHUNK_WORDS):
                words = Words(texts, cache)
                anchor, context, first, last = words.occurrences(threshold)
                chosen = _members(words.doc[first], context, wanted.slice(at, len(texts)))
                anchor, first, last = anchor[chosen], first[chosen], last[chosen]
                start, of = _ranges(first, last)
                found.append((anchor[of], words.window(start, threshold), at + words.doc[start]))
            if found:
                anchor, window, doc = map(np.concatenate, zip(*found))
                yield _rows(anchor ^ window, window, ids[doc], marks[doc])

    return emit


def _lengths(lists: pa.Array) -> np.ndarray:
    return lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)


def _members(doc: np.ndarray, value: np.ndarray, lists: pa.Array) -> np.ndarray:
    """Whether each value is in the list of its document."""
    own = np.repeat(np.arange(len(lists)), _lengths(lists))
    listed = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
    return np.isin(_mix(value + doc.astype(np.uint64) * _U(_BASE)), _mix(listed + own.astype(np.uint64) * _U(_BASE)))


def _ranges(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges first..last, and which range each is of."""
    sizes = last - first + 1
    of = np.repeat(np.arange(len(first)), sizes)
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + first[of], of


def _cut(threshold: int):
    """Removes what is covered: id, word counts and the words that stay."""

    def emit(batches):
        cache: dict[bytes, int] = {}
        for batch in batches:
            texts = batch.column(1).to_pylist()
            contexts, windows = batch.column(2), batch.column(3)
            marked = (_lengths(contexts) + _lengths(windows) > 0).tolist()
            totals, gone, kept, digests = [], [], [], []
            for at, some in word_chunks(texts, CHUNK_WORDS):
                touched = marked[at : at + len(some)]
                words = Words([own if has else [] for own, has in zip(some, touched)], cache)
                _, context, first, last = words.occurrences(threshold)
                n = len(words.hashes)
                whole = _members(words.doc[first], context, contexts.slice(at, len(some)))
                start, _ = _ranges(first, last)
                single = start[_members(words.doc[start], words.window(start, threshold), windows.slice(at, len(some)))]
                edge = np.zeros(n + 1, np.int64)
                np.add.at(edge, np.concatenate([first[whole], single]), 1)
                np.add.at(edge, np.concatenate([last[whole], single]) + threshold, -1)
                stays = np.cumsum(edge)[:n] == 0
                place = 0
                for own, has in zip(some, touched):
                    left = own
                    if has:
                        left = list(compress(own, stays[place : place + len(own)].tolist()))
                        place += len(own)
                    text = b" ".join(left)
                    totals.append(len(own))
                    gone.append(len(own) - len(left))
                    kept.append(text.decode())
                    digests.append(hashlib.sha256(text).hexdigest())
            yield pa.record_batch(
                [batch.column(0), pa.array(totals, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string()), pa.array(digests, pa.string())],
                names=["id", "n_words", "n_removed", "kept_text", "kept_sha256"],
            )

    return emit


def remove_repeats(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", threshold: int = THRESHOLD,
) -> DataFrame:
    """(id, n_words, n_removed, kept_text, kept_sha256) of every row.

    Removed is each word inside ``threshold`` consecutive words that also stand in a document
    with a smaller id. ``threshold`` must be more than the anchor's five words.
    """
    if threshold <= ANCHOR:
        raise ValueError("the threshold must be more than an anchor's words")
    body = F.coalesce(F.col(text), F.lit(""))
    # The mark keeps texts apart that have the same id.
    texts = docs.select(
        F.col(id_column).cast("long").alias("id"),
        F.pmod(F.xxhash64(body), F.lit(1 << 24)).cast("int").alias("mark"),
        body.alias("text"),
    )
    key = ["id", "mark"]
    seeds = texts.filter("id is not null").mapInArrow(_anchors(threshold), _FIELDS)
    matched = settle(
        _matched(seeds)
        .groupBy(*key)
        .agg(
            F.collect_set(F.when(F.col("covered"), F.col("part"))).alias("contexts"),
            F.collect_set(F.when(~F.col("covered"), F.col("part"))).alias("open"),
        )
    )
    # An outer join like the last one, so that both read the same shuffle of the texts.
    extend = texts.join(matched.select(*key, "open"), key, "left")
    windows = extend.select(*key, "text", "open").mapInArrow(_windows(threshold), _FIELDS)
    singles = _matched(windows).filter("covered").groupBy(*key).agg(F.collect_set("part").alias("windows"))
    marked = texts.join(matched.drop("open"), key, "left").join(singles, key, "left")
    return marked.select("id", "text", "contexts", "windows").mapInArrow(
        _cut(threshold),
        "id long, n_words long, n_removed long, kept_text string, kept_sha256 string",
    )
