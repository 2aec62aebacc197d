"""Best-fit packing of token sequences by a configuration linear program.

Only the histogram of piece lengths reaches the driver (one count per length up to the
capacity). A configuration says how many pieces of each length share one full sequence. The linear
program, fewest configurations that cover the histogram, is solved by multiplicative weights:
each length has a weight that falls exponentially with its coverage, a knapsack by dynamic programming
prices all rooms of a sequence, and configurations are traced through it from the pieces that there
are, one around every length per round. The fractional solution is rounded; what rounding leaves over is
solved as a program of its own, until one places less than a hundredth of the tokens. The few pieces that remain are packed by
best fit. The work on the driver depends on the capacity, not on the number of documents.

Pieces of one length are interchangeable, so a piece only needs its rank among those of its
length: counts per (length, salt) give the rank's start, a window within (length, salt) the rest.
A length that a third of all pieces have is spread over the salts. A binary search in the slot table, whose
size is bounded by lengths and rounds, turns the rank into a sequence and an offset.

Defined cases: null and empty texts are one piece, the end token; only documents above the
capacity are cut, and only their last piece may be shorter; repeated rows are packed once each;
a very long text is encoded by itself and cut; an empty table gives an empty result. Other columns are
not looked at.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, compress, groupby
from operator import not_

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from cohortloom.llm.common import modest_batches
from cohortloom.operators.materialize import settle

CAPACITY = 4096
END_ID = 1
CACHED_WORDS = 200_000  # of each generation
MARK = "\x01"  # one token between words that are encoded together
# Fixed value: a pre-tokenizer's pattern that keeps runs of letters, single digits and runs of other marks.
LETTER_RUNS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# ASCII marks that begin another run behind a letter; not those of contractions or special tokens.
MARKS = b".,;:!?$%&#*()[]{}\"-_+=/~^@`\\"
# Words that normalizers leave as they are and the pattern keeps whole: small letters of ASCII and Latin-1.
PLAIN = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+").fullmatch
PLAIN_NORMALIZERS = {"NFC", "Lowercase", "Replace"}
# Bytes by what they are to the cuts: white space, letters and digits of ASCII, marks, and the rest.
SPACE, END, MARKED = 1, 2, 3
KINDS = bytes(
    SPACE if i in b" \t\n\v\f\r" else END if i < 128 and chr(i).isalnum() else MARKED if i in MARKS else 0
    for i in range(256)
)
LATIN = 0xC3  # leads the letters of Latin-1, and two signs
LATIN_SIGNS = b"\x97\xb7"
CHUNK_BYTES = 1 << 22  # of texts that are encoded together, besides one longer text
ROUNDS = 4
EPSILON = 1e-9
LEAST_SHARE = 0.01  # of all tokens that another program must place for one more
PIECES_PER_SALT = 100_000


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _steps(parts: dict, name: str) -> list[dict]:
    step = parts.get(name) or {}
    return step.get(f"{name}s") or step.get(f"{name.replace('_', '')}s") or [step]


def _joined(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[pa.Array, pa.Array]]:
    """Ids and texts, null ones empty, of consecutive batches up to about ``limit`` bytes."""
    some, size = [], 0
    for batch in batches:
        texts = batch.column(1).cast(pa.large_binary()).fill_null(b"")
        if some and size + texts.nbytes > limit:
            yield tuple(map(pa.concat_arrays, zip(*some)))
            some, size = [], 0
        some.append((batch.column(0), texts))
        size += texts.nbytes
    if some:
        yield tuple(map(pa.concat_arrays, zip(*some)))


def _chunks(texts: pa.Array, limit: int) -> Iterator[pa.Array]:
    """Consecutive texts, up to ``limit`` bytes together, or one longer text."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(), dtype=np.int64)
    first = 0
    while first < len(texts):
        before = int(ends[first - 1]) if first else 0
        stop = max(first + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield texts.slice(first, stop - first)
        first = stop


def _cuts(data: bytes, starts: np.ndarray, marks: bool) -> np.ndarray:
    """Where the parts of adjoining texts begin: a word with the white space before it and, with
    ``marks``, what begins with a mark behind a letter or digit."""
    kinds = np.frombuffer(data.translate(KINDS), np.uint8)
    cut = np.zeros(len(data) + 1, bool)
    space = kinds == SPACE
    np.greater(space[1:], space[:-1], out=cut[1:-1])
    if marks:
        ends = kinds == END
        raw = np.frombuffer(data, np.uint8)
        latin = np.flatnonzero(raw[:-1] == LATIN) + 1
        ends[latin] = ~np.isin(raw[latin], np.frombuffer(LATIN_SIGNS, np.uint8))
        cut[1:-1] |= (kinds[1:] == MARKED) & ends[:-1]
    cut[starts] = True
    return np.flatnonzero(cut[:-1])


class TokenCache:
    """Ids of words as little-endian bytes.

    The tokenizer drops white space and neither normalizes nor merges across it, so a text's
    ids are those of its words in a row; so it is with marks behind letters, if its pattern parts them.
    The texts of a chunk lie side by side in Arrow: its distinct parts are found by a dictionary, looked
    up once, and put in a row by one gather. Words met for the first time are encoded together, plain
    ones without the tokenizer's normalizer and pattern, which would leave them as they are.
    The cache has two generations: when the young one is full it becomes the old one, whose words
    come back when they are met again, and those that are not are forgotten with the next one.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        parts = json.loads(self.tokenizer.to_str())
        normalizers, splitters = _steps(parts, "normalizer"), _steps(parts, "pre_tokenizer")
        #: Whether the tokenizer makes letters small, so that words may be given so.
        self.lower = any(step.get("type") == "Lowercase" for step in normalizers)
        self.special = [token["content"].encode() for token in parts.get("added_tokens") or ()]
        #: Whether it parts marks from the letters before them, so that each is encoded by itself.
        self.parts_marks = any(step.get("pattern") == {"Regex": LETTER_RUNS} for step in splitters) and all(
            len(_cuts(token, np.array([0]), True)) == 1 for token in self.special
        )
        self.plain = self._plain(path, parts, normalizers, splitters)
        self.ids: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        (self.mark,) = self._each([MARK])[0]

    def _plain(self, path: str, parts: dict, normalizers: list[dict], splitters: list[dict]):
        """The tokenizer without its normalizer and pattern, for words that need neither, or None.

        A token of the model's suffix ends a word, so that no mark is needed between words either.
        """
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, CharDelimiterSplit, Sequence

        model, vocabulary = parts["model"], self.tokenizer.get_vocab(with_added_tokens=False)
        suffix, letters = model.get("end_of_word_suffix"), ByteLevel.alphabet()
        steps = {step.get("type") for step in normalizers}
        spaces = [step for step in normalizers if step.get("type") == "Replace"]
        if not (
            model.get("type") == "BPE" and suffix and not model.get("dropout") and self.lower and self.parts_marks
            and steps <= PLAIN_NORMALIZERS and all(step["pattern"] == {"Regex": r"\s+"} for step in spaces)
            and [step.get("type") for step in splitters] == ["Split", "ByteLevel"]
            and not splitters[1].get("use_regex") and not splitters[1].get("add_prefix_space")
            and all(letter in vocabulary and letter + suffix in vocabulary for letter in letters)
        ):
            return None
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[number for token, number in vocabulary.items() if token.endswith(suffix)]] = True
        plain = Tokenizer.from_file(path)
        plain.normalizer = None
        plain.pre_tokenizer = Sequence([CharDelimiterSplit(" "), ByteLevel(add_prefix_space=False, use_regex=False)])
        return plain

    def _each(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn_all(self, words: set[bytes]) -> None:
        """Encode new words, plain ones apart."""
        new = list(words)
        kinds = list(map(PLAIN, new)) if self.plain else [None] * len(new)
        plain, new = list(compress(new, kinds)), list(compress(new, map(not_, kinds)))
        for at in range(0, len(plain), 8_192):
            self._learn_plain(plain[at : at + 8_192])
        for at in range(0, len(new), 8_192):
            self._learn(new[at : at + 8_192])

    def _learn_plain(self, words: list[bytes]) -> None:
        """Encode plain words many at a time."""
        joint = [b" ".join(words[i : i + 64]).decode() for i in range(0, len(words), 64)]
        found = [e.ids for e in self.plain.encode_batch_fast(joint, add_special_tokens=False)]
        ids = np.fromiter(chain.from_iterable(found), "<u4", sum(map(len, found)))
        stops = (4 * np.flatnonzero(self.ends[ids]) + 4).tolist()
        data = ids.tobytes()
        for word, start, stop in zip(words, [0, *stops], stops):
            self.ids[word] = data[start:stop]

    def _learn(self, words: list[bytes]) -> None:
        """Encode words many at a time, with a mark of one known id between them."""
        plain = [w for w in words if MARK.encode() not in w]
        groups = [plain[i : i + 64] for i in range(0, len(plain), 64)]
        joint = self._each([f" {MARK} ".join(w.decode() for w in group) for group in groups])
        for group, found in zip(groups, joint):
            ids = np.array(found, "<u4")
            ends = np.append(np.flatnonzero(ids == self.mark), len(ids)).tolist()
            data, at = ids.tobytes(), 0
            for word, stop in zip(group, ends):
                self.ids[word] = data[4 * at : 4 * stop]
                at = stop + 1
        odd = [w for w in words if MARK.encode() in w]
        for word, found in zip(odd, self._each([w.decode() for w in odd])):
            self.ids[word] = array("I", found).tobytes()

    def _find(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word; those of new ones are found."""
        if len(self.ids) > CACHED_WORDS:
            self.old, self.ids = self.ids, {}
        found = list(map(self.ids.get, words))
        missing = [i for i, ids in enumerate(found) if ids is None]
        new = {words[i] for i in missing}
        known = new.intersection(self.old)
        self.ids.update(zip(known, map(self.old.__getitem__, known)))
        self._learn_all(new.difference(known))
        for i in missing:
            found[i] = self.ids[words[i]]
        return found

    def _encode_chunk(self, texts: pa.Array) -> Iterator[bytes]:
        stops = np.cumsum(pc.binary_length(texts).to_numpy(), dtype=np.int64)
        if not stops[-1]:
            yield from (b"" for _ in texts)
            return
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset :]
        data = texts.buffers()[2][int(offsets[0]) : int(offsets[0] + stops[-1])].to_pybytes()
        small = data.lower() if self.lower else data
        # The tokenizer looks for special tokens before it makes letters small: none may come from capitals.
        if all(small.count(token) == data.count(token) for token in self.special):
            data = small
        bounds = np.append(0, stops)
        cuts = np.append(_cuts(data, bounds, self.parts_marks), len(data))
        parts = pa.Array.from_buffers(pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer(cuts), pa.py_buffer(data)])
        parts = parts.dictionary_encode()
        words = self._find([part.strip() for part in parts.dictionary.to_numpy(zero_copy_only=False)])
        found = pa.array(words, pa.large_binary()).take(parts.indices)
        ends = np.frombuffer(found.buffers()[1], np.int64)[np.searchsorted(cuts, bounds)].tolist()
        for start, stop in zip(ends, ends[1:]):
            yield found.buffers()[2][start:stop].to_pybytes()

    def encode_texts(self, texts: pa.Array) -> Iterator[bytes]:
        """The ids of each text, given as large binary without nulls."""
        for chunk in _chunks(texts, CHUNK_BYTES):
            yield from self._encode_chunk(chunk)

    def encode(self, texts: list[list[bytes]]) -> Iterator[bytes]:
        """The ids of each text, given as its words."""
        return self.encode_texts(pa.array(map(b" ".join, texts), pa.large_binary()))


@lru_cache(maxsize=1)
def _token_cache(path: str) -> TokenCache:
    return TokenCache(path)


def pieces(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
    tokenizer: str | None = None, with_ids: bool = False,
) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids]): every document's ids with the end token, cut."""
    path = tokenizer or default_tokenizer()
    end = array("I", [END_ID]).tobytes()
    id_type = docs.schema[id_column].dataType
    fields = [
        T.StructField("id", id_type), T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
    ]
    names = [f.name for f in fields]
    if with_ids:
        fields.append(T.StructField("ids", T.BinaryType()))

    def cut(batches):
        cache = _token_cache(path)
        size = 4 * capacity
        for doc_ids, texts in _joined(batches, CHUNK_BYTES):
            row, piece, length, crc, ids = [], [], [], [], []
            for i, data in enumerate(cache.encode_texts(texts)):
                data += end
                for k in range(0, len(data), size):
                    part = data[k : k + size]
                    row.append(i)
                    piece.append(k // size)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(part)
            numbers = np.array(piece, np.int64)
            columns = [
                doc_ids.take(pa.array(row, pa.int64())), pa.array(numbers.astype(np.int32)),
                pa.array(numbers * capacity), pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
            ]
            if with_ids:
                columns.append(pa.array(ids, pa.binary()))
            yield pa.record_batch(columns, names=names + ["ids"] * with_ids)
        pa.default_memory_pool().release_unused()  # the worker stays for other tasks

    modest_batches(docs.sparkSession)
    chosen = docs.select(F.col(id_column).alias("id"), F.col(text).cast("string").alias("text"))
    return chosen.mapInArrow(cut, T.StructType(fields))


Pattern = tuple[tuple[int, int], ...]  # (length, how many), longest first


def _price(lengths: np.ndarray, value: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Knapsack values of every room up to the capacity, and how many lengths fit in it."""
    best = np.zeros(capacity + 1)
    fits = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
    for room in range(int(lengths[0]), capacity + 1):
        k = fits[room]
        best[room] = max(0.0, (best[room - lengths[:k]] + value[:k]).max())
    return best, fits


def _configurations(lengths: np.ndarray, counts: np.ndarray, capacity: int, rounds: int) -> dict[Pattern, float]:
    """A fractional packing of the histogram into full sequences, by multiplicative weights.

    Each round prices the lengths anew and lets every length be covered by another ``1 / rounds``.
    Around every length that still may be, longest first, the knapsack is traced
    through what is left: a piece may be used as often as it exists and while its length may still be
    covered. A configuration that fills a sequence is raised until a length of it is covered.
    """
    covered = np.zeros(len(lengths))
    amount: dict[Pattern, float] = {}
    for turn in range(1, rounds + 1):
        # Weight by length is the optimal price of a perfect packing; coverage tilts it.
        value = lengths / capacity * np.exp(-(covered - covered.min()))
        best, fits = _price(lengths, value, capacity)
        free = turn / rounds - covered
        for first in range(len(lengths) - 1, -1, -1):
            if free[first] < EPSILON:
                continue
            used, room = {first: 1}, capacity - int(lengths[first])
            while k := fits[room]:
                total = np.where(free[:k] >= EPSILON, best[room - lengths[:k]] + value[:k], -1.0)
                for i, n in used.items():
                    if i < k and n >= counts[i]:
                        total[i] = -1.0
                i = int(total.argmax())
                if total[i] < 0:
                    break
                used[i] = used.get(i, 0) + 1
                room -= int(lengths[i])
            if room:
                continue
            raise_by = min(free[i] * counts[i] / n for i, n in used.items())
            for i, n in used.items():
                covered[i] += raise_by * n / counts[i]
                free[i] -= raise_by * n / counts[i]
            pattern = tuple(sorted(((int(lengths[i]), n) for i, n in used.items()), reverse=True))
            amount[pattern] = amount.get(pattern, 0.0) + raise_by
    return amount


def _program(histogram: dict[int, int], capacity: int, rounds: int) -> Iterator[tuple[Pattern, int]]:
    """Configurations of the rounded linear program, with how many sequences each fills.

    Amounts are rounded down, then up by their fractions, largest first, as far as pieces are left.
    What rounding leaves over is a histogram again, and a program of its own, until one places less
    than ``LEAST_SHARE`` of all tokens.
    """
    left = dict(histogram)
    while any(left.values()):
        lengths = np.array(sorted(n for n, c in left.items() if c))
        counts = np.array([left[int(n)] for n in lengths])
        found = _configurations(lengths, counts, capacity, rounds)
        whole = {pattern: int(amount + EPSILON) for pattern, amount in found.items()}
        steps = list(whole.items())
        rest = {pattern: found[pattern] - n for pattern, n in whole.items()}
        steps += [(p, 1) for p in sorted(rest, key=lambda p: (-rest[p], p)) if rest[p] > EPSILON]
        taken = 0
        for pattern, times in steps:
            times = min([times, *(left[length] // n for length, n in pattern)])
            if times:
                taken += times
                for length, n in pattern:
                    left[length] -= n * times
                yield pattern, times
        if taken * capacity < LEAST_SHARE * sum(n * c for n, c in histogram.items()):
            return


def _best_fit(left: dict[int, int], capacity: int) -> Iterator[tuple[Pattern, int]]:
    """Best fit on a histogram, whole multiples at a time."""
    active = sorted(n for n, c in left.items() if c)
    while active:
        used: Counter[int] = Counter()
        room = capacity
        while (at := bisect_right(active, room)) and room:
            length = active[at - 1]
            while at and used[length] >= left[length]:
                at -= 1
                length = active[at - 1] if at else 0
            if not at:
                break
            fit = min(room // length, left[length] - used[length])
            used[length] += fit
            room -= fit * length
        pattern = tuple(sorted(used.items(), reverse=True))
        times = min(left[length] // n for length, n in pattern)
        for length, n in pattern:
            left[length] -= n * times
        yield pattern, times
        active = [n for n in active if left[n]]


def plan(histogram: dict[int, int], capacity: int = CAPACITY, rounds: int = ROUNDS) -> list[tuple[Pattern, int]]:
    """Configurations and how many sequences each fills; together exactly the histogram."""
    left = {n: c for n, c in histogram.items() if c > 0}
    chosen = []
    for pattern, times in _program(left, capacity, rounds):
        chosen.append((pattern, times))
        for length, n in pattern:
            left[length] -= n * times
    return chosen + list(_best_fit(left, capacity))


def _slots(chosen: list[tuple[Pattern, int]], histogram: dict[int, int]) -> dict[str, np.ndarray]:
    """Runs of ranks, by length: where they begin and which sequences and offsets they get."""
    sequence, rows = 0, []
    for pattern, times in chosen:
        offset = 0
        for length, n in pattern:
            rows.append((length, n, times, sequence, offset))
            offset += length * n
        sequence += times
    rows.sort(key=lambda r: r[0])
    base = dict(zip(sorted(histogram), np.cumsum([0, *(histogram[n] for n in sorted(histogram))])))
    begin, kept = [], []
    for length, group in groupby(rows, key=lambda r: r[0]):
        rank = int(base[length])
        for row in group:
            begin.append(rank)
            kept.append(row)
            rank += row[1] * row[2]
    columns = np.array(kept, np.int64).reshape(-1, 5).T
    lengths = np.array(sorted(histogram), np.int64)
    return {
        "begin": np.array(begin, np.int64), "n": columns[1], "sequence": columns[3],
        "offset": columns[4], "lengths": lengths, "base": np.array([base[n] for n in sorted(histogram)], np.int64),
    }


def pack(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
    tokenizer: str | None = None, with_ids: bool = False, rounds: int = ROUNDS,
) -> DataFrame:
    """The pieces with sequence_id and offset (place in the sequence, from 0, without gaps)."""
    cut = settle(pieces(docs, id_column, text, capacity, tokenizer, with_ids))
    histogram = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}
    slots = docs.sparkSession.sparkContext.broadcast(
        _slots(plan(histogram, capacity, rounds), histogram)
    )
    salts = 16 + sum(histogram.values()) // PIECES_PER_SALT
    order = ["id", "piece", "ids_crc32"]
    salted = cut.withColumn("_salt", F.pmod(F.xxhash64(F.col("id").cast("string"), "piece"), F.lit(salts)))
    earlier = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        salted.groupBy("length", "_salt").agg(F.count(F.lit(1)).alias("_n"))
        .select("length", "_salt", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    )
    within = Window.partitionBy("length", "_salt").orderBy(*order)
    ranked = salted.join(starts, ["length", "_salt"]).withColumn(
        "_rank", F.col("_start") + F.row_number().over(within) - 1
    )

    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        s = slots.value
        size = length.to_numpy(np.int64)
        at = s["base"][np.searchsorted(s["lengths"], size)] + rank.to_numpy(np.int64)
        run = np.searchsorted(s["begin"], at, side="right") - 1
        turn, slot = np.divmod(at - s["begin"][run], s["n"][run])
        return pd.DataFrame({"sequence_id": s["sequence"][run] + turn, "offset": s["offset"][run] + slot * size})

    placed = F.pandas_udf(place, "sequence_id long, offset long")("length", "_rank")
    return ranked.withColumn("_at", placed).select(
        F.col("id").alias(id_column), *(c for c in cut.columns if c != "id"), "_at.sequence_id", "_at.offset"
    )


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, length, ids): whole sequences of pieces packed ``with_ids``."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids", "length")))
    joined = packed.groupBy("sequence_id").agg(parts.alias("parts"))
    ids = F.aggregate("parts", F.lit(b""), lambda done, part: F.concat(done, part["ids"]))
    length = F.aggregate("parts", F.lit(0).cast("bigint"), lambda n, part: n + part["length"])
    return joined.select("sequence_id", length.alias("length"), ids.alias("ids"))
