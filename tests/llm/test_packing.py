import json
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cohortloom.llm import packing as p
from .helpers import SMALL, documents


@given(st.dictionaries(st.integers(1, 64), st.integers(1, 400), max_size=30))
@settings(deadline=None, max_examples=30)
def test_plan_uses_exactly_the_histogram(histogram):
    chosen = p.plan(histogram, 64, 8)
    used = defaultdict(int)
    for pattern, times in chosen:
        assert times > 0 and sum(length * n for length, n in pattern) <= 64
        for length, n in pattern:
            used[length] += n * times
    assert used == histogram


def test_plan_is_near_the_bound():
    random = np.random.default_rng(2)
    sizes = np.minimum(4096, random.lognormal(6, 1, 20_000).astype(int) + 1)
    values, counts = np.unique(sizes, return_counts=True)
    chosen = p.plan(dict(zip(values.tolist(), counts.tolist())), 4096, 6)
    assert sum(times for _, times in chosen) <= 1.002 * sizes.sum() / 4096 + 1


def test_the_program_places_nearly_all_tokens(spark):
    cache = p.TokenCache(p.default_tokenizer())
    texts = [(r.text or "").encode().lower().split() for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("text").collect()]
    histogram = Counter()
    for at in range(0, len(texts), 1_000):
        for data in cache.encode(texts[at : at + 1_000]):
            whole, rest = divmod(len(data) // 4 + 1, 4096)
            histogram.update({4096: whole, rest: 1} if rest else {4096: whole})
    histogram = {n: c for n, c in histogram.items() if c}
    total = sum(n * c for n, c in histogram.items())
    placed = list(p._program(histogram, 4096, p.ROUNDS))
    assert all(sum(length * n for length, n in pattern) == 4096 for pattern, _ in placed)
    assert sum(times for _, times in placed) * 4096 >= 0.95 * total
    assert sum(times for _, times in p.plan(histogram)) <= 1.002 * total / 4096 + 1


def expected_ids(texts):
    tokenizer = Tokenizer.from_file(p.default_tokenizer())
    return [tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for t in texts]


def check(packed, texts_by_id, capacity):
    ids = dict(zip(texts_by_id, expected_ids(texts_by_id.values())))
    got = packed.collect()
    pieces, places = defaultdict(list), defaultdict(list)
    for r in got:
        own = np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4").tobytes()
        assert (r.length, r.ids_crc32, r.start) == (len(own) // 4, zlib.crc32(own), r.piece * capacity)
        pieces[r.doc_id].append((r.start, r.length))
        places[r.sequence_id].append((r.offset, r.length))
    for sequence in places.values():
        end = 0
        for offset, length in sorted(sequence):
            assert offset == end
            end += length
        assert end <= capacity
    return ids, pieces, len(places)


def test_whole_table_unpacks_to_its_ids(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    packed = p.pack(docs, with_ids=True)
    ids, pieces, sequences = check(packed, texts, 4096)
    assert {i: sum(n for _, n in own) for i, own in pieces.items()} == {i: len(x) for i, x in ids.items()}
    assert sequences <= sum(map(len, ids.values())) / 4096 * 1.02 + 1
    whole = p.sequences(packed).collect()
    assert sum(r.length for r in whole) == sum(map(len, ids.values()))
    assert all(len(r.ids) == 4 * r.length <= 4 * 4096 for r in whole)


def test_odd_texts(spark):
    texts = {1: None, 2: "", 3: " \n ", 4: "a " * 100, 5: "x" * 300, 6: "İstanbul ΣΑΣ \x01 a\x01b don't", None: "n"}
    docs = documents(spark, list(texts.items()) + [(4, texts[4])] * 2)
    packed = p.pack(docs, capacity=16)
    assert packed.filter("doc_id = 4").count() == 3 * 7
    check(packed, texts, 16)
    assert p.pack(documents(spark, [])).count() == 0


@pytest.mark.parametrize("limit", [1, 600_000])
def test_cache_limit_does_not_change_ids(monkeypatch, limit):
    monkeypatch.setattr(p, "CACHED_WORDS", limit)
    cache = p.TokenCache(p.default_tokenizer())
    texts = ["The cat's hat", "<|endoftext|>x", "\x01", "é é " + "q" * 99, "the THE The"]
    for _ in range(2):
        found = list(cache.encode([t.encode().split() for t in texts]))
        assert [np.frombuffer(x, "<u4").tolist() + [1] for x in found] == expected_ids(texts)


def odd_words(seed):
    rng = random.Random(seed)
    parts = ("The", "CAT", "é", "É", "ç", "ÿ", "×", "÷", "ß", "İ", "I\u0307", "e\u0301", "'s", "'LL", "n't", "1", "23", ".", ",", "?!", "...", ";", ":", "\u2026", "漢", "Σ", "ς", "\u00a0", "\u0085", "😀", "-", "_", "\x01", "Ω.", "\xb5")
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 5))) for _ in range(400)]


@pytest.mark.parametrize("seed", range(4))
def test_words_and_marks_apart_give_the_same_ids(monkeypatch, seed):
    monkeypatch.setattr(p, "CACHED_WORDS", (10, 1_000)[seed % 2])
    cache = p.TokenCache(p.default_tokenizer())
    assert cache.lower and cache.parts_marks
    words = odd_words(seed)
    texts = [" ".join(words[i : i + 7]) for i in range(0, len(words), 7)]
    for some in (texts, texts[::-1]):
        split = [t.encode().lower().split() for t in some]
        found = [x for at in range(0, len(split), 5) for x in cache.encode(split[at : at + 5])]
        assert [np.frombuffer(x, "<u4").tolist() + [1] for x in found] == expected_ids(some)


def test_tokenizers_that_keep_capitals_are_given_them():
    cache = p.TokenCache(p.default_tokenizer())
    steps = {"normalizer": None, "pre_tokenizer": {"type": "Sequence", "pretokenizers": [{"type": "Digits"}]}}
    assert p._steps(steps, "normalizer") == [{}] and p._steps(steps, "pre_tokenizer") == [{"type": "Digits"}]
    assert p._steps({"normalizer": {"type": "Lowercase"}}, "normalizer") == [{"type": "Lowercase"}]
    assert cache.mark is not None


def test_plain_words_pass_by_the_normalizer_and_the_pattern(monkeypatch):
    cache = p.TokenCache(p.default_tokenizer())
    given, each = [], cache._each
    monkeypatch.setattr(cache, "_each", lambda texts: given.extend(texts) or each(texts))
    words = "the gaßt größe été ÿ naïve zuzuzu $the été$$$ hat%% x&&, y***. größe" + " q" * 3 + " a" * 500
    (found,) = cache.encode([words.encode().lower().split()])
    assert np.frombuffer(found, "<u4").tolist() + [1] == expected_ids([words])[0]
    joint = " ".join(given).replace("$the", "")
    assert joint and not any(c.isalpha() for c in joint)


def test_special_tokens_and_letters_that_change_are_not_plain():
    cache = p.TokenCache(p.default_tokenizer())
    words = "<|endoftext|> a<|endoftext|> <|endoftext| x<|startoftext|>!! a\u0301 e\u0301$$ ªb µ a÷b É× it's%% x'$$ it's's-- \u0130x aÀ #a# 'll'".split()
    assert not any(p.PLAIN(w.encode().lower()) for w in words)
    assert all(p.PLAIN(chr(c).encode()) for c in [*range(0x61, 0x7B), *range(0xDF, 0xF7), *range(0xF8, 0x100)])
    (found,) = cache.encode([[w.encode().lower() for w in words]])
    assert np.frombuffer(found, "<u4").tolist() + [1] == expected_ids([" ".join(words)])[0]


def test_tokenizers_with_other_steps_have_no_plain_words():
    cache = p.TokenCache(p.default_tokenizer())
    parts = json.loads(cache.tokenizer.to_str())
    normalizers, splitters = p._steps(parts, "normalizer"), p._steps(parts, "pre_tokenizer")
    path = p.default_tokenizer()
    assert cache._plain(path, parts, normalizers, splitters)
    assert not cache._plain(path, parts, [*normalizers, {"type": "StripAccents"}], splitters)
    assert not cache._plain(path, parts, [*normalizers, {"type": "Replace", "pattern": {"String": "a"}}], splitters)
    assert not cache._plain(path, parts, normalizers, splitters[:1])
    assert not cache._plain(path, parts | {"model": parts["model"] | {"end_of_word_suffix": None}}, normalizers, splitters)


def test_marks_inside_words_are_parted_from_the_letters_before(monkeypatch):
    cache = p.TokenCache(p.default_tokenizer())
    given, each = [], cache._each
    monkeypatch.setattr(cache, "_each", lambda texts: given.extend(texts) or each(texts))
    words = "zuzuz.,zozoz.. größé--! a1.5 3.,4 x_≠y é×.ü÷.a ç..'s z.'the f.<|endoftext|>.g <|endoftext|>.h ⃃.a"
    (found,) = cache.encode([words.encode().split()])
    assert np.frombuffer(found, "<u4").tolist() + [1] == expected_ids([words])[0]
    pieces = " ".join(given).split()
    assert {".,zozoz", "..", "--!", "_≠y", "é×.ü÷.a", "..'s", ".'the", ".<|endoftext|>.g"} <= set(pieces)
    assert not {"zuzuz", "größé", "x", "ç"} & set(pieces)


def test_a_word_is_looked_up_once_for_many_texts(monkeypatch):
    cache = p.TokenCache(p.default_tokenizer())
    looked_up, find = [], cache._find
    monkeypatch.setattr(cache, "_find", lambda words: looked_up.extend(words) or find(words))
    texts = ["the cat, the hat", " the cat, a hat ", None, "", "the", " \n "] * 300
    batches = [
        pa.record_batch([pa.array(range(len(some))), pa.array(some, pa.string())], names=["id", "text"])
        for some in (texts[i : i + 100] for i in range(0, len(texts), 100))
    ]
    (joined,) = p._joined(iter(batches), p.CHUNK_BYTES)
    found = list(cache.encode_texts(joined[1]))
    assert [np.frombuffer(x, "<u4").tolist() + [1] for x in found[:6]] == expected_ids(texts[:6])
    assert found == found[:6] * 300
    assert len(looked_up) < 20


@pytest.mark.parametrize("limit", [1, 100, 1 << 23])
def test_texts_side_by_side_do_not_touch(monkeypatch, limit):
    monkeypatch.setattr(p, "CHUNK_BYTES", limit)
    cache = p.TokenCache(p.default_tokenizer())
    texts = ["a", ".b", "c ", " d", "", "é", "́", "e", "́.", None, "<|endof", "text|>", "x\xa0y", "\x85z", "\x1cq", " ", "'", "s"] * 3
    texts += [" ".join(odd_words(7))]
    batches = [pa.record_batch([pa.array(range(60))[: len(some)], pa.array([*some, "k"], pa.string())[:-1]], names=["id", "text"]) for some in (texts[:7], texts[7:])]
    sliced = [pa.record_batch([b.column(0), b.column(1)], names=["id", "text"]).slice(1) for b in batches]
    ids = [i for some, _ in p._joined(iter(sliced), limit) for i in some.to_pylist()]
    assert ids == [*range(1, 7), *range(1, len(texts) - 7)]
    found = [x for _, some in p._joined(iter(sliced), limit) for x in cache.encode_texts(some)]
    assert [np.frombuffer(x, "<u4").tolist() + [1] for x in found] == expected_ids(texts[1:7] + texts[8:])


def test_special_tokens_with_marks_behind_letters_stay_whole(tmp_path):
    tokenizer = Tokenizer.from_file(p.default_tokenizer())
    tokenizer.add_special_tokens(["<|end_of_text|>"])
    tokenizer.save(str(tmp_path / "t.json"))
    words = "zu.zu <|end_of_text|> the.<|end_of_text|>, cat."
    (found,) = p.TokenCache(str(tmp_path / "t.json")).encode([words.encode().split()])
    assert np.frombuffer(found, "<u4").tolist() == tokenizer.encode(words, add_special_tokens=False).ids


def test_capitals_make_no_special_token(spark):
    texts = {1: "A <|ENDOFTEXT|> B<|EndOfText|>. The", 2: "A <|endoftext|> The", 3: "THE <|StartOfText|>"}
    check(p.pack(documents(spark, list(texts.items())), capacity=64), texts, 64)


def test_memory_beside_the_texts_is_bounded():
    """A worker encodes 16 MB of texts with 16 MB of Arrow's memory: 8 MB of them at a time took 32."""
    source = random.Random(5)
    vocabulary = ["".join(source.choices("abcdefghij", k=source.randint(2, 9))) for _ in range(3_000)]
    texts = pa.array([" ".join(source.choices(vocabulary, k=2_000)).encode() for _ in range(1_250)], pa.large_binary())
    cache = p.TokenCache(p.default_tokenizer())
    usual, counted = pa.default_memory_pool(), pa.proxy_memory_pool(pa.default_memory_pool())
    pa.set_memory_pool(counted)
    try:
        encoded = sum(map(len, cache.encode_texts(texts)))
    finally:
        pa.set_memory_pool(usual)
    assert texts.nbytes > 15_000_000 and encoded
    assert counted.max_memory() < 24_000_000, counted.max_memory()
