"""Suffix dedup against a plain version over all windows."""

import glob
import hashlib
import random
import time

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from cohortloom.llm import bwt_dedup
from cohortloom.operators.materialize import FREE_SHUFFLES

from .helpers import documents, rows


def plain(texts, threshold=50):
    """texts: (id, bytes). (id, n_bytes, n_removed, n_spans, sha256) of each."""
    least = {}
    for own, text in texts:
        if own is not None:
            for i in range(len(text) - threshold + 1):
                window = text[i : i + threshold]
                least[window] = min(own, least.get(window, own))
    out = []
    for own, text in texts:
        gone = bytearray(len(text))
        for i in range(len(text) - threshold + 1):
            if own is not None and least[text[i : i + threshold]] < own:
                gone[i : i + threshold] = b"\1" * threshold
        rest = bytes(b for b, g in zip(text, gone) if not g)
        runs = sum(g and not before for before, g in zip(b"\0" + gone, gone))
        out.append((own, len(text), sum(gone), runs, hashlib.sha256(rest).hexdigest()))
    return sorted(out, key=str)


def check(spark, given, threshold=50):
    found = bwt_dedup.remove_repeats(documents(spark, [(i, t, "s") for i, t in given]), threshold=threshold)
    expected = plain([(i, (t or "").encode()) for i, t in given], threshold)
    assert rows(found, "id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == expected
    return expected


def prose(rng, n):
    return "".join(rng.choice("abcdefgh é漢\n .") for _ in range(n))


def some_texts(seed):
    rng = random.Random(seed)
    shared = [prose(rng, n) for n in (49, 50, 51, 60, 120, 400)]
    given = []
    for i in range(60):
        parts = [prose(rng, rng.choice((0, 1, 20, 90))) for _ in range(4)]
        for _ in range(rng.randrange(4)):
            passage = rng.choice(shared)
            cut = rng.choice((0, 0, 3, 11))
            parts.insert(rng.randrange(len(parts)), passage[cut:])
        given.append((rng.randrange(45), "".join(parts)))
    return given


@pytest.mark.parametrize("crowd", [1 << 14, 2])
def test_repeats_match_plain_version(spark, monkeypatch, crowd):
    monkeypatch.setattr(bwt_dedup, "CROWD", crowd)
    expected = check(spark, some_texts(crowd))
    assert sum(r[3] for r in expected) > 20


def in_batches(table, size):
    return table.combine_chunks().to_batches(max_chunksize=size)


def in_process(given, size, threshold=50):
    """The stages without Spark, on batches of ``size`` rows; what each stage is given is sorted here."""
    ids, marks, bodies = [i for i, _ in given], list(range(len(given))), [t.encode() for _, t in given]
    columns = [pa.array(ids), pa.array(marks, pa.int32()), pa.array(bodies, pa.binary())]
    texts = pa.table(columns, names=["id", "mark", "body"])
    anchors = pa.Table.from_batches(bwt_dedup._anchors(threshold)(in_batches(texts.select(["id", "body"]), size)))
    anchors = anchors.sort_by("anchor")
    own_shuffle = pc.not_equal(anchors["state"], bwt_dedup.KNOWN)
    parts = [anchors.filter(own_shuffle), anchors.filter(pc.invert(own_shuffle))]
    found = [b for part in parts for b in bwt_dedup._repeated(iter(in_batches(part, size)))]
    listed = {}
    for own, anchor in set(zip(*(pa.Table.from_batches(found)[c].to_pylist() for c in ("id", "anchor")))):
        listed.setdefault(own, []).append(anchor)
    wanted = texts.append_column("anchors", pa.array([listed.get(i) for i in ids], pa.list_(pa.int64())))
    copied = [[k] if any(i < own and other == text for i, other in given) else None for k, (own, text) in enumerate(given)]
    wanted = wanted.append_column("copied", pa.array(copied, pa.list_(pa.int32())))
    contexts = pa.Table.from_batches(bwt_dedup._contexts(threshold)(in_batches(wanted, size))).sort_by("anchor")
    spans = {}
    for row in pa.Table.from_batches(bwt_dedup._blocks(threshold)(in_batches(contexts, size))).to_pylist():
        spans.setdefault(row["id"], []).append(row)
    marked = texts.append_column("spans", pa.array([spans.get(i) for i in ids]))
    cut = pa.Table.from_batches(bwt_dedup._cut(in_batches(marked, size)))
    return rows_of(cut, "id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def rows_of(table, *names):
    return sorted(zip(*(table[name].to_pylist() for name in names)), key=str)


SETTINGS = [{}, {"BLOCK": 300}, {"RUN": 5, "BLOCK": 1}, {"CHUNK": 200}]


@pytest.mark.parametrize("settings, size", list(zip(SETTINGS, (1, 7, 1000, 13))))
def test_bounds_do_not_change_results(monkeypatch, settings, size):
    for name, value in settings.items():
        monkeypatch.setattr(bwt_dedup, name, value)
    bwt_dedup._powers.cache_clear()
    given = some_texts(size)
    assert in_process(given, size) == plain([(i, t.encode()) for i, t in given])
    bwt_dedup._powers.cache_clear()


def test_another_threshold(spark):
    check(spark, some_texts(9), 30)


def test_defined_cases(spark):
    line = "This very line is long enough to be found again, as it has over fifty bytes."
    given = [
        (None, line), (3, line), (1, "a" + line), (2, None), (4, ""), (5, line[:49]), (5, line[:50]),
        (6, line + line), (6, line + line), (7, "x" * 300), (8, "y" + "x" * 200 + "z"), (9, "\0" * 60), (10, "\0" * 55 + "q"),
        (1, "other text of the same id as one above, with " + line),
    ]
    check(spark, given)


def test_very_long_text_and_empty_table(spark):
    rng = random.Random(3)
    passage = prose(rng, 70)
    long = prose(rng, 300_000) + passage + prose(rng, 300_000) + "ab" * 5_000
    check(spark, [(1, long), (2, "start " + long[261_000:264_000] + " end"), (3, passage), (4, "ab" * 40)])
    assert rows(bwt_dedup.remove_repeats(documents(spark, []))) == []


def test_copies_of_all_sizes(spark):
    rng = random.Random(4)
    bodies = [prose(rng, 200) for _ in range(4)]
    check(spark, [(i, bodies[0] if i % 3 else bodies[i % 4]) for i in range(400)])


@pytest.mark.parametrize("seed", range(4))
def test_expansion_finds_common_prefixes(seed):
    rng = np.random.default_rng(seed)
    text = rng.integers(0, (2, 3, 256, 1)[seed], 400).astype(np.uint8)
    text[300:380] = text[20:100]
    order = bwt_dedup.suffix_order(text, 50)
    prefix = bwt_dedup.common_prefixes(text, order, 50)
    suffixes = [tuple(text[i : i + 50]) for i in order]
    assert suffixes == sorted(suffixes)
    for i in range(1, len(order)):
        same = next((k for k, (a, b) in enumerate(zip(suffixes[i - 1], suffixes[i])) if a != b), None)
        same = min(map(len, suffixes[i - 1 : i + 1])) if same is None else same
        assert prefix[i] == (same if same < 50 else 255)


def test_threshold_bounds(spark):
    with pytest.raises(ValueError):
        bwt_dedup.remove_repeats(documents(spark, []), threshold=24)


def shuffle_files(spark):
    env = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get()
    folders = list(env.blockManager().diskBlockManager().localDirsString())
    return {f for folder in folders for f in glob.glob(f"{folder}/*/shuffle_*")}


def test_shuffles_of_settled_steps_do_not_wait_for_garbage_collection(spark):
    rng = random.Random(5)
    passage = prose(rng, 90)
    given = documents(spark, [(i, prose(rng, 30) + passage, "s") for i in range(40)])
    given.count()
    before = shuffle_files(spark)
    found = bwt_dedup.remove_repeats(given)
    for _ in range(50):  # files go in the background
        left = shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.1)
    assert not left
    assert spark.conf.get(FREE_SHUFFLES) == "false"
    assert found.filter("n_removed >= 90").count() == 39
