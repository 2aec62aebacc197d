"""The pipeline against a plain version of every stage, on a whole small table."""

from collections import Counter, defaultdict

import corpus_pipeline as pipe
from cohortloom.llm import quality_rules
from .helpers import SMALL, rows, words
from .test_mixing_sharding import water_fill
from .test_packing import expected_ids
from .test_simhash import components, fingerprint


def test_stages_match_plain_versions(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    kept = quality_rules.assess(docs, quality_rules.fit(docs, labels)).filter("kept")
    expected = {r.doc_id for r in kept.select("doc_id").collect()}

    (_, first), (_, second), (_, third), (_, fourth), (_, fifth) = pipe.STAGES
    good = first(spark, docs, SMALL).cache()
    assert good.columns == columns and {r.doc_id for r in good.collect()} == expected
    clean = {r.doc_id for r in labels.filter("quality = 1").collect()}
    text = {r.doc_id: r.text for r in docs.collect()}
    assert not {i for i in clean - expected if len(words(text[i])) >= 30 and i not in base_failed(docs)}

    shorter = second(spark, good, SMALL).cache()
    total, seen = Counter(), Counter()
    for r in good.collect():
        total[r.source] += 1
        seen.update((r.source, line) for line in {x.strip(" \t\n\v\f\r") for x in r.text.split("\n")} if line)
    plain = []
    for r in good.collect():
        def stays(line):
            n = seen[r.source, line.strip(" \t\n\v\f\r")]
            return not (n >= 3 and n > 0.1 * total[r.source])
        body = "\n".join(x for x in r.text.split("\n") if stays(x))
        plain.append((r.doc_id, body, r.lang, r.source, len(body) if body != r.text else r.n_chars))
    assert shorter.columns == columns and rows(shorter) == sorted(plain, key=str)

    single = third(spark, shorter, SMALL).cache()
    groups = components([p[0] for p in plain], [fingerprint(p[1]) for p in plain])
    assert rows(single) == sorted((p for p in plain if p[0] in set(groups)), key=str)

    mixed = fourth(spark, single, SMALL).cache()
    sizes, got = defaultdict(int), defaultdict(int)
    originals = {r.doc_id: r for r in single.collect()}
    for r in originals.values():
        sizes[r.source] += len(words(r.text))
    partial = Counter()
    for r in mixed.collect():
        own = originals[r.doc_id]
        assert own.text.startswith(r.text) and (r.lang, r.source) == (own.lang, own.source)
        partial[r.source] += r.text != own.text
        got[r.source] += len(words(r.text))
    assert got == {s: int(t + 1e-9) for s, t in water_fill(sizes).items()}
    assert all(n <= 1 for n in partial.values())

    packed = fifth(spark, mixed, SMALL)
    ids = Counter(len(x) for x in expected_ids([r.text for r in mixed.collect()]))
    assert packed.agg({"length": "sum"}).first()[0] == sum(n * k for n, k in ids.items())
    places = defaultdict(list)
    for r in packed.collect():
        places[r.sequence_id].append((r.offset, r.length))
    for own in places.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= 4096


def base_failed(docs):
    found = quality_rules.assess(docs, []).filter("base_failed")
    return {r.doc_id for r in found.select("doc_id").collect()}


def test_run_is_the_stages_in_a_row(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for _, stage in pipe.STAGES:
        docs = stage(spark, docs, SMALL)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert rows(pipe.run(spark, SMALL), *columns) == rows(docs, *columns)


def test_no_documents(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for name in ("documents", "labels"):
        spark.read.parquet(f"{SMALL}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert pipe.run(spark, str(tmp_path)).count() == 0
    assert docs.count() == 0
