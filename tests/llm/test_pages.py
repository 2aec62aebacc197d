"""Line dedup, WARC and licence scans."""

import re
from collections import Counter, defaultdict
from math import log, sqrt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from cohortloom.llm import license_notices, license_scan, line_dedup, warc
from plan_tools import final_plan
from .helpers import SMALL, documents, rows


def test_lines_above_the_ratio_go(spark):
    texts = [f" menu\nown {i}\n\nfooter{i % 2}\nown {i}" for i in range(8)] + [None, "", "menu\nmenu"]
    docs = documents(spark, [(i, t, "a") for i, t in enumerate(texts)] + [(50, "menu\nx", None), (51, "menu", "b"), (51, "menu", "b")])
    kept = line_dedup.drop_boilerplate(docs, F.col("source"), line_dedup.text_lines(F.col("text")), 0.5, 3)
    found = {}
    for r in kept.collect():
        found.setdefault(r.doc_id, []).append(r.lines)
    assert found[0] == [["own 0", "", "footer0", "own 0"]]
    assert found[8] == [[]] and found[9] == [[""]] and found[10] == [[]]
    assert found[50] == [["menu", "x"]] and found[51] == [["menu"], ["menu"]]
    three = documents(spark, [(i, "menu\nx" + str(i), None) for i in range(3)])
    kept = line_dedup.drop_boilerplate(three, F.col("source"), line_dedup.text_lines(F.col("text")), 0.5, 3)
    assert rows(kept, "doc_id", "lines") == [(0, ["x0"]), (1, ["x1"]), (2, ["x2"])]
    none = line_dedup.drop_boilerplate(docs.limit(0), F.col("source"), line_dedup.text_lines(F.col("text")))
    assert none.count() == 0


def test_helper_names_and_long_texts_of_line_dedup(spark):
    names = ("_site", "_lines", "_dropped", "_row", "_of", "row_1", "row_2", "body", "gone", "site", "of", "h1", "h2", "total", "n")
    texts = ["menu\nown " + str(i) for i in range(6)] + ["menu\n" + "long line " * 100_000 + "\n" + "x\n" * 50_000, None, ""]
    docs = documents(spark, [(i, t, "a") for i, t in enumerate(texts)])
    lines = line_dedup.text_lines(F.col("text"))
    for copies in (True, False):
        expected = line_dedup.drop_boilerplate(docs, F.col("source"), lines, 0.5, copies_count=copies)
        found = line_dedup.drop_boilerplate(docs.withColumns({n: F.lit(n) for n in names}), F.col("source"), lines, 0.5, copies_count=copies)
        assert rows(found, *expected.columns) == rows(expected)
        assert {tuple(r[n] for n in names) for r in found.select(*names).collect()} == {names}
        assert {tuple(r.lines) for r in found.filter("doc_id < 6").collect()} == {(f"own {i}",) for i in range(6)}
    assert "Python" not in final_plan(found) and "ArrowEval" not in final_plan(found)


def test_the_key_of_many_copies_is_split(spark):
    many = [(i, "menu\n" + "copied words " * 40, "a") for i in range(3_000)]
    docs = documents(spark, many + [(i, f"menu\nown {i}", "a") for i in range(3_000, 6_000)], 12)
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
    }
    old = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        kept = line_dedup.drop_boilerplate(docs, F.col("source"), line_dedup.text_lines(F.col("text")))
        assert {tuple(r.lines) for r in kept.select("lines").collect()} == {()} | {(f"own {i}",) for i in range(3_000, 6_000)}
        joins = re.findall(r"SortMergeJoin.*", final_plan(kept))
        assert [x for x in joins if "LeftOuter" in x and "skew=true" in x], joins
    finally:
        for key, value in old.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_host(spark):
    urls = ["https://A.example.org/x", "http://u@b.c:80", "mailto:x", None, "https://h?q=//z"]
    frame = spark.createDataFrame([(u,) for u in urls], "u string")
    assert [r.h for r in frame.select(line_dedup.host_of(F.col("u")).alias("h")).collect()] == ["a.example.org", "b.c", "", None, "h"]


PAGES = [(1, "u1", "same é"), (2, "u2", "same é"), (9, "u3", "same é"), (9, "u3", "same é"), (3, None, None), (4, "u 4", ""), (None, "u", "same é"), (None, "u", "lone"), (5, "u5", "\r\n\r\nx" * 50), (6, "u", "12345"), (7, "u", "12345")]


def pages(spark, slices):
    return spark.createDataFrame([(*p, "extra") for p in PAGES], "page_id long, url string, html string, records string").repartition(slices)


def test_round_trip(spark, tmp_path):
    folder = str(tmp_path / "w")
    warc.write(pages(spark, 3), folder, file_bytes=600, least_shards=3)
    found = warc.read(spark, folder, with_payload=True).collect()
    assert len(found) == len(PAGES)
    kind = {(r.page_id, r.payload_bytes): (r.record_type, r.refers_to) for r in found}
    assert kind[9, 7] == ("response", None)
    assert kind[1, 7] == kind[2, 7] == kind[None, 7] == ("revisit", 9)
    assert kind[3, 0] == ("revisit", 4) and kind[None, 4] == ("response", None) and kind[6, 5] == ("revisit", 7)
    by_payload = {warc.base32_sha1((h or "").encode()): h or "" for _, _, h in PAGES}
    for r in found:
        assert r.payload == ("" if r.record_type == "revisit" else by_payload[r.payload_digest])
        assert r.payload_bytes == len(by_payload[r.payload_digest].encode())
    assert len(list(Path(folder).glob("pages-*.warc.gz"))) > 3
    assert not list(Path(folder, "temporary").iterdir())
    assert f"records {len(PAGES)}" in Path(folder, "COMMITTED").read_text()


def test_small_payloads_stay_responses(spark, tmp_path):
    folder = str(tmp_path / "w")
    warc.write(pages(spark, 2), folder, least_revisit_bytes=6)
    found = {(r.page_id, r.record_type) for r in warc.read(spark, folder).filter("payload_bytes < 6").collect()}
    assert found == {(3, "response"), (4, "response"), (6, "response"), (7, "response"), (None, "response")}


def test_files_do_not_depend_on_partitions(spark, tmp_path):
    table = spark.read.parquet(f"{SMALL}/pages.parquet")
    for name, slices in (("a", 1), ("b", 5)):
        warc.write(table.repartition(slices), str(tmp_path / name), file_bytes=20_000, least_shards=4)
    files = [{p.name: p.read_bytes() for p in (tmp_path / n).glob("*.gz")} for n in "ab"]
    assert files[0] == files[1] and len(files[0]) > 4


def test_commit_may_be_repeated_and_damage_is_found(spark, tmp_path):
    folder = tmp_path / "w"
    warc.write(pages(spark, 2), str(folder), least_shards=2)
    (folder / "temporary" / "lost.warc.gz").write_bytes(b"of a lost attempt")
    warc._commit(spark, str(folder))
    assert warc.read(spark, str(folder)).count() == len(PAGES)
    bad = b"".join(warc._member(warc.record(1, "u", b"abc", "X" * 32, 3, None, False)) for _ in range(1))
    next(folder.glob("*.gz")).write_bytes(bad)
    with pytest.raises(Exception, match="digest"):
        warc.read(spark, str(folder)).count()


def test_files_are_read_by_several_tasks_and_shards_dealt_evenly(spark, tmp_path):
    folder = str(tmp_path / "w")
    table = spark.read.parquet(f"{SMALL}/pages.parquet")
    manifest = warc.write(table, folder, least_shards=16)
    assert manifest.count() == 16 and {r.records > 0 for r in manifest.collect()} == {True}
    found = warc.read(spark, folder)
    assert found.rdd.getNumPartitions() == min(16, spark.sparkContext.defaultParallelism)
    assert found.select(F.spark_partition_id()).distinct().count() >= 6


def test_shards_are_bounded_and_long_payloads_whole(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "MOST_SHARDS", 3)
    long = "é" * 1_500_000
    frame = spark.createDataFrame([(i, "u", f"page {i} " * 50) for i in range(40)] + [(99, "u", long)], "page_id long, url string, html string")
    manifest = warc.write(frame, str(tmp_path / "w"), shard_bytes=100, least_shards=2, file_bytes=300)
    assert {r.shard for r in manifest.collect()} == {0, 1, 2}
    found = warc.read(spark, str(tmp_path / "w"), with_payload=True)
    assert found.count() == 41 and found.filter("page_id = 99").first().payload == long


def test_no_pages(spark, tmp_path):
    folder = str(tmp_path / "w")
    warc.write(pages(spark, 1).limit(0), folder)
    assert warc.read(spark, folder).count() == 0


def terms(text):
    return re.findall("[a-z0-9]+", text.lower())


def texts_of(lines):
    """Lines, runs of lines with terms, and all of them, as terms."""
    runs, run = [], []
    for line in [*lines, ""]:
        if terms(line):
            run += terms(line)
        elif run:
            runs, run = [*runs, run], []
    return [x for x in [*map(terms, lines), *runs, [t for line in lines for t in terms(line)]] if x]


def best_licences(files):
    """Best (licence, score) of every file, given as lines, by the formula alone."""
    split = [terms(line) for lines in files for line in lines if terms(line)]
    templates = [(n, Counter(terms(t))) for n, t in license_notices.NOTICES]
    known = {t for _, c in templates for t in c}
    df = Counter(t for x in split for t in set(x) & known)

    def idf(t):
        return log((1 + len(split)) / (1 + df[t])) + 1

    norms = [sqrt(sum((n * idf(t)) ** 2 for t, n in c.items())) for _, c in templates]
    for lines in files:
        best = (None, None)
        for text in map(Counter, texts_of(lines)):
            norm = sqrt(sum((n * idf(t)) ** 2 for t, n in text.items()))
            for (name, c), other in zip(templates, norms):
                score = round(sum(text[t] * n * idf(t) ** 2 for t, n in c.items() if t in text) / norm / other, 6)
                if score >= license_scan.THRESHOLD and score > (best[1] or 0):
                    best = (name, score)
        yield best


def test_notices_of_the_sql_are_the_templates():
    assert list(license_notices.NOTICES) == [(n, t) for n, ts in sorted(license_scan.TEMPLATES.items()) for t in ts]


MIT_FILE = """The MIT License (MIT)

Copyright (c) 2019 Some Author

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""
HEADERS = [
    (MIT_FILE, "MIT"),
    ("GNU GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007", "GPL-3.0"),
    ("                    GNU GENERAL PUBLIC LICENSE\n                       Version 2, June 1991\n\n Copyright (C) 1989, 1991 Free Software Foundation, Inc.,", "GPL-2.0"),
    ("/*\n * This program is free software: you can redistribute it and/or modify\n * it under the terms of the GNU General Public License as published by\n"
     " * the Free Software Foundation, either version 3 of the License, or\n * (at your option) any later version.\n */\n\nint main() {\n  return 0;\n}", "GPL-3.0"),
    ("# Licensed under the Apache License, Version 2.0 (the\n# 'License'); you may not use this file except in\n# compliance with the License.\n\nimport os\nprint(os.name)", "Apache-2.0"),
    ("// Permission to use, copy, modify, and/or distribute this software\n// for any purpose with or without fee is hereby granted, provided\n"
     "// that the above copyright notice and this permission notice\n// appear in all copies.", "ISC"),
    ("The general of the public army had no license to march in June", None),
]


def test_headers_of_several_lines_and_whole_licence_files(spark):
    table = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    extra = spark.createDataFrame([(10**9 + i, t) for i, (t, _) in enumerate(HEADERS)], table.schema)
    found = license_scan.own_licences(table.unionAll(extra), F.split("text", "\n")).filter("doc_id >= 1000000000")
    got = {r.doc_id - 10**9: (r.own_licence, r.own_score) for r in found.collect()}
    assert {i: name for i, (name, _) in got.items()} == {i: name for i, (_, name) in enumerate(HEADERS)}
    # A header is nearer to its template than any of its lines is.
    lines = [(10**9 + i, line) for i in (3, 5) for line in HEADERS[i][0].split("\n")]
    alone = license_scan.own_licences(table.unionAll(spark.createDataFrame(lines, table.schema)), F.array("text"))
    for r in alone.filter("doc_id >= 1000000000").collect():
        assert (r.own_score or 0) < got[r.doc_id - 10**9][1] - 0.05


def test_scores_match_the_formula(spark):
    table = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    some = [(10_001, "x\nLicensed under the MIT licence, or Apache License 2.0"), (10_002, None), (10_003, ""), (10_004, "GNU General Public License version 3 or 2"),
            (10_005, "All rights reserved.\n" + "many words " * 100_000), (10_006, "licensed\n \nunder CC BY 4.0")]
    docs = table.unionAll(spark.createDataFrame(some + [(10_010 + i, t) for i, (t, _) in enumerate(HEADERS)] * 2, table.schema))
    data = [(r.doc_id, (r.text or "").split("\n")) for r in docs.collect()]
    expected = sorted(zip((i for i, _ in data), best_licences([lines for _, lines in data])), key=str)
    found = license_scan.own_licences(docs, F.split("text", "\n"))
    got = sorted(((r.doc_id, (r.own_licence, r.own_score)) for r in found.collect()), key=str)
    assert [(i, name) for i, (name, _) in got] == [(i, name) for i, (name, _) in expected]
    assert all(a is None is b or abs(a - b) < 2e-6 for (_, (_, a)), (_, (_, b)) in zip(got, expected))
    assert sum(name is not None for _, (name, _) in expected) >= 5


def test_helper_names_and_empty_tables_of_scans(spark):
    clashing = ("own_licence", "_best", "f1", "f2", "t1", "chosen", "place", "folder", "name", "inside", "nearest", "holder", "plain", "term", "licence")
    data = [("h/LICENSE", "Licensed under the MIT License."), ("h/a", "words"), (None, None)]
    frame = spark.createDataFrame([(*r, *clashing) for r in data], ", ".join(f"{c} string" for c in ("path", "body", *clashing)))
    found = license_scan.scan(frame, F.col("path"), F.split("body", "\n"))
    kept = [c for c in clashing if c not in ("own_licence", "licence")]
    assert {tuple(r[c] for c in kept) for r in found.collect()} == {tuple(kept)}
    assert rows(found, "path", "own_licence", "licence", "inherited_from") == sorted(
        [("h/LICENSE", "MIT", "MIT", None), ("h/a", None, "MIT", "h"), (None, None, None, None)], key=str)
    assert license_scan.scan(frame.limit(0), F.col("path"), F.split("body", "\n")).count() == 0


def test_licence_texts_that_are_not_templates(spark):
    gnu = "{0} is free software; you can redistribute it and/or modify it under the terms of the GNU {1} as published by the Free Software Foundation; either version {2} of the License, or (at your option) any later version."
    texts = [
        ("Some rights? All rights reserved", "proprietary"), ("(c) All rights reserved.", "proprietary"),
        ("This text is licensed under CC BY 4.0", "CC-BY-4.0"), ("Text licensed under CC BY-SA 4.0", "CC-BY-SA-4.0"), ("Pictures licensed under CC BY-NC 4.0", "CC-BY-NC-4.0"),
        (gnu.format("This program", "General Public License", 3), "GPL-3.0"), (gnu.format("This library", "Lesser General Public License", 3), "LGPL-3.0"),
        (gnu.format("This", "General Public License", 2), "GPL-2.0"), (gnu.format("It", "Affero General Public License", 3), "AGPL-3.0"),
        ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the 'Software'), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software", "MIT"),
        ("This project is licensed under the MIT License", "MIT"), ("Code licensed under the Mozilla Public License 2.0", "MPL-2.0"),
        ("We walked all day and reserved a table by the lake", None),
    ]
    table = spark.read.parquet(f"{SMALL}/pages.parquet").select("page_id", F.col("html").alias("text"))
    known = {t for ts in license_scan.TEMPLATES.values() for t in ts}
    assert not known & {t for t, _ in texts}
    extra = spark.createDataFrame([(10**9 + i, t) for i, (t, _) in enumerate(texts)], table.schema)
    found = license_scan.own_licences(table.unionAll(extra), line_dedup.html_lines(F.col("text")))
    got = {r.page_id - 10**9: (r.own_licence, r.own_score) for r in found.filter("page_id >= 1000000000").collect()}
    assert {t: got[i][0] for i, (t, _) in enumerate(texts)} == dict(texts), got


def test_nearest_directory_is_inherited(spark):
    data = [
        ("h/LICENSE", "MIT"), ("h/a", None), ("h/x/b", None), ("h/x/y/c", None), ("h/x/y/d", "GPL-3.0"), ("h/x/y/z/e", None),
        ("h/x/y/z/own", "BSD-3-Clause"), ("g/a", "MIT"), ("g/b", "GPL-3.0"), ("g/c", None), ("h/l/LICENSE.txt", "GPL-2.0"), ("h/l/a", "MIT"),
        ("h/l/b", "MIT"), ("h/l/q/r", None), (None, None), (None, "MIT"),
    ]
    frame = spark.createDataFrame([(p, n, "x") for p, n in data], "path string, own_licence string, licence_files string")
    found = license_scan.inherit(frame, F.col("path"))
    got = defaultdict(set)
    for r in found.collect():
        got[r.path].add((r.licence, r.inherited_from))
    assert got["h/a"] == {("MIT", "h")} and got["h/x/b"] == {("MIT", "h")}
    assert got["h/x/y/c"] == {("GPL-3.0", "h/x/y")} and got["h/x/y/z/own"] == {("BSD-3-Clause", None)}
    assert got["h/x/y/z/e"] == {("BSD-3-Clause", "h/x/y/z")}
    assert got["g/c"] == {(None, None)}  # no agreement
    assert got["h/l/q/r"] == {("GPL-2.0", "h/l")} and got["h/l/a"] == {("MIT", None)}
    assert got[None] == {(None, None), ("MIT", None)}
    assert license_scan.inherit(frame.limit(0), F.col("path")).count() == 0


def test_url_paths(spark):
    urls = ["https://h.org/en/25#top", "http://h.org/es/3.html?q=/x", "https://h.org", "https://h.org/a/b/", None]
    path = license_scan.url_path(F.col("u"))
    frame = spark.createDataFrame([(u,) for u in urls], "u string").select(path.alias("p"), license_scan.directory_of(path).alias("d"))
    assert [tuple(r) for r in frame.collect()] == [("h.org/en/25", "h.org/en"), ("h.org/es/3.html", "h.org/es"), ("h.org/", "h.org"), ("h.org/a/b/", "h.org/a/b"), (None, None)]
