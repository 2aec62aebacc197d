"""The operators applied to whole tables, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.llm import ann, bwt_dedup, common, conversation_repair, importance, license_scan, line_dedup, mixing, packing, quality_rules, sharding, simhash, substring_dedup, warc
from cohortloom.llm.license_notices import NOTICES
from cohortloom.operators.materialize import settle

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_quality_rules(spark, folder):
    """No SQL: the rules are learned. tests/llm checks the statistics by brute force."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    rules = quality_rules.fit(docs, table(spark, folder, "labels"))
    return quality_rules.assess(docs, rules).drop("text")


@query
def op9_simhash(spark, folder):
    """No SQL: DuckDB has no XXH64. tests/llm checks it by brute force."""
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        simhash.hex_digits().alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


@query
def op7_substring_dedup(spark, folder):
    found = substring_dedup.remove_repeats(table(spark, folder, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_removed", "kept_sha256")


SQL["op7_substring_dedup"] = r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), w AS (
    SELECT doc_id, s, words[s:s + 12] AS gram
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS s FROM d)
), least AS (SELECT gram, min(doc_id) AS first FROM w GROUP BY gram),
hits AS (
    SELECT DISTINCT doc_id, unnest(range(s, s + 13)) AS place
    FROM w JOIN least USING (gram) WHERE first < doc_id
), gone AS (SELECT doc_id, list(place) AS places FROM hits GROUP BY doc_id)
SELECT d.doc_id, len(words) AS n_words, coalesce(len(places), 0) AS n_removed,
       sha256(coalesce(array_to_string(CASE WHEN places IS NULL THEN words
           ELSE list_filter(words, lambda x, i: NOT list_contains(places, i)) END, ' '), '')) AS kept_sha256
FROM d LEFT JOIN gone ON gone.doc_id = d.doc_id
"""


@query
def op6_packing(spark, folder):
    """No SQL: a tokenizer and a linear program. tests/llm unpacks it and compares the ids."""
    return packing.pack(table(spark, folder, "documents"))


@query
def op3_mixing(spark, folder):
    docs = table(spark, folder, "documents")
    sizes = docs.select("doc_id", "source", common.word_count(F.col("text")).alias("n_words"))
    mixed = mixing.mix(settle(sizes), size=F.col("n_words"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


SQL["op3_mixing"] = r"""
WITH d AS (
    SELECT doc_id, source,
           CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
           CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':mix'), 1, 15) AS BIGINT) AS key
    FROM documents
), s AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
           (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
    FROM d GROUP BY source
), r AS (
    SELECT *, 3 * source_size AS cap, sum(source_size) OVER () AS total,
           row_number() OVER (ORDER BY 3 * source_size / weight, source NULLS LAST) AS turn FROM s
), p AS (
    SELECT *, coalesce(sum(cap) OVER (ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS caps,
           sum(weight) OVER (ORDER BY turn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights FROM r
), c AS (SELECT *, weight * (CAST(total - caps AS DOUBLE) / weights) > cap AS capped FROM p),
u AS (
    SELECT CAST(any_value(total) - coalesce(sum(cap) FILTER (capped), 0) AS DOUBLE)
           / sum(weight) FILTER (NOT capped) AS share FROM c
), t AS (
    SELECT source, source_size,
           CASE WHEN capped THEN CAST(cap AS DOUBLE) ELSE weight * (SELECT share FROM u) END AS target FROM c
), x AS (
    SELECT d.*, source_size, target, CAST(floor(target) AS BIGINT) AS budget,
           coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id, size
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier
    FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       CAST(CASE WHEN source_size = 0 THEN 0 ELSE budget // source_size * size
           + greatest(0, least(size, budget % source_size - earlier)) END AS BIGINT) AS taken
FROM x
"""


@query
def op8_sharding(spark, folder):
    placed = sharding.shard(table(spark, folder, "documents"))
    return placed.select("doc_id", "n_bytes", "shard", "depth", "shard_bytes")


SQL["op8_sharding"] = """
WITH d AS (
    SELECT doc_id, CAST(coalesce(strlen(text), 0) AS BIGINT) AS n_bytes,
           lpad(bin(CAST('0x' || substr(md5(coalesce('k' || CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT)),
                60, '0') AS bits
    FROM documents
), p AS (
    SELECT *, CAST(unnest(range(0, 61)) AS INTEGER) AS depth FROM d
), b AS (
    SELECT depth, substr(bits, 1, depth) AS shard, CAST(sum(n_bytes) AS BIGINT) AS shard_bytes
    FROM p GROUP BY ALL HAVING sum(n_bytes) <= 1048576
)
SELECT doc_id, n_bytes, b.shard, b.depth, b.shard_bytes
FROM d JOIN b ON substr(bits, 1, b.depth) = b.shard
QUALIFY b.depth = min(b.depth) OVER (PARTITION BY doc_id)
"""


@query
def op5_ann(spark, folder):
    """No SQL: the search is approximate. tests/llm measures its recall by brute force."""
    return ann.nearest(table(spark, folder, "embeddings"))


@query
def op2_line_dedup(spark, folder):
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    host, lines = line_dedup.host_of(F.col("url")), line_dedup.html_lines(F.col("html"))
    kept = line_dedup.drop_boilerplate(pages.withColumn("host", host), F.col("host"), lines)
    blank = lambda x: F.length(F.btrim(x, F.lit(common.BLANKS))) > 0
    before, after = F.filter(lines, blank), F.filter("lines", blank)
    return kept.select(
        "page_id",
        "host",
        F.coalesce(F.size(before), F.lit(0)).cast("bigint").alias("n_lines"),
        F.size(after).cast("bigint").alias("n_kept"),
        F.sha2(F.array_join(after, "\n"), 256).alias("kept_sha256"),
    )


SQL["op2_line_dedup"] = r"""
WITH p AS (
    SELECT page_id, row_number() OVER () AS row,
           lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)) AS host,
           list_filter(coalesce(string_split(regexp_replace(html, '<[^>]*>', chr(10), 'g'), chr(10)), []),
               lambda x: length(trim(x, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))) > 0) AS lines
    FROM pages
), l AS (
    SELECT row, host, line, place, trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare
    FROM (SELECT row, host, unnest(lines) AS line, unnest(range(len(lines))) AS place FROM p)
), t AS (SELECT host, count(*) AS total FROM p GROUP BY host),
c AS (SELECT host, bare, count(DISTINCT row) AS n FROM l GROUP BY host, bare),
bad AS (
    SELECT c.host, bare FROM c JOIN t ON c.host IS NOT DISTINCT FROM t.host WHERE n >= 3 AND n > 0.1 * total
), k AS (
    SELECT row, count(*) AS n_kept, string_agg(line, chr(10) ORDER BY place) AS kept
    FROM l LEFT JOIN bad ON l.host IS NOT DISTINCT FROM bad.host AND l.bare = bad.bare
    WHERE bad.bare IS NULL GROUP BY row
)
SELECT page_id, host, CAST(len(lines) AS BIGINT) AS n_lines, coalesce(n_kept, 0) AS n_kept,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM p LEFT JOIN k ON p.row = k.row
"""


@query
def op4_warc(spark, folder):
    out = warc.scratch_folder(spark)
    warc.write(table(spark, folder, "pages"), out)
    return warc.read(spark, out).drop("url")


SQL["op4_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
m AS (SELECT hex, max(page_id) AS newest FROM p GROUP BY hex),
b AS (
    SELECT DISTINCT hex, list_aggregate(list_transform(range(32), lambda i:
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[1 + list_sum(list_transform(range(5), lambda k:
            (((strpos('0123456789abcdef', hex[1 + (5 * i + k) // 4]) - 1)
              >> (3 - (5 * i + k) % 4)) & 1) << (4 - k)))::INTEGER]), 'string_agg', '') AS digest
    FROM p
)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN page_id = newest THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> newest THEN newest END AS refers_to
FROM p JOIN m USING (hex) JOIN b USING (hex)
"""


@query
def op10_license_scan(spark, folder):
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    lines = line_dedup.html_lines(F.col("html"))
    found = license_scan.scan(pages, license_scan.url_path(F.col("url")), lines)
    return found.select("page_id", "own_licence", "own_score", "licence", "inherited_from")


_NOTICES = ", ".join(
    f"({turn}, '{name}', '{text.lower().replace(chr(39), chr(39) * 2)}')" for turn, (name, text) in enumerate(NOTICES)
)
SQL["op10_license_scan"] = rf"""
WITH notices(turn, name, notice) AS (VALUES {_NOTICES}),
nt AS (
    SELECT turn, name, term, count(*) AS tf
    FROM (SELECT turn, name, unnest(regexp_extract_all(notice, '[a-z0-9]+')) AS term FROM notices)
    GROUP BY ALL
),
p AS (
    SELECT page_id, row_number() OVER () AS row,
           regexp_replace(regexp_replace(url, '[?#].*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS bare,
           regexp_replace(lower(regexp_replace(html, '<[^>]*>', chr(10), 'g')), '[^a-z0-9\n]+', ' ', 'g') AS plain
    FROM pages
),
f AS (SELECT page_id, row, CASE WHEN contains(bare, '/') THEN bare ELSE bare || '/' END AS path FROM p),
l AS (
    SELECT row, string_split(trim(line, ' '), ' ') AS terms
    FROM (SELECT row, unnest(string_split(plain, chr(10))) AS line FROM p) WHERE trim(line, ' ') <> ''
),
texts AS (
    SELECT row, string_split(joined, ' ') AS terms, row_number() OVER () AS place
    FROM (
        SELECT DISTINCT row, trim(regexp_replace(text, '[ \n]+', ' ', 'g'), ' ') AS joined
        FROM (
            SELECT row, unnest(string_split(plain, chr(10))) AS text FROM p
            UNION ALL SELECT row, unnest(string_split_regex(plain, '\n( ?\n)+')) FROM p
            UNION ALL SELECT row, plain FROM p
        )
    ) WHERE joined <> ''
),
total AS (SELECT count(*) AS n FROM l),
df AS (SELECT term, count(*) AS lines FROM (SELECT unnest(list_distinct(terms)) AS term FROM l) GROUP BY term),
lt AS (SELECT row, place, term, count(*) AS tf
       FROM (SELECT row, place, unnest(terms) AS term FROM texts) GROUP BY ALL),
idf AS (
    SELECT term, ln((1 + n) / (1 + coalesce(lines, 0))) + 1 AS weight
    FROM (SELECT DISTINCT term FROM nt) LEFT JOIN df USING (term), total
),
lw AS (
    SELECT row, place, term, tf * coalesce(weight, ln(1 + n) + 1) AS x
    FROM lt LEFT JOIN idf USING (term), total
),
nw AS (SELECT turn, name, term, tf * weight AS y FROM nt JOIN idf USING (term)),
lengths AS (SELECT row, place, sqrt(sum(x * x)) AS line_length FROM lw GROUP BY row, place),
notice_lengths AS (SELECT turn, sqrt(sum(y * y)) AS notice_length FROM nw GROUP BY turn),
scores AS (
    SELECT row, turn, name, round(dot / (line_length * notice_length), 6) AS score
    FROM (SELECT row, place, turn, name, sum(x * y) AS dot FROM lw JOIN nw USING (term) GROUP BY ALL)
    JOIN lengths USING (row, place) JOIN notice_lengths USING (turn)
),
own AS (
    SELECT row, name AS own_licence, score AS own_score FROM scores WHERE score >= 0.6
    QUALIFY row_number() OVER (PARTITION BY row ORDER BY score DESC, turn) = 1
),
files AS (
    SELECT page_id, row, regexp_extract(path, '^(.*)/[^/]*$', 1) AS folder,
           regexp_matches(regexp_extract(path, '([^/]*)$', 1),
               '(?i)^(licen[cs]e|copying|notice|legal|terms)([._-].*)?$') AS is_licence, own_licence, own_score
    FROM f LEFT JOIN own USING (row)
),
votes AS (
    SELECT folder AS holder, own_licence AS theirs, count(*) AS n, count(*) FILTER (is_licence) AS named
    FROM files WHERE own_licence IS NOT NULL AND folder IS NOT NULL GROUP BY ALL
),
licensed AS (
    SELECT holder, theirs, named, n, sum(n) OVER (PARTITION BY holder) AS whole FROM votes
    QUALIFY row_number() OVER (PARTITION BY holder ORDER BY named DESC, n DESC, theirs DESC) = 1
),
nearest AS (
    SELECT folder, holder, theirs
    FROM (SELECT DISTINCT folder FROM files) JOIN licensed
      ON folder = holder OR starts_with(folder, holder || '/')
    WHERE named > 0 OR 2 * n > whole
    QUALIFY row_number() OVER (PARTITION BY folder ORDER BY length(holder) DESC) = 1
)
SELECT page_id, own_licence, own_score, coalesce(own_licence, theirs) AS licence,
       CASE WHEN own_licence IS NULL THEN holder END AS inherited_from
FROM files LEFT JOIN nearest USING (folder)
"""


@query
def op12_importance_resampling(spark, folder):
    """No SQL: DuckDB has no CRC-32. tests/llm checks it by brute force."""
    drawn = importance.resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return drawn.select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")


@query
def op11_conversation_repair(spark, folder):
    """No SQL: the least audit of a dynamic program. tests/llm checks it by brute force."""
    whole = table(spark, folder, "conversations")
    damaged = conversation_repair.damage(whole)
    found = conversation_repair.repair(damaged, place=F.struct("origin", "copy")).summaries()
    listed = whole.select("conv_id").distinct()
    known = listed.join(found, listed["conv_id"].eqNullSafe(found["id"]), "left")
    had = F.col("audit").isNotNull()
    numbers = ("blank", "duplicate", "truncated", "illegal", "cost")
    return known.select(
        "conv_id",
        F.when(had, F.col("gaps")).otherwise(F.lit(0)).cast("bigint").alias("gaps"),
        *(F.coalesce(n, F.lit(0)).cast("bigint").alias(n) for n in numbers),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


@query
def op13_suffix_dedup(spark, folder):
    found = bwt_dedup.remove_repeats(table(spark, folder, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")


SQL["op13_suffix_dedup"] = """
WITH d AS (
    SELECT doc_id, row_number() OVER () AS row, hex(encode(coalesce(text, ''))) AS x FROM documents
), w AS (
    SELECT row, doc_id, s, substr(x, 2 * s + 1, 100) AS gram
    FROM (SELECT row, doc_id, x, unnest(range(0, length(x) // 2 - 49)) AS s FROM d)
), least AS (SELECT gram, min(doc_id) AS first FROM w GROUP BY gram),
hits AS (SELECT row, s FROM w JOIN least USING (gram) WHERE first < doc_id),
steps AS (
    SELECT row, s, CASE WHEN s - lag(s) OVER (PARTITION BY row ORDER BY s) <= 50 THEN 0 ELSE 1 END AS opens FROM hits
), runs AS (
    SELECT row, min(s) AS a, max(s) + 50 AS b
    FROM (SELECT row, s, sum(opens) OVER (PARTITION BY row ORDER BY s) AS run FROM steps) GROUP BY row, run
), pieces AS (
    SELECT row, lag(b, 1, 0) OVER (PARTITION BY row ORDER BY a) AS f, a AS t FROM runs
    UNION ALL SELECT row, max(b), NULL FROM runs GROUP BY row
), kept AS (
    SELECT row, string_agg(substr(x, 2 * f + 1, 2 * (coalesce(t, length(x) // 2) - f)), '' ORDER BY f) AS rest
    FROM pieces JOIN d USING (row) GROUP BY row
), gone AS (SELECT row, sum(b - a) AS n_removed, count(*) AS n_spans FROM runs GROUP BY row)
SELECT doc_id, CAST(length(x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(rest, x))) AS kept_sha256
FROM d LEFT JOIN kept USING (row) LEFT JOIN gone USING (row)
"""
