"""The registered queries of this subpackage with the SQL they are checked against."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelake.llm import language_id, quality
from pagelake.llm.decontaminate import leaks
from pagelake.llm.divergence import audit_sources
from pagelake.llm.exact_dedup import exact_dedup
from pagelake.llm.language_id import held_out
from pagelake.llm.line_dedup import dedup_lines
from pagelake.llm.mixing import mixing_weights
from pagelake.llm.near_dedup import near_duplicates
from pagelake.llm.periodic import periodic_runs
from pagelake.llm.secrets import scan_secrets
from pagelake.llm.stage import table, written
from pagelake.llm.suffix_dedup import remove_repeats
from pagelake.llm.url_filter import filter_urls
from pagelake.llm.warc import audit, build_tree, manifest, record

Run = Callable[[SparkSession, str], DataFrame]


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which copy of each text stays."""
    found = exact_dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP1_SQL = """
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
  FROM documents
)
SELECT doc_id, max(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY norm) AS kept, sha256(norm) AS text_sha256
FROM d
"""

def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of each document without strings of 50 bytes that a smaller one has."""
    return remove_repeats(table(spark, sf_dir, "documents"))


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The secrets in each document, live-looking ones told from examples."""
    return scan_secrets(table(spark, sf_dir, "documents"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of each document without the lines of recurring templates."""
    kept = dedup_lines(table(spark, sf_dir, "documents"))
    digest = F.sha2(F.coalesce("text", F.lit("")), 256)
    counts = [F.col("_line_count").alias("n_lines"), F.col("_line_dropped").alias("n_dropped")]
    return kept.select("doc_id", *counts, digest.alias("kept_sha256"))


def op5_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record of the archive of all pages, and whether a second replica holds it unharmed.

    The second replica is the first with one character changed in each 101st page.
    """
    pages = table(spark, sf_dir, "pages")
    middle = (F.length("html") / 2 + 1).cast("int")
    damaged = F.when(F.col("page_id") % 101 == 7, F.overlay("html", F.lit("~"), middle, F.lit(1))).otherwise(F.col("html"))
    replica = record(F.col("page_id"), F.col("url"), damaged)
    records = written(manifest(pages, {"replica": replica}), "warc-manifest")
    found = audit(build_tree(records), build_tree(records, "replica"))
    hurt = found.where("corrupt").select(F.col("place").alias("record_no"), "corrupt")
    return (
        records.join(hurt, "record_no", "left")
        .na.fill(False, ["corrupt"])
        .select("page_id", "record_no", F.col("offset").alias("start_byte"), "length", F.col("digest").alias("record_sha256"), "corrupt")
    )


OP5_SQL = """
WITH p AS (
  SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html FROM pages
), two AS (
  SELECT page_id, url, html, CASE WHEN page_id % 101 = 7 AND html <> ''
    THEN html[1 : length(html) // 2] || '~' || html[length(html) // 2 + 2 :] ELSE html END AS copy FROM p
), r AS (
  SELECT page_id,
    concat('WARC/1.0', chr(13), chr(10), 'WARC-Type: response', chr(13), chr(10), 'WARC-Record-ID: <urn:page:', page_id, '>', chr(13), chr(10),
      'WARC-Target-URI: ', url, chr(13), chr(10), 'Content-Type: text/html', chr(13), chr(10)) AS head, html, copy FROM two
), b AS (
  SELECT page_id, concat(head, 'Content-Length: ', strlen(html), chr(13), chr(10), chr(13), chr(10), html, chr(13), chr(10), chr(13), chr(10)) AS rec,
    concat(head, 'Content-Length: ', strlen(copy), chr(13), chr(10), chr(13), chr(10), copy, chr(13), chr(10), chr(13), chr(10)) AS other FROM r
)
SELECT page_id, row_number() OVER (ORDER BY page_id) - 1 AS record_no,
  CAST(coalesce(sum(strlen(rec)) OVER (ORDER BY page_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start_byte,
  CAST(strlen(rec) AS BIGINT) AS length, sha256(rec) AS record_sha256, rec <> other AS corrupt
FROM b
"""


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of each document, learnt from four fifths of them."""
    docs = table(spark, sf_dir, "documents")
    hidden = held_out(F.col("doc_id"))
    model = language_id.learn(docs, ~hidden)
    return language_id.identify(docs, model).select("doc_id", hidden.alias("held_out"), "lang_pred", "score", "n_spans", "languages")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of each document, learnt from two thirds of the labels."""
    docs = table(spark, sf_dir, "documents")
    hidden = held_out(F.col("doc_id"), folds=3, fold=1)
    model = quality.learn(docs, table(spark, sf_dir, "labels"), ~hidden)
    return quality.classify(docs, model).select("doc_id", hidden.alias("held_out"), "score", "predicted")


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark items that each document holds."""
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP8_SQL = """
WITH words AS (
  SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[\\p{L}\\p{N}]+') AS w FROM benchmark
), doc_words AS (
  SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\\p{L}\\p{N}]+') AS w FROM documents
), sized AS (
  SELECT row_number() OVER () AS item, item_id, least(5, len(w)) AS k, w FROM words WHERE len(w) > 0
), item_shingles AS (
  SELECT DISTINCT item, item_id, k, array_to_string(w[i : i + k - 1], ' ') AS s
  FROM sized, unnest(range(1, len(w) - k + 2)) AS t(i)
), item_sizes AS (
  SELECT item, count(*) AS n_item FROM item_shingles GROUP BY item
), sizes AS (SELECT DISTINCT k FROM sized
), doc_shingles AS (
  SELECT DISTINCT row_no, doc_id, k, array_to_string(w[i : i + k - 1], ' ') AS s
  FROM (SELECT row_number() OVER () AS row_no, * FROM doc_words), sizes, unnest(range(1, len(w) - k + 2)) AS t(i)
)
SELECT doc_id, item_id, n_item, count(*) AS n_shared, count(*) / n_item AS containment
FROM doc_shingles JOIN item_shingles USING (k, s) JOIN item_sizes USING (item)
GROUP BY row_no, doc_id, item, item_id, n_item HAVING count(*) >= 0.8 * n_item - 1e-9
"""

def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate class of each document."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "class_size", "kept")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calibrated probability of each document, and whether it is drawn."""
    return mixing_weights(table(spark, sf_dir, "documents"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the sources of each language lie apart, and the terms each stands out by."""
    return audit_sources(table(spark, sf_dir, "documents"))


OP11_SQL = """
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
), w AS (
  SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
), k AS (
  SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= 10
), c AS (
  SELECT lang, source, term, count(*) AS n FROM w GROUP BY lang, source, term
), x AS (
  SELECT lang, source, term, coalesce(n, 0) AS n
  FROM (SELECT DISTINCT lang, source FROM d) JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)
), y AS (
  SELECT lang, source, term, n, sum(n) OVER g AS n_group, count(*) OVER g AS v, sum(n) OVER t AS total, sum(n) OVER l AS n_lang
  FROM x WINDOW g AS (PARTITION BY lang, source), t AS (PARTITION BY lang, term), l AS (PARTITION BY lang)
), z AS (
  SELECT lang, source, term, n, CAST(1 + (1000000000::HUGEINT * (n + 2)) // (n_group + 2 * v) AS BIGINT) AS p,
    CAST(1 + (1000000000::HUGEINT * (total + 2)) // (n_lang + 2 * v) AS BIGINT) AS q FROM y
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM z a JOIN z b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), g AS (
  SELECT DISTINCT lang, source FROM d
), found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM z WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM found
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""


def _repeating(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            number = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
            words = text.split() if text is not None and number % 10 == 0 else []
            if words:
                n, g = len(words), number // 10
                start = g % n
                period = 1 + (n - start) // (3 + g % 8)
                words = words[:start] + [words[start + i % period] for i in range(n - start)]
                text = b" ".join(words)
            texts.append(text)
        yield pa.record_batch([batch.column("doc_id"), pa.array(texts, pa.binary())], ["doc_id", "text"])


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The periodic runs of each document, after those of a tenth of the ids were made to repeat."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("text").cast("binary"))
    found = periodic_runs(docs.mapInArrow(_repeating, docs.schema))
    # Most periods first: fractions compared exactly, then by start and period.
    by_exponent = F.expr(
        """array_sort(runs, (a, b) -> CASE
             WHEN a.length * b.period > b.length * a.period THEN -1 WHEN a.length * b.period < b.length * a.period THEN 1
             WHEN a.start < b.start THEN -1 WHEN a.start > b.start THEN 1
             WHEN a.period < b.period THEN -1 WHEN a.period > b.period THEN 1 ELSE 0 END)"""
    )
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return (
        found.withColumn("best", F.get(by_exponent, F.lit(0)))
        .select(
            "doc_id",
            F.size("runs").cast("long").alias("n_runs"),
            "best.start",
            "best.length",
            "best.period",
            F.expr("1000 * best.length div best.period").alias("exponent_milli"),
            F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
            "collapsed_sha256",
        )
    )


#: Rules (host, path, verdict) of the query.
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on each page's URL; one that no rule lists is allowed."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return filter_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict")


OP13_SQL = """
WITH u AS (
  SELECT page_id, coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), '') AS h,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages
), p AS (
  SELECT row_number() OVER () AS r, page_id, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path FROM u
), rules(rule_host, rule_path, says) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), f AS (
  SELECT r, rule_host || rule_path AS rule, says,
    row_number() OVER (PARTITION BY r ORDER BY length(rule_host || rule_path) DESC, length(rule_host) DESC) AS best
  FROM p JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
)
SELECT page_id, host, path, rule, coalesce(says, 'allow') AS verdict FROM p LEFT JOIN (SELECT * FROM f WHERE best = 1) USING (r)
"""


QUERIES: dict[str, Run] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_secrets": op3_secrets,
    "op4_line_dedup": op4_line_dedup,
    "op5_warc_fixity": op5_warc_fixity,
    "op6_language_id": op6_language_id,
    "op7_quality": op7_quality,
    "op8_decontaminate": op8_decontaminate,
    "op9_near_dedup": op9_near_dedup,
    "op10_mixing": op10_mixing,
    "op11_source_divergence": op11_source_divergence,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_url_filter": op13_url_filter,
}

ORACLE_SQL: dict[str, str] = {
    "op1_exact_dedup": OP1_SQL,
    "op5_warc_fixity": OP5_SQL,
    "op8_decontaminate": OP8_SQL,
    "op11_source_divergence": OP11_SQL,
    "op13_url_filter": OP13_SQL,
}
