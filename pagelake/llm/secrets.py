"""Secret scans with corpus-wide ownership frequency.

Each whole text is scanned for labelled assignments, access key ids and long hexadecimal runs (the
base kinds), and for opaque tokens: other runs of token characters that mix letters and digits
densely. The value of every candidate is hashed. Over the corpus, the distinct repositories and
distinct owners of each hash are counted: a value in the hands of many owners is an example that
was widely copied, and so is one in more than ``LIVE_REPOS`` repositories whatever its owners; one that
stays with few of both and looks random is a live-looking credential.

Base spans are always reported. The method adds the opaque tokens that look live (kind ``opaque``)
and tells live spans from examples. A document is a repository; its ``source`` is the owner.

Defined results: a null text counts as empty; a null source is an owner of its own; a value seen
several times in one row counts once for it; rows of one doc_id are one repository, and so are those of
null doc_ids; an empty table gives an empty result; other columns are ignored whatever their names.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelake.llm.stage import written

# The base kinds in their order, their patterns and least lengths.
KINDS = ("assign", "access", "hex", "opaque")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 12, "access": 18, "hex": 16}

#: What an opaque token is made of, its least length, and the least share of digits.
OPAQUE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
OPAQUE_DIGITS = 0.1

#: Bits per character from which a value looks random, and owners and repositories up to which it is one's own.
LIVE_BITS, LIVE_OWNERS, LIVE_REPOS = 3.0, 2, 20

#: Quick tests of a whole column; a text that passes none holds no candidate.
MAY_HOLD = (r"(?i)(passw|secret|token|api_?key)", r"AKIA[A-Z0-9]", r"[0-9a-f]{16}")

Span = tuple[str, int, int, str]


def base_spans(text: str) -> list[Span]:
    """(kind, start, end, value) of the base kinds, by start and then kind as listed."""
    found = [("assign", m.start(), m.end(), m.group(2)) for m in ASSIGN.finditer(text) if len(m.group(2)) >= LEAST["assign"]]
    found += [("access", m.start(), m.end(), m.group()) for m in ACCESS.finditer(text) if len(m.group()) >= LEAST["access"]]
    found += [("hex", m.start(), m.end(), m.group()) for m in HEX.finditer(text) if len(m.group()) >= LEAST["hex"]]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def bits_per_char(value: str) -> float:
    return -sum(n / len(value) * math.log2(n / len(value)) for n in Counter(value).values())


def opaque_spans(text: str, base: list[Span]) -> list[Span]:
    """Dense letter-digit tokens that overlap no base span."""
    found = []
    for m in OPAQUE.finditer(text):
        value = m.group()
        digits = sum(c.isdigit() for c in value)
        if digits < OPAQUE_DIGITS * len(value) or not any(c.isalpha() for c in value):
            continue
        if all(m.end() <= start or end <= m.start() for _, start, end, _ in base):
            found.append(("opaque", m.start(), m.end(), value))
    return found


def value_hash(value: str) -> int:
    return int.from_bytes(hashlib.sha256(value.encode()).digest()[:8], "big", signed=True)


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end, _ in spans)


SPAN = pa.struct([("start", pa.int64()), ("kind_no", pa.int32()), ("end", pa.int64()), ("kind", pa.string()), ("value_hash", pa.int64()), ("random", pa.bool_())])
SPAN_SQL = "array<struct<start: long, kind_no: int, end: long, kind: string, value_hash: long, random: boolean>>"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    empty = hashlib.sha256(b"").hexdigest()
    for batch in batches:
        texts = pc.fill_null(batch.column("text"), "")
        holds = pc.or_(pc.match_substring_regex(texts, "[0-9]"), pc.match_substring_regex(texts, MAY_HOLD[0]))
        for pattern in MAY_HOLD[1:]:
            holds = pc.or_(holds, pc.match_substring_regex(texts, pattern))
        counts, digests, spans = [], [], []
        for may, text in zip(holds.to_pylist(), texts, strict=True):
            if not may:
                counts.append((0, 0, 0))
                digests.append(empty)
                spans.append([])
                continue
            text = text.as_py()
            base = base_spans(text)
            by_kind = Counter(s[0] for s in base)
            counts.append(tuple(by_kind[k] for k in KINDS[:3]))
            digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
            every = sorted(base + opaque_spans(text, base), key=lambda s: (s[1], KINDS.index(s[0])))
            spans.append([(start, KINDS.index(kind), end, kind, value_hash(v), bits_per_char(v) >= LIVE_BITS) for kind, start, end, v in every])
        names = [f.name for f in SPAN]
        yield pa.record_batch(
            [
                batch.column("doc_id"),
                batch.column("owner"),
                *(pa.array([c[k] for c in counts], pa.int64()) for k in range(3)),
                pa.array(digests, pa.string()),
                pa.array([[dict(zip(names, s, strict=True)) for s in row] for row in spans], pa.list_(SPAN)),
            ],
            ["doc_id", "owner", "n_assign", "n_access", "n_hex", "base_sha256", "found"],
        )


def ownership(candidates: DataFrame) -> DataFrame:
    """value_hash, n_repos, n_owners: distinct ones of rows (value_hash, owner, doc_id).

    Both steps combine in map tasks, so a value that a third of all documents hold is no hot key.
    """
    # In a struct, null counts as a value.
    distinct = {n: F.count_distinct(F.struct(c)).alias(n) for n, c in (("n_repos", "doc_id"), ("n_owners", "owner"))}
    return candidates.groupBy("value_hash").agg(*distinct.values())


def scan_secrets(docs: DataFrame, *, owner: str = "source", live_owners: int = LIVE_OWNERS, live_repos: int = LIVE_REPOS) -> DataFrame:
    """One row per document: counts and digest of the base spans, all spans, live and example counts.

    doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_opaque, n_live, n_example.
    """
    chosen = docs.select("doc_id", F.col(owner).cast("string").alias("owner"), "text")
    id_type = chosen.schema["doc_id"].dataType.simpleString()
    shape = f"doc_id {id_type}, owner string, n_assign long, n_access long, n_hex long, base_sha256 string, found {SPAN_SQL}"
    scanned = written(chosen.mapInArrow(_scan, shape).withColumn("row", F.monotonically_increasing_id()), "secret-spans")
    holding = scanned.where(F.size("found") > 0)
    values = holding.select("owner", "doc_id", F.explode(F.array_distinct(F.col("found.value_hash"))).alias("value_hash"))
    owned = ownership(values)
    judged = (
        holding.select("row", F.explode("found").alias("s"))
        .select("row", "s.*")
        .join(owned, "value_hash")
        .withColumn("example", (F.col("n_owners") > live_owners) | (F.col("n_repos") > live_repos))
        .withColumn("live", F.col("random") & ~F.col("example"))
        .where((F.col("kind") != "opaque") | F.col("live"))
        .groupBy("row")
        .agg(
            F.array_sort(F.collect_list(F.struct("start", "kind_no", "end", "kind"))).alias("s"),
            F.count_if(F.col("kind") == "opaque").alias("n_opaque"),
            F.count_if("live").alias("n_live"),
            F.count_if("example").alias("n_example"),
        )
    )
    spans = F.array_join(F.transform("s", lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    zero = F.lit(0).cast("long")
    return scanned.join(judged, "row", "left").select(
        "doc_id",
        "n_assign",
        "n_access",
        "n_hex",
        "base_sha256",
        F.coalesce(spans, F.lit("")).alias("spans"),
        F.coalesce("n_opaque", zero).alias("n_opaque"),
        F.coalesce("n_live", zero).alias("n_live"),
        F.coalesce("n_example", zero).alias("n_example"),
    )
