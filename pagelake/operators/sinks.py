"""Tables on plain parquet: append, replace and merge, with a commit log.

A table is a folder. Data files are written first, below ``data/``; then one small file
in ``commits/`` makes them part of the table, together with the row count and the cursor
mark of the run. A run that fails before that changes nothing, and the mark can never run
ahead of the data. Tables that belong together (a resource and its child tables) share a
log, and one file commits what a run wrote to all of them. Of two writers of one version
the second fails.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagelake.operators.commits import Log, Record, greatest_mark, live_files
from pagelake.operators.dedup import latest_by_key
from pagelake.operators.evolve import conformed, merged_schema
from pagelake.operators.joins import lookup_join
from pagelake.session import settle

BUCKET = "_bucket"

#: Rows of a bucket of a merged table. A table twice as large as its buckets allow gets more of them.
BUCKET_ROWS = 1_000_000


@dataclass(frozen=True)
class LoadReport:
    """What one write did. ``repeated``: the run was in the table already and nothing was written."""

    version: int
    disposition: str
    rows: int
    high_water: str | None
    late: int | None = None
    skipped: int | None = None
    repeated: bool = False
    error: str | None = None


@dataclass(frozen=True)
class Table:
    """A table folder; ``log_root`` is the folder whose log it shares, under its ``name``."""

    spark: SparkSession
    root: str
    log_root: str | None = None
    name: str = ""
    bucket_rows: int = BUCKET_ROWS

    # --- log -----------------------------------------------------------------

    def _log(self) -> Log:
        return Log(self.spark, self.log_root or self.root)

    def log(self) -> DataFrame:
        """Commit records of this table, one row per write."""
        return self._log().history().where(F.col("table") == self.name)

    def _records(self) -> list[Record]:
        return [r for r in self._log().current()[0] if r.table == self.name]

    def exists(self) -> bool:
        return bool(self._records())

    def high_water(self, resource: str | None = None) -> str | None:
        """The greatest cursor mark of all writes (of a resource); None before the first."""
        found = greatest_mark(r for r in self._records() if resource in (None, r.resource))
        return found.high_water if found else None

    def reports(self) -> DataFrame:
        """Load report: rows, mark, late rows and skipped feeds of every write."""
        return self.log().select("version", "resource", "run_id", "disposition", "rows", "high_water", "late", "skipped")

    def report_of(self, run_id: str, resource: str | None, pages: int | None = None) -> LoadReport | None:
        """The report of a run that is in the table already, unless it had other than ``pages`` pages when it was loaded."""
        for r in reversed(self._records()):
            if r.run_id == run_id and r.resource == resource and r.batch_id is None:
                if None not in (pages, r.pages) and pages != r.pages:
                    return None
                return LoadReport(r.version, r.disposition, r.rows, r.high_water, r.late, r.skipped, repeated=True)
        return None

    def streams(self, stream: str) -> dict[str, int]:
        """The last batch of each progress folder a stream of this name has had."""
        return {r.stream_id: r.batch_id for r in self._records() if r.run_id == stream and r.batch_id is not None}

    def paths_of(self, run_id: str, resource: str | None = None) -> list[str]:
        """Folders a run or stream has added (for a resource) that are still part of the table."""
        records = self._records()
        mine = {e["path"] for r in records if r.run_id == run_id and resource in (None, r.resource) for e in r.added}
        return [p for p in live_files(records) if p in mine]

    # --- reading -------------------------------------------------------------

    def read(self) -> DataFrame:
        """Current rows."""
        records = self._records()
        if not records:
            raise FileNotFoundError(f"no table at {self.root}")
        return self._rows(live_files(records), _schema_of(records))

    def schema(self) -> T.StructType:
        return _schema_of(self._records())

    def _rows(self, files: dict[str, tuple[int, str]], schema: T.StructType) -> DataFrame:
        """Rows of some folders in the table's types; one scan for each schema that files were written with."""
        by_schema: dict[str, list[str]] = {}
        for path, (_, written) in files.items():
            by_schema.setdefault(written, []).append(f"{self.root}/{path}")
        out = None
        for written, paths in by_schema.items():
            rows = conformed(self.spark.read.schema(T.StructType.fromJson(json.loads(written))).parquet(*paths), schema)
            out = rows if out is None else out.unionByName(rows)
        return self.spark.createDataFrame([], schema) if out is None else out

    # --- writing -------------------------------------------------------------

    def _write(self, rows: DataFrame, by: str | None = None) -> list[dict]:
        """Write a new data folder; its parts with their rows, one for each bucket with ``by``."""
        path = f"data/{uuid.uuid4().hex}"
        writer = rows.write.option("compression", "zstd")
        writer = writer.partitionBy(by) if by else writer
        writer.parquet(f"{self.root}/{path}")
        if by is None:
            return [{"path": path, "rows": -1}]
        found = self.spark.read.schema(rows.schema).parquet(f"{self.root}/{path}").groupBy(by).count().collect()
        return [{"path": f"{path}/{by}={r[by]}", "rows": r["count"]} for r in sorted(found, key=lambda r: r[by])]

    def staged_append(self, rows: DataFrame, *, without: Sequence[str] = (), **run: object) -> Record:
        """Append, written but not committed. ``without`` are folders that go with the same commit."""
        records = self._records()
        rows, watch = _watched(_writable(rows), run.get("cursor"))
        added = self._write(rows)
        seen = watch.get
        return self._record(records, "append", rows.schema, [{**a, "rows": seen["rows"]} for a in added], list(without), seen, run)

    def staged_replace(self, rows: DataFrame, **run: object) -> Record:
        records = self._records()
        rows, watch = _watched(_writable(rows), run.get("cursor"))
        added = self._write(rows)
        seen = watch.get
        return self._record([], "replace", rows.schema, [{**a, "rows": seen["rows"]} for a in added], list(live_files(records)), seen, run)

    def staged_merge(
        self,
        rows: DataFrame,
        keys: Sequence[str],
        order: Sequence[str | Column] = (),
        *,
        of_parents: DataFrame | None = None,
        unique: bool = False,
        **run: object,
    ) -> Record:
        """``unique``: the rows are one per key already and read from files, so they are neither sorted out nor written once more."""
        records = self._records()
        keys = list(keys)
        rows = _writable(rows.dropna(subset=keys))
        if unique:
            seen, incoming = _counted(rows, run.get("cursor"))
        else:
            rows, watch = _watched(rows, run.get("cursor"))
            if of_parents is None:
                rows = latest_by_key(rows, keys, list(order) or [F.lit(1)])
            incoming = settle(rows)
            seen = watch.get
        gone = (incoming if of_parents is None else of_parents).select(*keys).dropna()
        gone = settle(gone if unique else gone.distinct())
        live = live_files(records)
        stored = sum(n for n, _ in live.values())
        buckets = records[-1].buckets if records else None
        regroup = buckets is None or stored + seen["rows"] > 2 * self.bucket_rows * buckets
        if regroup:
            buckets = max(1, -(-(stored + seen["rows"]) // self.bucket_rows))
        bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias(BUCKET)
        touched = {r[0] for r in gone.select(bucket).distinct().collect()}
        old = live if regroup else {p: f for p, f in live.items() if int(p.rsplit("=", 1)[1]) in touched}
        schema = _table_schema(records, incoming.schema, seen)
        merged = conformed(incoming, schema)
        if old:
            # A short list of keys is broadcast, so stored rows are not shuffled to find them.
            stored_rows = self._rows(old, schema)
            by_stored = order and all(isinstance(o, str) and o in schema.names for o in order)
            if by_stored and of_parents is None:
                # The stored version stays where it comes first; of equal ones the incoming.
                rivals = lookup_join(stored_rows, gone, keys, "left_semi").withColumn("_incoming", F.lit(0))
                both = rivals.unionByName(merged.withColumn("_incoming", F.lit(1)))
                merged = latest_by_key(both, keys, [*order, "_incoming"]).drop("_incoming")
            kept = lookup_join(stored_rows, gone, keys, "left_anti")
            merged = kept.unionByName(merged)
        added = []
        if old or touched:
            # Rebalancing gives files of a good size and splits a bucket that is too large.
            added = self._write(merged.withColumn(BUCKET, bucket).hint("rebalance", BUCKET), BUCKET)
        return self._record(records, "merge", schema, added, list(old), seen, run, buckets)

    def staged(self, rows: DataFrame, disposition: str, keys: Sequence[str] = (), order: Sequence[str | Column] = (), **run: object) -> Record:
        """Append, replace or merge by name, written but not committed."""
        if disposition == "append":
            return self.staged_append(rows, **run)
        if disposition == "replace":
            return self.staged_replace(rows, **run)
        if disposition == "merge":
            return self.staged_merge(rows, keys, order, **run)
        raise ValueError(f"unknown disposition {disposition}")

    def commit(self, *records: Record) -> LoadReport:
        """Make what was staged, here and in the tables of the same log, part of them; the report of the first."""
        version = self._log().commit(list(records))
        own = records[0]
        return LoadReport(version, own.disposition, own.rows, own.high_water, own.late, own.skipped)

    def append(self, rows: DataFrame, **run: object) -> LoadReport:
        """Add rows; several versions of a key may pile up."""
        return self.commit(self.staged_append(rows, **run))

    def replace(self, rows: DataFrame, **run: object) -> LoadReport:
        """Make the rows the whole table; without rows it is empty but typed."""
        return self.commit(self.staged_replace(rows, **run))

    def merge(self, rows: DataFrame, keys: Sequence[str], order: Sequence[str | Column] = (), **run: object) -> LoadReport:
        """Upsert: an incoming key replaces the stored row; one row per key.

        Of several incoming rows with one key the first by ``order`` counts; where ``order`` names
        columns of the table, the stored row is compared as well, so that an older version that
        arrives later changes nothing. Without it the incoming row replaces the stored one. Rows
        without a key are left out. Rows live in hash buckets of the key and only the
        buckets an incoming key falls in are rewritten. For a child table, whose key is
        its parent's, ``of_parents`` gives the parents written: all their stored rows
        go and all incoming rows stay.
        """
        return self.commit(self.staged_merge(rows, keys, order, **run))

    def write(self, rows: DataFrame, disposition: str, keys: Sequence[str] = (), order: Sequence[str | Column] = (), **run: object) -> LoadReport:
        """Append, replace or merge by name."""
        return self.commit(self.staged(rows, disposition, keys, order, **run))

    def vacuum(self) -> int:
        """Delete data folders that are part of no version read now. No reader or writer may be at work."""
        kept = {p.split("/")[1] for p in live_files(self._records())}
        at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/data")
        fs = at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        dead = [s.getPath() for s in fs.listStatus(at) if s.getPath().getName() not in kept] if fs.exists(at) else []
        for path in dead:
            fs.delete(path, True)
        return len(dead)

    def _record(
        self,
        records: list[Record],
        disposition: str,
        written: T.StructType,
        added: list[dict],
        removed: list[str],
        seen: dict,
        run: dict,
        buckets: int | None = None,
    ) -> Record:
        empty = set(_empty_of(seen))
        if records:
            known = set(_schema_of(records).names)
            empty = {c for c in (empty | known) if c not in known or c in records[-1].empty} & (empty | (known - set(seen["names"])))
        return Record(
            table=self.name,
            resource=run.get("resource"),
            run_id=run.get("run_id"),
            stream_id=run.get("stream_id"),
            batch_id=run.get("batch_id"),
            disposition=disposition,
            rows=seen["rows"],
            high_water=seen.get("high_water"),
            added=added,
            removed=removed,
            schema=_table_schema(records, written, seen).json(),
            file_schema=written.json(),
            empty=sorted(empty),
            buckets=buckets,
            late=run.get("late"),
            skipped=run.get("skipped"),
            mark_type=seen.get("mark_type"),
            pages=run.get("pages"),
        )


def with_counts(record: Record, **counts: int | None) -> Record:
    """The record with late or skipped counts that are known only once the rows were written."""
    return replace(record, **counts)


def _schema_of(records: list[Record]) -> T.StructType:
    return T.StructType.fromJson(json.loads(records[-1].schema))


def _empty_of(seen: dict) -> list[str]:
    return [n for n, k in seen["names"].items() if not seen[k]]


def _table_schema(records: list[Record], written: T.StructType, seen: dict) -> T.StructType:
    if not records:
        return written
    return merged_schema(_schema_of(records), written, records[-1].empty, _empty_of(seen))


def _writable(rows: DataFrame) -> DataFrame:
    """Columns without a type as text: files cannot hold them otherwise."""
    untyped = [f.name for f in rows.schema.fields if isinstance(f.dataType, T.NullType)]
    return rows.withColumns({n: F.col(f"`{n}`").cast("string") for n in untyped}) if untyped else rows


class _Watch:
    """Counts taken while rows are written."""

    def __init__(self, names: dict[str, str], mark_type: str | None) -> None:
        self.observation = Observation()
        self.names, self.mark_type = names, mark_type

    @property
    def get(self) -> dict:
        return {**self.observation.get, "names": self.names, "mark_type": self.mark_type}


def _watched(rows: DataFrame, cursor: object) -> tuple[DataFrame, _Watch]:
    """Rows that report their count, largest cursor and columns with values while they are written."""
    names, mark_type, measures = _measures(rows, cursor)
    watch = _Watch(names, mark_type)
    return _shown(rows.observe(watch.observation, *measures), cursor), watch


def _counted(rows: DataFrame, cursor: object) -> tuple[dict, DataFrame]:
    """What :func:`_watched` reports, of rows that are files already, and the rows."""
    names, mark_type, measures = _measures(rows, cursor)
    return {**rows.agg(*measures).first().asDict(), "names": names, "mark_type": mark_type}, _shown(rows, cursor)


def _shown(rows: DataFrame, cursor: object) -> DataFrame:
    """Rows without a cursor column that only serves the mark: its name starts with "_"."""
    return rows.drop(str(cursor)) if str(cursor).startswith("_") else rows


def _measures(rows: DataFrame, cursor: object) -> tuple[dict[str, str], str | None, list[Column]]:
    names = {f.name: f"has{i}" for i, f in enumerate(_shown(rows, cursor).schema.fields)}
    whole = cursor is not None and isinstance(rows.schema[str(cursor)].dataType, T.IntegralType)
    measures = [F.count(F.lit(1)).alias("rows"), *(F.coalesce(F.max(F.col(f"`{n}`").isNotNull()), F.lit(False)).alias(k) for n, k in names.items())]
    if cursor is not None:
        largest = F.max(str(cursor))
        if isinstance(rows.schema[str(cursor)].dataType, (T.TimestampType, T.TimestampNTZType)):
            largest = F.date_format(largest, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
        measures.append(largest.cast("string").alias("high_water"))
    return names, None if cursor is None else "bigint" if whole else "text", measures


def cursor_state(table: Table) -> DataFrame:
    """Current mark of every resource that writes the table: the greatest it has had."""
    number = F.max(F.when(F.col("mark_type") == "bigint", F.col("high_water").try_cast("bigint"))).cast("string")
    return table.log().groupBy("resource").agg(F.coalesce(number, F.max("high_water")).alias("last_value"))
