"""From landed pages to tables, one resource at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagelake.functions.jsonpath import as_type
from pagelake.functions.text import snake_case
from pagelake.operators.commits import Log, Record
from pagelake.operators.contract import ensure_columns, with_sentinel
from pagelake.operators.dedup import latest_by_key
from pagelake.operators.dependent import child_pages
from pagelake.operators.incremental import incremental, or_floor, skip_stale_counted, take_while_fresh
from pagelake.operators.nested import array_columns, child_tables, flatten_structs
from pagelake.operators.pages import PAGE, POSITION, apply_status_policy, drop_page, skipped_feeds, unwrap
from pagelake.operators.sinks import LoadReport, Table, with_counts
from pagelake.session import scratch_scope, settle
from pagelake.sources.landing import infer_record, overlay, pick
from pagelake.sources.manifest import prune_runs
from pagelake.specs import Parent, Resource, Source

CURSOR = "_cursor"
# Where a record of a merged resource was delivered: of two versions with one cursor the later counts.
PLACE = "_place_in_run"


class Run:
    """One run of a source over landed pages.

    ``marks`` holds each resource's cursor mark as it stood before the run; it is never
    changed during it. ``options`` are values the special resources need (``mailbox``,
    ``site_id``, ``content``). ``records`` may pin the record type of a resource, which
    saves the inference pass. With a ``manifest`` of the landing, runs that hold nothing past
    a resource's mark are not read for it.
    """

    def __init__(
        self,
        spark: SparkSession,
        source: Source,
        pages: DataFrame,
        marks: Mapping[str, str | None] | None = None,
        records: Mapping[str, str | T.StructType] | None = None,
        manifest: DataFrame | None = None,
        **options: object,
    ) -> None:
        self.spark = spark
        self.manifest = manifest
        self.source = source
        self._pages = pick(pages, source.name)
        self.marks = dict(marks or {})
        self.records = dict(records or {})
        self.options = options
        self._increments: dict[tuple[str, bool], DataFrame] = {}
        self._crawled: dict[tuple, DataFrame] = {}
        self.late: dict[str, Observation] = {}

    def start(self, resource: Resource) -> object | None:
        """Mark of a resource in the cursor's own type, or its floor."""
        cursor = resource.cursor
        mark = or_floor(self.marks.get(resource.name), cursor.floor)
        if mark is None:
            return None
        if cursor.kind == "timestamp":
            return F.lit(mark).cast("timestamp")
        return int(mark) if cursor.kind == "bigint" else mark

    def pages(self, name: str) -> DataFrame:
        """Readable pages of a resource."""
        skip = self.source[name].skip if name in self.source.names() else ()
        return apply_status_policy(pick(self._pages, resource=name), skip)

    def landed(self, name: str) -> int:
        """How many pages of a resource there are, whatever their status."""
        return pick(self._pages, resource=self.source[name].pages_of or name).count()

    def skipped(self, name: str) -> DataFrame:
        """Feeds of a resource that ended on a skipped status."""
        return skipped_feeds(pick(self._pages, resource=name), list(self.source[name].skip))

    def record_type(self, resource: Resource, pages: DataFrame) -> T.StructType:
        """Record type: pinned, or found in the pages with the declared fields over it."""
        if resource.name in self.records:
            return as_type(self.records[resource.name])
        declared = as_type(resource.declared) if resource.declared else T.StructType()
        if resource.cursor and resource.build is None:
            declared = overlay(_cursor_field(resource), declared)
        return overlay(infer_record(pages, resource.selector), declared)

    def increment(self, name: str, *, full: bool = False) -> DataFrame:
        """Records of this run after the row transforms, not yet flattened."""
        if (name, full) not in self._increments:
            self._increments[name, full] = self._increment(self.source[name], full)
        return self._increments[name, full]

    def hold(self, name: str) -> None:
        """Write the increment once; what is built from it then reads the written rows."""
        self._increments[name, False] = settle(self.increment(name))

    def keep_latest(self, name: str) -> None:
        """Hold one version of each key: the largest cursor, then the latest delivery."""
        rows = self.increment(name)
        keys = list(self.source[name].key)
        order = [c for c in (CURSOR, PLACE) if c in rows.columns] or [F.lit(1)]
        self._increments[name, False] = settle(latest_by_key(rows.dropna(subset=keys), keys, order))

    def _increment(self, resource: Resource, full: bool) -> DataFrame:
        if resource.build is not None:
            return resource.build(self, resource)
        cursor = None if full else resource.cursor
        pages = self.pages(resource.pages_of or resource.name)
        if self.manifest is not None and cursor is not None and self.marks.get(resource.name) is not None:
            pages = prune_runs(pages, self.manifest, resource, self.start(resource))
        record = self.record_type(resource, pages)
        carry: list[str] = []
        if resource.parent is not None:
            parent = resource.parent
            parents = self._targets(parent) if parent.full else self.increment(parent.resource)
            pages = child_pages(parents, pages, parent.link, **parent.stamped)
            carry = list(parent.stamped)
        for entry in resource.stamp_request:
            pages = pages.withColumn(entry, F.try_element_at("request_key", F.lit(entry)))
            carry.append(entry)
        ordered = cursor is not None and cursor.how == "take_while"
        placed = resource.disposition == "merge" and not full
        rows = unwrap(pages, resource.selector, record, position=ordered or placed, carry=carry)
        if ordered:
            rows = take_while_fresh(
                rows,
                cursor.path,
                self.start(resource),
                feed=[f"{PAGE}.run_id", f"{PAGE}.feed"],
                missing=cursor.missing,
                inclusive=cursor.range_start == "closed",
            )
        elif cursor is not None and cursor.how == "skip_stale":
            rows, self.late[resource.name] = skip_stale_counted(rows, cursor.path, self.start(resource))
        if placed:
            rows = rows.withColumn(PLACE, F.struct(f"{PAGE}.run_id", f"{PAGE}.page_no", POSITION))
        rows = drop_page(rows)
        rows = reduce(lambda df, change: df.transform(change), resource.transforms, rows)
        if cursor is not None and cursor.how == "filter":
            rows = incremental(
                rows,
                cursor.path,
                self.start(resource),
                range_start=cursor.range_start,
                missing=cursor.missing,
            )
        return rows.withColumn(CURSOR, F.col(cursor.path)) if cursor is not None else rows

    def _targets(self, parent: Parent) -> DataFrame:
        """Keys of a parent read in full. Several resources crawl the same ones, so they
        are written once."""
        wanted = sorted({*parent.link.values(), *parent.stamped.values()})
        known = (parent.resource, parent.where, *wanted)
        if known not in self._crawled:
            rows = self.increment(parent.resource, full=True)
            rows = rows.transform(parent.where) if parent.where else rows
            self._crawled[known] = settle(rows.select(*wanted).distinct())
        return self._crawled[known]

    def rows(self, name: str) -> DataFrame:
        """The resource's table rows: flattened, in snake case, with the declared columns.

        Arrays of objects are left to :meth:`children`. The raw cursor stays in
        ``_cursor`` for the mark.
        """
        resource = self.source[name]
        flat = flatten_structs(self.increment(name)).drop(PLACE)
        return ensure_columns(flat, resource.contract).drop(
            *[c for c in array_columns(flat) if c not in resource.contract]
        )

    def children(self, name: str) -> dict[str, DataFrame]:
        """Child tables of the resource's arrays of objects."""
        resource = self.source[name]
        keys = [snake_case(k) for k in resource.key]
        flat = flatten_structs(self.increment(name))
        flat = flat.drop(CURSOR, PLACE, *[c for c in resource.contract if c not in keys])
        return child_tables(flat, keys, max_nesting=resource.max_nesting)


def _cursor_field(resource: Resource) -> T.StructType:
    names = resource.cursor.path.split(".")
    kind: T.DataType = as_type("bigint" if resource.cursor.kind == "bigint" else "string")
    for name in reversed(names):
        kind = T.StructType([T.StructField(name, kind)])
    return kind


def table_of(spark: SparkSession, warehouse: str, source: str, name: str, child: str | None = None) -> Table:
    """Table folder of a resource, or of one of its child tables, in a warehouse folder."""
    own = Table(spark, f"{warehouse.rstrip('/')}/{source}/{name}")
    return own if child is None else child_table_of(own, child)


def child_table_of(table: Table, child: str) -> Table:
    """Child table of a resource: a folder of its own, committed in the log of its parent."""
    return Table(table.spark, f"{table.root}__{child}", log_root=table.root, name=child)


def run_source(
    spark: SparkSession,
    source: Source,
    pages: DataFrame,
    warehouse: str,
    resources: Iterable[str] | None = None,
    *,
    run_id: str | None = None,
    sentinels: bool = False,
    child_tables: bool = True,
    on_error: str = "raise",
    side_by_side: int = 1,
    **options: object,
) -> dict[str, LoadReport]:
    """Load the resources (all by default) and report on each.

    The marks are read once before anything is written. A resource and its child tables
    are committed together, and its mark moves with that commit. A run that was appended
    before is not appended again. With ``on_error="report"`` a resource that fails is
    reported with its error and the others go on: so do, unread, those that take it as their parent.

    ``side_by_side`` resources are loaded at once, each in a job group of its own. A resource waits for its
    parent, whose increment it then shares, and for those that write the same table.
    """
    names = list(resources) if resources is not None else source.names()
    pages = pick(pages, run_id=run_id)
    marks = {
        r.name: table_of(spark, warehouse, source.name, r.table_name).high_water(r.name)
        for r in source.resources
        if r.cursor is not None
    }
    with scratch_scope(spark):
        run = Run(spark, source, pages, marks, **options)

        def load(name: str) -> LoadReport:
            spark.sparkContext.setJobGroup(f"{source.name}.{name}", f"load {source.name}.{name}")
            table = table_of(spark, warehouse, source.name, source[name].table_name)
            return _load(run, source[name], table, run_id, sentinels, child_tables)

        return _in_order(source, names, inheritable_thread_target(spark)(load), on_error, side_by_side)


def _in_order(source: Source, names: list[str], load: Callable[[str], LoadReport], on_error: str, side_by_side: int) -> dict[str, LoadReport]:
    """Load resources after what they wait for; a failed one takes along only those that need it."""
    parents = {n: source[n].parent.resource for n in names if source[n].parent is not None and source[n].parent.resource in names}
    waits = {n: {parents[n]} if n in parents else set() for n in names}
    for i, name in enumerate(names):
        # Writers of one table take turns, in the order given.
        before = [m for m in names[:i] if source[m].table_name == source[name].table_name]
        waits[name] |= {m for m in before[-1:] if name not in waits[m]}
    reports: dict[str, LoadReport] = {}
    running: dict[Future, str] = {}
    left = list(names)
    failed: Exception | None = None
    with ThreadPoolExecutor(max(1, side_by_side)) as pool:
        while left or running:
            for name in [n for n in left if waits[n] <= reports.keys()] if failed is None else []:
                left.remove(name)
                if name in parents and reports[parents[name]].error is not None:
                    reports[name] = _failure(source, name, f"not loaded: {parents[name]} failed")
                elif len(running) < side_by_side:
                    running[pool.submit(load, name)] = name
                else:
                    left.insert(0, name)
                    break
            if not running:
                if failed is not None:
                    break
                if left and not any(waits[n] <= reports.keys() for n in left):
                    raise ValueError(f"resources wait for each other: {left}")
                continue
            for future in wait(running, return_when=FIRST_COMPLETED).done:
                name = running.pop(future)
                error = future.exception()
                if error is None:
                    reports[name] = future.result()
                elif on_error == "report":
                    reports[name] = _failure(source, name, str(error))
                else:
                    failed = failed or error
    if failed is not None:
        raise failed
    return {name: reports[name] for name in names}


def _failure(source: Source, name: str, error: str) -> LoadReport:
    return LoadReport(0, source[name].disposition, 0, None, error=error)


def load_reports(spark: SparkSession, reports: Mapping[str, LoadReport]) -> DataFrame:
    """Reports as rows, to be kept: resource, disposition, rows, high_water, late, skipped, repeated, error."""
    rows = [(n, r.disposition, r.rows, r.high_water, r.late, r.skipped, r.repeated, r.error) for n, r in reports.items()]
    shape = "resource string, disposition string, rows bigint, high_water string, late bigint, skipped bigint, repeated boolean, error string"
    return spark.createDataFrame(rows, shape)


def _load(run: Run, resource: Resource, table: Table, run_id: str | None, sentinels: bool, child_tables: bool) -> LoadReport:
    name = resource.name
    keys = [snake_case(k) for k in resource.key]
    noted: dict = {"run_id": run_id, "resource": name}
    again = False
    if resource.disposition == "append" and run_id is not None:
        noted["pages"] = run.landed(name)
        if known := table.report_of(run_id, name, noted["pages"]):
            return known
        # More pages have landed under a run that was loaded before: what it had added goes with the same commit.
        again = bool(table.paths_of(run_id, name))
    merged = resource.disposition == "merge"
    if merged:
        # Child rows come from the versions that stay.
        run.keep_latest(name)
    staged: list[Record] = []
    if child_tables:
        children = run.children(name)
        if children and not merged:
            # Several tables come from the same records: parse them once.
            run.hold(name)
            children = run.children(name)
        parents = run.rows(name).select(*keys)
        staged = [_staged_child(child_table_of(table, c), rows, resource, parents, noted, again) for c, rows in children.items()]
        if resource.disposition != "append":
            # Rows of child tables that this run has nothing for go as well.
            for child in _known_children(table, name) - set(children):
                of = child_table_of(table, child)
                nothing = run.spark.createDataFrame([], of.schema())
                staged.append(_staged_child(of, nothing, resource, parents, noted))
    rows = run.rows(name)
    if sentinels and resource.sentinel:
        rows = with_sentinel(rows, keys)
    cursor = CURSOR if CURSOR in rows.columns else None
    skipped = run.skipped(name).count() if resource.skip else 0
    if merged:
        held = run.increment(name).schema
        # A key that the contract casts may repeat again.
        unique = all(held[k].dataType == rows.schema[c].dataType for k, c in zip(resource.key, keys, strict=True))
        own = table.staged_merge(rows, keys, unique=unique, cursor=cursor, skipped=skipped, **noted)
    else:
        own = table.staged(rows, resource.disposition, keys, cursor=cursor, skipped=skipped, **_without(table, noted, again), **noted)
    if name in run.late:
        own = with_counts(own, late=run.late[name].get["late"])
    return table.commit(own, *staged)


def _known_children(table: Table, resource: str) -> set[str]:
    return {r.table for r in Log(table.spark, table.root).current()[0] if r.table and r.resource == resource}


def _without(table: Table, noted: dict, again: bool) -> dict:
    return {"without": table.paths_of(noted["run_id"], noted["resource"])} if again else {}


def _staged_child(table: Table, rows: DataFrame, resource: Resource, parents: DataFrame, noted: dict, again: bool = False) -> Record:
    if resource.disposition != "merge":
        return table.staged(rows, resource.disposition, **_without(table, noted, again), **noted)
    own = [f"parent_{snake_case(k)}" for k in resource.key]
    # Deeper child tables carry the same parent columns under a longer prefix.
    found = [next(c for c in rows.columns if c.endswith(k)) for k in own]
    renamed = parents.select(
        *[parents[snake_case(k)].alias(c) for k, c in zip(resource.key, found, strict=True)]
    )
    return table.staged_merge(rows, found, of_parents=renamed, **noted)
