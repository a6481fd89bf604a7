"""Streams of landed pages into tables, one micro-batch at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from pagelake.operators.sinks import Table
from pagelake.sources.landing import PAGES


def stream_pages(spark: SparkSession, path: str, *, max_files: int | None = None) -> DataFrame:
    """Landed pages as a stream of newly arrived files."""
    reader = spark.readStream.schema(PAGES)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def batch_writer(
    table: Table,
    disposition: str,
    keys: Sequence[str] = (),
    order: Sequence[str | Column] = (),
    *,
    stream: str,
    prepare: Callable[[DataFrame], DataFrame] = lambda df: df,
    cursor: str | None = None,
    on_new_progress: str = "fail",
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function with one of the write dispositions.

    A batch is known by the id that its progress folder keeps for the stream, and its
    number: a restart after the commit leaves a committed batch alone, so every batch
    counts once. A new progress folder reads all landed pages again, from batch 0. A
    merge or replace may do so; for an append under a name that has been used that is an
    error, or with ``on_new_progress="reload"`` the first batch's commit takes out what
    the stream had added before.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        progress = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        if progress is None:
            raise RuntimeError("the stream's id is not known here; call this from foreachBatch")
        known = table.streams(stream)
        if progress in known and batch_id <= known[progress]:
            return
        run = {"run_id": stream, "stream_id": progress, "batch_id": batch_id, "cursor": cursor}
        if disposition == "append" and known and progress not in known:
            if on_new_progress != "reload":
                raise RuntimeError(f"stream {stream} has written to {table.root} from another progress folder")
            run["without"] = table.paths_of(stream)
        table.write(prepare(batch), disposition, keys, order, **run)

    return write


def run_available(
    stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str
) -> StreamingQuery:
    """Work through everything that has arrived, then stop."""
    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def stream_dedup(stream: DataFrame, keys: Sequence[str], ts: str, delay: str) -> DataFrame:
    """First delivery of each key; a repeat within ``delay`` of it is dropped.

    The state holds only keys seen within the delay.
    """
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


class OutOfOrder(RuntimeError):
    """A feed's pages did not land in the order in which they were asked for."""


def stream_take_while(
    rows: DataFrame,
    feed: Sequence[str],
    run: str,
    position: Sequence[str],
    cursor: str,
    *,
    missing: str = "stale",
) -> DataFrame:
    """Rows of each newest-first feed up to its first old row, across micro-batches and restarts.

    A feed's state is its mark as it stood when its newest run began, the greatest cursor delivered
    since, the place of that run's first old row and the last place delivered. Runs follow each other in
    the order of ``run``; the first has no mark and is taken whole. ``position`` is two columns of
    whole numbers (page, place in the page), neither null. Cursors are compared as they are, text as
    text; a missing one is old, or fresh with ``missing="include"``.

    Pages land in the order they were asked for, each after the answer to the one before; within a batch
    they may come in any order. An old row in front of delivered ones, or a row of a run before the
    newest, fails the stream with :class:`OutOfOrder`: what was delivered cannot be taken back.
    A task holds one feed's rows of one batch up to the first old row, so bound a batch by
    ``max_files``; the state is one small row for each feed.
    """
    if missing not in ("stale", "include"):
        raise ValueError("missing must be stale or include")
    schema = rows.schema
    kinds = {f.name: f.dataType for f in schema.fields}
    state_type = T.StructType(
        [T.StructField("run", kinds[run])]
        + [T.StructField(n, kinds[cursor]) for n in ("start", "high")]
        + [T.StructField(n, T.LongType()) for n in ("cut_page", "cut_place", "last_page", "last_place")]
    )
    page, place = position
    include = missing == "include"

    def places(part: pd.DataFrame) -> list[tuple[int, int]]:
        return list(zip(part[page].astype("int64").tolist(), part[place].astype("int64").tolist(), strict=True))

    def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now, start, high, *seen = state.get if state.exists else (None,) * 7
        before = tuple(seen[:2]) if seen and seen[0] is not None else None
        last = tuple(seen[2:]) if seen and seen[2] is not None else None
        by_run: dict[object, list[pd.DataFrame]] = {}
        for part in parts:
            for name, of_run in part.groupby(run, sort=False):
                by_run.setdefault(name, []).append(of_run)
        for name in sorted(by_run):
            if now is not None and name < now:
                raise OutOfOrder(f"rows of run {name} of feed {key} came after run {now}")
            if name != now:
                now, start, before, last = name, high, None, None
            held = pd.concat(by_run[name], ignore_index=True)
            held["_at"] = places(held)
            held = held.sort_values("_at", kind="stable")
            if start is not None:
                absent = held[cursor].isna()
                old = absent & (not include) | ~absent & (held[cursor].where(~absent, start) <= start)
                first = min(held.loc[old, "_at"], default=None)
                if first is not None and last is not None and first < last:
                    raise OutOfOrder(f"an old row of run {name} of feed {key} came after rows behind it")
                before = first if before is None else before if first is None else min(before, first)
            taken = held if before is None else held[held["_at"].map(lambda at: at < before).astype(bool)]
            if len(taken):
                last = max([taken["_at"].iloc[-1]] + ([last] if last else []))
                told = taken[cursor].dropna()
                newest = told.max() if len(told) else None
                high = newest if high is None or newest is not None and newest > high else high
                yield taken.drop(columns="_at")
        state.update((now, _plain(start), _plain(high), *(before or (None, None)), *(last or (None, None))))

    return rows.groupBy(*feed).applyInPandasWithState(step, schema, state_type, "append", GroupStateTimeout.NoTimeout)


def _plain(value: object) -> object:
    """A cursor as the state keeps it."""
    return value.to_pydatetime() if isinstance(value, pd.Timestamp) else value.item() if hasattr(value, "item") else value
