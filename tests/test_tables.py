import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import ids, page
from pagelake.operators import dedup, incremental as I, joins, nested as N
from pagelake.operators.contract import align_to_template, columns, drop_sentinel, ensure_columns, with_sentinel
from pagelake.operators.pages import unwrap
from pagelake.operators.sinks import Table, cursor_state
from pagelake.session import scratch_dir
from pagelake.streaming.streams import stream_take_while


@pytest.fixture
def table(spark):
    return Table(spark, scratch_dir(spark, "table"), bucket_rows=25)


def test_contract(spark):
    df = spark.sql(
        "select 'x' a, '7' n, 'bad' m, 'true' b, '2024-01-01T00:00:00Z' t, '1.5' d, "
        "named_struct('k', null) j, array(1) l, 'extra' e"
    )
    out = ensure_columns(
        df,
        columns(text=["a", "gone"], bigint=["n", "m"], bool=["b"], timestamp=["t"], decimal=["d"], json=["j", "l"]),
    )
    row = out.first().asDict()
    assert row["gone"] is None and row["n"] == 7 and row["m"] is None and row["b"] is True
    assert row["t"] == datetime(2024, 1, 1) and str(row["d"]) == "1.500000000"
    assert json.loads(row["j"]) == {"k": None} and row["l"] == "[1]" and row["e"] == "extra"
    assert dict(out.dtypes)["d"] == "decimal(38,9)"
    assert align_to_template(df, columns(bigint=["n"], text=["z", "a"])).columns == ["n", "z", "a"]
    with pytest.raises(ValueError):
        columns(blob=["x"])


def test_sentinel(spark):
    empty = spark.createDataFrame([], "id bigint, v string")
    assert ids(with_sentinel(empty), "id", "v") == [(None, None)]
    assert drop_sentinel(with_sentinel(empty)).count() == 0
    full = spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, v string")
    assert ids(with_sentinel(full), "id") == [(1,), (2,)]
    assert dict(with_sentinel(empty, ["other"]).dtypes)["other"] == "string"


def test_nested_rows(spark):
    df = spark.createDataFrame(
        [("{\"record_id\":\"r1\"}", None), ("plain", "own"), (None, "own")], "id string, record_id string"
    )
    assert [r["record_id"] for r in N.promote_nested_key(df, "id", "record_id").collect()] == ["r1", "own", None]
    values = {
        "name": [{"active_until": None, "value": "Acme"}],
        "stage": [{"active_until": "2020", "status": {"title": "Old"}}, {"status": {"title": "Won"}}],
        "gone": [{"active_until": "2020", "value": "x"}],
        "preset": [{"value": "new"}],
    }
    df = spark.createDataFrame([(json.dumps(values), "kept"), (None, "kept")], "values string, preset string")
    rows = N.promote_found(df, ["name", "declared"]).collect()
    assert (rows[0]["name"], rows[0]["stage"], rows[0]["gone"], rows[0]["preset"]) == ("Acme", "Won", None, "kept")
    assert rows[0]["declared"] is None and rows[1]["name"] is None


def test_hoist_iso_flatten(spark):
    df = spark.sql(
        "select 'in_1' id, 'sub_1' subscription, named_struct('d', named_struct('s', 'x')) parent "
        "union all select 'in_2', null, named_struct('d', named_struct('s', 'sub_2')) "
        "union all select 'in_3', null, null"
    )
    got = N.hoist_if_null(df, "subscription", "parent.d.s")
    assert ids(got.na.fill("-"), "id", "subscription") == [("in_1", "sub_1"), ("in_2", "sub_2"), ("in_3", "-")]
    df = spark.sql("select named_struct('Create', 'c', 'Last', '2024-01-01T00:00:00-08:00') AS Meta")
    row = N.iso_column(df, "Meta.Last").first()
    assert row["Meta"]["Last"] == datetime(2024, 1, 1, 8) and row["Meta"]["Create"] == "c"
    flat = N.flatten_structs(spark.sql("select named_struct('FreeForm', named_struct('X1', 1)) AS PrimaryPhone, 2 AS Id"))
    assert flat.columns == ["primary_phone__free_form__x1", "id"]
    with pytest.raises(ValueError):
        N.flatten_structs(spark.sql("select named_struct('b', 1) AS a, 2 AS a__b"))


def test_child_tables(spark):
    df = spark.sql(
        "select 'p' id, array(named_struct('Sku', 'a', 'parts', array(named_struct('n', 1), named_struct('n', 2))),"
        " named_struct('Sku', 'b', 'parts', null)) lines"
    )
    deep = N.child_tables(df, ["id"])
    assert set(deep) == {"lines", "lines__parts"}
    assert ids(deep["lines"], "parent_id", "list_idx", "sku") == [("p", 0, "a"), ("p", 1, "b")]
    assert ids(deep["lines__parts"], "parent_parent_id", "parent_list_idx", "list_idx", "n") == [
        ("p", 0, 0, 1),
        ("p", 0, 1, 2),
    ]
    capped = N.child_tables(df, ["id"], max_nesting=1)
    assert set(capped) == {"lines"}
    assert json.loads(capped["lines"].orderBy("list_idx").first()["parts"]) == [{"n": 1}, {"n": 2}]


def test_engagements(spark):
    df = spark.sql(
        "select named_struct('id', 101, 'bodyPreview', 'b') engagement, "
        "named_struct('contactIds', array(1001, 1002), 'companyIds', array(), 'dealIds', null) associations"
    )
    row = N.flatten_engagement(df).first()
    assert row["id"] == 101 and json.loads(row["associations__contact_ids"]) == [1001, 1002]
    assert row["associations__company_ids"] == "[]" and row["associations__deal_ids"] == "[]"


def test_cursors(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, "c"), (4, None)], "id int, c string")
    kept = df.where("c is not null")
    assert ids(I.incremental(kept, "c", "b"), "id") == [(3,)]
    assert ids(I.incremental(df, "c", "b", range_start="closed", missing="include"), "id") == [(1,), (3,), (4,)]
    assert ids(I.incremental(df, "c", None, missing="include"), "id") == [(1,), (2,), (3,), (4,)]
    assert ids(I.incremental(df, "c", "b", missing="stale"), "id") == [(3,)]
    with pytest.raises(Exception, match="cursor value is missing"):
        I.incremental(df, "c", "b").count()
    assert ids(I.skip_stale(df, "c", "a"), "id") == [(1,), (3,)]
    assert ids(I.late_rows(df, "c", "a"), "id") == [(2,), (4,)]
    assert I.high_water(df, "c").first()["high_water"] == "c"


def test_late_rows_are_counted(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, None)], "id int, c string")
    fresh, watch = I.skip_stale_counted(df, "c", "a")
    assert ids(fresh, "id") == [(1,)] and watch.get == {"late": 2, "fresh": 1}


def feed_pages(landed):
    return landed(
        page("s", "r", {"data": [{"id": 1, "u": "9"}, {"id": 2, "u": "8"}]}, feed="a", no=1),
        page("s", "r", {"data": [{"id": 3, "u": "5"}, {"id": 4, "u": "7"}]}, feed="a", no=2),
        page("s", "r", {"data": [{"id": 5, "u": "9"}]}, feed="a", no=3),
        page("s", "r", {"data": [{"id": 6, "u": "6"}, {"id": 7, "u": None}, {"id": 8, "u": "9"}]}, feed="b"),
        page("s", "r", {"data": [{"id": 9, "u": "9"}]}, feed="c"),
    )


def test_take_while(landed):
    rows = unwrap(feed_pages(landed), "data", "id bigint, u string", position=True)
    assert ids(I.take_while_fresh(rows, "u", "5"), "id") == [(1,), (2,), (6,), (9,)]
    got = I.take_while_fresh(rows, "u", "6", missing="include", inclusive=True)
    assert ids(got, "id") == [(1,), (2,), (6,), (7,), (8,), (9,)]
    assert I.take_while_fresh(rows, "u", None).count() == 9
    with pytest.raises(Exception, match="cursor value is missing"):
        I.take_while_fresh(rows, "u", "5", missing="raise").count()


def test_slices(spark):
    df = spark.range(25).selectExpr("(id * 7) % 25 AS id", "0 AS tie")
    assert [r[0] for r in I.ordered_slice(df, ["tie", "id"], 11, 5).select("id").collect()] == [10, 11, 12, 13, 14]
    got = I.numbered_slices(df, ["tie", "id"], 10)
    assert ids(got, "id", "slice_no") == [(i, i // 10 + 1) for i in range(25)]
    assert I.numbered_slices(df.limit(0), ["tie", "id"], 10).count() == 0


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("limits", [(1000, 1000), (0, 1000), (0, 5)])
def test_lookup_join_matches_plain_join(spark, how, limits):
    facts = spark.range(90).selectExpr("id", "case when id % 3 = 0 then 1 else id % 11 end AS k")
    lookup = spark.createDataFrame([(1, "one"), (2, "two"), (50, "none")], "k bigint, name string")
    got = joins.lookup_join(facts, lookup, ["k"], how, broadcast_rows=limits[0], hot_rows=limits[1])
    want = facts.join(lookup, ["k"], how)
    assert got.columns == want.columns
    assert ids(got, "id") == ids(want, "id") and got.exceptAll(want).count() == 0


def test_a_wide_lookup_is_not_broadcast(spark, monkeypatch):
    facts = spark.range(20).selectExpr("id", "id % 4 AS k")
    wide = spark.createDataFrame([(1, "x" * 1000, [("y" * 1000,)])], "k bigint, t string, a array<struct<s:string>>")

    def plan(limit):
        monkeypatch.setattr(joins, "BROADCAST_BYTES", limit)
        monkeypatch.setattr(joins, "split_join", lambda *a, **k: "split")
        return joins.lookup_join(facts, wide, ["k"])

    assert plan(1900) == "split"
    assert plan(2500).count() == 5


@pytest.mark.parametrize("broadcast_rows", [1000, -1])
def test_empty_lookups(spark, broadcast_rows):
    facts = spark.range(20).selectExpr("id", "id % 4 AS k")
    typed = spark.createDataFrame([], "k bigint, name string")
    filtered = facts.where("id < 0").selectExpr("k", "'n' AS name")
    joined = facts.join(filtered, "k").groupBy("k").agg(F.max("name").alias("name"))
    for lookup in [typed, filtered, joined, filtered.limit(0)]:
        for how, n in [("inner", 0), ("left", 20), ("left_semi", 0), ("left_anti", 20)]:
            assert joins.lookup_join(facts, lookup, ["k"], how, broadcast_rows=broadcast_rows).count() == n


def test_empty_writes(spark, table):
    empty = spark.createDataFrame([], "id int, c string")
    lost = empty.join(empty.select("id").where("id = 5"), "id")
    for rows in [empty, lost, lost.groupBy("id").agg(F.max("c").alias("c"))]:
        assert table.append(rows, cursor="c").rows == 0
        assert table.merge(rows, ["id"], cursor="c").rows == 0
    assert table.read().count() == 0


def test_hot_keys_are_split(spark):
    facts = spark.range(90).selectExpr("id", "case when id < 60 then 1 else id end AS k")
    hot = joins.hot_keys(facts, ["k"], 25)
    assert ids(hot, "k", "_pieces") == [(1, 3)]


def test_latest_and_canonical(spark):
    df = spark.createDataFrame(
        [(1, "2024", "a"), (1, "2025", "b"), (2, None, "c"), (None, None, "s")], "id int, t string, v string"
    )
    assert ids(dedup.current_view(df, ["id"], ["t"]), "id", "v") == [(1, "b"), (2, "c")]
    users = spark.createDataFrame([(1, "z"), (1, "y"), (2, "x")], "id int, organization string")
    assert ids(dedup.canonical_by(users, "id", "organization"), "id", "organization") == [(1, "y"), (2, "x")]
    plan = dedup.latest_by_key(df, ["id"], ["t"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_key_audit(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (None, None), (3, "c")], "k int, l string")
    assert ids(dedup.key_audit(df, ["k", "l"]).na.fill("-"), "k", "l", "problem") == [
        (1, "a", "duplicate"),
        (2, "-", "null_key"),
    ]


def test_append_replace(spark, table):
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "id int, c string")
    first = table.append(rows, cursor="c", resource="r")
    assert (first.rows, first.high_water) == (2, "b")
    table.append(rows.where("id = 1"), cursor="c", resource="r")
    assert ids(table.read(), "id") == [(1,), (1,), (2,)]
    table.replace(rows.where("id = 2"))
    assert ids(table.read(), "id") == [(2,)]
    table.replace(rows.limit(0))
    assert table.read().count() == 0 and table.read().columns == ["id", "c"]
    assert ids(cursor_state(table).where("resource = 'r'"), "resource", "last_value") == [("r", "b")]
    assert table.high_water("r") == "b" and table.high_water("other") is None
    assert table.reports().count() == 4


def test_merge(spark, table):
    base = spark.range(100).selectExpr("id", "'old' v")
    table.merge(base, ["id"])
    change = spark.sql("select 5L id, 'mid' v, 1 n union all select 5L, 'new', 2 union all select 200L, 'new', 1 union all select null, 'x', 1")
    for _ in range(2):
        table.merge(change, ["id"], [F.col("n").desc()])
        now = table.read()
        assert now.count() == 101
        assert ids(now.where("v <> 'old'"), "id", "v") == [(5, "new"), (200, "new")]
        assert "_bucket" not in now.columns
    last = table.log().orderBy(F.desc("version")).first()
    assert 1 <= len(last["added"]) <= 2 and len(last["removed"]) == len(last["added"])


def test_merge_of_children_drops_lost_ones(spark, table):
    lines = spark.sql("select 'a' p, 0 i union all select 'a', 1 union all select 'b', 0")
    parents = spark.sql("select 'a' p union all select 'b'")
    table.merge(lines, ["p"], of_parents=parents)
    assert ids(table.read(), "p", "i") == [("a", 0), ("a", 1), ("b", 0)]
    table.merge(lines.where("p = 'a' and i = 0"), ["p"], of_parents=parents)
    assert ids(table.read(), "p", "i") == [("a", 0)]


def test_a_failed_write_changes_nothing(spark, table):
    rows = spark.createDataFrame([(1, "a")], "id int, c string")
    table.append(rows, cursor="c")
    bad = rows.withColumn("id", F.raise_error(F.lit("boom")).cast("int"))
    with pytest.raises(Exception, match="boom"):
        table.append(bad, cursor="c")
    assert table.read().count() == 1 and table.high_water() == "a"
    table.append(spark.createDataFrame([(2, "b")], "id int, c string"), cursor="c")
    assert table.read().count() == 2 and table.high_water() == "b"


def test_of_two_writers_the_second_fails(spark, table):
    rows = spark.createDataFrame([(1, "a")], "id int, c string")
    table.append(rows)
    first, second = table.staged_append(rows), table.staged_append(rows)
    log = table._log()
    log.commit([first])
    name = f"{2:012d}.commit.json"
    with pytest.raises(Exception, match="exist"):
        log._write(name, [second])
    assert table.read().count() == 2


def test_log_is_summed_up(spark, table, monkeypatch):
    monkeypatch.setattr("pagelake.operators.commits.SNAPSHOT_EVERY", 4)
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "id int, c string")
    for k in range(9):
        table.append(rows.where(f"id = {k % 2 + 1}"), cursor="c", resource=f"r{k % 2}", run_id=f"run-{k}")
    assert table.read().count() == 9 and table.log().count() == 9
    assert (table.high_water("r0"), table.high_water("r1")) == ("a", "b")
    assert table.report_of("run-3", "r1").repeated
    table.replace(rows.limit(1))
    assert table.vacuum() == 9 and table.read().count() == 1


def test_types_widen(spark, table):
    table.merge(spark.sql("select 1 id, 1 n, cast(null as string) e, named_struct('a', 1) s"), ["id"])
    table.merge(spark.sql("select 2 id, 2.5D n, 7 e, named_struct('a', 'x', 'b', 2) s"), ["id"])
    table.merge(spark.sql("select 3 id, 4L n, cast(null as string) e, named_struct('b', 3) s, true more"), ["id"])
    got = {r["id"]: r for r in table.read().collect()}
    assert [got[i]["n"] for i in (1, 2, 3)] == [1.0, 2.5, 4.0] and [got[i]["e"] for i in (1, 2, 3)] == [None, 7, None]
    assert [tuple(got[i]["s"]) for i in (1, 2, 3)] == [("1", None), ("x", 2), (None, 3)] and got[3]["more"]


def test_merge_rewrites_few_files(spark, table):
    table.merge(spark.range(1000).selectExpr("id", "'old' v"), ["id"])
    held = len(table.log().first()["added"])
    table.merge(spark.sql("select 5L id, 'new' v"), ["id"])
    last = table.log().orderBy(F.desc("version")).first()
    assert held == 40 and len(last["added"]) == len(last["removed"]) == 1
    # A table that outgrows its buckets is dealt over more of them.
    table.merge(spark.range(1000, 4000).selectExpr("id", "'more' v"), ["id"])
    assert table.read().count() == 4000 and table.log().orderBy(F.desc("version")).first()["buckets"] == 160


@pytest.mark.parametrize("how", ["left", "left_anti", "inner", "left_semi"])
def test_null_keys_are_not_one_task(spark, how):
    facts = spark.range(1000).selectExpr("id", "case when id >= 1000 then 1 end k").repartition(6)
    facts = facts.unionByName(spark.sql("select 5000L id, 1 k"))
    lookup = spark.sql("select 1 k, 'one' v")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = joins.split_join(facts, lookup, ["k"], how, hot_rows=100)
        plain = facts.join(lookup, ["k"], how)
        assert joined.columns == plain.columns
        assert sorted(map(repr, joined.collect())) == sorted(map(repr, plain.collect()))
        if how in ("left", "left_anti"):
            sizes = joined.groupBy(F.spark_partition_id()).count().collect()
            assert len([r for r in sizes if r["count"] > 100]) >= 5
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_missing_cursor_counts_before_the_cut_only(landed):
    body = lambda *at: {"data": [{"id": n, "at": a} for n, a in enumerate(at)]}
    rows = unwrap(landed(page("s", "r", body("9", "1", None))), "data", "id bigint, at string", position=True)
    assert ids(I.take_while_fresh(rows, "at", "5", missing="raise"), "id") == [(0,)]
    early = unwrap(landed(page("s", "r", body("9", None, "1"))), "data", "id bigint, at string", position=True)
    with pytest.raises(Exception, match="cursor value is missing"):
        I.take_while_fresh(early, "at", "5", missing="raise").collect()


def take_stream(spark, tmp_path, batches, **more):
    """What is left of rows (feed, run, page, place, at) that arrive batch by batch, each after a restart."""
    source, out, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    schema = "feed string, run string, page long, place long, at string"
    for batch in batches:
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(source)
        taken = stream_take_while(spark.readStream.schema(schema).parquet(source), ["feed"], "run", ("page", "place"), "at", **more)
        write = taken.writeStream.format("parquet").option("path", out).option("checkpointLocation", progress)
        write.trigger(availableNow=True).start().awaitTermination()
    return sorted((r["feed"], r["run"], r["page"], r["place"]) for r in spark.read.schema(schema).parquet(out).collect())


def test_stream_take_while_keeps_the_mark_in_state(spark, tmp_path):
    first = [("a", "1", 1, 0, "5"), ("a", "1", 1, 1, None), ("b", "1", 1, 0, "3")]
    second = [("a", "2", 1, 1, "5"), ("a", "2", 1, 2, "9"), ("a", "2", 1, 0, "7"), ("b", "2", 1, 0, "4"), ("c", "2", 1, 0, "1")]
    # The cut of a feed holds in later batches of its run; b's goes on, then ends.
    third = [("a", "2", 2, 0, "8"), ("b", "2", 2, 0, "6"), ("b", "2", 2, 1, None), ("b", "2", 2, 2, "9")]
    # The next run's mark is the greatest that was delivered.
    fourth = [("a", "3", 1, 0, "8"), ("a", "3", 1, 1, "7"), ("a", "3", 1, 2, "8"), ("b", "3", 1, 0, "6")]
    got = take_stream(spark, tmp_path, [first, second, third, fourth])
    assert got == [
        ("a", "1", 1, 0), ("a", "1", 1, 1), ("a", "2", 1, 0), ("a", "3", 1, 0),
        ("b", "1", 1, 0), ("b", "2", 1, 0), ("b", "2", 2, 0), ("c", "2", 1, 0),
    ]


def test_stream_take_while_missing_and_order(spark, tmp_path):
    first, second = [("a", "1", 1, 0, "5")], [("a", "2", 2, 0, None), ("a", "2", 2, 1, "6")]
    assert len(take_stream(spark, tmp_path / "fresh", [first, second], missing="include")) == 3
    for late in ([("a", "2", 1, 0, "4")], [("a", "1", 3, 0, "9")]):
        with pytest.raises(Exception, match="OutOfOrder"):
            take_stream(spark, tmp_path / late[0][1], [first, [("a", "2", 2, 1, "6")], late])
