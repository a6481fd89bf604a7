"""Operators that must not read, sort or walk more than they need."""

import glob
import random

import pytest
from conftest import ids, page
from pyspark.sql import functions as F

from pagelake.operators import link_chains as L
from pagelake.operators import selection as S
from pagelake.operators import sinks
from pagelake.operators.dedup import latest_by_key
from pagelake.operators.dependent import fresh_content
from pagelake.operators.sinks import LoadReport, Table, cursor_state
from pagelake.plans import source_queries
from pagelake.plans.child_queries import invoice_line_items, invoice_pages
from pagelake.plans.document_queries import _write_library
from pagelake.plans.pipeline import _in_order, run_source, table_of
from pagelake.sources import manifest as M
from pagelake.sources.landing import store_pages
from pagelake.specs import Cursor, Parent, Resource, Source

BY_RUN = Resource("site", "events", "data", "single", disposition="append", cursor=Cursor("at"))


def landing_of_runs(landed, path, runs):
    return store_pages(landed(*(page("site", "events", {"data": rows}, run=run) for run, rows in runs.items())), path)


RUNS = {
    "r1": [{"id": 1, "at": "2024-01-01"}, {"id": 2, "at": "2024-01-05"}],
    "r2": [{"id": 3, "at": "2024-01-06"}],
    "r3": [{"id": 4, "at": "2024-01-02"}, {"id": 5}],
    "r4": [{"id": 6, "at": "2024-02-01"}],
}


def test_manifest(landed, tmp_path):
    pages = landing_of_runs(landed, str(tmp_path), {**RUNS, "r5": []})
    rows = M.run_ranges(pages, BY_RUN).collect()
    assert {r["run_id"]: (r["pages"], r["records"], r["missing"], r["least"], r["greatest"]) for r in rows} == {
        "r1": (1, 2, 0, "2024-01-01", "2024-01-05"),
        "r2": (1, 1, 0, "2024-01-06", "2024-01-06"),
        "r3": (1, 2, 1, "2024-01-02", "2024-01-02"),
        "r4": (1, 1, 0, "2024-02-01", "2024-02-01"),
        "r5": (1, 0, 0, None, None),
    }


def test_stale_runs_are_not_opened(spark, landed, tmp_path):
    pages = landing_of_runs(landed, str(tmp_path), RUNS)
    manifest = spark.createDataFrame(M.run_ranges(pages, BY_RUN).where("run_id <> 'r4'").collect(), M.MANIFEST)
    for run in ("r1", "r2"):
        for file in glob.glob(f"{tmp_path}/**/run_id={run}/*.parquet", recursive=True):
            with open(file, "wb") as out:
                out.write(b"no parquet")
    fresh = M.prune_runs(pages, manifest, BY_RUN, "2024-01-06")
    # A run without a cursor in some record is read, and so is one that the manifest does not know.
    assert ids(fresh, "run_id") == [("r3",), ("r4",)]
    assert "dynamicpruning" in fresh._jdf.queryExecution().executedPlan().toString()
    assert ids(M.prune_runs(pages.where("run_id >= 'r3'"), manifest, BY_RUN, None), "run_id") == [("r3",), ("r4",)]


def test_marks_are_compared_in_their_type(spark):
    manifest = spark.createDataFrame([("s", "e", "a", 1, 1, 0, "9", "9"), ("s", "e", "b", 1, 1, 0, "10", "10")], M.MANIFEST)
    runs = lambda cursor, mark: ids(M.worth_reading(manifest, cursor, mark), "run_id")
    assert runs(Cursor("n", kind="bigint"), 9) == [("b",)]
    assert runs(Cursor("n", kind="bigint", range_start="closed"), 9) == [("a",), ("b",)]
    assert runs(Cursor("n"), "9") == [] and runs(Cursor("n"), None) == [("a",), ("b",)]


# --- slices ------------------------------------------------------------------------


@pytest.mark.parametrize("order", [["day", "n"], ["flat", "name", "n"], ["part", "n"]])
def test_deep_slices(spark, monkeypatch, order):
    monkeypatch.setattr(S, "SMALL", 100)
    monkeypatch.setattr(S, "BINS", 64)
    rng = random.Random(7)
    stem = "a long common beginning "
    rows = [
        (
            rng.choice([None, i * (-1) ** i * 10**12, i]) if i % 9 == 0 else i,
            rng.choice([None, "", "é", stem + "x", stem + "y", stem * 2 + str(rng.randrange(99))]),
            rng.choice([0.5, -0.25, 1e300, None, 3.75, float(i)]),
            1,
            i,
        )
        for i in range(900)
    ]
    df = spark.createDataFrame(rows, "n long, name string, part double, flat int, id int").withColumn("day", F.date_add(F.lit("2024-01-01").cast("date"), F.col("id") % 5))
    order = [*order, "id"]
    every = [r["id"] for r in df.orderBy(*order).collect()]
    for start, size in ((401, 200), (890, 50)):
        assert [r["id"] for r in S.deep_slice(df, order, start, size).collect()] == every[start - 1 : start - 1 + size]
    chosen = S.Selection(df, order)
    bounds, before = chosen.locate(600)
    assert before <= 600 and chosen.between(bounds, bounds).count() <= 100
    assert S.deep_slice(df.limit(0), order, 1, 5).collect() == []


# --- links -------------------------------------------------------------------------


def linked(landed, *chain, feed="0"):
    """Pages (number, url, next url)."""
    return [page("graph", "messages", "{}", feed=feed, no=no, link=to, url=url) for no, url, to in chain]


def test_order_by_links(landed):
    n = 70
    sound = linked(landed, *((i, f"u{i}", f"u{i + 1}" if i < n else None) for i in range(1, n + 1)))
    moved = linked(landed, (1, "a", "b"), (2, "c", ""), (3, "b", "c"), feed="1")
    loop = linked(landed, (1, "a", "b"), (2, "b", "a"), feed="2")
    pages = landed(*sound, *moved, *loop)
    got = {(r["feed"], r["page_no"]): r["link_place"] for r in L.link_order(pages).collect()}
    assert all(got["0", i] == i for i in range(1, n + 1))
    assert [got["1", i] for i in (1, 2, 3)] == [1, 3, 2] and got["2", 1] is got["2", 2] is None
    found = ids(L.link_chain_audit(pages), "feed", "page_no", "problem")
    assert found == [("1", 2, "misplaced"), ("1", 3, "misplaced"), ("2", 1, "cycle"), ("2", 2, "cycle")]


def test_links_in_bodies_and_pages_without_urls(landed):
    body = {"value": [], "@odata.nextLink": "u2"}
    pages = landed(
        page("graph", "messages", body, no=1),
        page("graph", "messages", {"value": []}, no=2, url="u2"),
        page("graph", "messages", body, feed="1", no=1, url="u1"),
        page("graph", "messages", None, feed="1", no=2, url="u3"),
    )
    assert ids(L.link_chain_audit(pages), "feed", "page_no", "problem") == [("1", 1, "missing_page"), ("1", 2, "orphan")]
    assert L.link_chain_audit(pages.limit(0)).collect() == []


# --- files -------------------------------------------------------------------------


def test_stale_files_are_listed_only(spark, tmp_path):
    """Files over the length that Spark may read fail a job that opens them."""
    for name, size in (("a", 10), ("b", 5000), ("c[1]", 20), ("d", 0)):
        (tmp_path / name).write_bytes(b"x" * size)
    items = spark.createDataFrame([("a", 10), ("c[1]", 20), ("d", 0), ("gone", 3), ("a", 10)], "id string, size long")
    before = spark.conf.get("spark.sql.sources.binaryFile.maxLength")
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", 1000)
    try:
        got = fresh_content(spark, str(tmp_path), items, pack_files=2)
        assert [(i, len(c)) for i, c in ids(got, "item_id", "content")] == [("a", 10), ("c[1]", 20), ("d", 0)]
        assert fresh_content(spark, str(tmp_path), items.limit(0)).collect() == []
    finally:
        spark.conf.set("spark.sql.sources.binaryFile.maxLength", before)


def test_files_are_not_dealt_one_by_one(spark, tmp_path):
    """Listing and reading many files takes few tasks, hidden files are left out, folders are entered."""
    for n in range(300):
        folder = tmp_path / f"f{n % 3}" / "in [x] %20"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"{n}").write_bytes(b"x" * (n + 1))
    (tmp_path / "f0" / "_7").write_bytes(b"no")
    (tmp_path / "f0" / ".7").write_bytes(b"no")
    (tmp_path / "300").write_bytes(b"top")
    items = spark.createDataFrame([(str(n),) for n in range(0, 301, 2)], "id string")
    context = spark.sparkContext
    context.setJobGroup("files", "files")
    try:
        got = fresh_content(spark, str(tmp_path), items).collect()
        tracker = context.statusTracker()
        stages = {s for job in tracker.getJobIdsForGroup("files") for s in tracker.getJobInfo(job).stageIds}
        tasks = sum(info.numTasks for s in stages if (info := tracker.getStageInfo(s)))
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert sorted((int(r["item_id"]), len(r["content"])) for r in got) == [*((n, n + 1) for n in range(0, 300, 2)), (300, 3)]
    assert tasks < 150


def test_library_has_a_file_for_each_item(spark, tmp_path):
    rows = spark.createDataFrame([("2", "b"), ("1", "a"), ("2", ""), ("3", "ü")], "item string, value string").coalesce(1)
    _write_library(rows, str(tmp_path / "library"))
    files = {f.name: f.read_bytes() for f in (tmp_path / "library").rglob("*.txt")}
    assert sorted(files) == ["1.txt", "2.txt", "3.txt"]
    assert files["1.txt"] == b"a\n" and sorted(files["2.txt"].split(b"\n")) == [b"", b"", b"b"] and files["3.txt"] == "ü\n".encode()
    assert len(list((tmp_path / "library").iterdir())) == 1


# --- what is shuffled and written ----------------------------------------------------


@pytest.fixture
def shop(spark, tmp_path):
    """Two customers, three orders (one without lines), one with very many lines."""
    day = "timestamp'1997-01-01'"
    tables = {
        "nation": "SELECT 1 n_nationkey, 'n' n_name",
        "supplier": "SELECT 1 s_suppkey, 's' s_name, 1 s_nationkey",
        "customer": "SELECT id c_custkey, concat('c', id) c_name, 5.0D c_acctbal FROM range(1, 3)",
        "orders": f"SELECT id * 1000 o_orderkey, 1 + id % 2 o_custkey, 'O' o_orderstatus, {day} o_orderdate FROM range(1, 4)",
        "lineitem": f"""SELECT 1000 * (1 + id div 7) l_orderkey, id l_partkey, id l_suppkey, id l_linenumber, {day} l_shipdate,
            10.0D l_extendedprice, 0.5D l_discount, 1.0D l_quantity FROM range(14)
            UNION ALL SELECT 2000, id, id, id, {day}, 10.0D, 0.5D, 1.0D FROM range(100, 400)""",
        "events": f"SELECT 1L event_id, 1L user_id, 'view' event_type, {day} ts",
    }
    for name, sql in tables.items():
        spark.sql(sql).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_invoice_lines_are_joined_once(spark, shop):
    pages = invoice_pages(spark, shop)
    assert "lineitem.parquet" not in " ".join(pages.inputFiles())
    sizes = {r["feed"]: (r["n"], r["lines"]) for r in pages.where("resource = 'invoice_line_items'").selectExpr("feed", "size(from_json(body, 'data array<string>').data) l").groupBy("feed").agg(F.count("*").alias("n"), F.sum("l").alias("lines")).collect()}
    assert sizes == {"in_1000": (1, 6), "in_2000": (4, 306)}
    got = ids(invoice_line_items(spark, shop), "invoice_id", "n_lines", "revenue")
    assert got == [("in_1000", 7, 35.0), ("in_2000", 307, 1535.0)]


def test_commits_of_an_order_share_pages(spark, shop, monkeypatch):
    landed = {}
    monkeypatch.setattr(source_queries, "store_pages", lambda pages, path: landed.setdefault("pages", store_pages(pages, path)))
    found = source_queries.source_github(spark, shop)
    assert found.where("resource = 'pull_request_commits'").count() == 314
    pages = landed["pages"].where("resource = 'pull_request_commits'")
    assert {r["feed"]: r["count"] for r in pages.groupBy("feed").count().collect()} == {"c2|1000": 1, "c1|2000": 4}


def test_a_merged_run_is_sorted_out_once(spark, landed, tmp_path, monkeypatch):
    """Records held as one version of each key are not shuffled by key again, unless the contract casts the key."""
    calls = []
    monkeypatch.setattr(sinks, "latest_by_key", lambda *given: calls.append(given[1]) or latest_by_key(*given))
    rows = [{"id": "1", "at": "a", "v": "old"}, {"id": "1", "at": "b", "v": "new"}, {"id": "01", "at": "c", "v": "x"}, {"at": "d"}]
    for contract, kept, sorted_out in (({}, [("01", "x"), ("1", "new")], 0), ({"id": "bigint"}, [1], 1)):
        source = Source("s", (Resource("s", "r", "data", "single", disposition="merge", cursor=Cursor("at"), declared="id string, at string", contract=contract),))
        calls.clear()
        warehouse = f"{tmp_path}/{sorted_out}"
        report = run_source(spark, source, landed(page("s", "r", {"data": rows})), warehouse)["r"]
        table = table_of(spark, warehouse, "s", "r").read()
        assert (ids(table, "id", "v") if not contract else [r["id"] for r in table.collect()]) == kept
        assert len(calls) == sorted_out and report.high_water == "c"


# --- whole sources -----------------------------------------------------------------


def test_a_failure_takes_along_its_children_only():
    source = Source("s", (Resource("s", "child", "d", "single", parent=Parent("parent", {})), *(Resource("s", n, "d", "single") for n in ("parent", "other"))))
    done = []

    def load(name):
        done.append(name)
        if name == "parent":
            raise ValueError("no")
        return LoadReport(1, "replace", 1, None)

    for n in (1, 3):
        reports = _in_order(source, source.names(), load, "report", n)
        assert list(reports) == ["child", "parent", "other"] and reports["other"].error is None
        assert reports["parent"].error == "no" and reports["child"].error == "not loaded: parent failed"
    assert "child" not in done
    with pytest.raises(ValueError, match="no"):
        _in_order(source, source.names(), load, "raise", 2)


def test_marks_and_versions_do_not_go_back(spark, tmp_path):
    table = Table(spark, str(tmp_path / "t"))
    frame = lambda *rows: spark.createDataFrame(rows, "id int, at bigint, v string")
    for rows in ([(1, 10, "new"), (2, 1, "x")], [(1, 9, "old"), (2, 2, "y"), (3, 3, "z")], [(1, 10, "same")]):
        table.merge(frame(*rows), ["id"], ["at"], cursor="at", resource="r")
    assert ids(table.read(), "id", "at", "v") == [(1, 10, "same"), (2, 2, "y"), (3, 3, "z")]
    assert table.high_water("r") == "10" and cursor_state(table).first()["last_value"] == "10"
