"""The pipeline stage by stage against brute force, and the registered queries against their SQL."""

import subprocess
import sys

import pytest
from llm_fixtures import no_docs, odd_docs, sf_dir  # noqa: F401  (fixtures)
from test_dedup import leader_keys, leaks_brute, lines_brute, near_brute

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from pagelake.llm import queries as llm
from pagelake.llm.stage import written

duckdb = pytest.importorskip("duckdb")

CONTRACTS = {
    "op1_exact_dedup": "doc_id keep_id group_size kept text_sha256",
    "op2_suffix_dedup": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op3_secrets": "doc_id n_assign n_access n_hex base_sha256 spans",
    "op4_line_dedup": "doc_id n_lines n_dropped kept_sha256",
    "op5_warc_fixity": "page_id record_no start_byte length record_sha256 corrupt",
    "op6_language_id": "doc_id held_out lang_pred score",
    "op7_quality": "doc_id held_out score predicted",
    "op8_decontaminate": "doc_id item_id n_item n_shared containment",
    "op9_near_dedup": "doc_id class_id class_size kept",
    "op10_mixing": "doc_id source lang topic n_tokens weight probability sampled",
    "op11_source_divergence": "lang source part item value rank",
    "op12_periodic_runs": "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256",
    "op13_url_filter": "page_id host path rule verdict",
}


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plain = lambda df: [(r["doc_id"], r["text"]) for r in df.collect()]
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language", "lines", "near_duplicates", "benchmark", "mixing"]
    before = plain(docs)
    for name, stage in corpus_pipeline.STAGES:
        out = written(stage(spark, docs, sf_dir), f"test-{name}")
        after = plain(out)
        if name == "language":
            assert sorted(after) == sorted(d for d in before if any(c.isalpha() for c in d[1] or ""))
        if name == "lines":
            assert sorted(after) == sorted(lines_brute(before, leader_keys(spark, before)))
        if name == "near_duplicates":
            classes = near_brute(before)
            first = {c: min(i for (i, _), k in zip(before, classes, strict=True) if k == c) for c in classes}
            assert sorted(i for i, _ in after) == sorted(first.values())
        if name == "benchmark":
            items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
            held = {i for i, *_ in leaks_brute(before, items)}
            assert held and sorted(i for i, _ in after) == sorted(i for i, _ in before if i not in held)
        if name == "mixing":
            assert out.columns == [*docs.columns, "mix_weight", "mix_probability"] and set(after) <= set(before) and after
        else:
            assert out.columns == docs.columns
        docs, before = out, after


def test_stages_on_odd_and_no_rows(spark, sf_dir, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, sf_dir)
            assert out.columns[: len(docs.columns)] == docs.columns
            docs = written(out, f"test-{name}")
        docs.collect()


@pytest.mark.parametrize("name", sorted(llm.ORACLE_SQL))
def test_sql(spark, sf_dir, name):
    db = duckdb.connect()
    for table in ("documents", "benchmark", "pages"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    got = queries()[name](spark, sf_dir)
    result = db.execute(oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(got.columns)
    rows = [tuple(r) for r in got.select(*columns).collect()]
    assert sorted(rows, key=repr) == sorted(result.fetchall(), key=repr)


def test_contracts(spark, sf_dir):
    known = queries()
    assert set(llm.QUERIES) == set(CONTRACTS) and "pipeline" in known
    for name, columns in CONTRACTS.items():
        got = known[name](spark, sf_dir)
        assert set(columns.split()) <= set(got.columns)
        if "doc_id" in got.columns and name != "op8_decontaminate":
            assert got.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()


def test_nothing_else_needs_this_subpackage():
    code = (
        "import sys\n"
        "class Gone:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name in ('corpus_pipeline', 'pagelake.llm'):\n"
        "            raise ModuleNotFoundError(name, name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "names = set(e.queries())\n"
        "assert len(names) > 80 and 'pipeline' not in names and not any(n.startswith('op1_') for n in names)\n"
        "assert set(e.oracle_sql()) == names\n"
    )
    subprocess.run([sys.executable, "-c", code], check=True)
