import base64
import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from pagelake.functions import classify as C
from pagelake.functions import values as V
from pagelake.functions.jsonpath import json_truthy, to_json_text
from pagelake.functions.text import casefold, collapse_spaces, email_domain, snake_case


def apply(spark, fn, inputs, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    got = rows.select("i", fn(F.col("v")).alias("o")).orderBy("i").collect()
    return [r["o"] for r in got]


def test_entry_scalar(spark):
    entries = [{k: f"x-{k}"} for k in V.SCALAR_KEYS] + [
        {"status": {"title": "Open"}},
        {"status": "plain"},
        {},
        {"value": None, "domain": "x"},
        {"domain": "d", "value": "v"},
        {"currency_value": 12345678.5},
        {"value": 7},
    ]
    got = apply(spark, V.scalar_of_json_entry, [json.dumps(e) for e in entries])
    assert got[: len(V.SCALAR_KEYS)] == [f"x-{k}" for k in V.SCALAR_KEYS]
    rest = got[len(V.SCALAR_KEYS) :]
    assert rest[:5] == ["Open", None, None, None, "v"]
    assert float(rest[5]) == 12345678.5 and rest[6] == "7"


def test_active_value(spark):
    def one(entries):
        return json.dumps(entries) if entries is not None else None

    got = apply(
        spark,
        V.active_value,
        [
            one([{"active_until": "2020", "value": "old"}, {"active_until": None, "value": "new"}]),
            one([{"value": "no key"}]),
            one([{"active_until": "2020", "value": "old"}]),
            one([]),
            one("text"),
            one(["odd", {"value": "kept"}]),
            None,
        ],
    )
    assert got == ["new", "no key", None, None, None, "kept", None]


def test_times(spark):
    got = apply(spark, V.epoch_to_ts, [1700000000.0, 0.25, None], "double")
    assert got == [datetime(2023, 11, 14, 22, 13, 20), datetime(1970, 1, 1, 0, 0, 0, 250000), None]
    got = apply(spark, V.iso_to_ts, ["2024-05-01T00:00:00-08:00", "2024-05-01T00:00:00Z", "soon", None])
    assert got == [datetime(2024, 5, 1, 8), datetime(2024, 5, 1), None, None]
    got = apply(spark, V.cursor_text, ["1970-01-01T00:00:00Z", "2024-05-01 10:11:12", "2024-05-01T10:11:12.345Z"])
    assert got == ["1970-01-01 00:00:00", "2024-05-01 10:11:12", "2024-05-01 10:11:12"]


def test_first_value_and_refs(spark):
    kind = "array<struct<primary:boolean,value:string>>"
    got = apply(spark, V.first_value, [[(False, "a"), (True, "b")], [], None], kind)
    assert got == ["a", None, None]
    got = apply(spark, V.ref_to_id, ["10", '{"id": 11, "name": "n"}', None, '{"name": "n"}', "x"])
    assert got == [10, 11, None, None, None]


def test_json_text(spark):
    got = apply(spark, to_json_text, [[1, 2], [], None], "array<bigint>")
    assert [json.loads(g) for g in got] == [[1, 2], [], []]
    texts = ["true", "false", "0", "", None, "[]", "abc", "1"]
    assert apply(spark, json_truthy, texts) == [True, False, False, False, False, False, True, True]


def test_keys_names_content(spark):
    got = apply(spark, lambda c: V.joined_key("outlook", c, F.lit("a")), ["m", None])
    assert got == ["outlook:m:a", None]
    assert apply(spark, lambda c: V.name_or(c, "file"), ["x", "", None]) == ["x", "file", "file"]
    data = bytes(range(256)) * 3
    got = apply(spark, V.encode_content, [bytearray(data)], "binary")
    assert got == [base64.b64encode(data).decode()]


def test_depth(spark):
    def index(n):
        return base64.b64encode(b"x" * n).decode()

    values = [index(22), index(27), index(32), index(30), None, "", "not base64!", index(10)]
    values += [index(27) + "\n", index(27)[:-1], " " + index(27), "A===", "====", "=="]
    assert apply(spark, C.conversation_depth, values) == [0, 1, 2, 1, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0]


def test_subjects(spark):
    subjects = ["RE: NDA", "RE[2]: NDA", " fwd :x", "Antw: x", "Return: x", "NDA", "", None, "Sv: y"]
    assert apply(spark, C.subject_is_reply, subjects) == [
        True, True, True, True, False, False, False, False, True,
    ]
    texts = ["RE: FW:  Mutual NDA ", "re re: x", "AW: WG: Straße　Σας", None, "  ", "RE:RE[3]:a\tb", "ﬁNAL İ"]
    assert apply(spark, C.normalize_subject, texts) == [
        "mutual nda", "re re: x", "strasse σασ", "", "", "a b", "ﬁNAL İ".casefold(),
    ]


def test_casefold_matches_python(spark):
    texts = ["ΑΣ ας", "ẞß", "ſt", "ŉ ǰ ΐ", "Ꭰꭰ", "plain ABC", "ÀÉ", "ı I İ", "𐐀x", "DŽ"]
    assert apply(spark, casefold, texts) == [t.casefold() for t in texts]
    assert apply(spark, collapse_spaces, [" a \n b "]) == ["a b"]


def test_rounds(spark):
    names = ["NDA_v3.docx", "MutualNDA round 2.docx", "nda rev-4.pdf", "NDA draft2.docx", "plain.docx"]
    names += ["NDA_v2 round3.docx", "NDA_v3_countersigned.pdf", "nda-r4-return.pdf", "version12.docx"]
    names += ["x_v2024", "a v0"]
    assert apply(spark, C.round_from_filename, names) == [3, 2, 4, 2, None, 3, 3, 4, 12, None, 0]


def test_classify(spark):
    root = base64.b64encode(b"x" * 22).decode()
    second = base64.b64encode(b"x" * 32).decode()
    rows = spark.createDataFrame(
        [
            ("NDA.docx", "NDA", root),
            ("Teaser.pdf", "RE: NDA", root),
            ("NDA.docx", "RE: NDA", None),
            ("NDA.docx", "NDA", second),
            ("NDA.docx", None, "bad"),
        ],
        "f string, s string, c string",
    )
    got = rows.select(C.classify_mail(F.col("f"), F.col("s"), F.col("c")).alias("o")).select("o.*")
    assert [tuple(r) for r in got.collect()] == [
        ("fresh_nda", 1),
        ("teaser", 2),
        ("counterparty_return", 2),
        ("counterparty_return", 3),
        ("fresh_nda", 1),
    ]
    names = ["NDA v3_countersigned.docx", "redline.docx", "CIM_v2.pdf", "NDA.docx", "encounter.docx", "nda v0.docx"]
    got = apply(spark, C.classify_file, names)
    assert [tuple(g) for g in got] == [
        ("counterparty_return", 3),
        ("counterparty_return", 2),
        ("teaser", 2),
        ("fresh_nda", 1),
        ("counterparty_return", 2),
        ("fresh_nda", 1),
    ]


def test_domains_and_threads(spark):
    got = apply(spark, email_domain, ["A@Acme.COM", "x", "a@b@C.io", "a@", None])
    assert got == ["acme.com", None, "c.io", None, None]
    rows = spark.createDataFrame([("c1", "RE: x"), (None, "RE: X y")], "c string, s string")
    got = rows.select(C.thread_key(F.col("c"), F.col("s")).alias("k")).collect()
    assert [r["k"] for r in got] == ["c1", "x y"]


@pytest.mark.parametrize(
    ("name", "want"),
    [
        ("PrimaryEmailAddr", "primary_email_addr"),
        ("Id", "id"),
        ("bodyPreview", "body_preview"),
        ("Line1", "line1"),
        ("CountrySubDivisionCode", "country_sub_division_code"),
        ("already_snake", "already_snake"),
        ("HTTPStatus", "http_status"),
        ("Deal Value (ARR)", "deal_value_arr"),
        ("TotalAmt", "total_amt"),
    ],
)
def test_snake_case(name, want):
    assert snake_case(name) == want
