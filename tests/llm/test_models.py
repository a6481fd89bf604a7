"""Language, quality, secrets, fixity and mixing: brute force, held-out accuracy, odd rows."""

import hashlib
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from llm_fixtures import no_docs, odd_docs, sf_dir  # noqa: F401  (fixtures)
from pyspark.sql import functions as F

from pagelake.llm import language_id as G
from pagelake.llm import mixing as M
from pagelake.llm import quality as Q
from pagelake.llm import secrets as S
from pagelake.llm import warc as W

# --- language ----------------------------------------------------------------------


def test_held_out(spark):
    ids = spark.range(200).select(F.col("id"), G.held_out(F.col("id")).alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 5 == 0) for r in ids)


def test_language_of_held_out_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    hidden = G.held_out(F.col("doc_id"))
    model = G.learn(docs, ~hidden)
    assert model.languages == ("de", "en", "es", "fr")
    told = G.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where(hidden).collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in told]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in told)


def path_brute(scores, switch):
    """Best path of one row by plain dynamic programming."""
    n, k = scores.shape
    best, back = [list(scores[0])], []
    for t in range(1, n):
        row, came = [], []
        for s in range(k):
            options = [best[-1][p] - (switch if p != s else 0) for p in range(k)]
            p = int(np.argmax(options))
            row.append(options[p] + scores[t][s])
            came.append(p)
        best.append(row)
        back.append(came)
    state = int(np.argmax(best[-1]))
    path = [state]
    for came in reversed(back):
        path.append(came[path[-1]])
    return path[::-1], best[-1][state]


@pytest.mark.parametrize("seed", range(10))
def test_best_paths(seed):
    g = np.random.default_rng(seed)
    lengths = g.integers(1, 30, 12)
    rows = np.repeat(np.arange(12) * 2, lengths)
    scores = g.normal(size=(len(rows), 3)).astype(np.float32) * 3
    path = G.best_paths(scores, rows, 2.0)
    worth = lambda s, p: sum(s[t][p[t]] for t in range(len(p))) - 2.0 * sum(a != b for a, b in zip(p, p[1:]))
    for row in np.unique(rows):
        own = rows == row
        _, best = path_brute(scores[own].astype(float), 2.0)
        assert worth(scores[own].astype(float), path[own]) == pytest.approx(best, abs=1e-3)


def test_spans_of_mixed_text(spark):
    lines = {"en": "the house and the garden of the king with that", "de": "der hund und die katze sind nicht auf dem haus", "ru": "это наш дом и мы живем в нем всегда"}
    docs = [(i, " ".join(random.Random(i).sample(t.split(), 8)), lang) for i in range(60) for lang, t in lines.items()]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    model = G.learn(frame, F.lit(True))
    import pyarrow as pa

    found = G.words_of(pa.array([f"{lines['en']} {lines['de']} {lines['ru']}", "你好"]))
    path = G.best_paths(G.word_scores(model, found), found.rows, 4.0)
    spans = G.spans_of(found, path, model.languages)[0]
    assert [lang for _, lang in spans] == ["en", "de", "ru"] and sum(n for n, _ in spans) == 29
    # Scripts narrow the candidates: no Latin word may be Russian, no Cyrillic one English.
    assert not model.candidates[1][model.languages.index("ru")] and not model.candidates[3][model.languages.index("en")]


def test_two_hundred_languages_by_brute_force(spark):
    """Trigram scores, candidates, paths and spans against plain counting, beyond what a signed byte can number."""
    rng = random.Random(4)
    syllables = {f"l{i:03d}": [rng.choice("bcdfghklmnprstvz") + rng.choice("aeiou") for _ in range(5)] for i in range(200)}
    word = lambda lang: "".join(rng.choices(syllables[lang], k=rng.randint(2, 4)))
    train = [(n, " ".join(word(lang) for _ in range(30)), lang) for n, lang in enumerate(list(syllables) * 3)]
    train.append((9_000, "мы живем", "l000"))
    mixed = [(n, " ".join([word(a) for _ in range(25)] + [word(b) for _ in range(25)])) for n, (a, b) in enumerate([("l150", "l003"), ("l199", "l128")] * 3)]
    model = G.learn(spark.createDataFrame(train, "doc_id long, text string, lang string"), F.lit(True))
    assert len(model.languages) == 200

    slot = lambda t: (((t[0] << 16 | t[1] << 8 | t[2]) * 2654435761) % (1 << 32)) >> 16
    # Each word with the space before it and the one after it.
    grams = lambda w: [slot(w[i : i + 3]) for i in range(len(w) - 2)]
    counts = {lang: Counter(g for _, t, own in train if own == lang for w in t.split() for g in grams(f" {w} ".encode())) for lang in syllables}
    totals = {lang: sum(c.values()) for lang, c in counts.items()}
    score = lambda w, lang: sum(np.log((counts[lang][g] + 0.5) / (totals[lang] + 0.5 * G.SLOTS)) for g in grams(f" {w} ".encode()))
    # Latin words are candidates everywhere; one Cyrillic word in some 30 only in the language that has it.
    assert model.candidates[1].all() and model.candidates[3].tolist() == [lang == "l000" for lang in model.languages]
    spans = {r["doc_id"]: [(x["first_word"], x["n_words"], x["lang"]) for x in r["spans"]] for r in G.language_spans(spark.createDataFrame(mixed, "doc_id long, text string"), model).collect()}
    for n, text in mixed:
        table = np.array([[score(w, lang) for lang in model.languages] for w in text.split()])
        path, _ = path_brute(table, G.Settings().switch)
        want, first = [], 0
        for i in range(1, len(path) + 1):
            if i == len(path) or path[i] != path[first]:
                want.append((first, i - first, model.languages[path[first]]))
                first = i
        assert spans[n] == want and {x[2] for x in want} >= ({"l150", "l003"}, {"l199", "l128"})[n % 2]
    top = {r["doc_id"]: r["lang_pred"] for r in G.identify(spark.createDataFrame(mixed, "doc_id long, text string"), model).collect()}
    assert top[0] in ("l150", "l003") and top[1] in ("l199", "l128")


def test_language_odd(odd_docs, no_docs):
    model = G.learn(odd_docs, F.lit(True))
    got = defaultdict(list)
    for r in G.identify(odd_docs, model).collect():
        got[r["doc_id"]].append((r["lang_pred"], r["score"]))
    assert got[4] == [("und", 0.0)] and got[3] == [("und", 0.0)] and got[6] == got[8] == [("und", 0.0)]
    assert len(got[2]) == 2 and len(got[None]) == 2
    left = G.in_a_language(odd_docs, model)
    assert left.columns == odd_docs.columns and 4 not in {r["doc_id"] for r in left.collect()}
    nothing = G.learn(no_docs, F.lit(True))
    assert {r["lang_pred"] for r in G.identify(odd_docs, nothing).collect()} == {"und"}
    assert G.identify(no_docs, model).collect() == []


def test_words_are_runs_of_letters():
    import pyarrow as pa

    texts = ["\u201cHello\u201d \u00abmonde\u00bb \u00bfqu\u00e9\u00a0tal", "\u3000\u300c\u4f60\u597d\u300d\u4e16", "\U0001f600\ufe0f 1\ufe0f\u20e3 \u0301", "\u0e17\u0e35\u0e48 e\u0301t", None]
    found = G.words_of(pa.array(texts))
    words = [bytes(found.data[a:b]).decode() for a, b in zip(found.starts, found.ends, strict=True)]
    assert words == ["hello", "monde", "qu\u00e9", "tal", "\u4f60\u597d", "\u4e16", "\u0e17\u0e35\u0e48", "e\u0301t"]
    assert [G.SCRIPTS[x] for x in found.scripts] == ["latin"] * 4 + ["han"] * 2 + ["thai", "latin"] and found.rows.tolist() == [0] * 4 + [1] * 2 + [3] * 2


def test_every_text_with_a_letter_gets_a_language(spark):
    lines = {"en": "the house and the garden of the king with that", "ka": "\u10d4\u10e1 \u10d0\u10e0\u10d8\u10e1 \u10e9\u10d5\u10d4\u10dc\u10d8 \u10e1\u10d0\u10ee\u10da\u10d8", "zh": "\u3000\u300c\u8fd9\u662f\u6211\u4eec\u7684\u5bb6\u300d"}
    frame = spark.createDataFrame([(3 * i + n, t, lang) for i in range(40) for n, (lang, t) in enumerate(lines.items())], "doc_id long, text string, lang string")
    model = G.learn(frame, F.lit(True))
    asked = [(1, lines["ka"], "ka"), (2, lines["zh"], "zh"), (3, "\u201cgarden\u201d", "en"), (4, "\u00bfking?", "en"), (5, "\u10e1\u10d0\u10ee\u10da\u10d8", "ka")]
    asked += [(6, "\u1781\u17d2\u1798\u17c2\u179a", None), (7, "\u043c\u0438\u0440", None)]
    docs = spark.createDataFrame(asked, "doc_id long, text string, want string")
    told = {r["doc_id"]: r for r in G.identify(docs, model).collect()}
    assert all(told[i]["lang_pred"] == want for i, _, want in asked if want)
    assert all(told[i]["lang_pred"] in model.languages and told[i]["score"] > 0 for i, *_ in asked)
    assert G.in_a_language(docs, model).count() == len(asked)


# --- quality -----------------------------------------------------------------------


def test_quality_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    hidden = G.held_out(F.col("doc_id"), 3, 1)
    model = Q.learn(docs, labels, ~hidden)
    told = Q.classify(docs.join(labels.select("doc_id"), "doc_id", "left_semi"), model).join(labels, "doc_id").where(hidden).collect()
    truth = np.array([r["quality"] for r in told])
    guess = np.array([r["predicted"] for r in told])
    assert (truth == guess).mean() > 0.97 and (guess[truth == 0] == 0).mean() > 0.85


def test_vote_is_exact():
    g = np.random.default_rng(0)
    vectors = Q._unit(g.normal(size=(40, 8)))
    labels = g.integers(0, 2, 40).astype(float)
    model = Q.Model(None, None, vectors, labels, 0.5, Q.Settings(neighbours=5))
    asked = Q._unit(g.normal(size=(10, 8)))
    for q, score in zip(asked, Q.vote(model, asked), strict=True):
        near = sorted(((float(q @ v), y) for v, y in zip(vectors, labels, strict=True)), reverse=True)[:5]
        weights = [(max(s, 0) ** model.settings.sharpness, y) for s, y in near]
        assert score == pytest.approx(sum(w * y for w, y in weights) / sum(w for w, _ in weights))


def test_quality_odd(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (2, 0), (5, 1), (8, None), (None, 1)], "doc_id long, quality int")
    model = Q.learn(odd_docs, labels, F.lit(True))
    got = Q.classify(odd_docs, model).collect()
    assert len(got) == odd_docs.count() and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    none = Q.learn(no_docs, labels.limit(0), F.lit(True))
    assert {r["score"] for r in Q.classify(odd_docs, none).collect()} == {0.5}
    assert Q.classify(no_docs, model).collect() == []


# --- secrets -----------------------------------------------------------------------


def secrets_brute(docs):
    """The contract's base spans by the plain patterns, and the opaque tokens that few owners have."""
    base = {}
    for at, (_, _, text) in enumerate(docs):
        text = text or ""
        spans = []
        for m in re.finditer(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']? *[:=] *["']?([A-Za-z0-9+/_.=-]+)""", text):
            if len(m.group(2)) >= 12:
                spans.append((m.start(), 0, m.end(), "assign", m.group(2)))
        spans += [(m.start(), 1, m.end(), "access", m.group()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 18]
        spans += [(m.start(), 2, m.end(), "hex", m.group()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 16]
        base[at] = sorted(spans)
    opaque = {
        at: [(s, 3, e, k, v) for k, s, e, v in S.opaque_spans(text or "", [(k, s, e, v) for s, _, e, k, v in base[at]])]
        for at, (_, _, text) in enumerate(docs)
    }
    owners = defaultdict(set)
    for at, (_, owner, _) in enumerate(docs):
        for *_, v in base[at] + opaque[at]:
            owners[v].add(owner)
    out = []
    join = lambda spans: ",".join(f"{k}:{s}:{e}" for s, _, e, k, _ in spans)
    for at, (i, _, _) in enumerate(docs):
        more = [x for x in opaque[at] if len(owners[x[4]]) <= S.LIVE_OWNERS and S.bits_per_char(x[4]) >= S.LIVE_BITS]
        every = sorted(base[at] + more)
        live = sum(len(owners[v]) <= S.LIVE_OWNERS and S.bits_per_char(v) >= S.LIVE_BITS for *_, v in every)
        n = Counter(k for *_, k, _ in base[at])
        out.append((i, n["assign"], n["access"], n["hex"], hashlib.sha256(join(base[at]).encode()).hexdigest(), join(every), live))
    return sorted(out, key=repr)


SECRETS = ("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_live")


def test_secrets(spark):
    rng = random.Random(4)
    key = lambda n, of="abcdefABCDEF0123456789+/": "".join(rng.choice(of) for _ in range(n))
    shared, own = key(30), [key(rng.randint(8, 40)) for _ in range(12)]
    pieces = [
        lambda: f'password = "{rng.choice(own)}"',
        lambda: f"API_KEY:{shared} apikey='{rng.choice(own)}",
        lambda: "AKIA" + key(rng.randint(10, 20), "ABCXYZ0189"),
        lambda: key(rng.randint(10, 60), "0123456789abcdef"),
        lambda: f"élan {shared} 你好 {rng.choice(own)}",
        lambda: "an id é " + key(32),
        lambda: "Token = secret : passwd=short tokentoken==" + key(12),
        lambda: "ſecret=abcdefghijklmnop to\x4ben: AAAAAAAAAAAAAAAA",
    ]
    docs = [(i, rng.choice(["a", "b", "c", "d", None]), " ".join(rng.choice(pieces)() for _ in range(rng.randint(0, 4)))) for i in range(80)]
    docs += [(90, "a", None), (90, "a", ""), (None, None, "password: " + shared)]
    got = S.scan_secrets(spark.createDataFrame(docs, "doc_id long, source string, text string"))
    assert sorted((tuple(r) for r in got.select(*SECRETS).collect()), key=repr) == secrets_brute(docs)
    assert got.agg(F.sum("n_opaque"), F.sum("n_example")).first()[0] > 0


def test_secrets_copied_within_one_source(spark):
    wide, own, again = "Qx7Lm2Zp9Rt4Vb6Ny1Kc8Ws3", "Hd5Jf8Gq2Ta7Ue4Xi9Om1Pz6", "Cv3Bn8Mk5Lj2Hg7Fd4Sa9Qw1"
    docs = [(i, "hot", f"see {wide}") for i in range(S.LIVE_REPOS + 1)] + [(100 + i, "hot", f"see {own}") for i in range(S.LIVE_REPOS)]
    # Rows of one doc_id are one repository.
    docs += [(200, "hot", f"see {again}, row {i}") for i in range(S.LIVE_REPOS + 5)]
    got = S.scan_secrets(spark.createDataFrame(docs, "doc_id long, source string, text string")).collect()
    assert all((r["n_opaque"], r["n_live"]) == ((0, 0) if r["doc_id"] < 100 else (1, 1)) for r in got)
    labelled = [(i, "hot", f"token={wide}") for i in range(S.LIVE_REPOS + 1)]
    got = S.scan_secrets(spark.createDataFrame(labelled, "doc_id long, source string, text string")).collect()
    assert all((r["n_assign"], r["n_live"], r["n_example"]) == (1, 0, 1) for r in got)


def test_secrets_odd(spark, odd_docs, no_docs, sf_dir):
    assert S.scan_secrets(odd_docs).count() == odd_docs.count() and S.scan_secrets(no_docs).collect() == []
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plain = [(r["doc_id"], r["source"], r["text"]) for r in docs.collect()]
    assert sorted((tuple(r) for r in S.scan_secrets(docs).select(*SECRETS).collect()), key=repr) == secrets_brute(plain)


# --- fixity ------------------------------------------------------------------------


def test_fixity(spark, monkeypatch):
    pages = spark.createDataFrame([(i, f"http://x/{i}", "<p>" + "y" * (i % 7)) for i in range(300)] + [(None, None, None), (7, "again", "")], "page_id long, url string, html string")
    hurt = F.when(F.col("page_id").isin(0, 137, 299), "<p>!").otherwise(F.col("html"))
    records = W.manifest(pages, {"copy": W.record(F.col("page_id"), F.col("url"), hurt)})
    rows = sorted(records.collect(), key=lambda r: r["record_no"])
    assert [r["record_no"] for r in rows] == list(range(302))
    assert [r["page_id"] for r in rows] == [None, *range(8), 7, *range(8, 300)]
    assert all(a["offset"] + a["length"] == b["offset"] for a, b in zip(rows, rows[1:]))
    ours, theirs = W.build_tree(records), W.build_tree(records, "copy")
    assert ours.root() != theirs.root()
    # The root by hand.
    def sha(text):
        return hashlib.sha256(text.encode()).hexdigest()

    level = [(sha(f"{r['digest']}:{r['offset']}:{r['offset'] + r['length']}"), r["offset"], r["offset"] + r["length"]) for r in rows]
    while len(level) > 1:
        parts = [level[i : i + W.FANOUT] for i in range(0, len(level), W.FANOUT)]
        level = [(sha(",".join(":".join(map(str, c)) for c in part)), part[0][1], part[-1][2]) for part in parts]
    assert ours.root() == level[0][0]
    found = {(r["place"], r["start"], r["end"], r["corrupt"]) for r in W.audit(ours, theirs).collect()}
    differ = [r for r in rows if r["digest"] != r["copy_digest"] or (r["offset"], r["length"]) != (r["copy_offset"], r["copy_length"])]
    assert {r["page_id"] for r in rows if r["digest"] != r["copy_digest"]} == {0, 137, 299}
    assert found == {(r["record_no"], r["offset"], r["offset"] + r["length"], r["page_id"] in (0, 137, 299)) for r in differ}
    assert W.audit(ours, ours).collect() == []
    # A replica that ends early.
    short = W.build_tree(records.where("record_no < 250"))
    assert {r["place"] for r in W.audit(ours, short).collect()} == set(range(250, 302))


def test_fixity_of_same_length_and_moved_index(spark):
    pages = spark.createDataFrame([(i, f"http://x/{i}", "<p>abc") for i in range(100)], "page_id long, url string, html string")
    same = F.when(F.col("page_id") == 41, "<p>abd").otherwise(F.col("html"))
    records = W.manifest(pages, {"copy": W.record(F.col("page_id"), F.col("url"), same)}).withColumns(
        {"moved_offset": F.col("offset") + F.when(F.col("record_no") >= 90, 3).otherwise(0), "moved_length": F.col("length"), "moved_digest": F.col("digest")}
    )
    ours, moved = W.build_tree(records), W.build_tree(records, "moved")
    assert [(r["place"], r["corrupt"]) for r in W.audit(ours, W.build_tree(records, "copy")).collect()] == [(41, True)]
    assert ours.root() != moved.root()
    assert sorted((r["place"], r["corrupt"]) for r in W.audit(ours, moved).collect()) == [(i, False) for i in range(90, 100)]


def test_fixity_of_nothing(spark):
    none = W.manifest(spark.createDataFrame([], "page_id long, url string, html string, offset long, digest string"))
    tree = W.build_tree(none)
    assert none.collect() == [] and tree.root() is None and W.audit(tree, tree).collect() == []


# --- mixing ------------------------------------------------------------------------


def test_raking(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = M.mixing_weights(docs).collect()
    tokens = Counter()
    for r in got:
        tokens[r["source"], r["lang"], r["topic"]] += r["n_tokens"]
    cells = {c: float(t) for c, t in tokens.items() if t}
    total = sum(cells.values())
    want = []
    for k in range(3):
        have = Counter()
        for c, t in cells.items():
            have[c[k]] += t
        raw = {v: t**0.5 for v, t in have.items()}
        want.append({v: x / sum(raw.values()) for v, x in raw.items()})
    mass = dict(cells)
    for _ in range(60):
        for k in range(3):
            held = Counter()
            for c, m in mass.items():
                held[c[k]] += m
            mass = {c: m * want[k][c[k]] / held[c[k]] for c, m in mass.items()}
    for r in got:
        cell = r["source"], r["lang"], r["topic"]
        assert r["weight"] == pytest.approx(mass[cell] * total / cells[cell], rel=2e-2)
    expected = sum(r["n_tokens"] * r["probability"] for r in got)
    assert expected == pytest.approx(0.5 * total, rel=1e-3)
    kept = M.mixed(docs)
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in got if r["sampled"]}
    assert kept.columns == [*docs.columns, "mix_weight", "mix_probability"]


@pytest.mark.parametrize("cells_a_task", [0, 1_000_000])
def test_raking_until_all_hold_or_nothing_moves(spark, monkeypatch, cells_a_task):
    monkeypatch.setattr(M, "CELLS_A_TASK", cells_a_task)
    shape = "source string, lang string, topic string, tokens long"
    tied = [("s0", "en", "prose", 10**9), ("s1", "de", "prose", 10**6), ("s1", "en", "note", 1000), ("s0", "de", "note", 10)]
    if cells_a_task:
        got = M.rake(spark.createDataFrame(tied, shape)).collect()
        total = sum(t for *_, t in tied)
        for k in range(3):
            have, held = Counter(), Counter()
            for c in tied:
                have[c[k]] += c[3]
            for r in got:
                held[r[k]] += r["weight"] * r["tokens"] / total
            want = {v: t**0.5 / sum(x**0.5 for x in have.values()) for v, t in have.items()}
            assert all(held[v] == pytest.approx(w, abs=1e-5) for v, w in want.items())
        assert all(r["gap"] <= 1e-6 for r in got)
    # One language a source, and shares that differ.
    apart = spark.createDataFrame([("a", "en", "prose", 30), ("b", "de", "prose", 10)], shape)
    given = {"source": {"a": 0.5, "b": 0.5}, "lang": {"en": 0.8, "de": 0.2}}
    with pytest.warns(UserWarning, match="contradict"):
        got = M.rake(apart, M.Targets(given=given)).collect()
    assert all(r["gap"] == pytest.approx(0.3) for r in got)


def test_given_targets(spark):
    docs = spark.createDataFrame([(i, "a b c d", "s", "en" if i % 4 else "de") for i in range(400)], "doc_id long, text string, source string, lang string")
    got = M.mixing_weights(docs, M.Targets(given={"lang": {"en": 0.5, "de": 0.5}}, share=0.25))
    by = {r["lang"]: r["p"] for r in got.groupBy("lang").agg(F.avg("probability").alias("p")).collect()}
    assert by["de"] == pytest.approx(0.5, rel=1e-2) and by["en"] == pytest.approx(1 / 6, rel=1e-2)


def test_mixing_odd(odd_docs, no_docs):
    got = M.mixing_weights(odd_docs).collect()
    assert len(got) == odd_docs.count()
    assert all(r["sampled"] and r["probability"] == 1 for r in got if not r["n_tokens"])
    assert "unknown" in {r["source"] for r in got}
    kept = M.mixed(odd_docs)
    assert kept.columns[:5] == odd_docs.columns[:5] and 0 < kept.count() <= odd_docs.count()
    assert M.mixing_weights(no_docs).collect() == [] and M.mixed(no_docs).collect() == []


def test_texts_without_tokens_stay_in_mixed_company(spark):
    """An empty and a null text share their cell with short texts that weigh less than 1."""
    rows = [(i, "a b c d", "s" if i % 5 else "t", "en") for i in range(500)] + [(900, "", "s", "en"), (901, None, "s", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    targets = M.Targets(given={"source": {"s": 0.5, "t": 0.5}}, share=0.25)
    got = {r["doc_id"]: r for r in M.mixing_weights(docs, targets).collect()}
    assert got[1]["weight"] == pytest.approx(0.625, rel=1e-4) and got[1]["probability"] < 0.5
    assert all(got[i]["weight"] == got[i]["probability"] == 1 and got[i]["sampled"] for i in (900, 901))
    assert {900, 901} <= {r["doc_id"] for r in M.mixed(docs, targets).collect()}


def test_null_is_no_value_of_that_name(spark):
    rows = [(i, "a b c d", None if i % 4 else "unknown", "en") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    got = M.mixing_weights(docs, M.Targets(given={"source": {None: 0.5, "unknown": 0.5}})).collect()
    weights = {r["doc_id"] % 4 == 0: r["weight"] for r in got}
    assert weights[True] == pytest.approx(2, rel=1e-4) and weights[False] == pytest.approx(2 / 3, rel=1e-4)
    assert {r["source"] for r in got} == {"unknown"}


def test_cells_that_must_go_to_nothing():
    """Three cells, a half for each value: one cell can only be empty, which plain rounds reach by 1 / n."""
    codes = [np.array([0, 0, 1]), np.array([0, 1, 0]), np.array([0, 0, 0])]
    wants = [np.array([0.5, 0.5]), np.array([0.5, 0.5]), np.array([1.0])]
    mass, gap = M.raked(codes, wants, np.array([0.2, 0.3, 0.5]), M.Targets(rounds=1000))
    assert gap <= 1e-6 and mass == pytest.approx([0, 0.5, 0.5], abs=1e-6)


def test_rounds_are_bounded_and_the_gap_told(spark, monkeypatch):
    monkeypatch.setattr(M, "CELLS_A_TASK", 0)
    shape = "source string, lang string, topic string, tokens long"
    cells = spark.createDataFrame([("a", "x", "p", 20), ("a", "y", "p", 30), ("b", "x", "p", 50)], shape)
    halves = {"source": {"a": 0.5, "b": 0.5}, "lang": {"x": 0.5, "y": 0.5}}
    with pytest.warns(UserWarning, match="contradict"):
        got = M.rake(cells, M.Targets(given=halves, job_rounds=3)).collect()
    assert all(1e-6 < r["gap"] < 0.3 for r in got)


def test_mixing_by_brute_force(spark, sf_dir):
    """Topics, tokens, weights, budget and draw of every document, worked out one by one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r["doc_id"], r["text"] or "", r["source"], r["lang"]) for r in docs.collect()]

    def topic(text):
        size = len(text.encode())
        if text.count("|") * 20 > size:
            return "table"
        return "note" if size < 300 else "list" if text.count("\n") * 80 > size else "prose"

    told = [(i, s, g, topic(t), t.count(" ") + t.count("\n") + 1 if t else 0) for i, t, s, g in rows]
    cells = Counter()
    for _, *cell, n in told:
        cells[tuple(cell)] += n
    cells = {c: n for c, n in cells.items() if n}
    total = sum(cells.values())
    want = []
    for k in range(3):
        have = Counter()
        for c, n in cells.items():
            have[c[k]] += n
        want.append({v: n**0.5 / sum(x**0.5 for x in have.values()) for v, n in have.items()})
    mass = {c: n / total for c, n in cells.items()}
    for _ in range(3000):
        for k in range(3):
            held = Counter()
            for c, m in mass.items():
                held[c[k]] += m
            mass = {c: m * want[k][c[k]] / held[c[k]] for c, m in mass.items()}
    weight = {c: mass[c] * total / n for c, n in cells.items()}
    low, high = 0.0, 1e9
    for _ in range(200):
        middle = (low + high) / 2
        reached = sum(n * min(1.0, weight[c] * middle) for c, n in cells.items()) >= total / 2
        low, high = (low, middle) if reached else (middle, high)
    unit = {r["doc_id"]: r["u"] for r in docs.select("doc_id", (F.pmod(F.xxhash64(F.col("doc_id").cast("long"), F.lit("mixing")), F.lit(1 << 53)) / float(1 << 53)).alias("u")).collect()}
    got = {r["doc_id"]: r for r in M.mixing_weights(docs).collect()}
    for i, s, g, t, n in told:
        w = weight[s, g, t] if n else 1.0
        p = min(1.0, w * high) if n else 1.0
        r = got[i]
        assert (r["source"], r["lang"], r["topic"], r["n_tokens"]) == (s, g, t, n)
        assert r["weight"] == pytest.approx(w, rel=1e-3) and r["probability"] == pytest.approx(p, rel=2e-3)
        assert r["sampled"] == (unit[i] < p) or abs(unit[i] - p) < 5e-3


def test_language_batch_memory():
    """What a task holds for one batch of text, of eight languages, beside the batch itself."""
    rng = np.random.default_rng(1)
    model = G.Model(tuple("abcdefgh"), rng.random((G.SLOTS, 8), np.float32), np.ones((len(G.SCRIPTS), 8), bool))
    text = " ".join("abcde"[: 1 + i % 5] for i in range(600))
    texts = pa.array([text] * (G._batch_bytes(model) // len(text)))
    tracemalloc.start()
    words = G.words_of(texts)
    G.best_paths(G.word_scores(model, words), words.rows, 12.0)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200 << 20
