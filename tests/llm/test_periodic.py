import hashlib
import random
import zlib

import numpy as np
import pytest

from llm_fixtures import SF_DIR, no_docs, odd_docs, sf_dir  # noqa: F401
from pagelake.llm import periodic as P
from pagelake.llm.queries import op12_periodic_runs
from pagelake.llm.stage import table


def brute_runs(words):
    """Every run, by trying all periods at all places."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        start = 0
        while start < n - q:
            end = start
            while end + q < n and words[end] == words[end + q]:
                end += 1
            if end - start + q >= max(6, 4 * q) and (start, end + q) not in found:
                found[start, end + q] = q
            start = end + 1
    return sorted((a, b - a, q) for (a, b), q in found.items())


def brute_left(words, runs):
    gone = set()
    for start, length, q in runs:
        gone.update(range(start + q, start + length))
    return b" ".join(w for i, w in enumerate(words) if i not in gone)


def repetitive(rng, n):
    """Words of few kinds, with stretches that repeat at periods of any size and break off anywhere."""
    words = [rng.choice([b"a", b"b", b"c", b"d"][: rng.randint(1, 4)]) for _ in range(n)]
    for _ in range(rng.randint(0, 4)):
        at, q = rng.randrange(n), rng.randint(1, max(1, n // 5))
        for i in range(at + q, min(n, at + q * rng.randint(2, 9) + rng.randrange(q))):
            words[i] = words[i - q]
    return words


def long_fibonacci(n):
    a, b = [b"x"], [b"x", b"y"]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


def texts(rng):
    out = [[], [b"a"], [b"a"] * 5, [b"a"] * 6, [b"a"] * 100, [b"a", b"b"] * 4, [b"a", b"b", b"c"] * 4 + [b"a"], long_fibonacci(300)]
    out += [[b"a" if bin(i).count("1") % 2 else b"b" for i in range(256)] * 5]
    return out + [repetitive(rng, rng.randint(1, 150)) for _ in range(40)]


def runs_of(found):
    """Runs from local fragments, in the way that stitching joins them."""
    low, high, gap = P._joined(*found)
    best = {}
    for a, b, q in zip(low.tolist(), high.tolist(), gap.tolist(), strict=True):
        if b - a >= P.least_matches(q):
            best[a, b + q] = min(q, best.get((a, b + q), q))
    return sorted((a, b - a, q) for (a, b), q in best.items())


@pytest.mark.parametrize("seed", range(4))
def test_fragments_of_a_batch(seed, monkeypatch):
    rng = random.Random(seed)
    monkeypatch.setattr(P, "AT_ONCE", rng.choice([64, 1 << 19]))
    many = texts(rng)
    rng.shuffle(many)
    ids, starts = P._numbered(many)
    top = max(P._last_octave(len(t)) for t in many)
    found = runs_of(P.fragments(ids, range(top + 1)))
    want = [(int(s) + a, n, q) for s, t in zip(starts, many, strict=True) for a, n, q in brute_runs(t)]
    assert found == sorted(want)


@pytest.mark.parametrize("seed", range(3))
def test_stretches_of_a_long_document(seed, monkeypatch):
    rng = random.Random(seed)
    monkeypatch.setattr(P, "STRETCH", rng.choice([32, 64]))
    monkeypatch.setattr(P, "SMALL", rng.choice([1, 3]))
    for words in [*texts(rng), repetitive(rng, 600), [b"a", b"b", b"b"] * 150]:
        parts = []
        for first, last, low, high, a, b in P._stretches(len(words)) if len(words) >= 4 else []:
            ids, _ = P._numbered([words[a:b]])
            x, y, q = P.fragments(ids, range(first, last + 1), low - a, high - a)
            parts.append((x + a, y + a, q))
        found = runs_of([np.concatenate(c) for c in zip(*parts, strict=True)]) if parts else []
        assert found == brute_runs(words), words


def test_a_false_hash_match_changes_nothing(monkeypatch):
    """With hashes that always agree every fragment still rests on the words themselves."""
    monkeypatch.setattr(P.Words, "alike", lambda self, at, gap, length: np.ones(np.broadcast(at, gap).shape, bool))
    ids, _ = P._numbered([[b"w%d" % i for i in range(200)]])
    assert not len(P._checked(P.Words(ids), np.array([0, 50]), np.array([40, 90]), np.array([3, 7]))[0])


def as_rows(df):
    return sorted((r["doc_id"], r["n_words"], tuple(tuple(x) for x in r["runs"]), r["collapsed"], r["collapsed_sha256"]) for r in df.collect())


def test_documents_short_and_long(spark):
    rng = random.Random(3)
    many = [repetitive(rng, rng.randint(50, 400)) for _ in range(30)]
    docs = spark.createDataFrame([(i, b"\t\n ".join(w).decode()) for i, w in enumerate(many)], "doc_id long, text string")
    want = []
    for i, words in enumerate(many):
        runs = brute_runs(words)
        left = brute_left(words, runs)
        want.append((i, len(words), tuple(runs), left.decode() if runs else None, hashlib.sha256(left).hexdigest()))
    assert as_rows(P.periodic_runs(docs)) == want
    # The same where every document counts as long, and for one of many stretches.
    words = [b"%d" % rng.randrange(3000) for _ in range(150_000)]
    for at, q, end in ((20_000, 9_000, 61_000), (65_530, 3, 65_560), (70_000, 17, 140_000)):
        for i in range(at + q, end):
            words[i] = words[i - q]
    runs = runs_of(P.fragments(P._numbered([words])[0], range(P._last_octave(len(words)) + 1)))
    left = brute_left(words, runs)
    assert {q for _, _, q in runs} == {9_000, 3, 17} and len(list(P._stretches(len(words)))) > 6
    want.append((30, len(words), tuple(runs), left.decode(), hashlib.sha256(left).hexdigest()))
    docs = docs.unionByName(spark.createDataFrame([(30, b" ".join(words).decode())], docs.schema))
    assert as_rows(P.periodic_runs(docs, long_bytes=200)) == want


def test_odd_documents(spark, odd_docs, no_docs):
    rows = P.periodic_runs(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by_id = {r["doc_id"]: r for r in rows if r["doc_id"] in (3, 4, 6)}
    assert all(r["n_words"] == 0 and r["runs"] == [] and r["collapsed"] is None for r in by_id.values())
    long = [r for r in rows if r["n_words"] == 40_000][0]
    assert [tuple(x) for x in long["runs"]] == [(0, 40_000, 1)] and long["collapsed"] == "word"
    assert P.periodic_runs(no_docs).collect() == []


def test_query_by_brute_force(spark, sf_dir):
    want = []
    for r in table(spark, sf_dir, "documents").select("doc_id", "text").collect():
        words = (r["text"] or "").encode().split()
        h = zlib.crc32(str(r["doc_id"]).encode())
        if h % 10 == 0 and words:
            n, g = len(words), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = brute_runs(words) if len(words) < 1500 else runs_of(P.fragments(P._numbered([words])[0], range(20)))
        best = max(runs, key=lambda x: (x[1] / x[2], -x[0], -x[2]), default=(None, None, None))
        text = "".join(f"{a},{n},{q}\n" for a, n, q in sorted(runs, key=lambda x: (x[0], x[2])))
        milli = None if not runs else 1000 * best[1] // best[2]
        want.append(
            (r["doc_id"], len(runs), *best, milli, hashlib.sha256(text.encode()).hexdigest(), hashlib.sha256(brute_left(words, runs)).hexdigest())
        )
    got = op12_periodic_runs(spark, SF_DIR)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)
    assert sum(w[1] for w in want) > 5
