from collections import Counter

import numpy as np
import pytest

from llm_fixtures import no_docs, odd_docs  # noqa: F401
from pagelake.llm import divergence as D


def brute(rows, min_docs, top):
    """Every contract number from plain counts."""
    rows = [tuple((v or "") for v in r) for r in rows]
    table = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")

    def terms(text):
        data = text.encode().translate(table)
        return bytes(c if c >= 128 or 97 <= c <= 122 else 32 for c in data).split()

    docs, counts = Counter(), Counter()
    for lang, source, text in rows:
        found = Counter(terms(text))
        docs.update((lang, t) for t in found)
        for t, n in found.items():
            counts[lang, source, t] += n
    kept = {k for k, n in docs.items() if n >= min_docs}
    out = []
    langs = {r[0] for r in rows}
    for lang in langs:
        words = [t for k, t in kept if k == lang]
        sources = sorted({r[1] for r in rows if r[0] == lang})

        def rate(count, words=words):
            total = sum(count(t) for t in words)
            return {t: 1 + 1_000_000_000 * (count(t) + 2) // (total + 2 * len(words)) for t in words}

        p = {s: rate(lambda t, s=s, lang=lang: counts[lang, s, t]) for s in sources}
        q = rate(lambda t, lang=lang, sources=sources: sum(counts[lang, s, t] for s in sources))
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pairs = [(sum(f(p[s][t], p[o][t]) for t in words), o.encode()) for o in sources if o != s]
            high = [(f(p[s][t], q[t]), t) for t in words if counts[lang, s, t] and p[s][t] > q[t]]
            for part, values in (("pair", pairs), ("term", high)):
                values.sort(key=lambda v: (-v[0], v[1]))
                for rank, (value, item) in enumerate(values[: None if part == "pair" else top], 1):
                    out.append((lang, s, part, item.decode(), value, rank))
    return sorted(out)


def audited(df, **settings):
    return sorted(tuple(r) for r in D.audit_sources(df, **settings).collect())


def drawn(seed, n_sources, n=400):
    rng = np.random.default_rng(seed)
    words = np.array([f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)] + ["É", "ǅ", "x😀y", "A", "a"])
    weights = 1 / np.arange(1, len(words) + 1)
    rows = []
    for _ in range(n):
        source = f"s{rng.integers(n_sources)}"
        text = " ,1".join(rng.choice(words, rng.integers(0, 60), p=weights / weights.sum()))
        rows.append((["en", "de", None, "xx"][rng.integers(3)], source, text))
    return [*rows, ("xx", "one", "alone"), ("xx", "two", ""), (None, None, None), ("xx", "one", "alone"), ("en", "é", "wa"), ("en", "empty", "1 2")]


@pytest.mark.parametrize(("seed", "n_sources"), [(0, 3), (1, 70)])
def test_by_plain_counts(spark, seed, n_sources):
    rows = drawn(seed, n_sources)
    df = spark.createDataFrame(rows, "lang string, source string, text string")
    assert audited(df, min_docs=5, top=4) == brute(rows, 5, 4)


def test_no_term_is_kept(spark):
    rows = [("en", "a", "one"), ("en", "b", "two"), ("en", "c", None)]
    df = spark.createDataFrame(rows, "lang string, source string, text string")
    found = audited(df)
    assert found == brute(rows, 10, 10) and {r[2] for r in found} == {"pair"} and {r[4] for r in found} == {0}


def test_odd_documents(spark, odd_docs, no_docs):
    rows = [(r["lang"], r["source"], r["text"]) for r in odd_docs.collect()]
    assert audited(odd_docs, min_docs=2) == brute(rows, 2, 10)
    assert audited(no_docs) == []


def test_large_counts_stay_exact(spark):
    df = spark.createDataFrame([(9_007_199_254_740_993, 9_007_199_254_740_997, 3)], "n long, total long, n_terms long")
    got = df.select(D.probability(D.F.col("n"), "total")).first()[0]
    assert got == 1 + 1_000_000_000 * (9_007_199_254_740_993 + 2) // (9_007_199_254_740_997 + 6)


def test_words_of_a_text_in_pieces(monkeypatch):
    monkeypatch.setattr(D, "PIECE", 7)
    text = "Über-all b1c ÀB  longer-than-one-piece x".encode()
    assert sum(D._terms(text), []) == ["Über".encode(), b"all", b"b", b"c", "ÀB".replace("B", "b").encode(), b"longer", b"than", b"one", b"piece", b"x"]


def test_joint_cells_by_complement():
    """One word of terms, every cell against a count of its own."""
    rng = np.random.default_rng(5)
    a, b = rng.integers(0, 4, (3, 50)), rng.integers(0, 4, (2, 50))
    rate = lambda counts, extra: counts * 1000 + extra

    def levels(counts, extra):
        rows = [(s, rate(c, extra + s), sum(1 << t for t in range(50) if counts[s, t] == c)) for s in range(len(counts)) for c in (1, 2, 3)]
        return tuple(np.array(column, np.int64) for column in zip(*rows, strict=True))

    zero_a, zero_b = np.arange(3) + 7, np.arange(2) + 9
    got = D._word_sums(50, levels(a, 7), levels(b, 9), zero_a, zero_b)
    for i in range(3):
        for j in range(2):
            p, q = rate(a[i], 7 + i), rate(b[j], 9 + j)
            assert got[i, j] == ((p - q) ** 2 // (p + q)).sum()
