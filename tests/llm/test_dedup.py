"""Exact, near and line dedup and decontamination against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from llm_fixtures import no_docs, odd_docs, sf_dir  # noqa: F401  (fixtures)
from pyspark.sql import functions as F

from pagelake.llm import exact_dedup as E
from pagelake.llm import line_dedup as L
from pagelake.llm import near_dedup as N
from pagelake.llm.components import components
from pagelake.llm.decontaminate import decontaminate, leaks
from pagelake.llm.shingles import hashed_words, shingle_set, words
from pagelake.llm.textbits import mix

A_TO_Z = str.maketrans(E.UPPER, E.LOWER)


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


# --- exact -------------------------------------------------------------------------


def exact_brute(docs):
    groups = defaultdict(list)
    for i, t in docs:
        groups[(t or "").translate(A_TO_Z)].append(i)
    out = []
    for i, t in docs:
        norm = (t or "").translate(A_TO_Z)
        known = [x for x in groups[norm] if x is not None]
        keep = max(known) if known else None
        out.append((i, keep, len(groups[norm]), i == keep, hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=repr)


EXACT = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@pytest.mark.parametrize("capacity", [2, 50_000])
def test_exact(spark, odd_docs, capacity):
    docs = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    assert rows_of(E.exact_dedup(odd_docs, capacity), *EXACT) == exact_brute(docs)


def test_exact_on_given_tables(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = E.exact_dedup(docs, 20)
    assert rows_of(got, *EXACT) == exact_brute([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert got.select("bucket").distinct().count() > 4


def test_exact_empty(no_docs):
    assert E.exact_dedup(no_docs).collect() == []


def test_directory_splits_and_doubles(spark):
    keys = spark.range(1000).select(F.xxhash64("id").alias("key"))
    directory = E.build_directory(keys, 30)
    placed = directory.bucket_of(keys, "key").groupBy("bucket").count().collect()
    assert sum(r["count"] for r in placed) == 1000 and max(r["count"] for r in placed) <= 30
    # Every slot of the directory points at one bucket.
    assert sum(1 << (directory.depth - bits) for _, bits in directory.buckets) == 1 << directory.depth


def test_large_directory_is_joined(spark, monkeypatch):
    keys = spark.range(1000).select(F.xxhash64("id").alias("key"))
    directory = E.build_directory(keys, 5)
    assert len(directory.buckets) > 64
    small = rows_of(directory.bucket_of(keys, "key"), "key", "bucket")
    monkeypatch.setattr(E, "BROADCAST_SLOTS", 1)
    assert rows_of(directory.bucket_of(keys, "key"), "key", "bucket") == small
    assert all(b is not None for _, b in small)


def test_owners_hold_key_ranges(spark):
    entries = spark.range(4000).selectExpr("cast(id % 32 as int) as bucket", "xxhash64(id) as key", "'x' as text_sha256", "id as keep_id")
    plan = E.owned(entries)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "rangepartitioning(bucket" in plan
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        # A range may end inside a bucket, so four owners share three at most.
        assert E.owned(entries).select("bucket", F.spark_partition_id()).distinct().count() <= 32 + 3
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


# --- near --------------------------------------------------------------------------


def bag(text):
    found = words(text)
    k = min(5, len(found))
    return Counter(tuple(found[i : i + k]) for i in range(len(found) - k + 1)) if found else None


def near_brute(docs, threshold=0.8):
    """Class (as the smallest place) of each document by comparing all pairs."""
    all_bags = [bag(t) for _, t in docs]
    parent = list(range(len(docs)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(all_bags):
        for j in range(i):
            b = all_bags[j]
            if a and b:
                shared = sum((a & b).values())
                if shared >= threshold * (sum(a.values()) + sum(b.values()) - shared) - 1e-9:
                    parent[root(i)] = root(j)
    return [root(i) for i in range(len(docs))]


def edited_copies(rng, sizes, edits):
    """Groups of copies of a text with words changed at random."""
    vocabulary = [f"w{i}" for i in range(400)]
    docs = []
    for size in sizes:
        base = [rng.choice(vocabulary) for _ in range(rng.randint(60, 120))]
        for _ in range(size):
            copy = list(base)
            for _ in range(rng.randint(0, edits)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            docs.append((len(docs), " ".join(copy)))
    return docs


@pytest.mark.parametrize("seed", range(2))
def test_near_groups(spark, monkeypatch, seed):
    rng = random.Random(seed)
    docs = edited_copies(rng, [1, 2, 5, 40, 90], 3)
    monkeypatch.setattr(N, "CHUNK", 16)
    classes = near_brute(docs)
    smallest = {c: min(i for (i, _), k in zip(docs, classes, strict=True) if k == c) for c in classes}
    got = N.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"))
    assert rows_of(got, "doc_id", "class_id") == sorted(((i, smallest[c]) for (i, _), c in zip(docs, classes, strict=True)), key=repr)
    assert got.where("kept").count() == len(set(classes))


def test_near_on_given_tables(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plain = [(r["doc_id"], r["text"]) for r in docs.collect()]
    classes = near_brute(plain)
    smallest = {c: min(i for (i, _), k in zip(plain, classes, strict=True) if k == c) for c in classes}
    got = N.near_duplicates(docs)
    assert rows_of(got, "doc_id", "class_id") == sorted(((i, smallest[c]) for (i, _), c in zip(plain, classes, strict=True)), key=repr)
    left = N.drop_near_duplicates(docs)
    assert left.columns == docs.columns and rows_of(left, "doc_id") == [(i,) for i in sorted(set(smallest.values()), key=lambda x: repr((x,)))]


def test_near_odd(odd_docs, no_docs):
    got = N.near_duplicates(odd_docs).collect()
    assert len(got) == odd_docs.count()
    by_id = Counter(r["doc_id"] for r in got if r["kept"])
    # Rows 1 and 2 (twice) are one class; the wordless and null ones are classes of their own.
    assert by_id[1] == 1 and by_id[2] == 0 and by_id[3] == by_id[4] == by_id[6] == 1 and by_id[None] == 2
    left = N.drop_near_duplicates(odd_docs)
    assert left.columns == odd_docs.columns and left.count() == odd_docs.count() - 2
    twice = odd_docs.where("doc_id = 2")
    assert N.drop_near_duplicates(twice).count() == 1
    assert N.near_duplicates(no_docs).collect() == [] and N.drop_near_duplicates(no_docs).collect() == []


@pytest.mark.parametrize("most", [1, 3, 40])
def test_signatures_are_unbiased(most):
    g = np.random.default_rng(most)
    off = []
    for _ in range(150):
        keys = mix(g.integers(0, 1 << 62, 50, dtype=np.uint64))
        a = g.integers(1, most + 1, 50)
        b = np.where(g.random(50) < 0.3, g.integers(0, most + 1, 50), a)
        at = [np.flatnonzero(x) for x in (a, b)]
        rows = np.r_[np.zeros(len(at[0]), np.int64), np.ones(len(at[1]), np.int64)]
        signed = N.signatures(rows, np.r_[keys[at[0]], keys[at[1]]], np.r_[a[at[0]], b[at[1]]], 2)
        off.append((signed[0] == signed[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum())
    assert abs(np.mean(off)) < 4 * np.std(off) / np.sqrt(len(off)) and np.std(off) < 0.07


def test_components(spark):
    chain = [(i, i + 1) for i in range(20)] + [(100, 101), (102, 101), (50, 50)]
    got = components(spark.createDataFrame(chain, "a long, b long")).collect()
    assert {r["node"]: r["label"] for r in got} == {**{i: 0 for i in range(21)}, 100: 100, 101: 100, 102: 100}


def test_hashed_words_are_words():
    texts = ["Hello, wörld! a1 b_c", "", None, "ÉCOLE école — fin… ok", "İstanbul ΣΑΣ ſ", "x\ty\nz 你好 ½"]
    found = hashed_words(pa.array(texts))
    assert np.diff(found.firsts).tolist() == [len(words(t)) for t in texts]
    names = {}
    for at, word in enumerate(w for t in texts for w in words(t)):
        assert names.setdefault(word, found.hashes[at]) == found.hashes[at]
    assert len(set(names.values())) == len(names)


# --- lines -------------------------------------------------------------------------


def form_of(line):
    """The tokens of a line, those with digits masked unless all have some."""
    tokens = line.split()
    if tokens and not all(re.search("[0-9]", t) for t in tokens):
        tokens = ["<*>" if re.search("[0-9]", t) else t for t in tokens]
    return " ".join(tokens)


def lines_brute(docs, leader_key, settings=L.Settings()):
    """Leaders taken one by one in each leaf; documents of a template counted once."""
    held = defaultdict(set)
    for i, t in docs:
        for line in (t or "").split("\n"):
            if form_of(line):
                held[form_of(line)].add((i, t))
    leaves = defaultdict(list)
    for form in held:
        tokens = form.split(" ")
        leaves[len(tokens), tuple(tokens[: L.LEADING])].append(form)
    template = {}
    for forms in leaves.values():
        leaders = []
        for form in sorted(forms, key=lambda f: (len(held[f]), leader_key[f]), reverse=True):
            tokens = form.split(" ")
            like = lambda lead, own=tokens: sum(x == y for x, y in zip(own, lead, strict=True)) >= settings.similarity * len(own)
            lead = next((x for x in leaders if like(x)), None)
            if lead is None:
                leaders.append(tokens)
            template[form] = " ".join(lead or tokens)
    in_docs = defaultdict(set)
    for form, t in template.items():
        in_docs[t] |= held[form]
    first = {t: min((i for i, _ in d if i is not None), default=None) for t, d in in_docs.items()}
    out = []
    for i, t in docs:
        goes = lambda line, i=i: form_of(line) in template and len(in_docs[template[form_of(line)]]) >= settings.min_docs and first[template[form_of(line)]] != i
        out.append((i, None if t is None else "\n".join(line for line in t.split("\n") if not goes(line))))
    return out


def leader_keys(spark, docs):
    forms = {form_of(line) for _, t in docs if t for line in t.split("\n")}
    return {r["f"]: r["k"] for r in spark.createDataFrame([(f,) for f in forms], "f string").select("f", F.xxhash64("f").alias("k")).collect()}


def test_unrelated_indented_lines_stay(spark):
    """Indentation is no likeness, and no difference."""
    names = "alpha beta gamma delta epsilon zeta eta theta".split()
    docs = [(i, f"{' ' * 12}{n} = {n[::-1]}") for i, n in enumerate(names)]
    docs += [(20 + i, f"{' ' * i}return the same   value") for i in range(6)]
    got = {r["doc_id"]: r["text"] for r in L.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert {i: got[i] for i in range(8)} == dict(docs[:8])
    assert got[20] == docs[8][1] and all(got[20 + i] == "" for i in range(1, 6))


def test_lines(spark):
    rng = random.Random(1)
    shared = ["All rights reserved by the owners", "posted 12 times by user7", "read more of this here", "a b"]
    docs = []
    for i in range(60):
        own = [f"line {i} {j} of " + " ".join(rng.choice("klmnopq") for _ in range(5)) for j in range(rng.randint(0, 3))]
        lines = own + [re.sub("12", str(i), s) for s in rng.sample(shared, rng.randint(0, 3))] + ["posted by %s on monday at noon" % rng.choice(["ann", "bob", "cy"])]
        rng.shuffle(lines)
        docs.append((i, "\n".join(lines)))
    got = L.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string"))
    assert rows_of(got, "doc_id", "text") == sorted(lines_brute(docs, leader_keys(spark, docs)), key=repr)
    assert got.agg(F.sum("_line_dropped")).first()[0] > 50


def test_lines_on_given_tables(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plain = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = L.dedup_lines(docs)
    assert rows_of(got, "doc_id", "text") == sorted(lines_brute(plain, leader_keys(spark, plain)), key=repr)


def test_lines_odd(odd_docs, no_docs):
    got = L.dedup_lines(odd_docs, L.Settings(min_docs=2))
    assert got.columns[: len(odd_docs.columns)][:5] == odd_docs.columns[:5] and got.count() == odd_docs.count()
    texts = {(r["doc_id"], r["text"]) for r in got.collect()}
    assert (4, None) in texts and (3, "") in texts and (6, "\n\n \n") in texts
    assert L.dedup_lines(no_docs).collect() == []


def test_short_lines_and_any_whitespace(spark):
    short = ["Of.", "And ornd.", "\u8fd9\u662f\u6211\u4eec\u7684\u5bb6", "Page %d", "\u540d\u524d\u3000\u3042\u3044 %d", "id\tname\t%d\tx"]
    numbers = ["%d", "\u7b2c%d\u7ae0", "%d\t7%d"]
    text = lambda i: "\n".join([s.replace("%d", str(i)) for s in short + numbers] + ["", " \t\u3000", "end"])
    docs = spark.createDataFrame([(i, text(i)) for i in range(6)], "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in L.dedup_lines(docs).collect()}
    assert got[0] == text(0)
    # Each number line is another one, and blank lines stay.
    for i in range(1, 6):
        assert got[i].split("\n") == [s.replace("%d", str(i)) for s in numbers] + ["", " \t\u3000"]


def test_every_template_of_a_leaf(spark):
    """A leaf with an unrelated frequent line, against leaders taken one by one."""
    rng = random.Random(3)
    name = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    kinds = ["For more on this subject see also pages", "For more details please contact our colleague %s", "For more %s of the house of %s"]
    docs = [(i, kinds[0] if i < 20 else re.sub("%s", lambda _: name(), kinds[1 + i % 2])) for i in range(60)]
    docs += [(i, "For more " + " ".join(rng.choice("uvwxyz") for _ in range(6))) for i in range(60, 80)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    held = Counter(t for _, t in docs)
    keys = leader_keys(spark, docs)
    left, template = sorted(held, key=lambda f: (held[f], keys[f]), reverse=True), {}
    while left:
        lead = left[0].split(" ")
        taken = [f for f in left if len(f.split(" ")) == len(lead) and sum(map(str.__eq__, f.split(" "), lead)) >= 0.7 * len(lead)]
        template |= dict.fromkeys(taken, left[0])
        left = [f for f in left if f not in taken]
    groups = defaultdict(list)
    for i, t in docs:
        groups[template[t]].append(i)
    assert sum(len(g) >= 5 for g in groups.values()) >= 3
    want = sorted(i for g in groups.values() for i in (g if len(g) < 5 else [min(g)]))
    got = L.dedup_lines(frame)
    assert sorted(r["doc_id"] for r in got.where("text <> ''").collect()) == want


def test_texts_are_parted_into_lines_once(spark, monkeypatch):
    calls, lines = [], L._lines
    monkeypatch.setattr(L, "_lines", lambda docs: calls.append(1) or lines(docs))
    docs = [(i, f"the  shared line {i} of all\n  a line of {'abcdef'[i]} own ") for i in range(6)]
    got = L.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string"))
    assert rows_of(got, "doc_id", "text") == sorted(lines_brute(docs, leader_keys(spark, docs)), key=repr)
    assert len(calls) == 1


@pytest.mark.parametrize("few", [1, 2, 64])
def test_chance_likeness_takes_few_rounds(spark, monkeypatch, few):
    """Each line shares a stretch with the next by chance, so before, each waited a round for the one before it."""
    n = 10
    word = lambda *x: "w" + "".join("abcdefghijklmnop"[i] for i in x)
    stretch = lambda i, j: [word(i, j), word(j, i)]
    lines = []
    for i in range(n):
        bands = [stretch(i, 11), stretch(i, 12), stretch(i, 13), stretch(i, 14)]
        bands[i % 2], bands[(i + 1) % 2] = stretch(i, 15), stretch(i - 1, 15) if i else stretch(i, 10)
        lines.append(" ".join(["see", "also", *sum(bands, [])]))
    near = [" ".join(x.split(" ")[:-1] + ["else"]) for x in lines]
    docs = [(d, "\n".join(lines[: n - d])) for d in range(n)] + [(20 + d, "\n".join(near[d:])) for d in range(4)]
    rounds, write = [], L.written
    monkeypatch.setattr(L, "FEW", few)
    monkeypatch.setattr(L, "written", lambda df, name, **how: rounds.append(name) or write(df, name, **how))
    got = L.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string"))
    assert rows_of(got, "doc_id", "text") == sorted(lines_brute(docs, leader_keys(spark, docs)), key=repr)
    assert rounds.count("line-round") <= 5 if few == 64 else rounds.count("line-round") > 5


def test_documents_of_a_template_count_once(spark):
    names = ["Alice Smith", "Bob Jones", "Cy Brown", "Di Green", "Ed White", "Flo Black"]
    line = "For more details on that please contact %s"
    texts = ["\n".join(line % n for n in names[:4]), line % names[4]]
    twice = lambda docs: {r["doc_id"]: r["text"] for r in L.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    docs = list(enumerate(texts))
    assert twice(docs) == dict(docs)
    # In five documents it recurs.
    docs += [(2, line % names[5]), (3, line % "Gil Grey"), (4, line % "Hal Gold")]
    assert twice(docs) == {0: texts[0], 1: "", 2: "", 3: "", 4: ""}


# --- benchmark ---------------------------------------------------------------------


def leaks_brute(docs, items, threshold=0.8):
    out = []
    for item_id, text in items:
        found = words(text)
        if not found:
            continue
        k = min(5, len(found))
        own = shingle_set(found, k)
        for i, t in docs:
            shared = len(own & shingle_set(words(t), k))
            if shared >= threshold * len(own) - 1e-9:
                out.append((i, item_id, len(own), shared))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [2, 20_000])
def test_leaks(spark, sf_dir, block):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plain = [(r["doc_id"], r["text"]) for r in docs.collect()]
    given = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()][:9]
    edited = " ".join(w if n != 3 else "changed" for n, w in enumerate((given[0][1] + " " + given[1][1]).split(" ")))
    items = [*given, (900, ""), (901, None), (902, "the"), (903, plain[0][1][:40]), (903, edited), (None, given[2][1])]
    plain.append((10_000, "before " + edited + " after"))
    got = leaks(spark.createDataFrame(plain, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), block=block)
    assert rows_of(got, "doc_id", "item_id", "n_item", "n_shared") == leaks_brute(plain, items)


def test_decontaminate(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, "the same text as another one has"), (2, None)], "item_id long, text string")
    left = decontaminate(odd_docs, items)
    assert left.columns == odd_docs.columns
    assert Counter(r["doc_id"] for r in left.collect()) == Counter({3: 1, 4: 1, None: 2, 5: 2, 6: 1, 7: 1, 8: 1})
    assert decontaminate(no_docs, items).collect() == []
    assert decontaminate(odd_docs, items.limit(0)).count() == odd_docs.count()


def test_decontaminate_judges_each_row(spark):
    items = spark.createDataFrame([(1, "one two three four five six seven")], "item_id long, text string")
    leak, clean = "so one two three four five six seven it is", "nothing of that kind is in here at all"
    docs = spark.createDataFrame([(None, leak), (None, clean), (1, leak), (1, clean), (2, None)], "doc_id long, text string")
    assert rows_of(decontaminate(docs, items), "doc_id", "text") == sorted([(None, clean), (1, clean), (2, None)], key=repr)


def test_bitmap_keeps_every_key_and_few_others(spark):
    rows = spark.range(20_000).select(F.xxhash64("id").alias("form_key"), "id").withColumn("form_key", F.when(F.col("id") == 7, F.lit(-(2**63))).otherwise(F.col("form_key")))
    keys = rows.where("id % 10 = 7").select("form_key")
    left = {r.id for r in L._near_keys(rows, keys).collect()}
    assert {i for i in range(20_000) if i % 10 == 7} <= left
    assert len(left) < 2_100
    none = keys.limit(0)
    assert L._near_keys(rows, none).count() == 0
