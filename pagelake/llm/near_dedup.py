"""MinHash near-dedup of weighted shingles: BagMinHash, bands, exact multiset overlap.

A document is the multiset of its five-word shingles. BagMinHash gives it a signature whose places
agree between two documents with the probability of their weighted Jaccard similarity: each shingle
throws points in time over the axis of its weight, a Poisson process that is the same in every
document, and a document sees the points below its own count; the first point in each of ``PLACES``
places signs it. The weight axis is cut into the levels (0, 1], (1, 2], (2, 4], ... with a process
each, and a point's place within a level is found by halving it, so a count of n costs about
log2(n) processes. Points are thrown in order of time up to a horizon by which a document's places
are full with near certainty; documents with an empty place go on with a later horizon.

Documents with equal multisets are one node. Nodes that agree in a band meet in its bucket. There,
all are compared with one hub, a hub of many nodes in chunks. The nodes that the hub did not take
are then compared with all others of the bucket, chunk by chunk in blocks, as products of incidence
matrices. So each connection that all pairs of a bucket would give is found, and no pairs are
written: a star for each bucket, and from each block a forest of its links. Comparing is exact, over
whole texts. A group whose copies are like its hub costs one comparison a copy; one whose copies
differ among themselves by about the threshold costs a matrix product for each two chunks.

Defined results: words are runs of letters and digits in lower case; a text of one to four words is
one shingle; null and wordless texts are classes of their own and stay; repeated rows are members of
one class; in a class the smallest doc_id stays (null counts as smallest, then the row read first);
an empty table gives an empty result; columns beyond doc_id and text are ignored or passed on
unchanged; names that begin with ``_near_`` are the operator's own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagelake.llm.components import components
from pagelake.llm.shingles import hashed_words, shingle_hashes
from pagelake.llm.stage import written
from pagelake.llm.textbits import MIX_A, MIX_B, mix, ranges, slices_by_bytes

SHINGLE, THRESHOLD = 5, 0.8
BANDS, ROWS = 20, 4
PLACES = BANDS * ROWS

#: Documents compared with a copy of their hub's text.
CHUNK = 256


def bags(texts: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, shingle, count) of every distinct shingle, by row and then shingle."""
    found = hashed_words(texts)
    hashes, rows = shingle_hashes(found, size)
    # A text too short for a shingle is one of all its words.
    n_words = np.diff(found.firsts)
    for k in range(1, size):
        if (short := n_words == k).any():
            less, less_rows = shingle_hashes(found, k)
            use = short[less_rows]
            hashes, rows = np.concatenate([hashes, less[use]]), np.concatenate([rows, less_rows[use]])
    order = np.lexsort((hashes, rows))
    hashes, rows = hashes[order], rows[order]
    if not len(rows):
        return rows, hashes, np.zeros(0, np.int64)
    new = np.flatnonzero(np.r_[True, (hashes[1:] != hashes[:-1]) | (rows[1:] != rows[:-1])])
    return rows[new], hashes[new], np.diff(np.r_[new, len(rows)])


def _uniform(x: np.ndarray) -> np.ndarray:
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)


def _points(rows: np.ndarray, seeds: np.ndarray, rates: np.ndarray, lows: np.ndarray, counts: np.ndarray, horizon: np.ndarray) -> tuple[np.ndarray, ...]:
    """(row, place, time, point) of every accepted point up to each row's horizon."""
    out: list[tuple[np.ndarray, ...]] = []
    state = mix(seeds)
    # Most processes have no point in time: tell without a logarithm.
    first = _uniform(state)
    live = np.flatnonzero(first >= np.exp(-rates * horizon[rows]))
    rows, state, rates, lows, counts = rows[live], state[live], rates[live], lows[live], counts[live]
    time = -np.log(first[live]) / rates
    while len(rows):
        point = mix(state + MIX_A)
        detail = mix(point + MIX_B)
        # The point's unit of weight within its level, as halving the level again and again finds it.
        unit = lows + 1 + np.floor(_uniform(mix(detail + MIX_A)) * np.maximum(lows, 1)).astype(np.int64)
        unit = np.where(lows == 0, 1, unit)
        seen = unit <= counts
        place = (detail >> np.uint64(33)).astype(np.int64) % PLACES
        out.append((rows[seen], place[seen], time[seen], point[seen]))
        state = mix(state + MIX_B)
        time = time - np.log(_uniform(state)) / rates
        live = time <= horizon[rows]
        rows, state, rates, lows, counts, time = (x[live] for x in (rows, state, rates, lows, counts, time))
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.uint64))


def signatures(rows: np.ndarray, shingles: np.ndarray, counts: np.ndarray, n_rows: int) -> np.ndarray:
    """(n_rows, PLACES) signatures of bags; a row without shingles has only zeros."""
    signed = np.zeros((n_rows, PLACES), np.uint64)
    if not len(rows):
        return signed
    levels = 1 + np.ceil(np.log2(counts)).astype(np.int64)
    level = ranges(np.zeros(len(counts), np.int64), levels)
    of = np.repeat(np.arange(len(counts)), levels)
    # Level 0 is (0, 1]; level j above it is (2 ** (j - 1), 2 ** j].
    lows = np.where(level == 0, 0, 1 << np.maximum(level - 1, 0))
    rates = np.maximum(lows, 1).astype(np.float64)
    seeds = shingles[of] + level.astype(np.uint64) * MIX_B
    of_row, of_count = rows[of], counts[of]
    weight = np.bincount(rows, weights=counts, minlength=n_rows)
    horizon = PLACES * (np.log(PLACES) + 6.0) / np.maximum(weight, 1)
    todo = weight > 0
    while todo.any():
        use = todo[of_row]
        at, place, time, point = _points(of_row[use], seeds[use], rates[use], lows[use], of_count[use], horizon)
        order = np.argsort(-time, kind="stable")
        flat = np.zeros(n_rows * PLACES, np.uint64)
        # The earliest point of a place is written last.
        flat[at[order] * PLACES + place[order]] = point[order]
        fresh = flat.reshape(n_rows, PLACES)
        signed[todo] = fresh[todo]
        todo = todo & (signed == 0).any(1)
        horizon = horizon * 4
    return signed


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices_by_bytes(batch, "text", 1 << 20):
            n = len(part)
            rows, shingles, counts = bags(part.column("text"))
            signed = signatures(rows, shingles, counts, n)
            bands = np.zeros((n, BANDS), np.uint64)
            for b in range(BANDS):
                key = np.full(n, b + 1, np.uint64)
                for r in range(ROWS):
                    key = mix(key * MIX_A + signed[:, b * ROWS + r])
                bands[:, b] = key
            # Two order-free sums over a bag name it.
            keys = []
            for salt in (MIX_A, MIX_B):
                total = np.zeros(n, np.uint64)
                np.add.at(total, rows, mix(shingles ^ salt) * counts.astype(np.uint64))
                keys.append(total)
            size = np.bincount(rows, weights=counts, minlength=n).astype(np.int64)
            yield pa.record_batch(
                [
                    part.column("doc_id"),
                    part.column("text_key"),
                    pa.array(size),
                    pa.array(keys[0].view(np.int64)),
                    pa.array(keys[1].view(np.int64)),
                    pa.FixedSizeListArray.from_arrays(pa.array(bands.reshape(-1).view(np.int64)), BANDS).cast(pa.list_(pa.int64())),
                ],
                ["doc_id", "text_key", "size", "bag_a", "bag_b", "bands"],
            )


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Similarity of the members that follow each (hub, chunk) row to its text."""
    hub = None
    for batch in batches:
        for part in slices_by_bytes(batch, "text", 1 << 20):
            rows, shingles, counts = bags(part.column("text"))
            cuts = np.searchsorted(rows, np.arange(len(part) + 1))
            hubs = part.column("hub").to_numpy(zero_copy_only=False)
            chunks = part.column("chunk").to_numpy(zero_copy_only=False)
            nodes = part.column("node").to_pylist()
            out = []
            for i, node in enumerate(nodes):
                a, b = cuts[i], cuts[i + 1]
                if node is None:
                    hub = (hubs[i], chunks[i], shingles[a:b].copy(), counts[a:b].copy())
                    continue
                assert hub is not None and hub[:2] == (hubs[i], chunks[i]), "a member came before its hub"
                theirs, weights = hub[2:]
                at = np.minimum(np.searchsorted(theirs, shingles[a:b]), len(theirs) - 1)
                same = theirs[at] == shingles[a:b]
                shared = int(np.minimum(weights[at], counts[a:b])[same].sum())
                total = int(weights.sum() + counts[a:b].sum()) - shared
                out.append((hubs[i], node, shared / total))
            if out:
                yield pa.record_batch([pa.array([o[k] for o in out], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.float64()))], ["hub", "node", "similarity"])


def _similarities(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(hub, node, similarity) of (hub, node) pairs, from (node, text) rows."""
    sizes = pairs.groupBy("hub").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks"))
    sizes = written(sizes, "near-hubs")
    members = (
        pairs.join(sizes, "hub")
        .select("hub", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int").alias("chunk"), "node")
        .join(texts, "node")
        .select("hub", "chunk", "node", "text")
    )
    heads = (
        texts.join(sizes, F.col("node") == F.col("hub"))
        .select("hub", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), F.lit(None).cast("long").alias("node"), "text")
    )
    laid = heads.unionByName(members).repartition("hub", "chunk").sortWithinPartitions("hub", "chunk", F.col("node").asc_nulls_first())
    return written(laid.mapInArrow(_compare, "hub long, node long, similarity double"), "near-compared")


def _order(node):
    """Which node of a bucket is its hub: the same choice in every bucket, but no favour to small ids."""
    return F.struct(F.xxhash64(node, F.lit("hub")), F.col(node))


def _texts_of(open_: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """(node, text) of the nodes that meet another one."""
    meeting = open_.select("node").distinct().join(nodes.select("node", "doc_id", "text_key"), "node")
    found = docs.select(F.col("doc_id").alias("_id"), "text").withColumn("_key", F.xxhash64("text"))
    same = F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_key") == F.col("text_key"))
    # Rows that repeat hold the same text; one of them is enough.
    return written(found.join(meeting.hint("merge"), same).select("node", "text").dropDuplicates(["node"]), "near-texts")


def _links(nodes: DataFrame, docs: DataFrame, threshold: float) -> DataFrame:
    """(a, b) links that connect all nodes which the similar pairs within buckets connect."""
    met = nodes.select("node", F.explode("bands").alias("bucket"))
    crowded = met.groupBy("bucket").agg(F.count("*").alias("n"), F.min(_order("node")).alias("h")).where("n > 1").select("bucket", F.col("h.node").alias("hub"))
    starred = written(met.join(crowded.hint("merge"), "bucket"), "near-buckets")
    texts = _texts_of(starred, nodes, docs)
    starred = starred.where("node <> hub")
    compared = _similarities(starred.select("hub", "node").distinct(), texts)
    judged = starred.join(compared.hint("merge"), ["hub", "node"]).select("bucket", "node", "hub", (F.col("similarity") >= threshold).alias("linked"))
    judged = written(judged, "near-judged")
    sure = judged.where("linked").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    return sure.unionByName(_beyond_hubs(judged, texts, threshold))


def _beyond_hubs(judged: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Links of the nodes that their bucket's hub did not take, to others of the bucket.

    Buckets of the same nodes are looked at once. A bucket is cut into chunks, and each two of them
    are a block for one task, which returns no pairs but a forest of the links it finds.
    """
    stats = (
        judged.groupBy("bucket")
        .agg(
            F.count("*").alias("n"),
            F.count_if(~F.col("linked")).alias("open"),
            *(F.sum(F.xxhash64("node", F.lit(salt)).cast("decimal(38,0)")).alias(f"s{salt}") for salt in (1, 2)),
        )
        .where("n > 1 and open > 0")
    )
    once = stats.groupBy("n", "open", "s1", "s2").agg(F.min("bucket").alias("bucket")).withColumn("chunks", F.ceil(F.col("n") / CHUNK).cast("int"))
    dealt = judged.join(once.select("bucket", "chunks").hint("merge"), "bucket").withColumn("chunk", F.pmod(F.xxhash64("node"), "chunks").cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other")
    blocks = dealt.select("bucket", "node", "linked", "chunk", other).select(
        "bucket", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"), "chunk", "node", "linked"
    )
    rows = blocks.join(texts.hint("merge"), "node")
    return written(rows.groupBy("bucket", "low", "high").applyInArrow(_forest(threshold), "a long, b long"), "near-beyond")


#: Columns of shingles multiplied at a time.
COLUMNS = 4096


def _overlaps(rows: np.ndarray, shingles: np.ndarray, counts: np.ndarray, n: int, split: int) -> np.ndarray:
    """Multiset overlaps of the first ``split`` rows with the others (with ``split`` 0, of all with all).

    A shingle of count c is c columns of ones, so that products of columns add up to the smaller count.
    """
    turn = ranges(np.zeros(len(counts), np.int64), counts)
    of = np.repeat(np.arange(len(counts)), counts)
    row = rows[of]
    _, column, held = np.unique(mix(shingles[of] + turn.astype(np.uint64) * MIX_A), return_inverse=True, return_counts=True)
    keep = held[column] > 1
    _, column = np.unique(column[keep], return_inverse=True)
    row = row[keep]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    a, b = (slice(0, split), slice(split, n)) if split else (slice(0, n), slice(0, n))
    total = np.zeros((a.stop - a.start, b.stop - b.start), np.float32)
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        low, high = np.searchsorted(column, [first, first + COLUMNS])
        ones = np.zeros((n, COLUMNS), np.float32)
        ones[row[low:high], column[low:high] - first] = 1
        total += ones[a] @ ones[b].T
    return total


def _forest(threshold: float):
    def forest(table: pa.Table) -> pa.Table:
        table = table.sort_by([("chunk", "ascending"), ("node", "ascending")])
        n = len(table)
        nodes = table.column("node").to_numpy()
        linked = table.column("linked").to_numpy()
        chunk = table.column("chunk").to_numpy()
        crossing = table.column("low")[0].as_py() != table.column("high")[0].as_py()
        split = int(np.searchsorted(chunk, chunk[0], "right")) if crossing else 0
        out: list[tuple[int, int]] = []
        if not crossing or split < n:
            parts, first = [], 0
            for batch in table.select(["text"]).to_batches():
                for part in slices_by_bytes(batch, "text", 1 << 20):
                    rows, shingles, counts = bags(part.column("text"))
                    parts.append((rows + first, shingles, counts))
                    first += len(part)
            rows, shingles, counts = (np.concatenate(x) for x in zip(*parts))
            weight = np.bincount(rows, weights=counts, minlength=n)
            shared = _overlaps(rows, shingles, counts, n, split)
            a, b = (np.arange(split), np.arange(split, n)) if split else (np.arange(n), np.arange(n))
            similar = shared >= threshold * (weight[a][:, None] + weight[b][None, :] - shared) - 1e-6
            # What the hub took is connected through it already.
            similar &= ~(linked[a][:, None] & linked[b][None, :])
            parent = list(range(n))

            def root(x: int) -> int:
                while parent[x] != x:
                    parent[x] = parent[parent[x]]
                    x = parent[x]
                return x

            for i, j in zip(*np.nonzero(similar)):
                x, y = int(a[i]), int(b[j])
                if x != y and root(x) != root(y):
                    parent[root(x)] = root(y)
                    out.append((int(nodes[x]), int(nodes[y])))
        return pa.table([pa.array([o[k] for o in out], pa.int64()) for k in range(2)], ["a", "b"])

    return forest


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, text_key, class_id (the smallest doc_id of the class), class_size, kept."""
    chosen = docs.select("doc_id", "text")
    keyed = chosen.withColumn("text_key", F.xxhash64("text"))
    id_type = chosen.schema["doc_id"].dataType.simpleString()
    shape = f"doc_id {id_type}, text_key long, size long, bag_a long, bag_b long, bands array<long>"
    signed = written(keyed.mapInArrow(_sign, shape).withColumn("row", F.monotonically_increasing_id()), "near-signed")
    first = F.struct("doc_id", "row", "text_key")
    bag = ["bag_a", "bag_b", "size"]
    nodes = signed.where("size > 0").groupBy(*bag).agg(F.min_by(F.struct("row", "doc_id", "text_key", "bands"), first).alias("f"))
    nodes = written(nodes.select(*bag, F.col("f.row").alias("node"), "f.doc_id", "f.text_key", "f.bands"), "near-nodes")
    links = written(_links(nodes, chosen, threshold), "near-all-links")
    labels = components(links)
    named = nodes.select(*bag, "node").join(labels.hint("merge"), "node", "left").select(*bag, F.coalesce("label", "node").alias("label"))
    members = written(
        signed.select("doc_id", "text_key", "row", *bag)
        .join(named.hint("merge"), bag, "left")
        .select("doc_id", "text_key", "row", F.coalesce("label", F.col("row")).alias("label")),
        "near-members",
    )
    # Written, so that the join below may split a class that holds many rows.
    classes = written(members.groupBy("label").agg(F.min(F.struct("doc_id", "row")).alias("f"), F.count("*").alias("class_size")), "near-classes")
    return members.join(classes.hint("merge"), "label").select(
        "doc_id", "text_key", F.col("f.doc_id").alias("class_id"), "class_size", (F.col("row") == F.col("f.row")).alias("kept")
    )


def drop_near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with one document of each class."""
    judged = near_duplicates(docs, threshold).groupBy("doc_id", "text_key").agg(F.count_if("kept").alias("_near_stay"), F.count("*").alias("_near_n"))
    some = judged.where("_near_stay < _near_n").withColumnsRenamed({"doc_id": "_near_doc", "text_key": "_near_text"})
    some = written(some, "near-gone")
    same = F.col("doc_id").eqNullSafe(F.col("_near_doc")) & (F.col("_near_key") == F.col("_near_text"))
    keyed = docs.withColumn("_near_key", F.xxhash64("text"))
    kept = keyed.join(some, same, "left_anti").select(docs.columns)
    partly = some.where("_near_stay > 0")
    if partly.limit(1).count():
        # Rows equal in id and text, of which one stays.
        turn = F.row_number().over(Window.partitionBy("_near_doc", "_near_text").orderBy("_near_key"))
        kept = kept.unionByName(keyed.join(partly, same).withColumn("_near_turn", turn).where("_near_turn <= _near_stay").select(docs.columns))
    return kept
