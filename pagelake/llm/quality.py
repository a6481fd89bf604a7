"""Quality classifier: nearest-neighbour voting over latent-semantic vectors.

Terms are words and the byte pairs that hold a mark (so shouting, bars and junk are terms too),
hashed into ``SLOTS``; a word that follows itself is a term too. A bounded sample of labelled documents (about ``Settings.sample`` rows, those
with a hash of doc_id under a threshold) gives inverse document frequencies and, by a truncated
singular value decomposition, the projection to ``Settings.rank`` latent dimensions. Projection and
labelled vectors are broadcast: at most ``2 * sample * rank + SLOTS * rank`` numbers, whatever the
corpus. Every document's whole text is projected and compared with every labelled vector by exact
cosine products, a block of documents at a time; the ``neighbours`` nearest vote for their labels
with the ``sharpness``-th power of their similarity.

Defined results: null and empty texts have no direction and score the label's share in the sample;
so does everything when no row is labelled 1 or 0 (0.5 without any label); null labels are no
labels; a doc_id labelled twice votes twice; an empty table gives an empty result; other columns
are ignored whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelake.llm.shingles import ASCII_WORD, hashed_words
from pagelake.llm.textbits import bytes_of, slices_by_bytes

WORD_SLOTS, MARK_SLOTS, REPEAT_SLOTS = 6144, 2016, 32
SLOTS = WORD_SLOTS + MARK_SLOTS + REPEAT_SLOTS

#: Documents projected at a time.
BLOCK = 64


@dataclass(frozen=True)
class Settings:
    sample: int = 2500
    rank: int = 64
    neighbours: int = 25
    sharpness: float = 4.0
    seed: int = 11


@dataclass(frozen=True)
class Model:
    idf: np.ndarray
    projection: np.ndarray  # (SLOTS, rank)
    vectors: np.ndarray  # (labelled, rank), of length 1
    labels: np.ndarray
    share: float
    settings: Settings


def term_counts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, slot) of every term, in no particular order."""
    found = hashed_words(texts)
    word_rows = np.repeat(np.arange(len(texts)), np.diff(found.firsts))
    word_slots = (found.hashes >> np.uint64(20)) % np.uint64(WORD_SLOTS)
    # A repeated word; dealt over some slots, so that it weighs as much as a topic does.
    again = np.flatnonzero((found.hashes[1:] == found.hashes[:-1]) & (word_rows[1:] == word_rows[:-1]))
    repeat_slots = WORD_SLOTS + MARK_SLOTS + again % REPEAT_SLOTS
    data, offsets = bytes_of(texts)
    if len(data) > 1:
        upper = (data >= 65) & (data <= 90)
        mark = ~ASCII_WORD[data] & ~upper
        # Pairs with a mark, and pairs of capitals; a lone space between words says nothing.
        told = (mark[:-1] & mark[1:]) | (upper[:-1] & upper[1:]) | ((mark[:-1] | mark[1:]) & (data[:-1] != 32) & (data[1:] != 32))
        told[offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(data))] - 1] = False
        at = np.flatnonzero(told)
        shape = np.where(mark, data, np.where(upper, 65, 97)).astype(np.uint32)
        pair = (shape[at] << np.uint32(8)) | shape[at + 1]
        mark_slots = ((pair * np.uint32(2654435761)) >> np.uint32(16)) % np.uint32(MARK_SLOTS)
        mark_rows = np.searchsorted(offsets, at, "right") - 1
    else:
        mark_slots = mark_rows = np.zeros(0, np.int64)
    return (
        np.concatenate([word_rows, mark_rows, word_rows[again]]).astype(np.int64),
        np.concatenate([word_slots.astype(np.int64), mark_slots.astype(np.int64) + WORD_SLOTS, repeat_slots]),
    )


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """label, slots, counts of each sampled document."""
    for batch in batches:
        for part in slices_by_bytes(batch, "text", 1 << 20):
            rows, slots = term_counts(part.column("text"))
            keys, counts = np.unique(rows * SLOTS + slots, return_counts=True)
            cuts = np.searchsorted(keys, np.arange(len(part) + 1) * SLOTS)
            yield pa.record_batch(
                [
                    part.column("label"),
                    pa.array([(keys[a:b] % SLOTS).astype(np.uint16).tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()),
                    pa.array([counts[a:b].astype(np.uint32).tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()),
                ],
                ["label", "slots", "counts"],
            )


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


def learn(docs: DataFrame, labels: DataFrame, training: Column, *, label: str = "quality", settings: Settings = Settings()) -> Model:
    """Fit on a bounded sample of the labelled documents for which ``training`` (on doc_id) holds."""
    known = labels.where(training & F.col(label).isNotNull()).select("doc_id", F.col(label).cast("int").alias("label"))
    total = known.count()
    unit = F.pmod(F.xxhash64("doc_id", F.lit(settings.seed)), F.lit(1 << 30)) / (1 << 30)
    # Expected rows are settings.sample, so this side of the join stays small.
    chosen = known.where(unit < settings.sample / max(total, 1))
    rows = (
        docs.select("doc_id", "text")
        .join(F.broadcast(chosen), "doc_id")
        .select("label", "text")
        .mapInArrow(_features, "label int, slots binary, counts binary")
        .collect()
    )
    rank = settings.rank
    if not rows:
        return Model(np.ones(SLOTS, np.float32), np.zeros((SLOTS, rank), np.float32), np.zeros((1, rank), np.float32), np.array([0.5]), 0.5, settings)
    # In an order of their own: results don't hang on which task ends first.
    rows = sorted(rows, key=lambda r: (bytes(r["slots"]), bytes(r["counts"]), r["label"]))
    matrix = np.zeros((len(rows), SLOTS), np.float32)
    for i, r in enumerate(rows):
        matrix[i, np.frombuffer(r["slots"], np.uint16)] = np.log1p(np.frombuffer(r["counts"], np.uint32))
    idf = np.log((1 + len(rows)) / (1 + (matrix > 0).sum(0))).astype(np.float32) + 1
    matrix = _unit(matrix * idf).astype(np.float32)
    # Randomised range finder with two power steps, then an exact decomposition of the small rest.
    rng = np.random.default_rng(settings.seed)
    width = min(rank + 16, len(rows))
    basis = np.linalg.qr(matrix @ rng.standard_normal((SLOTS, width)).astype(np.float32))[0]
    for _ in range(2):
        basis = np.linalg.qr(matrix @ (matrix.T @ basis))[0]
    right = np.linalg.svd(basis.T @ matrix, full_matrices=False)[2][:rank]
    projection = np.zeros((SLOTS, rank), np.float32)
    projection[:, : len(right)] = right.T
    truth = np.array([r["label"] for r in rows], np.float64)
    return Model(idf, projection, _unit(matrix @ projection).astype(np.float32), truth, float(truth.mean()), settings)


def vote(model: Model, vectors: np.ndarray) -> np.ndarray:
    """The score of unit vectors: similarity-weighted labels of the nearest labelled ones."""
    near = vectors @ model.vectors.T
    k = min(model.settings.neighbours, near.shape[1])
    top = np.argpartition(-near, k - 1, axis=1)[:, :k]
    weight = np.maximum(np.take_along_axis(near, top, 1), 0).astype(np.float64) ** model.settings.sharpness
    total = weight.sum(1)
    return np.where(total > 0, (weight * model.labels[top]).sum(1) / np.maximum(total, 1e-300), model.share).clip(0, 1)


def _score(sent):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = sent.value
        scaled = model.projection * model.idf[:, None]
        for batch in batches:
            for part in slices_by_bytes(batch, "text", 1 << 20):
                rows, slots = term_counts(part.column("text"))
                order = np.argsort(rows, kind="stable")
                rows, slots = rows[order], slots[order]
                latent = np.zeros((len(part), model.settings.rank), np.float32)
                for start in range(0, len(part), BLOCK):
                    stop = min(start + BLOCK, len(part))
                    a, b = np.searchsorted(rows, [start, stop])
                    counts = np.bincount((rows[a:b] - start) * SLOTS + slots[a:b], minlength=(stop - start) * SLOTS)
                    latent[start:stop] = np.log1p(counts.astype(np.float32)).reshape(stop - start, SLOTS) @ scaled
                yield pa.record_batch([part.column("doc_id"), pa.array(vote(model, _unit(latent).astype(np.float32)))], ["doc_id", "score"])

    return score


def classify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score (0 to 1) and predicted (1 where the score is at least 0.5)."""
    chosen = docs.select("doc_id", "text")
    sent = docs.sparkSession.sparkContext.broadcast(model)
    scored = chosen.mapInArrow(_score(sent), f"doc_id {chosen.schema['doc_id'].dataType.simpleString()}, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
