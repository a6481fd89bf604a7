"""Language ID: script ranges, per-word scores, and Viterbi with a switching penalty.

Learning: byte-trigram counts per language over a bounded sample of labelled documents (about
``Settings.sample_a_language`` for each language, those with a hash of doc_id under a threshold),
whose whole texts are counted by Spark tasks. A word's score in a language is the sum of the log
probabilities of its trigrams, spaces around it included.

Words are runs of letters and the marks on them; everything else, within ASCII or beyond, parts them.

Prediction, for every word of the whole text: the script range of its first letter says which
languages are candidates (those that use the script in at least ``script_share`` of their sample
words; every learned language for a script that none uses or that is not listed); then the best path through the words, where changing the language costs ``switch``, labels
spans of mixed-language text. All documents of a batch take each step together, so no word is
visited by the interpreter on its own. The language with the most bytes under the path is the
document's; the score is its share of them.

Defined results: null texts and texts without a letter are ``und`` with score 0; ties go to the
alphabetically first language; every text with a letter gets a learned language; without any training row everything is ``und``; languages are the
non-null ``lang`` values of the training rows, whatever they are; an empty table gives an empty
result; columns beyond doc_id, text and lang are ignored or passed on, and names that begin with
``_lang_`` are the operator's own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelake.llm.textbits import bytes_of, ranges, slices_by_bytes

#: Slots of the hashed trigram table of a language.
SLOTS = 1 << 16

#: First bytes of UTF-8 sequences by script. Fixed values; a lead byte shared by scripts is decided by its second byte below.
SCRIPTS = ("other", "latin", "greek", "cyrillic", "armenian", "hebrew", "arabic", "indic", "thai", "kana", "han", "hangul")


@dataclass(frozen=True)
class Settings:
    sample_a_language: int = 1500
    switch: float = 12.0
    script_share: float = 0.01
    smoothing: float = 0.5


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    #: (SLOTS, languages) log probabilities
    scores: np.ndarray
    #: (scripts, languages) whether words of the script may be in the language
    candidates: np.ndarray


def _script_tables() -> tuple[np.ndarray, np.ndarray]:
    lead = np.zeros(256, np.int8)
    lead[ord("a") : ord("z") + 1] = 1
    lead[0xC3:0xCA] = 1
    lead[0xCE:0xD0] = 2
    lead[0xD0:0xD4] = 3
    lead[0xD4:0xD6] = 4
    lead[0xD6:0xD8] = 5
    lead[0xD8:0xDC] = 6
    lead[0xE4:0xEA] = 10
    lead[0xEA:0xEE] = 11
    second = np.zeros((256, 256), np.int8)
    second[0xE0, 0xA4:0xB8] = 7
    second[0xE0, 0xB8:0xBC] = 8
    second[0xE1, 0xB8:0xBC] = 1
    second[0xE1, 0xBC:0xC0] = 2
    second[0xE3, 0x81:0x84] = 9
    second[0xE3, 0x90:0xC0] = 10
    return lead, second


LEAD, SECOND = _script_tables()

#: What parts words beyond ASCII: other characters than letters and marks, and marks that follow no letter.
NO_WORD = r"(?:^|[\x00-@\[-`{-\x7F])\p{M}[^\x00-\x7F\p{L}]*|[^\x00-\x7F\p{L}\p{M}][^\x00-\x7F\p{L}]*"

#: Bytes that make up words where ``NO_WORD`` is out: lower-case letters and everything beyond ASCII.
IN_WORD = np.zeros(256, bool)
IN_WORD[ord("a") : ord("z") + 1] = True
IN_WORD[0x80:] = True


@dataclass
class Words:
    """The words of a batch: where they are, which row they belong to, and their scripts."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    rows: np.ndarray
    scripts: np.ndarray


def words_of(texts: pa.Array) -> Words:
    lowered = pc.utf8_lower(pc.fill_null(texts, ""))
    data, offsets = bytes_of(pc.replace_substring_regex(lowered, NO_WORD, " "))
    # A space after every row, so that no word or trigram runs over into the next.
    n, rows = len(data), len(offsets) - 1
    spaced = np.full(n + rows + 1, 32, np.uint8)
    row_of_byte = np.repeat(np.arange(rows, dtype=np.int64), np.diff(offsets))
    spaced[np.arange(n) + row_of_byte + 1] = data
    inside = IN_WORD[spaced]
    spaced[~inside] = 32
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    starts, ends = edge[::2], edge[1::2]
    first, second = spaced[starts], spaced[np.minimum(starts + 1, len(spaced) - 1)]
    scripts = np.where(LEAD[first] > 0, LEAD[first], SECOND[first, second])
    row_starts = offsets[:-1] + np.arange(rows) + 1
    return Words(spaced, starts, ends, np.searchsorted(row_starts, starts, "right") - 1, scripts)


def _slots(data: np.ndarray) -> np.ndarray:
    """The table slot of the trigram that begins at each byte."""
    wide = data.astype(np.uint32)
    key = (wide[:-2] << np.uint32(16)) | (wide[1:-1] << np.uint32(8)) | wide[2:]
    return ((key * np.uint32(2654435761)) >> np.uint32(16)).astype(np.int32)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Trigram and script counts of each language in a partition, as one small row each."""
    grams: dict[str, np.ndarray] = {}
    scripts: dict[str, np.ndarray] = {}
    for batch in batches:
        for part in slices_by_bytes(batch, "text", 1 << 20):
            words = words_of(part.column("text"))
            if not len(words.starts):
                continue
            languages = part.column("lang").dictionary_encode()
            codes = languages.indices.to_numpy(zero_copy_only=False)[words.rows]
            slots = _slots(words.data)
            # Each word with the space before it and the one after it.
            sizes = words.ends - words.starts
            at = ranges(words.starts - 1, sizes)
            by_byte = np.repeat(codes, sizes)
            for code, name in enumerate(languages.dictionary.to_pylist()):
                grams[name] = grams.get(name, 0) + np.bincount(slots[at[by_byte == code]], minlength=SLOTS)
                scripts[name] = scripts.get(name, 0) + np.bincount(words.scripts[codes == code], minlength=len(SCRIPTS))
    names = list(grams)
    yield pa.record_batch(
        [
            pa.array(names, pa.string()),
            pa.array([grams[n].astype(np.int64).tobytes() for n in names], pa.binary()),
            pa.array([scripts[n].astype(np.int64).tobytes() for n in names], pa.binary()),
        ],
        ["lang", "grams", "scripts"],
    )


def _add_up(table: pa.Table) -> pa.Table:
    total = {c: sum(np.frombuffer(v, np.int64) for v in table.column(c).to_pylist()).tobytes() for c in ("grams", "scripts")}
    return pa.table({"lang": table.column("lang")[:1].cast(pa.string()), "grams": pa.array([total["grams"]], pa.binary()), "scripts": pa.array([total["scripts"]], pa.binary())})


def learn(docs: DataFrame, training: Column, settings: Settings = Settings()) -> Model:
    """Fit on a bounded sample of the labelled rows for which ``training`` holds."""
    known = docs.where(training & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = known.groupBy("lang").agg(F.count("*").alias("n")).collect()
    if not counts:
        return Model((), np.zeros((SLOTS, 0), np.float32), np.zeros((len(SCRIPTS), 0), bool))
    unit = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / (1 << 30)
    share = F.lit(1.0)
    for r in counts:
        share = F.when(F.col("lang") == r["lang"], settings.sample_a_language / r["n"]).otherwise(share)
    wide = "lang string, grams binary, scripts binary"
    per_task = known.where(unit < share).select("lang", "text").mapInArrow(_count, wide)
    summed = {r["lang"]: r for r in per_task.groupBy("lang").applyInArrow(_add_up, wide).collect()}
    languages = tuple(sorted(summed))
    grams = np.stack([np.frombuffer(summed[x]["grams"], np.int64) for x in languages], 1).astype(np.float64)
    scripts = np.stack([np.frombuffer(summed[x]["scripts"], np.int64) for x in languages], 1).astype(np.float64)
    scores = np.log(grams + settings.smoothing) - np.log(grams.sum(0) + settings.smoothing * SLOTS)
    candidates = scripts >= settings.script_share * np.maximum(scripts.sum(0), 1)
    # Unlisted scripts, and those that no language uses: all languages compete by score.
    candidates[0] = True
    candidates[~candidates.any(1)] = True
    return Model(languages, scores.astype(np.float32), candidates)


def word_scores(model: Model, words: Words) -> np.ndarray:
    """(words, languages) scores; languages that are no candidates for a word's script get a floor."""
    n = len(model.languages)
    out = np.zeros((len(words.starts), n), np.float32)
    if not len(words.starts):
        return out
    slots = _slots(words.data)
    for k in range(n):
        sums = np.concatenate([[0.0], np.cumsum(model.scores[:, k][slots], dtype=np.float64)])
        out[:, k] = sums[words.ends - 1] - sums[words.starts - 1]
    allowed = model.candidates[words.scripts]
    floor = 20.0 * (words.ends - words.starts)
    out -= np.where(allowed, 0.0, floor[:, None]).astype(np.float32)
    return out


def best_paths(scores: np.ndarray, rows: np.ndarray, switch: float) -> np.ndarray:
    """The language of each word on the best path of its row; ``rows`` is ascending."""
    n, k = scores.shape
    if not n or not k:
        return np.zeros(n, np.int64)
    firsts = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
    lengths = np.diff(np.r_[firsts, n])
    # Longest rows first: at each step, those still going are a prefix.
    order = np.argsort(-lengths, kind="stable")
    firsts, lengths = firsts[order], lengths[order]
    going = len(lengths) - np.searchsorted(lengths[::-1], np.arange(lengths[0]), "right")
    best = scores[firsts].astype(np.float64)
    came_from = np.zeros(n, np.int32)  # the best language of the word before
    stays = np.ones((n, k), bool)
    for t in range(1, int(lengths[0])):
        m = going[t]
        before = best[:m]
        top = before.argmax(1)
        change = before[np.arange(m), top] - switch
        stay = before >= change[:, None]
        at = firsts[:m] + t
        came_from[at], stays[at] = top, stay
        best[:m] = np.where(stay, before, change[:, None]) + scores[at]
    path = np.zeros(n, np.int64)
    state = best.argmax(1)
    for t in range(int(lengths[0]) - 1, -1, -1):
        m = going[t]
        at = firsts[:m] + t
        path[at] = state[:m]
        if t:
            state[:m] = np.where(stays[at, state[:m]], state[:m], came_from[at])
    return path


def spans_of(words: Words, path: np.ndarray, languages: tuple[str, ...]) -> list[list[tuple[int, str]]]:
    """For each row that has words, (number of words, language) of each run of one language."""
    if not len(path):
        return []
    cut = np.flatnonzero(np.r_[True, (path[1:] != path[:-1]) | (words.rows[1:] != words.rows[:-1])])
    sizes = np.diff(np.r_[cut, len(path)])
    out: dict[int, list[tuple[int, str]]] = {}
    for at, size in zip(cut, sizes, strict=True):
        out.setdefault(int(words.rows[at]), []).append((int(size), languages[path[at]]))
    return [out[r] for r in sorted(out)]


#: Text bytes that take the steps together, for eight languages and fewer the more there are; and the least.
BATCH_BYTES, LEAST_BYTES = 3 << 19, 1 << 18
#: Bytes of a model that is sent to the tasks: some thousand languages.
MODEL_BYTES = 1 << 30


def _batch_bytes(model: Model) -> int:
    return max(LEAST_BYTES, BATCH_BYTES * 8 // max(8, len(model.languages)))


def _sent(docs: DataFrame, model: Model):
    """The model as a broadcast, of measured size."""
    size = model.scores.nbytes + model.candidates.nbytes
    if size > MODEL_BYTES:
        raise ValueError(f"a model of {len(model.languages)} languages has {size} bytes, more than {MODEL_BYTES}")
    return docs.sparkSession.sparkContext.broadcast(model)


def _predict(sent, settings: Settings):
    columns = ["_lang_pred", "_lang_score", "_lang_spans", "_lang_count"]

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        names = np.array([*model.languages, "und"], dtype=object)
        k = len(model.languages)
        for batch in batches:
            for part in slices_by_bytes(batch, "text", _batch_bytes(model)):
                words = words_of(part.column("text"))
                path = best_paths(word_scores(model, words), words.rows, settings.switch)
                share = np.zeros((len(part), max(k, 1)))
                np.add.at(share, (words.rows, path), words.ends - words.starts if k else 0)
                total = share.sum(1)
                label = np.where((total > 0) & (k > 0), share.argmax(1), k)
                score = np.where(total > 0, share.max(1) / np.maximum(total, 1), 0.0)
                cut = np.flatnonzero(np.r_[True, (path[1:] != path[:-1]) | (words.rows[1:] != words.rows[:-1])]) if len(path) else []
                n_spans = np.bincount(words.rows[cut], minlength=len(part))
                rest = [c for c in part.schema.names if c not in columns]
                yield pa.record_batch(
                    [
                        *(part.column(c) for c in rest),
                        pa.array(names[label], pa.string()),
                        pa.array(score, pa.float64()),
                        pa.array(n_spans, pa.int64()),
                        pa.array((share > 0).sum(1), pa.int64()),
                    ],
                    [*rest, *columns],
                )

    return predict


def labelled(docs: DataFrame, model: Model, settings: Settings = Settings()) -> DataFrame:
    """``docs`` with _lang_pred, _lang_score, _lang_spans and _lang_count."""
    has_letter = F.coalesce(F.col("text"), F.lit("")).rlike(r"\p{L}")
    chosen = docs.withColumn("_lang_letter", has_letter)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields)
    added = "_lang_pred string, _lang_score double, _lang_spans long, _lang_count long"
    found = chosen.mapInArrow(_predict(_sent(docs, model), settings), f"{fields}, {added}")
    return found.withColumns(
        {
            "_lang_pred": F.when(F.col("_lang_letter"), F.col("_lang_pred")).otherwise("und"),
            "_lang_score": F.when(F.col("_lang_letter"), F.col("_lang_score")).otherwise(0.0),
        }
    ).drop("_lang_letter")


def identify(docs: DataFrame, model: Model, settings: Settings = Settings()) -> DataFrame:
    """doc_id, lang_pred, score, n_spans (runs of one language), languages (that any word got)."""
    shown = {"_lang_pred": "lang_pred", "_lang_score": "score", "_lang_spans": "n_spans", "_lang_count": "languages"}
    return labelled(docs.select("doc_id", "text"), model, settings).drop("text").withColumnsRenamed(shown)


def _label_spans(sent, settings: Settings):
    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        shape = pa.list_(pa.struct([("first_word", pa.int64()), ("n_words", pa.int64()), ("lang", pa.string())]))
        for batch in batches:
            for part in slices_by_bytes(batch, "text", _batch_bytes(model)):
                words = words_of(part.column("text"))
                found: list[list[dict]] = [[] for _ in range(len(part))]
                if model.languages and len(words.rows):
                    path = best_paths(word_scores(model, words), words.rows, settings.switch)
                    for row, spans in zip(np.unique(words.rows).tolist(), spans_of(words, path, model.languages), strict=True):
                        first = 0
                        for size, lang in spans:
                            found[row].append({"first_word": first, "n_words": size, "lang": lang})
                            first += size
                yield pa.record_batch([part.column("doc_id"), pa.array(found, shape)], ["doc_id", "spans"])

    return label


def language_spans(docs: DataFrame, model: Model, settings: Settings = Settings()) -> DataFrame:
    """doc_id, spans: the labelled stretches of each text as structs of first_word (from 0), n_words and lang."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    shape = f"doc_id {kind}, spans array<struct<first_word: long, n_words: long, lang: string>>"
    return docs.select("doc_id", "text").mapInArrow(_label_spans(_sent(docs, model), settings), shape)


def in_a_language(docs: DataFrame, model: Model, settings: Settings = Settings()) -> DataFrame:
    """``docs`` without those of no learned language (``und``)."""
    return labelled(docs, model, settings).where("_lang_pred <> 'und'").select(docs.columns)


def held_out(doc_id: Column, folds: int = 5, fold: int = 0) -> Column:
    """Rows that are kept from learning: the CRC-32 of the id's decimal text, modulo ``folds``."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))
