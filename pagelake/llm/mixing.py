"""Mixing sources to target weights by iterative proportional fitting.

Token counts are added up by source, language and topic. Raking scales the cells of that table in
turn to the wanted marginal of each attribute until all three hold; the result is a weight for each
cell. Cells that targets leave nothing for would only shrink by 1 / n in n rounds: whenever the rounds
have doubled, those that shrank with them are tried at nothing, and stay so if all marginals then hold. Where the
targets contradict each other the weights settle short of them: raking ends when a round changes nothing any more, or
after ``rounds`` (``job_rounds`` where each is a job); ``gap`` says how far off it is, and a warning is given.

A document is then kept with probability ``budget * weight``, at most 1; the factor is chosen so that
the expected tokens come to ``share`` of all. The draw is a hash of the doc_id, so a rerun keeps the
same documents.

Target marginals default to the present ones raised to ``power`` and scaled to 1, which lifts small
sources, languages and topics against large ones. The table has a row for each combination that
occurs. Up to ``CELLS_A_TASK`` combinations are raked by one task, however many rounds that takes; more
stay in Spark tables, where each raking step is a sum by one attribute, joined back, and each round is
one job that cuts lineage by writing.

Topic, where no column names one, is the kind of matter a text is by its make-up (``TOPICS``).
Tokens are counted as the spaces and line breaks of a text and one more.

Defined results: a null source, language or topic is a category of its own, shown as ``unknown`` but not
mixed with a value of that name (targets name it by None); null and empty texts have no tokens, get
probability 1 and weight 1 and are kept, since they cost nothing; a null
doc_id is drawn as 0; repeated rows are drawn alike; an empty table gives an empty result.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from pagelake.llm.stage import written

#: Kinds of matter, the first that holds: many bars, few bytes, many lines, the rest.
TOPICS = ("table", "note", "list", "prose")

ATTRIBUTES = ("source", "lang", "topic")

#: Combinations that one task rakes.
CELLS_A_TASK = 1_000_000


@dataclass(frozen=True)
class Targets:
    power: float = 0.5
    share: float = 0.5
    #: Raking ends when no marginal is further than this from its target, as a share of all.
    tolerance: float = 1e-6
    #: Or when a round moves no cell by more than this share of all: the targets contradict each other.
    stalled: float = 1e-12
    #: Or after so many rounds, in one task and as jobs.
    rounds: int = 20_000
    job_rounds: int = 200
    #: Wanted shares by attribute and value in place of the default, e.g. {"lang": {"en": 0.5, "de": 0.5}}.
    given: dict[str, dict[str | None, float]] | None = None


def _times(text: Column, what: str) -> Column:
    """How often a character occurs."""
    return F.octet_length(text) - F.octet_length(F.replace(text, F.lit(what), F.lit("")))


def n_tokens(text: Column) -> Column:
    held = F.octet_length(text) > 0
    return F.when(held, _times(text, " ") + _times(text, "\n") + 1).otherwise(0).cast("long")


def topic_of(text: Column) -> Column:
    size = F.octet_length(text)
    return (
        F.when(_times(text, "|") * 20 > size, "table")
        .when(size < 300, "note")
        .when(_times(text, "\n") * 80 > size, "list")
        .otherwise("prose")
    )


def _named(value: Column) -> Column:
    """A category's name inside: null is told from every text."""
    return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit(""))


def _shown(name: str) -> Column:
    """The category as given, null as ``unknown``."""
    return F.when(F.col(name) == "", F.lit("unknown")).otherwise(F.substring(name, 2, 1 << 30))


def described(docs: DataFrame, topic: str | None = None) -> DataFrame:
    """``docs`` with _source, _lang, _topic (categories by their inside names) and _tokens."""
    text = F.coalesce(F.col("text"), F.lit(""))
    subject = _named(topic_of(text) if topic is None else F.col(topic))
    return docs.withColumns(
        {
            "_source": _named(F.col("source")),
            "_lang": _named(F.col("lang")),
            "_topic": subject,
            "_tokens": n_tokens(text),
        }
    )


def _targets(cells: DataFrame, attribute: str, targets: Targets) -> DataFrame:
    """(attribute, want): the wanted share of each value that occurs, 1 in all."""
    present = cells.groupBy(attribute).agg(F.sum("tokens").alias("have"))
    given = (targets.given or {}).get(attribute)
    if given is None:
        raw = present.withColumn("raw", F.pow("have", F.lit(targets.power)))
    else:
        asked = cells.sparkSession.createDataFrame(list(given.items()), f"{attribute} string, raw double")
        raw = present.join(F.broadcast(asked), attribute, "left").na.fill(0.0, ["raw"])
    total = raw.agg(F.sum("raw").alias("all")).first()["all"] or 1.0
    return raw.select(attribute, (F.col("raw") / total).alias("want"))


def _fitted(cells: DataFrame, attribute: str, wanted: DataFrame) -> DataFrame:
    """One raking step: every value of the attribute gets its wanted share. ``gap`` keeps the largest distance met so far."""
    held = cells.groupBy(attribute).agg(F.sum("mass").alias("held")).join(wanted, attribute)
    factor = F.when(F.col("held") > 0, F.col("want") / F.col("held")).otherwise(0.0)
    step = held.select(attribute, factor.alias("factor"), F.abs(F.col("held") - F.col("want")).alias("off"))
    return cells.join(step, attribute).select(
        *ATTRIBUTES, "tokens", "before", (F.col("mass") * F.col("factor")).alias("mass"), F.greatest("gap", "off").alias("gap")
    )


def _rake_rounds(current: DataFrame, wanted: dict[str, DataFrame], targets: Targets) -> DataFrame:
    """The cells with their fitted mass and gap, one job a round."""
    for done in range(1, targets.job_rounds + 1):
        current = current.withColumns({"before": F.col("mass"), "gap": F.lit(0.0)})
        for a in ATTRIBUTES:
            current = _fitted(current, a, wanted[a])
        # Both are noted while the round is written.
        watch = Observation()
        noted = current.observe(watch, F.max("gap").alias("gap"), F.max(F.abs(F.col("mass") - F.col("before"))).alias("moved"))
        current = written(noted, "mixing-round").drop("before", "gap")
        gap, moved = watch.get["gap"] or 0.0, watch.get["moved"] or 0.0
        if gap <= targets.tolerance or moved <= targets.stalled or done == targets.job_rounds:
            break
    return current.withColumn("gap", F.lit(gap))


#: A cell that lost this share of its mass while the rounds doubled is on its way to nothing.
SHRUNK = 0.7


def raked(codes: list[np.ndarray], wants: list[np.ndarray], mass: np.ndarray, targets: Targets) -> tuple[np.ndarray, float]:
    """The fitted mass of the cells, and how far a marginal is from its target."""

    def one_round(mass: np.ndarray) -> tuple[np.ndarray, float]:
        gap = 0.0
        for code, want in zip(codes, wants, strict=True):
            held = np.bincount(code, mass, len(want))
            gap = max(gap, float(np.abs(held - want).max()))
            mass = mass * np.divide(want, held, out=np.zeros_like(want), where=held > 0)[code]
        return mass, gap

    gap, done, marked, mark = 0.0, 0, 32, mass
    while done < targets.rounds:
        before = mass
        mass, gap = one_round(mass)
        done += 1
        if gap <= targets.tolerance or np.abs(mass - before).max() <= targets.stalled:
            break
        if done == marked:
            shrinking = (mass > 0) & (mass < SHRUNK * mark)
            mark, marked = mass, 2 * marked
            if shrinking.any():
                tried, off = np.where(shrinking, 0.0, mass), 1.0
                for _ in range(min(done, targets.rounds - done)):
                    tried, off = one_round(tried)
                    done += 1
                    if off <= targets.tolerance:
                        return tried, off
                # What the trial cost counts, but not as rounds of the mass.
                marked = max(marked, 2 * done)
    return mass, gap


def _rake_task(targets: Targets):
    """The same in one task, over rows with the wanted share of each of their values."""

    def rake_all(table: pa.Table) -> pa.Table:
        codes = [table.column(a).combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False) for a in ATTRIBUTES]
        wants = []
        for a, code in zip(ATTRIBUTES, codes, strict=True):
            want = np.zeros(code.max() + 1)
            want[code] = table.column(f"want_{a}").to_numpy()
            wants.append(want)
        mass, gap = raked(codes, wants, table.column("mass").to_numpy().copy(), targets)
        kept = table.select([*ATTRIBUTES, "tokens"])
        return kept.append_column("mass", pa.array(mass)).append_column("gap", pa.array(np.full(len(mass), gap)))

    return rake_all


def rake(cells: DataFrame, targets: Targets = Targets()) -> DataFrame:
    """source, lang, topic, tokens, weight, gap of each cell, from rows with its tokens.

    Weights average 1 over the tokens; the gap, one for all, is how far the last round found a marginal from its target.
    """
    cells = written(cells.where("tokens > 0").withColumn("tokens", F.col("tokens").cast("double")), "mixing-cells")
    wanted = {a: written(_targets(cells, a, targets), f"mixing-{a}") for a in ATTRIBUTES}
    size = cells.agg(F.count("*").alias("n"), F.coalesce(F.sum("tokens"), F.lit(0.0)).alias("t")).first()
    total = size["t"]
    current = cells.withColumn("mass", F.col("tokens") / (total or 1.0))
    if size["n"] <= CELLS_A_TASK:
        for a in ATTRIBUTES:
            current = current.join(wanted[a].withColumnRenamed("want", f"want_{a}"), a)
        shape = ", ".join(f"{a} string" for a in ATTRIBUTES) + ", tokens double, mass double, gap double"
        current = written(current.groupBy().applyInArrow(_rake_task(targets), shape), "mixing-raked")
    else:
        current = _rake_rounds(current, wanted, targets)
    gap = current.agg(F.max("gap").alias("gap")).first()["gap"] or 0.0
    if gap > targets.tolerance:
        warnings.warn(f"mixing targets contradict each other: a marginal is {gap:.3g} of all tokens off", stacklevel=2)
    return current.select(*ATTRIBUTES, "tokens", (F.col("mass") * total / F.col("tokens")).alias("weight"), "gap")


#: Factors tried in one pass, and passes; each narrows the bounds to one step of the last.
GRID, PASSES = 64, 4


def budget_factor(cells: DataFrame, share: float) -> float:
    """The factor at which documents kept with min(1, factor * weight) are expected to hold ``share`` of the tokens."""
    ends = cells.where("weight > 0").agg(F.min("weight").alias("least"), F.max("weight").alias("most"), F.sum("tokens").alias("t")).first()
    if not ends["t"]:
        return 0.0
    low, high = share * 0.5 / ends["most"], 1.0 / ends["least"]
    for _ in range(PASSES):
        tried = [low * (high / low) ** (k / GRID) for k in range(GRID + 1)]
        sums = cells.agg(*[F.sum(F.col("tokens") * F.least(F.lit(1.0), F.col("weight") * f)).alias(f"s{k}") for k, f in enumerate(tried)]).first()
        reached = next((k for k in range(GRID + 1) if sums[f"s{k}"] >= share * ends["t"]), GRID)
        low, high = tried[max(reached - 1, 0)], tried[reached]
    return high


def _drawn(told: DataFrame, targets: Targets) -> DataFrame:
    """Rows with source, lang, topic and n_tokens, and weight, probability, gap and sampled added."""
    if targets.given:
        inside = {a: {"" if v is None else f"={v}": share for v, share in given.items()} for a, given in targets.given.items()}
        targets = replace(targets, given=inside)
    counted = told.groupBy(*(f"_{a}" for a in ATTRIBUTES)).agg(F.sum("_tokens").alias("tokens"))
    weights = written(rake(counted.withColumnsRenamed({f"_{a}": a for a in ATTRIBUTES}), targets), "mixing-weights")
    factor = budget_factor(weights, targets.share)
    # As many rows as combinations of the three attributes occur; Spark broadcasts it only below its size limit.
    chances = weights.select(
        *(F.col(a).alias(f"_{a}") for a in ATTRIBUTES),
        F.col("weight").alias("_weight"),
        F.col("gap").alias("_gap"),
        F.least(F.lit(1.0), F.col("weight") * factor).alias("_probability"),
    )
    drawn = F.pmod(F.xxhash64(F.coalesce(F.col("doc_id").cast("long"), F.lit(0)), F.lit("mixing")), F.lit(1 << 53)) / float(1 << 53)
    return (
        told.join(chances, [f"_{a}" for a in ATTRIBUTES], "left")
        .na.fill(1.0, ["_weight", "_probability"])
        .na.fill(0.0, ["_gap"])
        # What has no tokens costs nothing, whatever the other documents of its cell weigh.
        .withColumns({c: F.when(F.col("_tokens") == 0, F.lit(1.0)).otherwise(F.col(c)) for c in ("_weight", "_probability")})
        .withColumn("_sampled", drawn < F.col("_probability"))
    )


def mixing_weights(docs: DataFrame, targets: Targets = Targets(), topic: str | None = None) -> DataFrame:
    """One row per document: doc_id, source, lang, topic, n_tokens, weight, probability, gap, sampled."""
    needed = list(dict.fromkeys(["doc_id", "source", "lang", *([topic] if topic else []), "text"]))
    told = described(docs.select(*needed), topic)
    told = written(told.select("doc_id", *(f"_{a}" for a in ATTRIBUTES), "_tokens"), "mixing-documents")
    shown = {f"_{a}": a for a in ATTRIBUTES} | {"_tokens": "n_tokens", "_weight": "weight", "_probability": "probability", "_gap": "gap", "_sampled": "sampled"}
    drawn = _drawn(told, targets).withColumns({f"_{a}": _shown(f"_{a}") for a in ATTRIBUTES})
    return drawn.withColumnsRenamed(shown).select("doc_id", *shown.values())


def mixed(docs: DataFrame, targets: Targets = Targets(), topic: str | None = None) -> DataFrame:
    """The sampled documents with all their columns, and mix_weight and mix_probability."""
    kept = _drawn(described(docs, topic), targets).where("_sampled")
    return kept.select(*docs.columns, F.col("_weight").alias("mix_weight"), F.col("_probability").alias("mix_probability"))
