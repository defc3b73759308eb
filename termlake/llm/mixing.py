"""Mixing to target weights: raking of token mass, then sampling by calibrated probabilities.

Token mass is summed by cell (source, lang, topic). Iterative proportional
fitting scales the cells until the masses of every source, language and topic
have their target shares. Dividing by a cell's own mass gives the weight of its
tokens; the probability of its documents is that weight times one factor, cut
at 1, with the factor set so that the expected tokens meet the budget.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import broadcast_if_small, measure, stage

MARGINS = ("source", "lang", "topic")
TOPICS = 8
ROUNDS = 15  # rounds of the three margins
CALIBRATION = 40  # halvings of the interval of the factor
# Cells are keys, not documents; a table measured to be smaller is one batch on the driver.
LOCAL_CELLS = 100_000
TOKEN = r"[^ \t\n\x0B\f\r]+"
SPACE = r"[ \t\n\x0B\f\r]+"


def _words(text: Column) -> Column:
    """Runs between ASCII white space, perhaps an empty one at either end; null and empty: one empty word."""
    return F.split(F.coalesce(text, F.lit("")), SPACE)


def _count(words: Column) -> Column:
    """Words that are not empty."""
    return F.size(F.filter(words, lambda w: w != "")).cast("bigint")


def _topic(words: Column) -> Column:
    """Topic number of a text, from the longest of its words (of equal ones the last in order).

    A stand-in for a topic model, computed in the row: the rarest kind of word is
    the longest, so copies and near copies mostly share a topic.
    """
    top = F.array_max(F.transform(words, lambda w: F.struct(F.length(w).alias("n"), w.alias("w"))))["w"]
    return F.pmod(F.conv(F.substring(F.md5(top.cast("binary")), 1, 8), 16, 10).cast("bigint"), F.lit(TOPICS)).cast("int")


def token_count(text: Column) -> Column:
    """Words of a text: runs of anything but ASCII white space; null and empty: 0."""
    return _count(_words(text))


def topic_of(text: Column) -> Column:
    """As ``_topic``, from the text."""
    return _topic(_words(text))


def uniform(key: Column, seed: int) -> Column:
    """A number in [0, 1) that depends on the key and the seed only."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") / float(1 << 48)


def prepare(docs: DataFrame, topic: Column | None = None) -> DataFrame:
    """``docs`` with ``_topic`` and ``_tokens``.

    The words are a column of their own, so a text is split once for both.
    """
    split = docs.withColumn("_words", _words(F.col("text")))
    words = F.col("_words")
    return split.withColumns({"_topic": topic if topic is not None else _topic(words), "_tokens": _count(words)}).drop("_words")


def cells(docs: DataFrame) -> DataFrame:
    """``(source, lang, topic, mass)`` of prepared documents; cells without tokens are left out."""
    mass = docs.groupBy("source", "lang", F.col("_topic").alias("topic")).agg(F.sum("_tokens").alias("mass"))
    return mass.where(F.col("mass") > 0)


def smoothed_targets(cell: DataFrame, power: float) -> dict[str, DataFrame]:
    """Target share of each value of a margin: its share of the mass to ``power``, normalised by :func:`rake`."""
    return {
        m: cell.groupBy(F.col(m).alias("value")).agg(F.pow(F.sum("mass").cast("double"), F.lit(power)).alias("target"))
        for m in MARGINS
    }


def rake(cell: DataFrame, targets: dict[str, DataFrame]) -> DataFrame:
    """Cells with ``fit``: the mass after raking.

    ``targets`` holds ``(value, target)`` for each margin; targets are divided by
    their sum over the values that occur. A value without a target gets none of
    the mass. Null is a value like others.
    """
    total = cell.agg(F.sum("mass")).first()[0] or 0
    goals = {}
    for m in MARGINS:
        found = cell.select(F.col(m).alias("value")).distinct()
        t = targets[m].select(F.col("value").alias("_v"), F.col("target").cast("double").alias("target"))
        there = found.join(t, found["value"].eqNullSafe(t["_v"]), "left").select("value", F.coalesce("target", F.lit(0.0)).alias("target"))
        whole = there.agg(F.sum("target")).first()[0] or 0.0
        goals[m] = there.withColumn("target", F.col("target") / F.lit(whole or 1.0) * F.lit(float(total)))
    if measure(cell, LOCAL_CELLS)[1] and all(measure(g, LOCAL_CELLS)[1] for g in goals.values()):
        return _rake_batch(cell, goals)
    return _rake_spread(cell, goals)


def _rake_spread(cell: DataFrame, goals: dict[str, DataFrame]) -> DataFrame:
    """Raking as aggregations and joins; every round is a written table."""
    fitted = cell.withColumn("fit", F.col("mass").cast("double"))
    goals = {m: stage(g, "mixing-goals") for m, g in goals.items()}
    for _ in range(ROUNDS):
        for m in MARGINS:
            now = fitted.groupBy(F.col(m).alias("_v")).agg(F.sum("fit").alias("_now"))
            goal = goals[m]
            factor = now.join(goal, now["_v"].eqNullSafe(goal["value"])).select(
                "_v", F.when(F.col("_now") > 0, F.col("target") / F.col("_now")).otherwise(0.0).alias("_f")
            )
            factor = broadcast_if_small(stage(factor, "mixing-factor"))
            fitted = fitted.join(factor, fitted[m].eqNullSafe(factor["_v"])).withColumn("fit", F.col("fit") * F.col("_f")).drop("_v", "_f")
        fitted = stage(fitted, "mixing-fit")
    return fitted


def _rake_batch(cell: DataFrame, goals: dict[str, DataFrame]) -> DataFrame:
    """The same rounds over a measured, small table."""
    rows = sorted(cell.collect(), key=lambda r: repr(tuple(r)))
    goal = {m: {r["value"]: r["target"] for r in g.collect()} for m, g in goals.items()}
    fit = [float(r["mass"]) for r in rows]
    for _ in range(ROUNDS):
        for m in MARGINS:
            now: dict = {}
            for r, f in zip(rows, fit):
                now[r[m]] = now.get(r[m], 0.0) + f
            factor = {v: goal[m].get(v, 0.0) / n if n > 0 else 0.0 for v, n in now.items()}
            fit = [f * factor[r[m]] for r, f in zip(rows, fit)]
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cell.schema.fields)
    data = [(*[r[c] for c in cell.columns], f) for r, f in zip(rows, fit)]
    return cell.sparkSession.createDataFrame(data, f"{fields}, fit double")


def calibrate(fitted: DataFrame, share: float) -> DataFrame:
    """Adds ``weight`` and ``probability`` to raked cells.

    The factor is found by halving: each step is one sum over the cells. If all
    cells with weight are taken whole and still miss the budget, they all stay.
    """
    cell = stage(fitted.withColumn("weight", F.col("fit") / F.col("mass")), "mixing-weights")
    sums = cell.agg(F.sum("mass"), F.max("weight")).first()
    budget, top = share * (sums[0] or 0), sums[1] or 0.0
    low, high = 0.0, 1.0
    if top > 0:
        least = cell.where("weight > 0").agg(F.min("weight")).first()[0]
        low, high = math.log(share / top) - 1.0, math.log(1.0 / least)
        # All interval ends of a few halvings are summed in one pass.
        for _ in range(CALIBRATION // 4):
            grid = [low + (high - low) * k / 16 for k in range(17)]
            kept = [F.sum(F.col("mass") * F.least(F.lit(1.0), F.col("weight") * F.lit(math.exp(g)))).alias(f"g{k}") for k, g in enumerate(grid)]
            got = cell.agg(*kept).first()
            k = max([i for i in range(16) if got[i] <= budget], default=0)
            low, high = grid[k], grid[k + 1]
    factor = math.exp((low + high) / 2) if top > 0 else 0.0
    return cell.withColumn("probability", F.least(F.lit(1.0), F.col("weight") * F.lit(factor)))


def attach(docs: DataFrame, cell: DataFrame, seed: int) -> DataFrame:
    """Prepared documents with ``_weight``, ``_probability`` and ``_sampled``.

    Documents without tokens have weight and probability 0. Cells are joined by
    broadcast when measured small, else by a join that Spark may split.
    """
    c = broadcast_if_small(
        cell.select(F.col("source").alias("_s"), F.col("lang").alias("_l"), F.col("topic").alias("_t"), F.col("weight").alias("_weight"), F.col("probability").alias("_probability"))
    )
    same = docs["source"].eqNullSafe(c["_s"]) & docs["lang"].eqNullSafe(c["_l"]) & docs["_topic"].eqNullSafe(c["_t"])
    joined = docs.join(c, same, "left").drop("_s", "_l", "_t")
    zero = (F.col("_tokens") == 0) | F.col("_weight").isNull()
    joined = joined.withColumns({"_weight": F.when(zero, 0.0).otherwise(F.col("_weight")), "_probability": F.when(zero, 0.0).otherwise(F.col("_probability"))})
    return joined.withColumn("_sampled", uniform(F.col("doc_id"), seed) < F.col("_probability"))


def mix(docs: DataFrame, share: float, power: float = 0.5, targets: dict[str, DataFrame] | None = None, seed: int = 7) -> DataFrame:
    """One row per document: its cell, tokens, weight, probability and whether it is sampled.

    ``share``: expected part of all tokens. ``targets`` default to the smoothed
    shares of the corpus itself. Repeated rows of a doc_id in a cell fall together;
    a null doc_id is one id. An empty table gives an empty result.
    """
    ready = stage(prepare(docs.select("doc_id", "source", "lang", "text")).drop("text"), "mixing-docs")
    cell = stage(cells(ready), "mixing-cells")
    done = calibrate(rake(cell, targets or smoothed_targets(cell, power)), share)
    return attach(ready, done, seed).select(
        "doc_id", "source", "lang", F.col("_topic").alias("topic"), F.col("_tokens").alias("n_tokens"),
        F.col("_weight").alias("weight"), F.col("_probability").alias("probability"), F.col("_sampled").alias("sampled"),
    )


def keep_sampled(docs: DataFrame, share: float, power: float = 0.5, seed: int = 7) -> DataFrame:
    """The sampled documents, all columns as they were."""
    narrow = docs.select("source", "lang", "text")
    cell = stage(cells(prepare(narrow)), "mixing-cells")
    done = calibrate(rake(cell, smoothed_targets(cell, power)), share)
    row = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_row"), "doc_id", "source", "lang", "text")
    return attach(prepare(row), done, seed).where("_sampled").select("_row.*")
