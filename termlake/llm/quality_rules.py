"""Quality rules: base counts, then robust multivariate outliers per language and source.

Every text becomes a vector of transformed statistics. For each (lang, source) a
minimum covariance determinant estimate is fitted by concentration steps over
all its rows: rows are ranked by Mahalanobis distance, the nearest share ``H``
gives the next centre and covariance. A step is one partial aggregation of
integer sums by (group, distance bin), so no group meets in a task, sums don't
depend on the order of rows, and a result is the same in every run.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import broadcast_if_small, stage
from .batches import bound_batches, text_struct

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks")
# Statistics of the vector, and the standard deviation below which a spread isn't told from none.
NAMES = ("word_length", "symbols", "dup_lines", "repeats", "upper", "marks")
FLOORS = np.array([0.10, 0.06, 0.15, 0.12, 0.06, 0.08])
P = len(NAMES)

WINDOW = 8
UNIT = 1024  # statistics are kept as integers of 1/UNIT
H = 0.75
STEPS = 4
BINS = 16  # distance bins per doubling
MIN_ROWS = 200  # smaller (lang, source) groups of a language are pooled
LEAST_ROWS = 5 * P  # smaller pools of a language are pooled over all languages; below it no estimate is made
REWEIGHT = 0.975
REJECT = 1e-6  # chi-square tail beyond which a vector is an outlier

_MULTIPLIERS = np.array([pow(0x9E3779B97F4A7C15, k + 1, 1 << 64) | 1 for k in range(WINDOW)], np.uint64)
_UPPER = slice(65, 91)
_MARKS = [b for b in range(33, 127) if not chr(b).isalnum()]
_SPACE = [9, 10, 11, 12, 13, 32]
_SYMBOLS = [ord(c) for c in "#*$%&|<>"]


def repeated_words(words: list[bytes]) -> int:
    """Words inside windows of ``WINDOW`` words that occur twice or more."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.array([seen.setdefault(w, len(seen)) for w in words], np.uint64)
    if len(seen) == len(words):
        return 0
    mixed = sum(ids[k : k + n] * _MULTIPLIERS[k] for k in range(WINDOW))
    if len(np.unique(mixed)) == n:
        return 0
    # Some hashes meet: name windows of 2, 4 and 8 words exactly.
    names, width = ids.astype(np.int64), 1
    while width < WINDOW:
        pairs = names[:-width] * (int(names.max()) + 1) + names[width:]
        names, width = np.unique(pairs, return_inverse=True)[1], width * 2
    twice = np.bincount(names)[names] > 1
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, np.flatnonzero(twice), 1)
    np.add.at(edges, np.flatnonzero(twice) + WINDOW, -1)
    return int((np.cumsum(edges) > 0).sum())


def counts(text: str) -> tuple[int, ...]:
    """``COUNTS`` of one text. Words are runs of anything but U+0020 and U+0009 to U+000D."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    chars = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    lines = [x for x in text.split("\n") if x.strip(" \t\r\x0b\x0c")]
    return (
        len(words),
        len(text) - int(chars[_SPACE].sum()),
        int(chars[_SYMBOLS].sum()),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        int(chars[_UPPER].sum()),
        int(chars[_MARKS].sum()),
    )


def with_counts(docs: DataFrame, column: str = "_counts") -> DataFrame:
    """``docs`` with a struct of ``COUNTS`` of each whole text (null text: as empty)."""
    return bound_batches(docs).withColumn(column, text_struct(F.col("text"), ", ".join(f"{c} bigint" for c in COUNTS), lambda: counts))


def base_failed(c: Column) -> Column:
    return (c["n_words"] < 20) | (100 * c["n_repeat_words"] > 30 * c["n_words"])


def vector(c: Column) -> list[Column]:
    """Transformed statistics as integers of 1/UNIT; shares by the arcsine of their root."""

    def share(part: Column, whole: Column) -> Column:
        return F.asin(F.sqrt(F.least(part / F.greatest(whole, F.lit(1)), F.lit(1.0))))

    stats = [
        F.log(F.greatest(c["word_chars"], F.lit(1)) / F.greatest(c["n_words"], F.lit(1))),
        share(c["n_symbols"], c["word_chars"]),
        share(c["n_dup_lines"], c["n_lines"]),
        share(c["n_repeat_words"], c["n_words"]),
        share(c["n_upper"], c["word_chars"]),
        share(c["n_marks"], c["word_chars"]),
    ]
    return [F.rint(s * UNIT).cast("bigint") for s in stats]


def chi2_tail(x: float) -> float:
    """P(chi-square with P degrees of freedom > x), for even P."""
    return math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(P // 2))


def chi2_quantile(tail: float) -> float:
    low, high = 0.0, 1000.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_tail(mid) > tail else (low, mid)
    return high


CUT = chi2_quantile(REJECT)
STATE = "grp string, start int, centre array<double>, inverse array<double>, logdet double, cov array<double>"


def _spreads(cov: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Variances in units of the floors along the principal axes, and the axes."""
    values, axes = np.linalg.eigh(cov / np.outer(FLOORS, FLOORS))
    return np.maximum(values, 0.0), axes


def _state(grp: str, start: int, centre: np.ndarray, cov: np.ndarray) -> tuple:
    """``cov`` as estimated; distances go by its spreads, each at least the floor."""
    values, axes = _spreads(cov)
    values = np.maximum(values, 1.0)
    inverse = (axes / values) @ axes.T / np.outer(FLOORS, FLOORS)
    return grp, start, list(centre), inverse.ravel().tolist(), float(np.log(values).sum()), cov.ravel().tolist()


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["grp", "start", "centre", "inverse", "logdet", "cov"])


def _first_states(key: tuple, hist: pd.DataFrame) -> pd.DataFrame:
    """Two starts from medians: spreads by median absolute deviation, and equal spreads."""
    centre, spread = np.zeros(P), np.zeros(P)
    for i, part in hist.groupby("dim"):
        values, n = part["value"].to_numpy(float) / UNIT, part["n"].to_numpy(float)

        def median(v: np.ndarray) -> float:
            order = np.argsort(v, kind="stable")
            return float(v[order][np.searchsorted(np.cumsum(n[order]), n.sum() / 2)])

        centre[i] = median(values)
        spread[i] = 1.4826 * median(np.abs(values - centre[i]))
    return _frame([_state(key[0], 0, centre, np.diag(spread**2)), _state(key[0], 1, centre, np.diag(FLOORS**2) * 9)])


def _moments(part: pd.DataFrame, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = (part["n"].to_numpy(float) * weight).sum()
    first = np.array([(part[f"s{i}"].to_numpy(float) * weight).sum() for i in range(P)]) / n
    cov = np.zeros((P, P))
    for i in range(P):
        for j in range(i, P):
            cov[i, j] = cov[j, i] = (part[f"s{i}_{j}"].to_numpy(float) * weight).sum() / n - first[i] * first[j]
    return first / UNIT, cov / UNIT**2


def _edge(bins: np.ndarray) -> np.ndarray:
    """Distance at the upper end of bins."""
    return 2.0 ** ((bins + 1) / BINS)


def _step(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
    """Concentration step: the nearest share H of rows, the last bin in part."""
    part = part.sort_values("bin")
    n = part["n"].to_numpy(float)
    before = np.cumsum(n) - n
    weight = np.clip((H * n.sum() - before) / n, 0, 1)
    centre, cov = _moments(part, weight)
    return _frame([_state(key[0], key[1], centre, cov)])


def _median_scale(part: pd.DataFrame, cov: np.ndarray) -> float:
    """Factor, above or below 1, that brings the median squared distance to what ``cov`` makes it.

    An axis at its floor adds less than a chi-square to the distance, so the
    median is that of a weighted sum, by the approximation of Wilson and Hilferty.
    """
    n = part["n"].to_numpy(float)
    at = np.searchsorted(np.cumsum(n), n.sum() / 2)
    values, _ = _spreads(cov)
    parts = np.minimum(values, 1.0)
    if parts.sum() < 1e-3:
        return 1.0
    degrees = parts.sum() ** 2 / (parts**2).sum()
    return float(_edge(part["bin"].to_numpy()[at])) / (parts.sum() * (1 - 2 / (9 * degrees)) ** 3)


def _reweight(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
    """Moments of the rows inside the ``REWEIGHT`` quantile of a rescaled estimate."""
    near = (_edge(part["bin"].to_numpy()) <= chi2_quantile(1 - REWEIGHT)).astype(float)
    if not (part["n"].to_numpy() * near).sum():
        near[:] = 1.0
    centre, cov = _moments(part, near)
    return _frame([_state(key[0], key[1], centre, cov)])


def _rescale(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
    part = part.sort_values("bin")
    cov = np.array(list(part["cov"].iloc[0])).reshape(P, P)
    return _frame([_state(key[0], key[1], np.array(list(part["centre"].iloc[0])), cov * _median_scale(part, cov))])


def distance(z: list[Column], centre: Column, inverse: Column) -> Column:
    """Squared Mahalanobis distance, unrolled into plain arithmetic."""
    off = [z[i] / F.lit(float(UNIT)) - centre[i] for i in range(P)]
    total = F.lit(0.0)
    for i in range(P):
        total = total + inverse[i * P + i] * off[i] * off[i]
        for j in range(i + 1, P):
            total = total + 2 * inverse[i * P + j] * off[i] * off[j]
    return F.greatest(total, F.lit(0.0))


def groups(counted: DataFrame) -> DataFrame:
    """``(lang, source, grp)``: the group whose estimate a source's rows use.

    A null language or source is a value of its own. Sources under ``MIN_ROWS``
    rows are pooled within their language, pools under ``LEAST_ROWS`` rows over
    all languages. If that last pool is below ``LEAST_ROWS`` too, it has a null group.
    """
    sizes = counted.where(F.col("_counts.n_words") > 0).groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))
    sizes = stage(sizes, "quality-sizes")
    small = F.col("n") < MIN_ROWS
    pools = sizes.where(small).groupBy("lang").agg(F.sum("n").alias("pool")).withColumnRenamed("lang", "_lang")
    named = sizes.join(pools, sizes["lang"].eqNullSafe(pools["_lang"]), "left")
    alone = small & (F.col("pool") < LEAST_ROWS)
    last = named.where(alone).agg(F.sum("n")).first()[0] or 0
    own = F.to_json(F.struct("lang", "source"))
    pooled = F.to_json(F.struct("lang", F.lit(True).alias("pool")))
    rest = F.lit("rest") if last >= LEAST_ROWS else F.lit(None).cast("string")
    grp = F.when(alone, rest).when(small, pooled).otherwise(own)
    return named.select(F.col("lang").alias("_lang"), F.col("source").alias("_source"), grp.alias("grp"))


def attach_group(df: DataFrame, sources: DataFrame) -> DataFrame:
    same = df["lang"].eqNullSafe(sources["_lang"]) & df["source"].eqNullSafe(sources["_source"])
    return df.join(broadcast_if_small(sources), same, "left").drop("_lang", "_source")


def fit(counted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Estimates of all groups from rows ``(lang, source, _counts)``, which should be a staged table.

    Returns the groups of sources and the table ``STATE``; an empty table gives empty ones.
    """
    sources = stage(groups(counted), "quality-groups")
    z = [f"z{i}" for i in range(P)]
    rows = attach_group(counted.where(F.col("_counts.n_words") > 0), sources).where(F.col("grp").isNotNull())
    rows = stage(rows.select("grp", *[v.alias(n) for v, n in zip(vector(F.col("_counts")), z)]), "quality-vectors")

    pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("dim"), F.col(n).alias("value")) for i, n in enumerate(z)])).alias("v")
    hist = rows.select("grp", pairs).groupBy("grp", "v.dim", "v.value").agg(F.count(F.lit(1)).alias("n"))
    state = stage(hist.groupBy("grp").applyInPandas(_first_states, STATE), "quality-state")

    def binned(state: DataFrame) -> DataFrame:
        joined = rows.join(broadcast_if_small(state), "grp")
        d = distance([F.col(n) for n in z], F.col("centre"), F.col("inverse"))
        sums = [F.sum(n).alias(f"s{i}") for i, n in enumerate(z)]
        sums += [F.sum(F.col(z[i]) * F.col(z[j])).alias(f"s{i}_{j}") for i in range(P) for j in range(i, P)]
        bins = F.floor(F.log2(F.greatest(d, F.lit(1e-6))) * BINS).cast("int").alias("bin")
        return joined.select("grp", "start", *z, bins).groupBy("grp", "start", "bin").agg(F.count(F.lit(1)).alias("n"), *sums)

    for _ in range(STEPS):
        state = stage(binned(state).groupBy("grp", "start").applyInPandas(_step, STATE), "quality-state")
    best = state.groupBy("grp").agg(F.min_by(F.struct(*state.columns[1:]), F.struct("logdet", "start")).alias("s")).select("grp", "s.*")
    best = stage(best, "quality-state")

    def rescaled(state: DataFrame) -> DataFrame:
        bins = binned(state).join(broadcast_if_small(state), ["grp", "start"])
        return stage(bins.groupBy("grp", "start").applyInPandas(_rescale, STATE), "quality-state")

    state = stage(binned(rescaled(best)).groupBy("grp", "start").applyInPandas(_reweight, STATE), "quality-state")
    return sources, rescaled(state)


def judge(counted: DataFrame, sources: DataFrame, state: DataFrame) -> DataFrame:
    """``counted`` with ``_base_failed``, ``_distance`` (null without an estimate) and ``_kept``."""
    state = state.select("grp", "centre", "inverse")
    c = F.col("_counts")
    joined = attach_group(counted, sources).join(broadcast_if_small(state), "grp", "left")
    d = distance(vector(c), F.col("centre"), F.col("inverse"))
    joined = joined.withColumn("_base_failed", base_failed(c)).withColumn("_distance", d)
    kept = ~F.col("_base_failed") & F.coalesce(F.col("_distance") <= CUT, F.lit(True))
    return joined.withColumn("_kept", kept).drop("grp", "centre", "inverse")


def quality_table(docs: DataFrame) -> DataFrame:
    """One row per document: base counts, verdicts and distance.

    Null texts count as empty, which fail the base rule; repeated rows are
    judged alike; ties don't arise, as a verdict is a threshold.
    """
    counted = stage(with_counts(docs.select("doc_id", "lang", "source", "text")).drop("text"), "quality-counts")
    judged = judge(counted, *fit(counted))
    return judged.select(
        "doc_id", *[F.col(f"_counts.{c}").alias(c) for c in COUNTS[:5]],
        F.col("_base_failed").alias("base_failed"), F.col("_kept").alias("kept"), F.col("_distance").alias("distance"),
    )


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that the rules keep, all columns as they were."""
    narrow = stage(with_counts(docs.select("lang", "source", "text")).drop("text"), "quality-counts")
    sources, state = fit(narrow)
    judged = judge(with_counts(docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_row"), "lang", "source", "text")), sources, state)
    return judged.where("_kept").select("_row.*")
