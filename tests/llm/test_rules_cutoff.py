"""The outlier rule on numbers drawn to order."""

import random

import numpy as np
from pyspark.sql import functions as F

from termlake.llm import quality_rules

COUNTED = "doc_id bigint, lang string, source string, _counts struct<" + ",".join(f"{c}:bigint" for c in quality_rules.COUNTS) + ">"


def counted(i, rnd, lang="en", source="a", **other):
    """Counts of a document of 1,000 words with shares that spread by about a floor."""
    angle = lambda mid, sd: np.sin(np.clip(rnd.gauss(mid, sd), 0, 1.5)) ** 2
    chars = int(1000 * np.exp(rnd.gauss(1.6, 0.10)))
    c = {
        "n_words": 1000, "word_chars": chars, "n_symbols": int(chars * angle(0.2, 0.06)), "n_dup_lines": int(1000 * angle(0.5, 0.15)),
        "n_repeat_words": int(1000 * min(angle(0.3, 0.08), 0.3)), "n_lines": 1000, "n_upper": int(chars * angle(0.25, 0.06)), "n_marks": int(chars * angle(0.35, 0.08)),
    } | other
    return i, lang, source, tuple(c[k] for k in quality_rules.COUNTS)


def verdicts(scratch, rows):
    table = scratch.createDataFrame(rows, COUNTED)
    return {r["doc_id"]: r["_kept"] for r in quality_rules.judge(table, *quality_rules.fit(table)).collect()}


def test_one_statistic_decides_near_its_floor(scratch):
    rnd = random.Random(8)
    rows = [counted(i, rnd) for i in range(2000)]
    # Eight of the spreads above off in one statistic, under 8.7 of floor and spread added up.
    middle = {"word_chars": 4953, "n_symbols": 195, "n_dup_lines": 230, "n_repeat_words": 87, "n_upper": 303, "n_marks": 582}
    planted = {"word_chars": int(4953 * np.exp(0.8)), "n_symbols": int(4953 * np.sin(0.2 + 0.48) ** 2), "n_dup_lines": int(1000 * np.sin(1.55) ** 2), "n_upper": int(4953 * np.sin(0.25 + 0.48) ** 2), "n_marks": int(4953 * np.sin(0.35 + 0.64) ** 2)}
    for k, (name, value) in enumerate(planted.items()):
        rows.append(counted(10_000 + k, rnd, **middle | {name: value}))
    got = verdicts(scratch, rows)
    assert np.mean([got[i] for i in range(2000)]) > 0.998
    assert not any(got[10_000 + k] for k in range(len(planted)))


def test_rare_languages_are_judged(scratch):
    rnd = random.Random(9)
    junk = {"n_symbols": 2500}
    rows = [counted(i, rnd, lang="en") for i in range(300)]
    rows += [counted(1000 + i, rnd, lang="fi", source="abc"[i % 3]) for i in range(60)]
    rows += [counted(2000 + i, rnd, lang=[None, "is", "mt"][i % 3], source="a") for i in range(60)]
    rows += [counted(3000 + i, rnd, lang=lang, **junk) for i, lang in enumerate(("en", "fi", None, "is", "mt"))]
    got = verdicts(scratch, rows)
    assert not any(got[3000 + i] for i in range(5))
    assert np.mean([kept for i, kept in got.items() if i < 3000]) > 0.98
