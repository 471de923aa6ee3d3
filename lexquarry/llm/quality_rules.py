"""Quality rules combined by weak supervision, in DataFrame functions only.

Each rule votes good (1), bad (-1) or abstains (0).  Expectation-maximisation
estimates, without labels, how often each rule gives each vote to good and to
bad texts (Dawid and Skene's model); the posterior that a text is good replaces
"all rules must pass".  Texts are grouped by their votes first, so an iteration
reads at most 3 ^ rules rows.  A prior of PRIOR_ROWS pseudo-rows, spread as in START,
keeps the classes from changing places; its part of the estimates shrinks as texts grow in number.

A text fails at once with fewer than 10 words or with over 20 % of its words in
repeated 5-word windows; else it is kept if its posterior is 0.5 or more.

Defined cases: a null text has no words and fails; a very long text is one row like
any other; a posterior of exactly 0.5 keeps the text; repeated rows are judged each; an
empty table gives an empty result; only id and text are read, whatever other columns are called.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexquarry.scratch import save

_SPACE = r"[\x20\x09-\x0D]"
ROUNDS = 25
PRIOR_ROWS = 100.0
#: Starting shares of the votes (bad, abstain, good) among good and among bad texts.
START = {"good": (0.05, 0.25, 0.70), "bad": (0.50, 0.30, 0.20)}
START_GOOD = 0.85

RULES = ("length", "word_size", "symbols", "lines", "repeats", "capitals", "endings")


def text_counts(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the counts that the rules need, one pass over each text."""
    step = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    step = step.select(
        "doc_id",
        "text",
        F.filter(F.split("text", _SPACE + "+"), lambda w: w != "").alias("words"),
        F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
    )
    step = step.select(
        "doc_id",
        "text",
        "lines",
        F.size("words").alias("n"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("h"),
    )
    window = F.transform(
        F.sequence(F.lit(0), F.col("n") - 5),
        lambda i: F.xxhash64(*(F.get("h", i + k) for k in range(5))),
    )
    step = step.select(
        "doc_id",
        F.col("n").cast("long").alias("n_words"),
        (F.length("text") - F.regexp_count("text", F.lit(_SPACE))).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("lines", lambda x: x.rlike(r"""[.!?…:"'»)\]][\x20\x09-\x0D]*$"""))).cast("long").alias("n_ended"),
        F.regexp_count("text", F.lit(r"\p{Lu}")).cast("long").alias("n_capitals"),
        F.when(F.col("n") >= 5, window).otherwise(F.array().cast("array<bigint>")).alias("windows"),
    )
    step = step.withColumn("again", F.size("windows") > F.size(F.array_distinct("windows")))
    placed = F.sort_array(F.transform("windows", lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    step = step.withColumn("placed", F.when(F.col("again"), placed)).drop("windows")
    twice = F.filter("placed", lambda z, k: (z["g"] == F.get("placed", k - 1)["g"]) | (z["g"] == F.get("placed", k + 1)["g"]))
    step = step.withColumn("starts", F.when(F.col("again"), F.sort_array(F.transform(twice, lambda z: z["i"])))).drop("placed")
    added = F.transform("starts", lambda q, k: F.when(k == 0, F.lit(5)).otherwise(F.least(F.lit(5), q - F.get("starts", k - 1))))
    covered = F.aggregate(added, F.lit(0), lambda a, b: a + b)
    return step.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("starts", "again")


def _vote(good: Column, bad: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0)


def votes() -> dict[str, Column]:
    """The rules' votes over the columns of :func:`text_counts`."""
    n, c = F.col("n_words"), F.col
    return {
        "length": _vote(n >= 40, n < 15),
        "word_size": _vote(c("word_chars").between(3 * n, 9 * n), (c("word_chars") < 2 * n) | (c("word_chars") > 15 * n)),
        "symbols": _vote(50 * c("n_symbols") <= n, 5 * c("n_symbols") > n),
        "lines": _vote((c("n_lines") > 2) & (c("n_dup_lines") == 0), 3 * c("n_dup_lines") > c("n_lines")),
        "repeats": _vote(c("n_repeat_words") * 100 <= n, c("n_repeat_words") * 100 > 12 * n),
        "capitals": _vote(10 * c("n_capitals") <= c("word_chars"), 3 * c("n_capitals") > c("word_chars")),
        "endings": _vote(2 * c("n_ended") >= c("n_lines"), (c("n_lines") > 4) & (10 * c("n_ended") < c("n_lines"))),
    }


def _ratios(model: dict) -> tuple[float, list[float]]:
    """The log odds of good, and the log ratios of all votes, by rule and then vote."""
    odds = math.log(model["p"] / (1 - model["p"]))
    return odds, [math.log(model["good", r, v] / model["bad", r, v]) for r in RULES for v in (-1, 0, 1)]


def _posterior(odds: Column, ratios: Column) -> Column:
    """P(good | votes) under the model's shares."""
    for k, rule in enumerate(RULES):
        odds = odds + F.get(ratios, F.col(rule) + (3 * k + 1))
    return 1 / (1 + F.exp(-odds))


def fit(patterns: DataFrame, rounds: int = ROUNDS) -> dict:
    """EM over a table of vote patterns with their numbers ``n``; returns the model's shares.

    The shares reach each round as a row of data, so that all rounds run the same compiled plan.
    """
    spark = patterns.sparkSession
    model: dict = {(y, r, v): START[y][v + 1] for y in START for r in RULES for v in (-1, 0, 1)}
    model["p"] = START_GOOD
    for _ in range(rounds):
        shares = spark.createDataFrame([_ratios(model)], "odds double, ratios array<double>")
        weighed = patterns.crossJoin(F.broadcast(shares))  # one row
        good = weighed.withColumn("good", F.col("n") * _posterior(F.col("odds"), F.col("ratios"))).withColumn("bad", F.col("n") - F.col("good"))
        row = good.agg(
            *(F.sum(y).alias(y) for y in START),
            *(F.sum(F.when(F.col(r) == v, F.col(y)).otherwise(0.0)).alias(f"{y}_{r}_{v}") for y in START for r in RULES for v in (-1, 0, 1)),
        ).first()
        if not row["good"]:
            return model
        total = row["good"] + row["bad"]
        extra = {"good": PRIOR_ROWS * START_GOOD, "bad": PRIOR_ROWS * (1 - START_GOOD)}
        new: dict = {
            (y, r, v): (row[f"{y}_{r}_{v}"] + extra[y] * START[y][v + 1]) / (row[y] + extra[y]) for y in START for r in RULES for v in (-1, 0, 1)
        }
        new["p"] = (row["good"] + extra["good"]) / (total + PRIOR_ROWS)
        change = max(abs(new[k] - model[k]) for k in model)
        model = new
        if change < 1e-4:
            break
    return model


def judge(docs: DataFrame) -> DataFrame:
    """Per row: ``doc_id``, the counts, ``base_failed``, the votes, ``posterior`` and ``kept``."""
    counted = save(text_counts(docs).withColumns(votes()), "counts")
    patterns = save(counted.groupBy(*RULES).agg(F.count("*").alias("n")).coalesce(1), "patterns")  # 3 ^ 7 rows at most
    odds, ratios = _ratios(fit(patterns))
    posterior = _posterior(F.lit(odds), F.array(*(F.lit(x) for x in ratios)))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return counted.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        F.array(*RULES).alias("votes"),
        F.round(posterior, 6).alias("posterior"),
        (~failed & (posterior >= 0.5)).alias("kept"),
    )
