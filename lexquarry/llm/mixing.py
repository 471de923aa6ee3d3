"""Mixing sources to target weights, in DataFrame functions only.

A source with share p of the tokens gets the weight p ^ a / sum(p ^ a).  The
exponent a is bisected between 0 (all sources alike) and 1 (as they are) to meet
either a target entropy or a limit on repetition: how much more often than the
least repeated source any source is repeated.  Each bisection step reads the
table of source totals once and halves the interval GRID_BITS times.

The weights become budgets: passes over a source = budget * weight / tokens.  A
source's rows are dealt to blocks of about BLOCK_ROWS rows by hash, the blocks
are permuted, and so are the rows of each block.  All whole passes take every
row; the last, partial pass takes the permutation's rows up to the budget, found
from running sums over blocks and then inside blocks, so no task sees a whole
source.

Defined cases: null and empty source names are one source; a row without words
costs nothing and is taken once per whole pass, at least once; a source without
any words takes no weight; repeated rows are separate rows; an empty table gives
an empty result; only id, text and source are read by :func:`mixture`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexquarry.scratch import save

BLOCK_ROWS = 4096
GRID_BITS = 5
STEPS = 5
SEED = 20_26
MOST_REPETITION = 2.0


def _measures(totals: DataFrame, exponents: list[float]) -> list[tuple[float, float, float]]:
    """(exponent, entropy of the weights, ratio of the most to the least repetition)."""
    log_p = F.log(F.col("tokens") / F.col("all_tokens"))
    grid = totals.where("tokens > 0").select(log_p.alias("l"), F.explode(F.array(*(F.lit(x) for x in exponents))).alias("a"))
    power = F.exp(F.col("a") * F.col("l"))
    rows = grid.groupBy("a").agg(F.sum(power).alias("z"), F.sum(power * F.col("l")).alias("d"), F.max("l").alias("high"), F.min("l").alias("low"))
    entropy = F.log("z") - F.col("a") * F.col("d") / F.col("z")
    ratio = F.exp((1 - F.col("a")) * (F.col("high") - F.col("low")))
    return sorted((r[0], r[1], r[2]) for r in rows.select("a", entropy, ratio).collect())


def find_exponent(totals: DataFrame, entropy: float | None = None, repetition: float | None = None) -> float:
    """The least exponent in [0, 1] whose weights keep to the targets.

    Entropy falls and repetition falls as the exponent grows, so with an entropy
    target the exponent is where the entropy meets it, and with a repetition
    limit the least one that keeps it; with both, the greater of the two.  An
    entropy that no exponent gives is an error.
    """
    out = 0.0
    if entropy is not None:
        even, own = (m[1] for m in _measures(totals, [0.0, 1.0]))
        if not own - 1e-9 <= entropy <= even + 1e-9:
            raise ValueError(f"an entropy of {entropy} is out of reach: the weights' lies between {own} and {even}")
    for target, meets in (
        (entropy, lambda m: m[1] <= entropy),
        (repetition, lambda m: m[2] <= repetition),
    ):
        if target is None:
            continue
        low, high = 0.0, 1.0
        for _ in range(STEPS):
            width = (high - low) / (1 << GRID_BITS)
            points = _measures(totals, [low + width * k for k in range((1 << GRID_BITS) + 1)])
            good = [m[0] for m in points if meets(m)]
            high = min(good, default=high)
            low = max([m[0] for m in points if m[0] < high], default=high)
            if low == high:
                break
        out = max(out, high)
    return out


def _parts(docs: DataFrame, key, entropy: float | None, repetition: float | None, budget: int | None) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    thin = save(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            key.alias("key"),
            F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
            F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("n_tokens"),
            F.xxhash64(F.lit(SEED), F.col("doc_id"), text).alias("draw"),
        ).withColumn("row", F.monotonically_increasing_id()),
        "thin",
    )
    totals = thin.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("rows"))
    whole = totals.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    totals = save(totals.withColumn("all_tokens", F.lit(whole)), "totals")
    exponent = find_exponent(totals, entropy, repetition) if whole else 1.0
    power = F.when(F.col("tokens") > 0, F.exp(F.lit(exponent) * F.log(F.col("tokens") / F.col("all_tokens")))).otherwise(0.0)
    weighed = totals.withColumn("power", power)
    z, cover = weighed.agg(F.sum("power"), F.max(F.when(F.col("power") > 0, F.col("tokens") / F.col("power")))).first()
    z = z or 1.0
    spent = float(budget) if budget is not None else float((cover or 0.0) * z)  # by default, every source is passed over once at least
    passes = F.when(F.col("tokens") > 0, spent * F.col("weight") / F.col("tokens")).otherwise(1.0)
    sources = (
        weighed.withColumn("weight", F.col("power") / z)
        .withColumn("passes", passes)
        .withColumn("full", F.floor(F.col("passes") + 1e-9))
        .withColumn("rest", F.greatest(F.lit(0.0), (F.col("passes") - F.col("full")) * F.col("tokens") + 1e-6))
        .withColumn("blocks", F.ceil(F.col("rows") / BLOCK_ROWS))
        .select("source", "weight", "passes", "full", "rest", "blocks")
    )
    dealt = thin.join(sources, "source").withColumn("block", F.pmod(F.col("draw"), F.col("blocks")))
    sums = dealt.groupBy("source", "block").agg(F.sum("n_tokens").alias("tokens"))
    earlier = Window.partitionBy("source").orderBy(F.xxhash64(F.lit(SEED + 1), "block"), "block").rowsBetween(Window.unboundedPreceding, -1)
    begins = sums.select("source", "block", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("begins"))
    inside = Window.partitionBy("source", "block").orderBy(F.xxhash64(F.lit(SEED + 2), "draw"), "draw", "row")
    upto = F.col("begins") + F.sum("n_tokens").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    return dealt.join(begins, ["source", "block"]).select(
        "doc_id",
        "key",
        "source",
        "n_tokens",
        F.lit(exponent).alias("exponent"),
        "weight",
        "passes",
        "block",
        (upto - F.col("n_tokens")).alias("tokens_before"),
        F.when(F.col("n_tokens") == 0, F.greatest(F.lit(1), "full"))
        .otherwise(F.col("full") + (upto <= F.col("rest")).cast("int"))
        .cast("long")
        .alias("repeats"),
    )


def mixture(docs: DataFrame, entropy: float | None = None, repetition: float | None = MOST_REPETITION, budget: int | None = None) -> DataFrame:
    """Per row: its source's ``weight`` and ``passes``, its place in the permutation, and its ``repeats``.

    ``budget`` is in tokens; without one, it is the least with which no source
    is cut, so that every row is taken at least once.
    """
    return _parts(docs, F.lit(None).cast("long"), entropy, repetition, budget).drop("key")


def mix(docs: DataFrame, entropy: float | None = None, repetition: float | None = MOST_REPETITION, budget: int | None = None) -> DataFrame:
    """``docs`` with every row as often as :func:`mixture` says, columns unchanged."""
    name = "__lexquarry_key"
    key = F.xxhash64(*(F.col(f"`{c}`") for c in docs.columns))
    # rows alike in all columns share a key; their repeats are added up and given to one of them
    times = _parts(docs, key, entropy, repetition, budget).groupBy("key").agg(F.sum("repeats").cast("int").alias("__lexquarry_times"))
    times = save(times.where("__lexquarry_times > 0").withColumnRenamed("key", name), "times")
    taken = docs.withColumn(name, key).join(times, name).dropDuplicates([name])
    again = F.explode(F.sequence(F.lit(1), F.col("__lexquarry_times"))).alias("__lexquarry_pass")
    return taken.select(*(F.col(f"`{c}`") for c in docs.columns), again).drop("__lexquarry_pass")
