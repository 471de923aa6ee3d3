"""Language identification by Bayesian evidence fusion.

The posterior of a language adds, in logarithms,

* the text likelihood: byte 3-grams of the lower-cased text, hashed to BUCKETS,
  under Dirichlet-smoothed language profiles, divided by the number of grams and
  multiplied by at most CREDIT grams, since neighbouring grams are not independent;
* what the page declares (``<html lang>``), and what its address suffix says,
  each through a confusion table counted over the corpus;
* the host's prior: its language shares, shrunk toward its suffix's, and those
  toward the corpus's, each with STRENGTH pseudo-rows.

Tables and priors are grouped sums of the text posteriors, and every row's own
share is taken out of its host before it is judged, so no row confirms itself.
A further class, ``und``, has all grams alike: texts without letters fall there.

Profiles are fitted on at most about FIT_ROWS labelled documents of each language,
drawn by hash.  The MOST_LANGUAGES commonest languages have profiles of their own;
any further ones share one, ``other``, so that their rows are known for a language.

Defined cases: a null or empty text leaves the text evidence out, so the other
evidence decides; a very long text counts as a whole, its evidence being a mean; a
null host, suffix or declaration is a value of its own; unknown declared codes are
counted like any other; of equally likely languages the first by name is taken, and
``und`` only if no other is as likely; repeated rows count each; an empty table gives
an empty result; only the columns named in the call are read, whatever others are called.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexquarry.llm import _text as tx
from lexquarry.llm._bloom import without_keys
from lexquarry.llm._skew import join_groups
from lexquarry.scratch import save

BUCKETS = 1 << 16
FIT_ROWS = 2000
MOST_LANGUAGES = 256
OTHER = "other"
CREDIT = 60.0
STRENGTH = 20.0
UND = "und"
UND_PRIOR = 0.001
#: Pseudo-values in smoothing the tables of declarations and suffixes.
VALUES = 64

_LETTER = np.zeros(256, dtype=bool)
_LETTER[0x61:0x7B] = _LETTER[0x80:] = True


def _grams(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and row of each byte 3-gram around letters; all that is no letter counts as one space."""
    raw, offsets = tx.utf8(column)
    low = tx._LOWER[raw]
    low = np.where(_LETTER[low], low, np.uint8(0x20)).astype(np.uint32)
    if len(low) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    packed = (low[:-2] << 16) | (low[1:-1] << 8) | low[2:]
    row = np.repeat(np.arange(len(column)), np.diff(offsets))
    keep = (row[:-2] == row[2:]) & (low[1:-1] != 0x20)
    return ((packed[keep] * np.uint32(2654435761)) >> np.uint32(16)).astype(np.int64), row[:-2][keep]


def _profile_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, j in tx.slices(batch.column("text")):
            part = batch.slice(i, j - i)
            bucket, row = _grams(part.column("text"))
            lang = part.column("lang").dictionary_encode()
            code = lang.indices.to_numpy()[row].astype(np.int64)
            pairs, n = np.unique(code * BUCKETS + bucket, return_counts=True)
            names = lang.dictionary.take(pa.array(pairs // BUCKETS))
            yield pa.RecordBatch.from_arrays([names, pa.array((pairs % BUCKETS).astype(np.int32)), pa.array(n, pa.int64())], names=["lang", "bucket", "n"])


class Profiles:
    """Log probabilities of gram buckets by language; the last language is ``und``."""

    def __init__(self, langs: list[str], table: np.ndarray):
        self.langs, self.table = langs, table


def fit_profiles(labelled: DataFrame, lang: str = "lang", text: str = "text") -> Profiles:
    """Profiles of all languages, each from about FIT_ROWS of its rows at most."""
    rows = labelled.select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text")).where("lang IS NOT NULL AND text IS NOT NULL")
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n"))
    named = sizes.orderBy(F.desc("n"), "lang").limit(MOST_LANGUAGES).collect()
    names = {r.lang: r.n for r in named}
    rest = sizes.agg(F.sum("n")).first()[0] or 0
    rest -= sum(names.values())
    share = {name: min(1.0, FIT_ROWS / n) for name, n in names.items()}
    if rest:
        share[OTHER] = min(1.0, FIT_ROWS / rest)
    if not share:
        return Profiles([UND], np.full((BUCKETS, 1), -np.log(BUCKETS), np.float32))
    chance = labelled.sparkSession.createDataFrame(list(share.items()), "lang string, share double")  # MOST_LANGUAGES + 1 rows at most
    draw = F.shiftrightunsigned(F.xxhash64("text"), 11) / float(1 << 53)
    drawn = rows.withColumn("lang", F.when(F.col("lang").isin(list(names)), F.col("lang")).otherwise(OTHER)).join(F.broadcast(chance), "lang").where(draw < F.col("share"))
    drawn = drawn.select("lang", "text").dropDuplicates()  # copies are drawn together, and count once
    counts = save(drawn.mapInArrow(_profile_counts, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")), "profiles")
    langs = sorted(share)
    table = np.full((BUCKETS, len(langs) + 1), 0.5, dtype=np.float32)
    at = {name: k for k, name in enumerate(langs)}
    got = counts.toArrow()  # (MOST_LANGUAGES + 1) * BUCKETS rows at most
    if got.num_rows:
        table[got.column("bucket").to_numpy(), np.array([at[x] for x in got.column("lang").to_pylist()])] += got.column("n").to_numpy()
    table[:, -1] = 1.0
    return Profiles([*langs, UND], np.log(table / table.sum(axis=0, dtype=np.float64)).astype(np.float32))


def _likelihoods(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value.table
        for batch in batches:
            for i, j in tx.slices(batch.column("text"), 1 << 20):
                part = batch.slice(i, j - i)
                bucket, row = _grams(part.column("text"))
                n = np.bincount(row, minlength=len(part))
                sums = np.stack([np.bincount(row, weights=table[:, k][bucket], minlength=len(part)) for k in range(table.shape[1])], axis=1)
                scaled = sums / np.maximum(n, 1)[:, None] * np.minimum(n, CREDIT)[:, None]
                lists = tx.list_array(scaled.ravel(), np.full(len(part), scaled.shape[1]), pa.float64())
                names = [c for c in part.schema.names if c != "text"]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), pa.array(n, pa.int64()), lists], names=[*names, "n_grams", "evidence"])

    return run


def _added(*arrays: Column) -> Column:
    first, *rest = arrays
    for other in rest:
        first = F.zip_with(first, other, lambda a, b: a + b)
    return first


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def _normalised(scores: Column) -> Column:
    """Posteriors from log scores."""

    def shares(powers: Column) -> Column:
        return _let(F.aggregate(powers, F.lit(0.0), lambda a, b: a + b), lambda total: F.transform(powers, lambda x: x / total))

    return _let(scores, lambda s: _let(F.array_max(s), lambda most: _let(F.transform(s, lambda x: F.exp(x - most)), shares)))


def _sums(k: int, source: str = "soft") -> Column:
    return F.array(*(F.sum(F.col(source)[i]) for i in range(k)))


def identify(rows: DataFrame, profiles: Profiles, keys: list[str], text: str, declared: str, suffix: str, host: str) -> DataFrame:
    """``keys`` of each row with ``language, probability, text_language, declared, n_grams, rejected``.

    A row is rejected when ``und`` wins, that is when neither its text nor its
    surroundings speak for any language.
    """
    spark = rows.sparkSession
    langs = profiles.langs
    k = len(langs)
    shared = spark.sparkContext.broadcast(profiles)  # BUCKETS * (MOST_LANGUAGES + 2) floats at most
    named = rows.select(
        *(F.col(c).alias(f"k{i}") for i, c in enumerate(keys)),
        F.lower(F.substring_index(F.trim(F.col(declared)), "-", 1)).alias("declared"),
        F.coalesce(F.lower(F.col(suffix)), F.lit("")).alias("suffix"),
        F.coalesce(F.lower(F.col(host)), F.lit("")).alias("host"),
        F.col(text).cast("string").alias("text"),
    ).withColumn("declared", F.coalesce("declared", F.lit("")))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in named.schema if f.name != "text")
    read = save(named.mapInArrow(_likelihoods(shared), f"{schema}, n_grams long, evidence array<double>"), "evidence")
    flat = F.array(*(F.lit(float(np.log((1 - UND_PRIOR) / max(k - 1, 1)))) for _ in range(k - 1)), F.lit(float(np.log(UND_PRIOR))))
    soft = read.withColumn("soft", F.transform(_normalised(_added(F.col("evidence"), flat)), lambda p: F.when(F.col("n_grams") > 0, p).otherwise(F.lit(0.0))))

    by_host = soft.groupBy("host", "suffix").agg(_sums(k).alias("host_n"), F.count("*").alias("host_rows"))
    by_suffix = by_host.groupBy("suffix").agg(_sums(k, "host_n").alias("suffix_n"))
    whole = by_suffix.agg(_sums(k, "suffix_n").alias("n")).first()
    total = np.array([x or 0.0 for x in (whole.n or [0.0] * k)])
    share = (total + 1e-3) / (total + 1e-3).sum()
    share_col = F.array(*(F.lit(float(x)) for x in share))

    def pooled(n: Column, prior: Column) -> Column:
        def shares(counts: Column) -> Column:
            size = F.aggregate(counts, F.lit(0.0), lambda a, b: a + b)
            return _let(size, lambda whole: F.zip_with(counts, prior, lambda a, p: (F.greatest(a, F.lit(0.0)) + STRENGTH * p) / (whole + STRENGTH)))

        return _let(n, shares)

    by_suffix = by_suffix.withColumn("suffix_p", pooled(F.col("suffix_n"), share_col))
    # P(value | language): smoothed counts of each value, among those of the language
    def table_of(column: str) -> DataFrame:
        counts = soft.groupBy(column).agg(_sums(k).alias("n"))
        return counts.select(
            column,
            F.transform(
                F.zip_with("n", F.array(*(F.lit(float(x)) for x in total)), lambda a, t: (a + 0.5) / (t + 0.5 * (VALUES + 1))),
                lambda x: F.log(x),
            ).alias(f"{column}_log"),
        )

    hosts = by_host.join(by_suffix.select("suffix", "suffix_p"), "suffix")
    joined = (
        join_groups(soft, hosts, ["host", "suffix"], "host_rows")
        .join(table_of("declared"), "declared")
        .join(table_of("suffix"), "suffix")
    )
    others = F.zip_with("host_n", "soft", lambda a, b: F.greatest(a - b, F.lit(0.0)))
    prior = F.transform(pooled(others, F.col("suffix_p")), lambda p: F.log(p))
    # the address suffix enters through its own table; the host's prior is taken against it so that it is not counted twice
    against = F.transform("suffix_p", lambda p: -F.log(p))
    base = F.array(*(F.lit(float(np.log(x))) for x in share))
    scores = _added(F.col("evidence"), F.col("declared_log"), F.col("suffix_log"), base, prior, against)
    und = F.array(*(F.lit(0.0) for _ in range(k - 1)), F.lit(float(np.log(UND_PRIOR))))
    judged = joined.withColumn("posterior", _normalised(_added(scores, und)))
    names = F.array(*(F.lit(x) for x in langs))
    best = F.array_max("posterior")
    pick = F.array_position("posterior", best)
    return judged.select(
        *(F.col(f"k{i}").alias(c) for i, c in enumerate(keys)),
        F.element_at(names, pick.cast("int")).alias("language"),
        F.round(best, 6).alias("probability"),
        F.element_at(names, F.array_position("evidence", F.array_max("evidence")).cast("int")).alias("text_language"),
        F.nullif("declared", F.lit("")).alias("declared"),
        "n_grams",
        (F.element_at(names, pick.cast("int")) == UND).alias("rejected"),
    )


# Patterns of HTML and addresses.
_LANG = r"""(?i)<html\b[^>]*?\blang\s*=\s*["']?([A-Za-z]+)"""
_HIDDEN = r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->|<[^>]*>"


def page_columns(pages: DataFrame) -> DataFrame:
    """``page_id, text, declared, suffix, host`` of HTML pages."""
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.regexp_replace("html", _HIDDEN, " ").alias("text"),
        F.nullif(F.regexp_extract(F.coalesce("html", F.lit("")), _LANG, 1), F.lit("")).alias("declared"),
        F.substring_index(host, ".", -1).alias("suffix"),
        host.alias("host"),
    )


def document_columns(docs: DataFrame) -> DataFrame:
    """The same of documents: the stated language is the declaration, the source is the host."""
    return docs.select(
        F.xxhash64("doc_id", "text").alias("key"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.col("lang").cast("string").alias("declared"),
        F.lit("").alias("suffix"),
        F.col("source").cast("string").alias("host"),
    )


def identify_corpus(docs: DataFrame, pages: DataFrame) -> DataFrame:
    """Languages of all pages and documents, in one model; ids of the other kind are null."""
    rows = document_columns(docs).drop("key").withColumn("page_id", F.lit(None).cast("long")).unionByName(
        page_columns(pages).withColumn("doc_id", F.lit(None).cast("long"))
    )
    return identify(rows, fit_profiles(docs), ["doc_id", "page_id"], "text", "declared", "suffix", "host")


def keep_identified(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that no language claims."""
    found = identify(document_columns(docs), fit_profiles(docs), ["key"], "text", "declared", "suffix", "host")
    gone = save(found.where("rejected").select(F.col("key").alias("__lexquarry_key")).distinct(), "rejected")
    return without_keys(docs.withColumn("__lexquarry_key", F.xxhash64("doc_id", "text")), gone, "__lexquarry_key").drop("__lexquarry_key")
