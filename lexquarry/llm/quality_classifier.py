"""Quality and toxicity by hierarchical empirical Bayes.

Document evidence: the log likelihood ratio of a logistic regression over hashed
features (words and beginnings of words, once for occurring and once more for
making up a hundredth of the words; the symbols around words; and coarse shape
figures), of which it sees the MOST_FEATURES whose rates under the two labels differ most, by at least
SIGMAS standard errors.

Site evidence: sums of the document posteriors by host and by path give each
site's rate.  A path's rate is shrunk toward its host's and a host's toward the
corpus's, with strengths estimated from the spread between sites beyond what
chance gives (method of moments), so sparse sites stay near the corpus.  A row's
own share is taken out of its site before it is judged.  The posterior adds the
document's log odds to the log odds of its path's rate.

The classifier is fitted on at most about FIT_ROWS labelled rows, drawn by hash;
all sums are over all rows.

Defined cases: a null or empty text has no evidence and is judged by its site; a
null host or path is a site of its own; labels of unknown documents and null
labels are ignored, and repeated labels count each; without labels of both kinds
the evidence is nought; repeated rows are judged each; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexquarry.llm import _text as tx
from lexquarry.llm._skew import join_groups
from lexquarry.scratch import save

FIT_ROWS = 20_000
_FEATURE = (1 << 40) - 1
#: Bytes of the beginnings of words.
PREFIXES = (4, 5, 6, 7, 8)
SIGMAS = 4.0
MOST_FEATURES = 4096
RIDGE, DESCENTS, PACE = 1e-4, 400, 0.15
LEAST_ROWS = 5
TOXIC_FROM = 0.5
#: The fit also sees so many thinned copies of each text, with a feature's chance to stay, so that
#: features that mostly come together each carry weight alone.
THINNED, STAYS = 2, 0.5
MOST_EVIDENCE = 12.0
LEAST_STRENGTH, MOST_STRENGTH = 2.0, 1000.0
_WINDOW = 1 << 20


def _pair(row: np.ndarray, h: np.ndarray) -> np.ndarray:
    return row.astype(np.int64) * np.int64(1 << 40) + (h >> np.uint64(24)).astype(np.int64)


def _shape(row: np.ndarray, kind: int, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return row, tx.mix(value.astype(np.int64).view(np.uint64) * np.uint64(64) + np.uint64(kind))


def _features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, feature) of each text; a feature is a hash of 40 bits."""
    rows = np.arange(len(column))
    plain = tx.scan(column, tx.ALNUM)
    raw = tx.scan(column, tx.SPACED, lower=False)
    n = np.maximum(raw.per_row, 1)
    parts = []
    for row, h in ((plain.row, plain.hash), *(tx.prefixes(plain, size) for size in PREFIXES)):
        pairs, times = np.unique(_pair(row, h), return_counts=True)
        row, h = pairs >> 40, (pairs & _FEATURE).astype(np.uint64) << np.uint64(24)
        often = 100 * times >= n[row]
        parts += [(row, h), (row[often], tx.mix(h[often]))]
    end = raw.buf[raw.end - 1] if len(raw.end) else np.zeros(0, np.uint8)
    other = ~tx.ALNUM[tx._LOWER[end]]
    two = end.astype(np.int64) * 256 + np.where(raw.end - raw.start > 1, raw.buf[np.maximum(raw.end - 2, 0)] if len(raw.end) else 0, 0)
    parts.append(_shape(raw.row[other], 1, np.where(end == raw.buf[np.maximum(raw.end - 2, 0)], two, end)[other]) if len(raw.end) else _shape(rows[:0], 1, rows[:0]))
    upper = (raw.buf >= 0x41) & (raw.buf <= 0x5A)
    owner = np.repeat(rows, np.diff(raw.offsets))
    sizes = np.maximum(np.diff(raw.offsets), 1)
    kinds = np.unique(_pair(raw.row, raw.hash))
    distinct = np.bincount(kinds >> 40, minlength=len(column))
    parts.append(_shape(rows, 2, np.log2(n).astype(np.int64)))
    parts.append(_shape(rows, 3, 20 * np.bincount(owner[upper], minlength=len(column)) // sizes))
    parts.append(_shape(rows, 4, 10 * distinct // n))
    parts.append(_shape(rows, 5, 10 * np.bincount(raw.row[other], minlength=len(column)) // n))
    parts.append(_shape(rows, 6, np.minimum(sizes // n, 30)))
    row, h = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    pairs = np.unique(_pair(row, h))
    full = np.diff(raw.offsets) > 0
    row, feature = pairs >> 40, pairs & _FEATURE
    keep = full[row]
    return row[keep], feature[keep]


def _feature_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, j in tx.slices(batch.column("text"), _WINDOW):
            part = batch.slice(i, j - i)
            row, feature = _features(part.column("text"))
            label = part.column("label").to_numpy().astype(np.int64)[row]
            pairs, n = np.unique(feature * 2 + label, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(pairs // 2), pa.array(pairs % 2, pa.int32()), pa.array(n, pa.int64())], names=["feature", "label", "n"])


def _places(told: np.ndarray, feature: np.ndarray) -> np.ndarray:
    """The place of each feature in the sorted ``told``, or -1."""
    if not len(told):
        return np.full(len(feature), -1)
    at = np.minimum(np.searchsorted(told, feature), len(told) - 1)
    return np.where(told[at] == feature, at, -1)


def _told_features(told: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j in tx.slices(batch.column("text"), _WINDOW):
                part = batch.slice(i, j - i)
                row, feature = _features(part.column("text"))
                place = _places(told, feature)
                counts = np.bincount(row[place >= 0], minlength=len(part))
                yield pa.RecordBatch.from_arrays(
                    [part.column("label"), tx.list_array(place[place >= 0].astype(np.int32), counts, pa.int32())], names=["label", "features"]
                )

    return run


def _descend(owner: np.ndarray, feature: np.ndarray, label: np.ndarray, k: int) -> tuple[np.ndarray, float]:
    """Ridge logistic regression over binary features, by gradient steps of adaptive size."""
    w, first, second = np.zeros(k + 1), np.zeros(k + 1), np.zeros(k + 1)
    for step in range(1, DESCENTS + 1):
        z = w[k] + np.bincount(owner, weights=w[feature], minlength=len(label))
        off = 1 / (1 + np.exp(-z)) - label
        slope = np.append(np.bincount(feature, weights=off[owner], minlength=k), off.sum()) / len(label)
        slope[:k] += RIDGE * w[:k]
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope * slope
        w -= PACE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8) / np.sqrt(1 + step / 50)
    return w[:k], float(w[k])


@dataclass
class Evidence:
    """The log likelihood ratio: ``constant`` and the ``weights`` of the sorted ``told`` features (MOST_FEATURES at most)."""

    told: np.ndarray
    weights: np.ndarray
    constant: float


def fit_weights(labelled: DataFrame) -> Evidence:
    """Fitted on rows of ``(text, label)``."""
    rows = labelled.where("text IS NOT NULL AND label IN (0, 1)")
    share = FIT_ROWS / max(rows.count(), 1)
    draw = F.shiftrightunsigned(F.xxhash64("text", F.lit(7)), 11) / float(1 << 53)
    drawn = save((rows.where(draw < share) if share < 1 else rows).select("text", F.col("label").cast("int").alias("label")), "drawn")
    sizes = dict(drawn.groupBy("label").count().collect())
    if not sizes.get(0) or not sizes.get(1):
        return Evidence(np.zeros(0, np.int64), np.zeros(0), 0.0)
    n0, n1 = float(sizes[0]), float(sizes[1])
    counts = (
        drawn.mapInArrow(_feature_counts, "feature long, label int, n long")
        .groupBy("feature")
        .agg(F.sum(F.when(F.col("label") == 0, F.col("n")).otherwise(0)).alias("a"), F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("b"))
        .where(F.col("a") + F.col("b") >= LEAST_ROWS)
    )
    pool = (F.col("a") + F.col("b") + 0.5) / (n0 + n1 + 1.0)
    error = F.sqrt(pool * (1 - F.least(pool, F.lit(0.999))) * (1 / n0 + 1 / n1))
    sigmas = F.abs((F.col("b") + 0.5) / (n1 + 1.0) - (F.col("a") + 0.5) / (n0 + 1.0)) / error
    best = counts.select("feature", sigmas.alias("sigmas")).where(F.col("sigmas") > SIGMAS).orderBy(F.desc("sigmas"), "feature").limit(MOST_FEATURES)
    told = np.sort(np.array([r.feature for r in best.collect()], dtype=np.int64))
    sample = drawn.mapInArrow(_told_features(told), "label int, features array<int>").toArrow().combine_chunks()  # about FIT_ROWS rows
    features = sample.column("features").combine_chunks()
    label = sample.column("label").to_numpy().astype(float)
    owner = np.repeat(np.arange(len(label)), np.diff(features.offsets.to_numpy()))
    flat = features.values.to_numpy()[features.offsets[0].as_py() :]
    draws = np.random.default_rng(len(flat))
    owners, flats = [owner], [flat]
    for copy in range(1, THINNED + 1):
        stays = draws.random(len(flat)) < STAYS
        owners.append(owner[stays] + copy * len(label))
        flats.append(flat[stays])
    weights, constant = _descend(np.concatenate(owners), np.concatenate(flats), np.tile(label, THINNED + 1), len(told))
    return Evidence(told, weights, constant - float(np.log((n1 + 1) / (n0 + 1))))


def _evidence(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = shared.value
        for batch in batches:
            for i, j in tx.slices(batch.column("text"), _WINDOW):
                part = batch.slice(i, j - i)
                row, feature = _features(part.column("text"))
                some = np.bincount(row, minlength=len(part)) > 0
                sums = []
                for t in tables:
                    place = _places(t.told, feature)
                    got = place >= 0
                    total = t.constant + np.bincount(row[got], weights=t.weights[place[got]], minlength=len(part))
                    sums.append(np.where(some, np.clip(total, -MOST_EVIDENCE, MOST_EVIDENCE), 0.0))
                names = [c for c in part.schema.names if c != "text"]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in names), *(pa.array(s, pa.float64()) for s in sums)], names=[*names, *(f"e{k}" for k in range(len(sums)))]
                )

    return run


def _logit(p: Column) -> Column:
    p = F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), p))
    return F.log(p / (1 - p))


def _sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def _strength(sites: DataFrame, total: str, n: str, rate: float) -> float:
    """Pseudo-rows of the prior, from the spread of site rates beyond binomial chance."""
    p = F.col(total) / F.col(n)
    seen = sites.where(F.col(n) >= 2).agg(F.sum(F.col(n) * (p - rate) * (p - rate)), F.sum(n), F.count("*")).first()
    if not seen[1]:
        return MOST_STRENGTH
    spread = seen[0] / seen[1] - rate * (1 - rate) * seen[2] / seen[1]
    if spread <= 0:
        return MOST_STRENGTH
    return float(min(MOST_STRENGTH, max(LEAST_STRENGTH, rate * (1 - rate) / spread - 1)))


def classify(rows: DataFrame, evidence: list[Evidence], rates: list[float], keys: list[str]) -> DataFrame:
    """``keys`` with ``p_document``, ``p_host``, ``p_path`` and ``posterior``, each an array over the labels.

    ``rows`` has ``text``, ``host`` and ``path``; ``rates`` are the labels' shares.
    """
    shared = rows.sparkSession.sparkContext.broadcast(evidence)  # MOST_FEATURES numbers at most for each label
    named = rows.select(*keys, F.coalesce("host", F.lit("")).alias("host"), F.coalesce("path", F.lit("")).alias("path"), F.col("text").cast("string").alias("text"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in named.schema if f.name != "text")
    kinds = range(len(evidence))
    read = save(named.mapInArrow(_evidence(shared), schema + "".join(f", e{k} double" for k in kinds)), "evidence")
    read = read.withColumns({f"d{k}": _sigmoid(F.col(f"e{k}") + float(np.log(rates[k] / (1 - rates[k])))) for k in kinds})
    paths = save(read.groupBy("host", "path").agg(F.count("*").alias("path_n"), *(F.sum(f"d{k}").alias(f"path_{k}") for k in kinds)), "paths")
    hosts = paths.groupBy("host").agg(F.sum("path_n").alias("host_n"), *(F.sum(f"path_{k}").alias(f"host_{k}") for k in kinds))
    whole = hosts.agg(F.sum("host_n"), *(F.sum(f"host_{k}") for k in kinds)).first()
    if not whole[0]:
        whole = [1, *rates]
    mean = [min(max(whole[k + 1] / whole[0], 1e-6), 1 - 1e-6) for k in kinds]
    host_s = [_strength(hosts, f"host_{k}", "host_n", mean[k]) for k in kinds]
    path_s = [_strength(paths, f"path_{k}", "path_n", mean[k]) for k in kinds]
    sites = paths.join(hosts, "host")
    joined = join_groups(read, sites, ["host", "path"], "path_n")

    def rate(k: int) -> tuple[Column, Column]:
        host = (F.col(f"host_{k}") - F.col(f"d{k}") + host_s[k] * mean[k]) / (F.col("host_n") - 1 + host_s[k])
        path = (F.col(f"path_{k}") - F.col(f"d{k}") + path_s[k] * host) / (F.col("path_n") - 1 + path_s[k])
        return host, path

    return joined.select(
        *keys,
        F.array(*(F.round(f"d{k}", 6) for k in kinds)).alias("p_document"),
        F.array(*(F.round(rate(k)[0], 6) for k in kinds)).alias("p_host"),
        F.array(*(F.round(rate(k)[1], 6) for k in kinds)).alias("p_path"),
        F.array(*(F.round(_sigmoid(F.col(f"e{k}") + _logit(rate(k)[1])), 6) for k in kinds)).alias("posterior"),
    )


LABELS = ("quality", "toxic")


def classify_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row: ``doc_id``, posteriors of quality and toxicity with their parts, and ``kept``.

    The source is the host and (source, language) the path.
    """
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("source").cast("string").alias("host"), F.concat_ws("/", "source", "lang").alias("path"))
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), *(F.col(c).cast("int").alias(c) for c in LABELS))
    share = min(1.0, 1.5 * FIT_ROWS / max(known.count(), 1))  # no more texts are shuffled than the fit needs
    known = save(known.where(F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(3)), 11) / float(1 << 53) < share), "labels")
    labelled = save(own.join(known, "doc_id").select("text", *LABELS), "labelled")
    evidence, rates = [], []
    for c in LABELS:
        rows = labelled.select("text", F.col(c).alias("label"))
        evidence.append(fit_weights(rows))
        n, ones = rows.where("label IN (0, 1)").agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
        rates.append((ones + 1) / (n + 2))
    found = classify(own, evidence, rates, ["doc_id"])
    quality, toxic = F.col("posterior")[0], F.col("posterior")[1]
    return found.select(
        "doc_id",
        quality.alias("quality"),
        toxic.alias("toxicity"),
        F.col("p_document").alias("document_evidence"),
        F.col("p_host").alias("host_rates"),
        F.col("p_path").alias("path_rates"),
        (toxic >= TOXIC_FROM).alias("toxic"),
        ((quality >= 0.5) & (toxic < TOXIC_FROM)).alias("kept"),
    )
