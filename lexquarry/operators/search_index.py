"""Ranked search that is served by an index.

The index is a set of published tables (:mod:`lexquarry.sources.published`).  Chunks are laid
out in the order of their keys, which shuffles them once, and numbered in blocks of BLOCK rows.  ``postings`` holds, for
each token and block, the rows that hold the token, how often, and the greatest of these counts.
It is partitioned by the token's bucket and sorted by token, so that a request reads the
buckets of its own tokens and of these the row groups that hold them.

A search first reads the maxima alone, which bound the score of any row of a block.  Blocks
with the highest bounds are scored; from then on the k-th best score is a floor, and only
blocks whose bound reaches it are read.  The result equals a scan of all texts
(:func:`scan`) whatever the order.

A batch of changed chunks becomes a new segment with blocks of its own and a list of the keys
it replaces; a row counts only in the newest segment that names its key.

Defined cases: a null or empty text has no tokens; of repeated keys every row counts for
itself; a null key can be found but never replaced; a request without terms finds nothing.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexquarry.functions.text import normalize
from lexquarry.operators.search import Request, Rules
from lexquarry.scratch import drop, save
from lexquarry.sources.published import Table, Version, current, publish

#: Rows of a block; buckets of tokens; least and greatest length of a token; most occurrences that count.
BLOCK, BUCKETS, LEAST, LONGEST, MOST = 4096, 64, 3, 64, 12
#: Rows whose blocks are scored first, for each row asked for; up to so many blocks are named in the plan, more are joined.
FIRST, NAMED = 4, 1000
#: Texts of so many characters are searched for each of their words.
_SHORT = 12_000


def occurrences(normal: str) -> dict[str, int]:
    """Each distinct word of LEAST to LONGEST letters, with how often it occurs in the text, inside longer words too (not overlapping, up to MOST).

    Words of longer texts are broken into substrings that are looked up among the words, so the work follows the
    length of the text and not the square of its vocabulary.
    """
    words = Counter(normal.split(" "))
    tokens = {w: 0 for w in words if LEAST <= len(w) <= LONGEST}
    if len(normal) <= _SHORT:
        return {w: min(normal.count(w), MOST) for w in tokens}
    sizes = sorted({len(w) for w in tokens})
    for word, n in words.items():
        seen = set()
        for size in sizes:
            if size > len(word):
                break
            for i in range(len(word) - size + 1):
                part = word[i : i + size]
                if part in tokens and part not in seen:
                    seen.add(part)
                    tokens[part] += n * word.count(part)
    return {w: min(n, MOST) for w, n in tokens.items()}


def _posted(rows: int, number: int, most: int = 1 << 22):
    """Rows of ``key, kinds..., __norm`` in order to their places (``block, at, key, kinds...``) and, behind each block, its postings.

    A block lies in one task, so that its postings are made there and nothing but these is shuffled.  A block with
    more than ``most`` of them has a token's postings in several rows, which add up as those of several blocks do.
    """

    def lists(block: int, token: list[str], at: list[int], n: list[int]) -> dict[str, pa.Array]:
        coded = pa.array(token, pa.string()).dictionary_encode()
        codes = coded.indices.to_numpy()
        order = np.argsort(codes, kind="stable")
        ats, ns = np.array(at, np.int32)[order], np.array(n, np.int32)[order]
        size = np.bincount(codes, minlength=len(coded.dictionary))
        first = np.cumsum(size) - size
        offsets = pa.array(np.append(first, len(codes)).astype(np.int32))
        listed = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([pa.array(ats), pa.array(ns)], ["at", "n"]))
        return {"block": pa.array(np.full(len(size), block, np.int64)), "token": coded.dictionary, "most": pa.array(np.maximum.reduceat(ns, first)), "n": pa.array(size.astype(np.int32)), "rows": listed}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin = (number << 48) + (TaskContext.get().partitionId() << 28)
        done, token, at, n = 0, [], [], []
        schema = None

        def filled(columns: dict[str, pa.Array]) -> pa.RecordBatch:
            size = len(columns["block"])
            return pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(size, f.type)) for f in schema], schema=schema)

        for batch in batches:
            given = batch.schema.remove(batch.schema.get_field_index("__norm"))
            posting = [pa.field("token", pa.string()), pa.field("most", pa.int32()), pa.field("n", pa.int32()), pa.field("rows", pa.list_(pa.struct([("at", pa.int32()), ("n", pa.int32())])))]
            schema = pa.schema([pa.field("block", pa.int64()), pa.field("at", pa.int32()), *(pa.field(f"c{i}", f.type) for i, f in enumerate(given)), *posting])
            place = np.arange(done, done + len(batch))
            places = {"block": pa.array(begin + place // rows), "at": pa.array((place % rows).astype(np.int32))}
            yield filled(places | {f"c{i}": batch.column(f.name) for i, f in enumerate(given)})
            for normal in batch.column("__norm"):
                if token and (done % rows == 0 or len(token) > most):
                    yield filled(lists(begin + (done - 1) // rows, token, at, n))
                    token, at, n = [], [], []
                found = occurrences(normal.as_py() or "")
                token += found
                n += found.values()
                at += [done % rows] * len(found)
                done += 1
        if token:
            yield filled(lists(begin + (done - 1) // rows, token, at, n))

    return run


def _bucket(token: Column | str) -> Column:
    return F.pmod(F.xxhash64(token), F.lit(BUCKETS)).cast("int")


def _segment(chunks: DataFrame, key: str, text: str, kinds: list[str], number: int) -> tuple[dict[str, Table], DataFrame]:
    """The tables of one segment; block numbers hold the segment's number, so that blocks of segments differ."""
    rows = chunks.select(F.col(key).alias("key"), *(F.col(c) for c in kinds), normalize(text).alias("__norm"))
    names = ["key", *kinds]
    given = ", ".join(f"c{i} {rows.schema[c].dataType.simpleString()}" for i, c in enumerate(names))
    ranged = rows.repartitionByRange("key", F.xxhash64("__norm")).sortWithinPartitions("key")
    made = save(ranged.mapInArrow(_posted(BLOCK, number), f"block long, at int, {given}, token string, most int, n int, rows array<struct<at:int,n:int>>"), "posted")
    postings = made.where("token IS NOT NULL").select("token", "block", "most", "n", "rows", _bucket("token").alias("bucket"))
    docs = made.where("at IS NOT NULL").select("block", "at", *(F.col(f"c{i}").alias(c) for i, c in enumerate(names)))
    by_token = lambda df: df.repartitionByRange("bucket", "token", "block").sortWithinPartitions("bucket", "token", "block").write.partitionBy("bucket")
    by_block = lambda df: df.repartitionByRange("block").sortWithinPartitions("block", "at").write
    return {f"postings-{number}": Table(postings, laid_out=by_token), f"docs-{number}": Table(docs, laid_out=by_block)}, made


def build_index(chunks: DataFrame, folder: str, key: str, text: str, kinds: list[str] | None = None) -> Version:
    """Publish an index of all chunks, in place of one that is there; ``kinds`` are columns to rank by and to give back."""
    tables, made = _segment(chunks, key, text, kinds or [], 0)
    version = publish(chunks.sparkSession, folder, tables, carry=False)
    drop(made)
    return version


def update_index(changed: DataFrame, folder: str, key: str, text: str, removed: DataFrame | None = None) -> Version:
    """Publish the index with changed and new chunks, and without those whose keys are in ``removed``; only these are read."""
    spark = changed.sparkSession
    before = current(spark, folder)
    number = max(_segments(before)) + 1
    kinds = [c for c in before.table("docs-0").columns if c not in ("block", "at", "key")]
    tables, made = _segment(changed, key, text, kinds, number)
    keys = changed.select(F.col(key).alias("key"))
    keys = keys if removed is None else keys.unionByName(removed.select(F.col(key).alias("key")))
    tables[f"gone-{number}"] = Table(keys.where("key IS NOT NULL").distinct())
    version = publish(spark, folder, tables, after=before)
    drop(made)
    return version


def _segments(version: Version) -> list[int]:
    return sorted(int(name.split("-")[1]) for name in version.tables if name.startswith("docs-"))


def _of_tokens(version: Version, tokens: list[str]) -> DataFrame:
    """The postings of some tokens in all segments; buckets and tokens are literals, so that no others are read."""
    own = reduce(lambda a, b: a | b, (F.col("bucket") == _bucket(F.lit(t)) for t in tokens))
    parts = [version.table(f"postings-{k}").where(own & F.col("token").isin(tokens)) for k in _segments(version)]
    return reduce(DataFrame.unionByName, parts)


@dataclass(frozen=True)
class _Points:
    """A request as points: of terms, of boosts and of kinds."""

    terms: tuple[str, ...]
    anchors: tuple[str, ...]
    boosts: dict[str, int]
    kinds: tuple[tuple[str, int], ...]
    least: int

    @classmethod
    def of(cls, request: Request, rules: Rules) -> _Points:
        boosts: dict[str, int] = {}
        for domain, term, points in rules.boosts:
            if domain in request.domains:
                boosts[term] = boosts.get(term, 0) + points
        for word in (*request.terms, *request.anchors, *boosts):
            if not re.fullmatch(f"[a-z0-9]{{{LEAST},{LONGEST}}}", word):
                raise ValueError(f"the index holds words of {LEAST} to {LONGEST} letters or digits, not {word!r}")
        return cls(request.terms, request.anchors, boosts, request.preferred, request.least)

    @property
    def tokens(self) -> list[str]:
        return sorted({*self.terms, *self.anchors, *self.boosts})


def _scored(rows: DataFrame, points: _Points, kind: str | None) -> DataFrame:
    """Rows of enough terms and an anchor with their scores; ``rows`` has ``hits, anchored, part`` of each."""
    score = F.lit(40) + F.col("part")
    if kind:
        for name, more in points.kinds:
            score = score + F.when(F.col(kind) == name, more).otherwise(0)
    return rows.where((F.col("hits") >= points.least) & F.col("anchored")).withColumn("score", score.cast("long")).where("score > 0").withColumn("hits", F.col("hits").cast("long"))


def _sums(points: _Points, n: Column) -> dict[str, Column]:
    """Aggregates over the tokens of a row (``n`` their counts) or of a block (``n`` their maxima)."""
    term, anchor = F.col("token").isin(*points.terms), F.col("token").isin(*points.anchors) if points.anchors else F.lit(False)
    boost = reduce(lambda c, b: c.when(F.col("token") == b[0], b[1]), points.boosts.items(), F.when(F.lit(False), 0)).otherwise(0)
    return {
        "hits": F.count_if(term),
        "anchored": F.bool_or(anchor) if points.anchors else F.lit(True),
        "part": F.sum(F.when(term, 24 + n).otherwise(0) + boost),
        "upper": F.sum(F.when(term, 24 + n).otherwise(0) + F.greatest(boost, F.lit(0))),
    }


def _rows(version: Version, points: _Points, kind: str | None, blocks: list[int] | DataFrame) -> DataFrame:
    """The scored rows of some blocks: of a list, or of a table of ``block``."""

    def within(df: DataFrame) -> DataFrame:
        return df.where(F.col("block").isin(blocks)) if isinstance(blocks, list) else df.join(blocks, "block", "left_semi")

    posted = within(_of_tokens(version, points.tokens)).select("token", "block", F.explode("rows").alias("r")).select("token", "block", "r.at", "r.n")
    sums = _sums(points, F.col("n"))
    hits = posted.groupBy("block", "at").agg(sums["hits"].alias("hits"), sums["anchored"].alias("anchored"), sums["part"].alias("part"))
    parts = []
    for k in _segments(version):
        own = hits.where(F.shiftright("block", 48) == k)
        found = _scored(own.join(within(version.table(f"docs-{k}")), ["block", "at"]), points, kind)
        for later in (x for x in _segments(version) if x > k):
            found = found.join(version.table(f"gone-{later}"), "key", "left_anti")
        parts.append(found)
    return reduce(DataFrame.unionByName, parts).drop("block", "at", "anchored", "part")


def bounds(version: Version, request: Request, rules: Rules, kind: str | None = None) -> DataFrame:
    """``block, upper, n``: the blocks that may hold rows of a request, and what no row of theirs can exceed."""
    points = _Points.of(request, rules)
    extra = 40 + (sum(max(0, p) for _, p in points.kinds) if kind else 0)
    sums = _sums(points, F.col("most"))
    found = _of_tokens(version, points.tokens).groupBy("block").agg(sums["hits"].alias("hits"), sums["anchored"].alias("anchored"), (sums["upper"] + extra).alias("upper"), F.sum("n").alias("n"))
    return found.where((F.col("hits") >= points.least) & F.col("anchored")).select("block", "upper", "n")


def search(version: Version, request: Request, rules: Rules, k: int, kind: str | None = None) -> DataFrame:
    """The best ``k`` rows of a request by (score, key): ``key, hits, score`` and the index's kinds.

    A row of a term has 40 points, 24 for each term in it and the term's occurrences (12 at most), and the
    points of the request's domains and of its preferred kinds.  It must hold enough terms and one anchor.
    """
    points = _Points.of(request, rules)
    if not points.terms:
        none = version.table(f"docs-{_segments(version)[0]}").drop("block", "at").limit(0)
        return none.withColumns({"hits": F.lit(0).cast("long"), "score": F.lit(0).cast("long")})
    limits = save(bounds(version, request, rules, kind), "bounds")
    first, held = [], 0
    for block, n in limits.orderBy(F.desc("upper"), "block").limit(max(8, FIRST * k)).select("block", "n").collect():  # a few blocks
        if held < FIRST * k * len(points.tokens):
            first.append(block)
            held += n
    top = save(_ranked(_rows(version, points, kind, first), k), "top")
    scores = [r.score for r in top.select("score").collect()]  # k rows
    floor = min(scores) if len(scores) == k else 0
    rest = save(limits.where((F.col("upper") >= floor) & ~F.col("block").isin(first)).select("block"), "rest")
    drop(limits)
    more = [r.block for r in rest.limit(NAMED + 1).collect()]
    if not more:
        return top
    return _ranked(_rows(version, points, kind, more if len(more) <= NAMED else rest).unionByName(top), k)


def _ranked(rows: DataFrame, k: int) -> DataFrame:
    return rows.orderBy(F.desc("score"), "key").limit(k)


def scan(chunks: DataFrame, request: Request, rules: Rules, key: str, text: str, kinds: list[str] | None = None, kind: str | None = None) -> DataFrame:
    """The rows of a request with their scores, by reading all texts: what :func:`search` takes its best from."""
    points = _Points.of(request, rules)
    norm = F.concat(F.lit(" "), F.col("__norm"), F.lit(" "))
    has = lambda w: norm.contains(f" {w} ")
    count = lambda w: F.least(F.floor((F.length("__norm") - F.length(F.replace("__norm", F.lit(w), F.lit("")))) / len(w)), F.lit(MOST))
    zero = F.lit(0)
    rows = chunks.select(F.col(key).alias("key"), *(kinds or []), normalize(text).alias("__norm")).withColumns({
        "hits": sum((has(w).cast("int") for w in points.terms), zero),
        "anchored": reduce(lambda a, b: a | b, (has(w) for w in points.anchors)) if points.anchors else F.lit(True),
        "part": sum((F.when(has(w), 24 + count(w)).otherwise(0) for w in points.terms), zero) + sum((F.when(has(w), p).otherwise(0) for w, p in points.boosts.items()), zero),
    })
    return _scored(rows, points, kind).drop("__norm", "anchored", "part")
