"""Language-model scores from a log-frequency Bloom filter.

Counts c of words and word pairs, single ones included, are quantised as
q = 1 + floor(log_b c) and the events (gram, 1) ... (gram, q) are put in a Bloom
filter; a count is read back by probing (gram, 1), (gram, 2), ... until one is
missing, and stands for the mean count of that level over the corpus.

Grams are dealt by hash to slots, one for about SLOT_TOKENS training tokens, and
each slot's bits are BITS_PER_EVENT for each of its events, so the filter grows
with what was counted, at an even chance of false hits, and depends on the data
alone.  A filter of up to MODEL_BYTES is broadcast.  A larger one stays in its
slots: the distinct grams of each slice of texts go to the slots, are probed
there, and their levels come back to the slice.  Both ways probe the same bits.

The model is a bigram with Dirichlet smoothing toward the word distribution:
P(w | h) = (c(h, w) + K P(w)) / (c(h) + K) and P(w) = (c(w) + 0.5) / (N + 0.5 (V + 1)).
Each text is read as <start> words <end>; the end counts as a token.

The base score uses exact counts: those of the HOT most frequent words travel as
a bounded array, all others by a join on the word.

Defined cases: a null text is empty and scores its end alone; a null doc_id is
not held out; repeated rows are learnt from and scored each; a text longer than a
slice is a slice of its own; ties in the choice of the HOT words go by word hash and
change no result; with nothing to learn from N = V = 0; only id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexquarry.llm import _text as tx
from lexquarry.scratch import save

FOLDS, HELD_OUT = 5, 1
BASE = 1.5
PROBES = 5
#: With 5 probes, some 2 % of unseen grams are taken for single ones.
BITS_PER_EVENT = 8
SLOT_TOKENS, LEAST_SLOTS = 1 << 17, 64
#: The largest filter that is broadcast, held once by each worker.
MODEL_BYTES = 128 << 20
K = 400.0
HOT = 1 << 19
#: Tokens whose pairs are counted together; a pair of so many occurrences in them is counted over the whole task.
WINDOW, FREQUENT = 1_000_000, 64

END, START = tx.mix(np.array([0xE0D, 0x57A7], dtype=np.uint64))
_LEVELS = 64


def _tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token hashes with each row's end, the token before each, and tokens per row."""
    words = tx.scan(column, tx.SPACED)
    counts = words.per_row + 1
    last = np.cumsum(counts) - 1
    out = np.full(int(counts.sum()), END, np.uint64)
    inside = np.ones(len(out), dtype=bool)
    inside[last] = False
    out[inside] = words.hash
    before = np.empty_like(out)
    before[1:] = out[:-1]
    before[last - counts + 1] = START
    return out, before, counts


def _pair(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return tx.mix(tx.mix(before + np.uint64(2)) ^ word)


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0

    def flush() -> pa.RecordBatch:
        values, counts = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(tx.signed(values)), pa.array(counts, pa.int64())], names=["word", "c"])

    for batch in batches:
        for i, j in tx.slices(batch.column("text")):
            held.append(_tokens(batch.column("text").slice(i, j - i))[0])
            size += len(held[-1])
            if size >= WINDOW:
                yield flush()
                held, size = [], 0
    if held:
        yield flush()


def slots_for(tokens: int) -> int:
    """A power of two, so that a slot gets about SLOT_TOKENS tokens of the corpus."""
    return 1 << max(LEAST_SLOTS.bit_length() - 1, (max(tokens, 1) // SLOT_TOKENS).bit_length())


def _in_slots(grams: np.ndarray, slots: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The order by slot; then, of the slots in use, names and sizes, and the grams' prints in that order."""
    slot = grams & np.uint64(slots - 1)
    by = np.argsort(slot, kind="stable")
    names, first = np.unique(slot[by], return_index=True)
    return by, names.astype(np.int32), np.diff(np.append(first, len(by))), (grams[by] >> np.uint64(32)).astype(np.uint32)


def _by_slot(grams: np.ndarray, counts: np.ndarray, size: int, slots: int) -> pa.RecordBatch:
    """One row for each slot, with its grams and their counts."""
    by, names, sizes, prints = _in_slots(grams, slots)
    return pa.RecordBatch.from_arrays(
        [pa.array(names), pa.array(np.full(len(names), size, np.int32)), tx.list_array(prints.view(np.int32), sizes, pa.int32()), tx.list_array(counts[by].astype(np.int64), sizes)],
        names=["slot", "size", "grams", "counts"],
    )


class _Frequent:
    """Counts of a task's frequent grams, which leave it once and not with every window.

    A window's grams of FREQUENT and more occurrences are few (WINDOW / FREQUENT); what is held is let go at WINDOW grams.
    """

    def __init__(self) -> None:
        self.grams, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def rest(self, grams: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The window's grams without its frequent ones, which are added up."""
        many = counts >= FREQUENT
        self.grams, back = np.unique(np.concatenate([self.grams, grams[many]]), return_inverse=True)
        self.counts = np.bincount(back, weights=np.concatenate([self.counts, counts[many]]), minlength=len(self.grams)).astype(np.int64)
        return grams[~many], counts[~many]


def _pair_counts(slots: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, frequent = [], 0, _Frequent()
        for batch in batches:
            for i, j in tx.slices(batch.column("text")):
                word, before, _ = _tokens(batch.column("text").slice(i, j - i))
                held.append(_pair(before, word))
                size += len(word)
                if size >= WINDOW:
                    yield _by_slot(*frequent.rest(*np.unique(np.concatenate(held), return_counts=True)), 2, slots)
                    held, size = [], 0
                    if len(frequent.grams) >= WINDOW:
                        yield _by_slot(frequent.grams, frequent.counts, 2, slots)
                        frequent = _Frequent()
        if held:
            yield _by_slot(*frequent.rest(*np.unique(np.concatenate(held), return_counts=True)), 2, slots)
        if len(frequent.grams):
            yield _by_slot(frequent.grams, frequent.counts, 2, slots)

    return run


def _words_by_slot(slots: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                yield _by_slot(batch.column("word").to_numpy().view(np.uint64), batch.column("c").to_numpy(), 1, slots)

    return run


def level_of(counts: np.ndarray) -> np.ndarray:
    return np.minimum(1 + np.floor(np.log(counts) / np.log(BASE) + 1e-9).astype(np.int64), _LEVELS - 1)


def _bit(prints: np.ndarray, level: int, bits: np.ndarray | np.uint64, k: int) -> np.ndarray:
    """The k-th bit of the event (gram, level) inside a slot of ``bits`` bits."""
    a = tx.mix(prints.astype(np.uint64) ^ np.uint64(level * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
    return (a + np.uint64(k) * (tx.mix(a) | np.uint64(1))) % bits


def _fill(prints: np.ndarray, counts: np.ndarray, pairs: np.ndarray, per_event: int) -> tuple[np.ndarray, dict]:
    """The bytes of one slot; also the number of grams and sum of counts at each (size, level)."""
    levels = level_of(counts)
    bits = np.uint64(-(-int(levels.sum()) * per_event // 64) * 64)
    filled = np.zeros(int(bits), dtype=np.uint8)
    stats = {}
    for size, own in ((1, ~pairs), (2, pairs)):
        n = np.bincount(levels[own], minlength=_LEVELS)
        total = np.bincount(levels[own], weights=counts[own], minlength=_LEVELS)
        stats[size] = [(int(k), int(n[k]), int(total[k])) for k in np.flatnonzero(n)]
    level = 1
    while len(prints):
        for k in range(PROBES):
            filled[_bit(prints, level, bits, k).astype(np.int64)] = 1
        level += 1
        live = levels >= level
        prints, levels = prints[live], levels[live]
    return np.packbits(filled, bitorder="little"), stats


def _slot_row(slot: int, size: np.ndarray, grams: np.ndarray, counts: np.ndarray, per_event: int) -> pa.RecordBatch:
    found = []
    for k in (1, 2):
        own = size == k
        if own.any():
            g, inverse = np.unique(grams[own], return_inverse=True)
            c = np.bincount(inverse, weights=counts[own]).astype(np.int64)
            found.append((g, c, np.full(len(g), k == 2)))
    packed, stats = _fill(*(np.concatenate([f[k] for f in found]) for k in range(3)), per_event)
    flat = [(k, *x) for k, rows in stats.items() for x in rows]
    return pa.RecordBatch.from_arrays(
        [pa.array([slot], pa.int32()), pa.array([packed.tobytes()], pa.binary()), *(pa.array([[f[k] for f in flat]], pa.list_(pa.int64())) for k in range(4))],
        names=["slot", "bits", "size", "level", "n", "total"],
    )


def _flat(batch: pa.RecordBatch) -> list[np.ndarray]:
    """Slot, size, print and count of every gram of rows of lists, however short the lists are."""
    lists = batch.column("grams")
    times = lists.value_lengths().to_numpy(zero_copy_only=False)
    grams = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint32)
    return [*(np.repeat(batch.column(c).to_numpy(zero_copy_only=False), times) for c in ("slot", "size")), grams, batch.column("counts").flatten().to_numpy(zero_copy_only=False)]


def _runs(of: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin, and the end."""
    return np.concatenate([[0], np.flatnonzero(of[1:] != of[:-1]) + 1, [len(of)]])


def _build(per_event: int):
    """From rows sorted by slot: whole slots are built as they end, and the grams of the last one are held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        for batch in batches:
            new = _flat(batch)
            if not len(new[0]):
                continue
            if held and new[0][-1] == held[0][0][0]:  # still the slot that is held
                held.append(new)
                continue
            slot, size, grams, counts = (np.concatenate(x) for x in zip(*held, new, strict=True))
            ends = _runs(slot)
            for i, j in zip(ends[:-2], ends[1:-1], strict=True):
                yield _slot_row(int(slot[i]), size[i:j], grams[i:j], counts[i:j], per_event)
            held = [[x[ends[-2] :] for x in (slot, size, grams, counts)]]
        if held:
            slot, size, grams, counts = (np.concatenate(x) for x in zip(*held, strict=True))
            yield _slot_row(int(slot[0]), size, grams, counts, per_event)

    return run


def _levels(prints: np.ndarray, bits: np.ndarray, data: np.ndarray, base: np.ndarray) -> np.ndarray:
    """Probe level after level until one is missing; ``bits`` and ``base`` (in bytes) are those of each print's slot."""
    level = np.zeros(len(prints), np.uint8)
    live = np.flatnonzero(bits > 0)
    at = 1
    while len(live) and at < _LEVELS:
        for k in range(PROBES):
            bit = _bit(prints[live], at, bits[live], k)
            byte = data[base[live] + (bit >> np.uint64(3)).astype(np.int64)]
            live = live[(byte >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1]
        level[live] = at
        at += 1
    return level


class Filter:
    """The whole filter as held by each worker: the bytes of its slots one after the other."""

    def __init__(self, bits: np.ndarray, data: np.ndarray):
        self.bits, self.data = bits, data
        self.base = np.concatenate([[0], np.cumsum(bits)]).astype(np.int64) // 8

    def levels(self, grams: np.ndarray) -> np.ndarray:
        slot = (grams & np.uint64(len(self.bits) - 1)).astype(np.int64)
        return _levels((grams >> np.uint64(32)).astype(np.uint32), self.bits[slot], self.data, self.base[slot])


def _level_means(stats: dict[tuple[int, int], tuple[int, int]]) -> np.ndarray:
    means = np.zeros((3, _LEVELS))
    for size in (1, 2):
        for level in range(1, _LEVELS):
            n, total = stats.get((size, level), (0, 0))
            means[size][level] = total / n if n else BASE ** (level - 0.5)
    return means


class _Slice:
    """Tokens of some texts, and the distinct grams to look up: words, then the start, then pairs."""

    def __init__(self, column: pa.Array):
        self.word, before, self.counts = _tokens(column)
        self.kinds, self.inverse = np.unique(self.word, return_inverse=True)
        self.twos, self.back = np.unique(_pair(before, self.word), return_inverse=True)
        self.grams = np.concatenate([self.kinds, [START], self.twos])


def _scored(part: pa.RecordBatch, x: _Slice, levels: np.ndarray, means: np.ndarray, hot: tuple[np.ndarray, np.ndarray], floor: float) -> pa.RecordBatch:
    rows, n = len(part), len(x.kinds)
    row = np.repeat(np.arange(rows), x.counts)
    hot_words, hot_counts = hot
    at = np.minimum(np.searchsorted(hot_words, x.kinds), max(len(hot_words) - 1, 0))
    known = hot_words[at] == x.kinds if len(hot_words) else np.zeros(n, dtype=bool)
    log = np.where(known, np.log10((hot_counts[at] if len(hot_words) else np.zeros(n)) + 0.5), 0.0)
    rare = np.flatnonzero(~known[x.inverse])
    pairs, times = np.unique(row[rare] * n + x.inverse[rare], return_counts=True)
    owner, kind = np.divmod(pairs, max(n, 1))

    words, start, twos = means[1][levels[:n]], means[1][levels[n]], means[2][levels[n + 1 :]]
    history = np.empty(len(x.word))
    history[1:] = words[x.inverse][:-1]
    history[np.cumsum(x.counts) - x.counts] = start
    pair = np.minimum(twos[x.back], np.minimum(history, words[x.inverse]))
    p = (pair + K * ((words + 0.5) / floor)[x.inverse]) / (history + K)
    return pa.RecordBatch.from_arrays(
        [
            part.column("row"),
            part.column("doc_id"),
            part.column("held_out"),
            pa.array(x.counts, pa.int64()),
            pa.array(np.bincount(row, weights=known[x.inverse], minlength=rows).astype(np.int64)),
            pa.array(np.bincount(row, weights=log[x.inverse], minlength=rows)),
            pa.array(np.bincount(row, weights=np.log10(p), minlength=rows)),
            tx.list_array(tx.signed(x.kinds[kind]), np.bincount(owner, minlength=rows)),
            tx.list_array(times.astype(np.int32), np.bincount(owner, minlength=rows), pa.int32()),
        ],
        names=["row", "doc_id", "held_out", "n_tokens", "hot_known", "hot_log", "score", "rare", "times"],
    )


_SCORED = "row long, doc_id long, held_out boolean, n_tokens long, hot_known long, hot_log double, score double, rare array<long>, times array<int>"


def _score_with(model, means: np.ndarray, hot, floor: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j in tx.slices(batch.column("text")):
                part = batch.slice(i, j - i)
                x = _Slice(part.column("text"))
                yield _scored(part, x, model.value.levels(x.grams), means, hot.value, floor)

    return run


_TEXTS = ("row", "doc_id", "held_out", "text")


def _sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts packed into rows of one slice each."""
    for batch in batches:
        for i, j in tx.slices(batch.column("text")):
            part = batch.slice(i, j - i)
            cuts = pa.array([0, len(part)], pa.int32())
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(cuts, part.column(c)) for c in _TEXTS], names=list(_TEXTS))


def _asked(slots: int):
    """For each slice and slot, the prints to look up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, texts in zip(batch.column("slice").to_pylist(), batch.column("text"), strict=True):
                _, names, sizes, prints = _in_slots(_Slice(texts.values).grams, slots)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names), pa.array(np.full(len(names), name, np.int64)), tx.list_array(prints.view(np.int32), sizes, pa.int32())], names=["slot", "slice", "prints"]
                )

    return run


def _answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by slot, the slot's bits (slice -1) before what is asked of it: levels.  The rows of a slot are answered together."""
    slot, data = None, np.zeros(0, np.uint8)
    for batch in batches:
        slots, names = batch.column("slot").to_numpy(), batch.column("slice").to_numpy()
        asked = batch.column("prints").fill_null([])
        times = asked.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        prints = asked.flatten().to_numpy(zero_copy_only=False).view(np.uint32)
        ends = np.concatenate([[0], np.cumsum(times)])
        levels = np.zeros(len(prints), np.uint8)
        cuts = _runs(slots) if len(slots) else []
        for i, j in zip(cuts[:-1], cuts[1:], strict=True):
            if slots[i] != slot:
                slot, data = slots[i], np.zeros(0, np.uint8)
            if names[i] < 0:
                data = np.frombuffer(batch.column("bits")[int(i)].as_buffer(), np.uint8)
            own = slice(ends[i], ends[j])
            levels[own] = _levels(prints[own], np.full(ends[j] - ends[i], 8 * len(data), np.uint64), data, np.zeros(ends[j] - ends[i], np.int64))
        said = np.flatnonzero(names >= 0)  # a slot's bits have no prints, so the levels of the others lie end to end
        offsets = np.concatenate([[0], np.cumsum(times[said])]).astype(np.int32)
        answers = pa.Array.from_buffers(pa.binary(), len(said), [None, pa.py_buffer(offsets), pa.py_buffer(levels)])
        yield pa.RecordBatch.from_arrays([pa.array(names[said]), pa.array(slots[said]), answers], names=["slice", "slot", "levels"])


def _bytes(column: pa.Array) -> np.ndarray:
    """All bytes of a binary column, end to end."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]] if len(column) else np.zeros(0, np.uint8)


def _score_answered(slots: int, means: np.ndarray, hot, floor: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                part = pa.RecordBatch.from_arrays([batch.column(c)[k].values for c in _TEXTS], names=list(_TEXTS))
                x = _Slice(part.column("text"))
                levels = np.empty(len(x.grams), np.uint8)
                levels[_in_slots(x.grams, slots)[0]] = _bytes(batch.column("answers")[k].values.field("levels"))
                yield _scored(part, x, levels, means, hot.value, floor)

    return run


def _score_by_slots(texts: DataFrame, built: DataFrame, slots: int, means: np.ndarray, hot, floor: float) -> DataFrame:
    """Scores by a filter of any size: grams go to their slots, and levels come back."""
    listed = "row array<long>, doc_id array<long>, held_out array<boolean>, text array<string>"
    slices = save(texts.mapInArrow(_sliced, listed).withColumn("slice", F.monotonically_increasing_id()), "slices")
    asked = slices.select("slice", "text").mapInArrow(_asked(slots), "slot int, slice long, prints array<int>")
    both = asked.withColumn("bits", F.lit(None).cast("binary")).unionByName(
        built.select("slot", F.lit(-1).cast("long").alias("slice"), "bits", F.lit(None).cast("array<int>").alias("prints"))
    )
    levels = both.repartition("slot").sortWithinPartitions("slot", "slice").mapInArrow(_answered, "slice long, slot int, levels binary")
    answers = levels.groupBy("slice").agg(F.sort_array(F.collect_list(F.struct("slot", "levels"))).alias("answers"))  # a byte for each gram of a slice
    return slices.join(answers, "slice").select(*_TEXTS, "answers").mapInArrow(_score_answered(slots, means, hot, floor), _SCORED)


def _held_out() -> F.Column:
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(FOLDS)) == HELD_OUT, F.lit(False))


def score_documents(docs: DataFrame) -> DataFrame:
    """Per row: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), _held_out().alias("held_out"))
    learnt = texts.where("NOT held_out").select("text")
    vocabulary = save(learnt.mapInArrow(_word_counts, "word long, c long").groupBy("word").agg(F.sum("c").alias("c")), "words")
    total, distinct, starts = vocabulary.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*"), F.max(F.when(F.col("word") == int(np.array([END]).view(np.int64)[0]), F.col("c")))).first()

    slots = slots_for(total)
    shape = "slot int, size int, grams array<int>, counts array<long>"
    start = spark.createDataFrame([(int(np.array([START]).view(np.int64)[0]), int(starts or 0))], "word long, c long").where("c > 0")
    grams = learnt.mapInArrow(_pair_counts(slots), shape).unionByName(vocabulary.unionByName(start).mapInArrow(_words_by_slot(slots), shape))
    sorted_grams = grams.repartition("slot").sortWithinPartitions("slot")
    built = save(sorted_grams.mapInArrow(_build(BITS_PER_EVENT), "slot int, bits binary, size array<long>, level array<long>, n array<long>, total array<long>"), "filter")
    flat = built.select(F.explode(F.arrays_zip("size", "level", "n", "total")).alias("x")).groupBy("x.size", "x.level").agg(F.sum("x.n").alias("n"), F.sum("x.total").alias("c"))
    means = _level_means({(r["size"], r["level"]): (r["n"], r["c"]) for r in flat.collect()})  # 2 * _LEVELS rows at most
    top = vocabulary.orderBy(F.desc("c"), "word").limit(HOT).toArrow()  # HOT rows of 16 bytes at most
    words, counts = top.column("word").to_numpy().view(np.uint64), top.column("c").to_numpy()
    order = np.argsort(words)
    hot = spark.sparkContext.broadcast((words[order], counts[order]))
    texts = texts.withColumn("row", F.monotonically_increasing_id())

    weight = built.agg(F.coalesce(F.sum(F.octet_length("bits")), F.lit(0))).first()[0]
    floor = total + 0.5 * (distinct + 1)
    if weight <= MODEL_BYTES:
        bits, held = np.zeros(slots, np.uint64), [b""] * slots
        for r in built.select("slot", "bits").toLocalIterator():  # MODEL_BYTES at most
            held[r.slot] = bytes(r.bits)
            bits[r.slot] = 8 * len(r.bits)
        model = spark.sparkContext.broadcast(Filter(bits, np.frombuffer(b"".join(held), np.uint8)))
        scored = texts.select(*_TEXTS).mapInArrow(_score_with(model, means, hot, floor), _SCORED)
    else:
        scored = _score_by_slots(texts, built, slots, means, hot, floor)
    scored = save(scored, "scored")
    rare = scored.select("row", F.explode(F.arrays_zip("rare", "times")).alias("x")).select("row", F.col("x.rare").alias("word"), F.col("x.times").alias("times"))
    c = F.coalesce("c", F.lit(0))
    others = (
        rare.join(vocabulary, "word", "left")
        .groupBy("row")
        .agg(F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("known"), F.sum(F.col("times") * F.log10(c + 0.5)).alias("log"))
    )
    return scored.join(others, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("hot_known") + F.coalesce("known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("hot_log") + F.coalesce("log", F.lit(0.0)) - F.col("n_tokens") * float(np.log10(floor))).alias("base_score"),
        "score",
    )
