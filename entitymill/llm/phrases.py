"""Phrase collocations: every frequent n-gram through mergeable Misra-Gries summaries, then exact counts.

Texts are lower-cased (A-Z), split at `[.,;:!?\\x0A-\\x0D]` into pieces and those into words
`[^\\x20\\x09]+`. Runs of one to `LONGEST` words inside a piece are counted per language.

1. Texts are written again as slices of some `SLICE_BYTES` of one language, cut between pieces.
2. Every slice counts its n-grams by hash and deals the hashes over partitions of the hash space, as
   sorted packed numbers. A partition merges what it gets into a Misra-Gries summary. Its capacity is
   `SPARE` times its mass divided by the threshold, so that what the summary has subtracted from any
   count stays below threshold / `SPARE`; a hash whose count plus all that was subtracted reaches the
   threshold survives. No frequent n-gram is ever lost, and what survives beside them is rare.
3. The survivors go back to the slices that hold them, which count these n-grams by hashes of 64 bits;
   sums over the slices are exact. What is below the threshold goes. Every frequent n-gram gets its words
   from one slice, the first that holds it.

Counts of all parts of a candidate are among them, as a part is at least as frequent as the whole.
Cuts, scores and containment are joins and aggregates on exact integers (decimals of 38 digits).

Scale: a partition's mass is bounded by `PARTITION_MASS`, the number of partitions grows with the
corpus. An n-gram moves once as a four-byte number per slice, however often the slice has it, a
survivor as twelve bytes more; rows hold what a slice sends to a partition, and only frequent n-grams
become rows of their own, once. Texts are shuffled twice. Nothing is broadcast or collected. The numbers of a partition are
held packed until its survivors are known (some bytes per unit of mass).

Defined cases: a null text is empty, a null lang is `und`; texts without words count nothing; a piece
longer than a slice is a slice of its own; repeated rows count as often as they occur; doc_ids are
not looked at; other columns are ignored; an empty table gives no rows. N-grams are told apart by
64-bit hashes of their language and words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.numbering import newest_per_group
from ..operators.skew import lookup_join
from ..session import keep_table, setting
from . import textbytes as tb

LONGEST = 5
THRESHOLD = 100
TOP = 2000
SLICE_BYTES = 4 << 20
PARTITION_MASS = 8_000_000
SPARE = 4
# Arrow buffers double as they grow, on both sides of the pipe: bytes of a batch, and numbers that are added up at once.
BATCH_BYTES = 8 << 20
MERGED = 1 << 20
WORDS = 1 << 16
BREAKS = b".,;:!?\x0a\x0b\x0c\x0d"

_BREAK = np.zeros(256, bool)
_BREAK[list(BREAKS)] = True
_WORD = ~_BREAK
_WORD[[9, 32]] = False


def _slices(size: int):
    """(lang, text) rows to (slice, lang, text, words): texts of a language joined up to about `size` bytes."""
    kind = pa.schema([("slice", pa.int64()), ("lang", pa.string()), ("text", pa.binary()), ("words", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = TaskContext.get().partitionId() << 32
        held: dict[str, list[bytes]] = {}
        sizes: dict[str, int] = {}

        def row(lang: str) -> pa.RecordBatch:
            nonlocal made
            made += 1
            text = np.frombuffer(b"\n".join(held.pop(lang)), np.uint8)
            sizes.pop(lang)
            text = tb.lower_ascii()[text]
            starts, _, _ = tb.word_bounds(text, np.array([0, len(text)]), _WORD)
            return pa.RecordBatch.from_arrays(
                [pa.array([made], pa.int64()), pa.array([lang], pa.string()), pa.array([text.tobytes()], pa.binary()),
                 pa.array([len(starts)], pa.int64())], schema=kind)

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
                for part in _parts(text.as_buffer().to_pybytes(), size):
                    held.setdefault(lang, []).append(part)
                    sizes[lang] = sizes.get(lang, 0) + len(part) + 1
                    if sizes[lang] >= size:
                        yield row(lang)
                    elif sum(sizes.values()) >= 16 * size:  # a task of very many languages
                        yield row(max(sizes, key=sizes.__getitem__))
        for lang in list(held):
            yield row(lang)

    return run


def _parts(text: bytes, size: int) -> Iterator[bytes]:
    """A long text in parts that end at a break, or where it ends."""
    low = 0
    while len(text) - low > 2 * size:
        window = _BREAK[np.frombuffer(text, np.uint8, offset=low + size, count=len(text) - low - size)]
        cut = int(window.argmax())
        if not window[cut]:
            break
        yield text[low : low + size + cut]
        low += size + cut
    yield text[low:]


def corpus_slices(docs: DataFrame, size: int = SLICE_BYTES) -> DataFrame:
    """The written table of slices: slice, lang, text (lower-cased UTF-8), words."""
    texts = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))
    with _small_batches(docs):
        return keep_table(texts.mapInArrow(_slices(size), "slice bigint, lang string, text binary, words bigint")
                          .where("words > 0"), "phrase-slices", huge_rows=True)


def _small_batches(df: DataFrame):
    return setting(df.sparkSession, "spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def _ngrams(lang: str, text: np.ndarray, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, tuple]]:
    """(size, hashes, first words, word bounds) of the n-grams inside the pieces of a slice."""
    starts, ends, _ = tb.word_bounds(text, np.array([0, len(text)]), _WORD)
    table = tb.byte_values()
    # some words at a time, as their hashes take arrays of all their bytes
    words = np.concatenate([np.zeros(0, np.uint64), *(
        tb.word_hashes(text, starts[a : a + WORDS], ends[a : a + WORDS], table) for a in range(0, len(starts), WORDS))])
    piece = np.cumsum(_BREAK[text], dtype=np.int32)[starts]
    own = np.bitwise_xor.reduce(tb.mix(np.frombuffer(lang.encode(), np.uint8).astype(np.uint64)
                                       + (np.arange(len(lang.encode()), dtype=np.uint64) << np.uint64(8))))
    for size in range(1, longest + 1):
        hashes = tb.window_hashes(words, size)
        if not len(hashes):
            break
        at = np.flatnonzero(piece[: len(hashes)] == piece[size - 1 :])
        yield size, tb.mix(hashes[at] ^ (own + np.uint64(size))), at, (starts, ends)


def _address(hashes: np.ndarray, partitions: int) -> tuple[np.ndarray, np.ndarray]:
    """Partition and 32-bit number of a hash."""
    return (hashes >> np.uint64(32)) % np.uint64(partitions), hashes & np.uint64(0xFFFFFFFF)


def _deal(partitions: int, longest: int):
    """Slices to (part, slice, numbers, counts): the slice's n-gram numbers of each hash partition."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(len(batch)):
                text = np.frombuffer(batch.column("text")[at].as_buffer(), np.uint8)
                lang = batch.column("lang")[at].as_py()
                keys, counts = np.unique(np.concatenate([
                    part << np.uint64(32) | number for part, number in (
                        _address(h, partitions) for _, h, _, _ in _ngrams(lang, text, longest))]), return_counts=True)
                part = (keys >> np.uint64(32)).astype(np.int64)
                cuts = np.flatnonzero(np.diff(part, prepend=-1))
                ends = [*cuts[1:].tolist(), len(keys)]
                numbers, counts = keys.astype(np.uint32), counts.astype(np.uint32)
                # mostly ones: those above go as a list of places
                rows = [(numbers[a:b].tobytes(), _packed(counts[a:b])) for a, b in zip(cuts.tolist(), ends, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part[cuts]), pa.array(np.repeat(batch.column("slice")[at].as_py(), len(cuts))),
                     pa.array([n for n, _ in rows], pa.binary()), pa.array([c for _, c in rows], pa.binary())],
                    ["part", "slice", "numbers", "counts"])

    return run


def _packed(counts: np.ndarray) -> bytes:
    """Counts as the places of those above one and their values."""
    more = np.flatnonzero(counts > 1).astype(np.uint32)
    return more.tobytes() + counts[more].tobytes()


def _unpacked(data: bytes, n: int) -> np.ndarray:
    pairs = np.frombuffer(data, np.uint32)
    counts = np.ones(n, np.int64)
    counts[pairs[: len(pairs) // 2]] = pairs[len(pairs) // 2 :]
    return counts


class Summary:
    """A mergeable Misra-Gries summary of numbers with counts."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.numbers, self.counts = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        self.subtracted = 0

    def merge(self, numbers: np.ndarray, counts: np.ndarray) -> None:
        both, place = np.unique(np.concatenate([self.numbers, numbers]), return_inverse=True)
        total = np.bincount(place, np.concatenate([self.counts, counts]), len(both)).astype(np.int64)
        if len(both) > self.capacity:
            # what the largest count beyond the capacity has goes from all of them
            least = int(np.partition(total, len(total) - self.capacity - 1)[len(total) - self.capacity - 1])
            total -= least
            self.subtracted += least
            both, total = both[total > 0], total[total > 0]
        self.numbers, self.counts = both, total

    def survivors(self, threshold: int) -> np.ndarray:
        return self.numbers[self.counts + self.subtracted >= threshold]


def summarised(rows: list[tuple[int, bytes, bytes]], threshold: int, merged: int = MERGED) -> Summary:
    """The summary of a hash partition; its capacity follows from the partition's own mass."""
    mass = sum(len(n) // 4 + int(np.frombuffer(c, np.uint32)[len(c) // 8 :].sum(dtype=np.int64)) for _, n, c in rows)
    summary = Summary(SPARE * mass // threshold + 1)
    waiting, size = [], 0
    for _, numbers, counts in rows:
        values = np.frombuffer(numbers, np.uint32)
        waiting.append((values, _unpacked(counts, len(values))))
        size += len(values)
        if size >= merged:
            summary.merge(*map(np.concatenate, zip(*waiting, strict=True)))
            waiting, size = [], 0
    if waiting:
        summary.merge(*map(np.concatenate, zip(*waiting, strict=True)))
    return summary


def _survive(threshold: int):
    """Rows sorted by part to (slice, part, numbers): the survivors that each slice holds."""
    def settle(rows: list[tuple[int, bytes, bytes]], part: int) -> Iterator[pa.RecordBatch]:
        left = summarised(rows, threshold).survivors(threshold)
        for low in range(0, len(rows), 1000):
            some = rows[low : low + 1000]
            found = [np.intersect1d(np.frombuffer(n, np.uint32), left, assume_unique=True) for _, n, _ in some]
            full = [i for i, f in enumerate(found) if len(f)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([some[i][0] for i in full], pa.int64()), pa.array([part] * len(full), pa.int64()),
                 pa.array([found[i].tobytes() for i in full], pa.binary())], ["slice", "part", "numbers"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, bytes, bytes]] = []
        current = None
        for batch in batches:
            parts = batch.column("part").to_pylist()
            for at, part in enumerate(parts):
                if part != current and held:
                    yield from settle(held, current)
                    held = []
                current = part
                held.append((batch.column("slice")[at].as_py(), batch.column("numbers")[at].as_py(),
                             batch.column("counts")[at].as_py()))
        if held:
            yield from settle(held, current)

    return run


def _sent_to(texts: DataFrame, sent: DataFrame) -> DataFrame:
    """Rows (slice, lang, text, sent): what is sent to a slice, one by one, and behind it the slice's text.

    Nothing is gathered in a row: a task sorts what it gets, on disk if need be.
    """
    sent = sent.select("slice", F.lit(None).cast("string").alias("lang"), F.lit(None).cast("binary").alias("text"),
                       F.struct(*(c for c in sent.columns if c != "slice")).alias("sent"))
    both = sent.unionAll(texts.select("slice", "lang", "text", F.lit(None).cast(sent.schema["sent"].dataType).alias("sent")))
    return both.repartition("slice").sortWithinPartitions("slice", F.isnull("sent"))


def _texts_with(batches: Iterator[pa.RecordBatch], *fields: str) -> Iterator[tuple]:
    """(slice, lang, text, a list of what was sent for each field) of the slices that were sent something."""
    held: list[tuple] = []
    for batch in batches:
        text, sent = batch.column("text"), batch.column("sent")
        columns = [sent.field(f) for f in fields]
        is_text = text.is_valid().to_numpy(zero_copy_only=False)
        for at in range(len(batch)):
            if not is_text[at]:
                held.append(tuple(c[at].as_py() for c in columns))
            elif held:
                yield batch.column("slice")[at].as_py(), batch.column("lang")[at].as_py(), text[at].as_buffer(), *map(
                    list, zip(*held, strict=True))
                held = []


def _survivors_of(parts: list[int], numbers: list[bytes]) -> np.ndarray:
    """Sorted addresses that survived in a slice."""
    return np.sort(np.concatenate([
        np.frombuffer(n, np.uint32).astype(np.uint64) | np.uint64(part << 32)
        for part, n in zip(parts, numbers, strict=True)]))


def _held(values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Places of the values that are among the wanted ones (sorted)."""
    place = np.minimum(np.searchsorted(wanted, values), len(wanted) - 1)
    return np.flatnonzero(wanted[place] == values)


def _count(partitions: int, longest: int):
    """Slices with the numbers that survived in them to (part, slice, hashes, counts), exact and packed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number_of, lang, text, parts, numbers in _texts_with(batches, "part", "numbers"):
            left, some = _survivors_of(parts, numbers), []
            for _, hashes, _, _ in _ngrams(lang, np.frombuffer(text, np.uint8), longest):
                part, number = _address(hashes, partitions)
                some.append(hashes[_held(part << np.uint64(32) | number, left)])
            hashes, counts = np.unique(np.concatenate(some), return_counts=True)
            part = _address(hashes, partitions)[0].astype(np.int64)
            order = np.argsort(part, kind="stable")
            part, hashes, counts = part[order], hashes[order], counts[order].astype(np.uint32)
            cuts = np.flatnonzero(np.diff(part, prepend=-1)).tolist()
            ends = [*cuts[1:], len(part)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part[cuts]), pa.array([number_of] * len(cuts), pa.int64()),
                 pa.array([hashes[a:b].tobytes() for a, b in zip(cuts, ends, strict=True)], pa.binary()),
                 pa.array([counts[a:b].tobytes() for a, b in zip(cuts, ends, strict=True)], pa.binary())],
                ["part", "slice", "hashes", "counts"])

    return run


class Sums:
    """Exact counts of hashes and the first slice of each, added up some at a time."""

    def __init__(self, merged: int = MERGED):
        self.merged = merged
        self.hashes, self.total, self.first = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, number_of: int, hashes: bytes, counts: bytes) -> None:
        values = np.frombuffer(hashes, np.uint64)
        self.waiting.append((values, np.frombuffer(counts, np.uint32).astype(np.int64),
                             np.full(len(values), number_of, np.int64)))
        self.size += len(values)
        if self.size >= self.merged:
            self.merge()

    def merge(self) -> None:
        hashes, counts, first = map(np.concatenate, zip(
            (self.hashes, self.total, self.first), *self.waiting, strict=True))
        self.hashes, place = np.unique(hashes, return_inverse=True)
        self.total, self.first = np.zeros(len(self.hashes), np.int64), np.full(len(self.hashes), np.iinfo(np.int64).max)
        np.add.at(self.total, place, counts)
        np.minimum.at(self.first, place, first)
        self.waiting, self.size = [], 0


def _add_up(threshold: int):
    """Rows sorted by part to (slice, hashes, counts): frequent n-grams at the first slice that has each."""
    def settle(sums: Sums) -> pa.RecordBatch:
        sums.merge()
        often = sums.total >= threshold
        hashes, total, first = sums.hashes[often], sums.total[often], sums.first[often]
        order = np.argsort(first, kind="stable")
        hashes, total, first = hashes[order], total[order], first[order]
        cuts = np.flatnonzero(np.diff(first, prepend=-1)).tolist()
        ends = [*cuts[1:], len(first)]
        return pa.RecordBatch.from_arrays(
            [pa.array(first[cuts]), pa.array([hashes[a:b].tobytes() for a, b in zip(cuts, ends, strict=True)], pa.binary()),
             pa.array([total[a:b].tobytes() for a, b in zip(cuts, ends, strict=True)], pa.binary())],
            ["slice", "hashes", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, current = None, None
        for batch in batches:
            for part, *row in zip(*(batch.column(c).to_pylist() for c in ("part", "slice", "hashes", "counts")), strict=True):
                if part != current:
                    if sums:
                        yield settle(sums)
                    sums, current = Sums(), part
                sums.add(*row)
        if sums:
            yield settle(sums)

    return run


def _name(longest: int):
    """Slices with the frequent n-grams that they name to (lang, phrase, size, a)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, lang, text, hashes, counts in _texts_with(batches, "hashes", "counts"):
            data = text.to_pybytes()
            wanted = np.concatenate([np.frombuffer(x, np.uint64) for x in hashes])
            totals = np.concatenate([np.frombuffer(x, np.int64) for x in counts])
            order = np.argsort(wanted)
            wanted, totals = wanted[order], totals[order]
            for size, found, first, (starts, ends) in _ngrams(lang, np.frombuffer(data, np.uint8), longest):
                hit = _held(found, wanted)
                named, one = np.unique(found[hit], return_index=True)
                word = first[hit[one]]
                phrases = [b" ".join(data[a:b].split()) for a, b in zip(
                    starts[word].tolist(), ends[word + size - 1].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(one), pa.string()), pa.array(phrases, pa.binary()).cast(pa.string()),
                     pa.array(np.full(len(one), size, np.int32)), pa.array(totals[np.searchsorted(wanted, named)])],
                    ["lang", "phrase", "size", "a"])

    return run


def frequent_ngrams(slices: DataFrame, threshold: int = THRESHOLD, longest: int = LONGEST) -> DataFrame:
    """(lang, phrase, size, a): every n-gram of one to `longest` words that occurs `threshold` times."""
    spark = slices.sparkSession
    mass = longest * (slices.agg(F.sum("words")).first()[0] or 0)
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # several to a task, so that tasks are even
    partitions = max(8 * least, -(-mass // PARTITION_MASS))
    dealt = slices.select("slice", "lang", "text").mapInArrow(
        _deal(partitions, longest), "part bigint, slice bigint, numbers binary, counts binary")
    found = dealt.repartition(least, "part").sortWithinPartitions("part").mapInArrow(
        _survive(threshold), "slice bigint, part bigint, numbers binary")
    texts = slices.select("slice", "lang", "text")
    counted = _sent_to(texts, found).mapInArrow(
        _count(partitions, longest), "part bigint, slice bigint, hashes binary, counts binary")
    often = counted.repartition(least, "part").sortWithinPartitions("part").mapInArrow(
        _add_up(threshold), "slice bigint, hashes binary, counts binary")
    with _small_batches(slices):
        often = keep_table(often, "often")
        return keep_table(_sent_to(texts, often).mapInArrow(
            _name(longest), "lang string, phrase string, size int, a bigint"), "frequent-ngrams")


def _within(phrases: DataFrame) -> DataFrame:
    """(lang, phrase, longest_a): the largest count of a longer phrase that holds the phrase."""
    words, size = F.split("phrase", " "), F.col("size")
    inner = F.flatten(F.transform(F.sequence(F.lit(2), size - 1), lambda n: F.transform(
        F.sequence(F.lit(1), size - n + 1), lambda i: F.array_join(F.slice(words, i, n), " "))))
    held = phrases.where("size > 2").select("lang", F.explode(F.array_distinct(inner)).alias("phrase"), "a")
    return held.groupBy("lang", "phrase").agg(F.max("a").alias("longer_a"))


def scored_phrases(ngrams: DataFrame, totals: DataFrame) -> DataFrame:
    """lang, phrase, a, l, r, n, score of the candidates that no equally frequent longer one holds."""
    phrases = ngrams.where("size > 1")
    kept = keep_table(phrases.join(_within(phrases).hint("merge"), ["lang", "phrase"], "left").where(
        "longer_a IS NULL OR longer_a < a").select("lang", "phrase", "size", "a"), "phrases")
    words = F.split("phrase", " ")
    cuts = kept.select("lang", "phrase", "a", F.explode(F.transform(
        F.sequence(F.lit(1), F.col("size") - 1), lambda k: F.struct(
            k.alias("k"), F.array_join(F.slice(words, F.lit(1), k), " ").alias("first"),
            F.array_join(F.slice(words, k + 1, F.col("size") - k), " ").alias("rest")))).alias("cut"))
    parts = cuts.select("lang", "phrase", "a", "cut.k", F.explode(F.array(
        F.struct(F.lit(True).alias("is_first"), F.col("cut.first").alias("part")),
        F.struct(F.lit(False).alias("is_first"), F.col("cut.rest").alias("part")))).alias("p"))
    # a very common word is a part of very many phrases
    known = ngrams.select(F.struct("lang", F.col("phrase").alias("part")).alias("key"), F.col("a").alias("n"))
    sided = parts.select(F.struct("lang", "p.part").alias("key"), "lang", "phrase", "a", "k", "p.is_first")
    counted = lookup_join(sided, known, "key", "phrase", broadcast=False).groupBy("lang", "phrase", "a", "k").agg(
        F.max(F.when(F.col("is_first"), F.col("n"))).alias("l"), F.max(F.when(~F.col("is_first"), F.col("n"))).alias("r"))
    # both products have 38 digits
    score = F.expr("(CAST(a AS DECIMAL(18, 0)) * 1000 * CAST(n AS DECIMAL(15, 0)))"
                   " DIV (CAST(l AS DECIMAL(18, 0)) * CAST(r AS DECIMAL(18, 0)))")
    best = F.min(F.struct("score", "k", "l", "r")).alias("b")
    return lookup_join(counted, totals, "lang", "phrase").withColumn("score", score).groupBy("lang", "phrase", "a", "n").agg(best).select(
        "lang", "phrase", "a", "b.l", "b.r", "n", "b.score")


def collocations(docs: DataFrame, threshold: int = THRESHOLD, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first `top` phrases of every language."""
    slices = corpus_slices(docs)
    totals = slices.groupBy("lang").agg(F.sum("words").alias("n"))
    scored = scored_phrases(frequent_ngrams(slices, threshold), totals)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    ranked = newest_per_group(scored, "lang", order, "phrase", top)
    return ranked.select("lang", F.col("rank_in_group").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")

