"""Benchmark decontamination by winnowing.

Words are `[0-9a-z]` and everything beyond ASCII, after lower-casing A-Z. Of every run of
`window - gram + 1` consecutive gram hashes the least one is a fingerprint. Two texts that share
`window` consecutive words share such a run, hence choose the same fingerprint inside it: joining
the fingerprints of documents and items misses no shared window. Each fingerprint carries the
words within reach of a window around it; the join compares those words and extends the common
run both ways, so a hit never rests on a hash. Since every shared window has its own fingerprint
inside, the runs found this way cover every hit word, however long the shared passage is.

An item of fewer words than a window, but at least one, is a window of its own length; documents
then also offer their runs of exactly that length.

Scale: documents are read once and never shuffled; only fingerprints that the benchmark has leave
the scan as long as the benchmark's fingerprints fit a broadcast of `BROADCAST_MARKS` numbers.
Beyond that all document fingerprints go through the join. The join reads two bare shuffles, so
adaptive execution splits a passage that a third of the documents hold.

Defined cases: null or empty texts have no words and are clean; items without words are never
met; a null doc_id or item_id is kept as an id of its own (item ids that are null are counted in
n_items but not listed); repeated document rows get a result each; repeated items count once by
id; other columns of the inputs are ignored. With an empty benchmark all documents are clean.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import keep_table
from . import textbytes as tb

WINDOW = 10
GRAM = 5
# Numbers of eight bytes: 32 MB at most.
BROADCAST_MARKS = 4_000_000

_MARK = pa.struct([("mark", pa.int64()), ("pos", pa.int64()), ("before", pa.int32()), ("words", pa.list_(pa.string()))])
_MARK_DDL = "array<struct<mark:bigint,pos:bigint,before:int,words:array<string>>>"


def _selected(hashes: np.ndarray, first: np.ndarray, gram: int, window: int) -> np.ndarray:
    """Places of the grams that are least in some window lying in one row."""
    _, anchors, _, _ = tb.minimiser_runs(hashes, first, gram, window)
    return np.unique(anchors)


def _marks_of(
    data: np.ndarray, offsets: np.ndarray, lengths: list[int], window: int, gram: int,
    wanted: np.ndarray | None, own_window: bool,
) -> tuple[np.ndarray, list[list[dict]]]:
    """Word counts of the rows of a slice, and their fingerprints.

    lengths: sizes of short items to look for, or with own_window (for items) each row shorter
    than a window gives itself as its only fingerprint.
    """
    data = tb.lower_ascii()[data]
    starts, ends, first = tb.word_bounds(data, offsets, tb.alphanumeric())
    hashes = tb.word_hashes(data, starts, ends, tb.byte_values())
    counts = np.diff(first)
    found: list[list[dict]] = [[] for _ in counts]
    text = data.tobytes()

    def add(places: np.ndarray, values: np.ndarray, size: int, reach: int) -> None:
        if wanted is not None and len(places):
            at = np.searchsorted(wanted, values[places].view(np.int64))
            at[at == len(wanted)] = 0
            places = places[wanted[at] == values[places].view(np.int64)] if len(wanted) else places[:0]
        rows = np.searchsorted(first, places, "right") - 1
        for place, row in zip(places.tolist(), rows.tolist(), strict=True):
            low = max(place - reach, int(first[row]))
            high = min(place + size + reach, int(first[row + 1]))
            words = [text[starts[i] : ends[i]].decode() for i in range(low, high)]
            found[row].append({"mark": int(values[place].view(np.int64)), "pos": place - int(first[row]),
                               "before": place - low, "words": words})

    grams = tb.window_hashes(hashes, gram)
    add(_selected(grams, first, gram, window), grams, gram, window - gram)
    for size in lengths if not own_window else sorted(set(counts[(counts > 0) & (counts < window)].tolist())):
        # a salt keeps the runs of a short length apart from the grams
        runs = tb.mix(tb.window_hashes(hashes, size) ^ np.uint64(size << 32))
        places = np.arange(len(runs))
        rows = np.searchsorted(first, places, "right") - 1
        fits = places + size <= first[rows + 1]
        if own_window:
            fits &= (counts[rows] == size) & (places == first[rows])
        add(places[fits], runs, size, 0)
    return counts, found


def _scan(lengths: list[int], window: int, gram: int, wanted, own_window: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = None if wanted is None else wanted.value
        for batch in batches:
            for low, high, data, offsets in tb.slices(batch.column("text")):
                counts, found = _marks_of(data, offsets, lengths, window, gram, marks, own_window)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key").slice(low, high - low), pa.array(counts, pa.int64()),
                     pa.array(found, pa.list_(_MARK))], ["key", "n_words", "marks"])

    return run


def fingerprints(
    texts: DataFrame, lengths: list[int], window: int, gram: int, wanted=None, own_window: bool = False
) -> DataFrame:
    """(key, n_words, marks) of (key, text)."""
    schema = f"key {dict(texts.dtypes)['key']}, n_words bigint, marks {_MARK_DDL}"
    return texts.mapInArrow(_scan(lengths, window, gram, wanted, own_window), schema)


def hits(found: DataFrame, items: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(key, item_id, low, high): the runs of document words that an item holds as well.

    found: (key, marks) of documents; items: item_id and its marks.
    """
    doc = found.select("key", F.explode("marks").alias("m")).select(
        "key", "m.mark", "m.pos", "m.before", "m.words", F.size("m.words").alias("size"))
    # items with the same words around a fingerprint are one row of the join
    item = (
        items.select("item_id", F.explode("marks").alias("m"))
        .groupBy("m.mark", F.col("m.before").alias("item_before"), F.col("m.words").alias("item_words"))
        .agg(F.collect_set(F.struct("item_id")).alias("ids"))
    )
    # equal words going left from the fingerprint, and going right from its first word
    left = F.expr(
        "aggregate(sequence(1, least(before, item_before) + 1), 0, (a, i) -> if(a = i - 1 AND"
        " i <= least(before, item_before) AND"
        " element_at(words, before - i + 1) = element_at(item_words, item_before - i + 1), i, a))")
    right = F.expr(
        "aggregate(sequence(1, least(size - before, size(item_words) - item_before)), 0, (a, i) ->"
        " if(a = i - 1 AND words[before + i - 1] = item_words[item_before + i - 1], i, a))")
    run = doc.join(item, "mark").withColumn("left", left).withColumn("right", right)
    # a run is as long as a window, or it is the whole of a short item
    whole = F.col("left") + F.col("right") >= window
    short_whole = (F.col("item_before") == 0) & (F.col("right") == F.size("item_words")) & (
        F.size("item_words") < window)
    return (
        run.where(whole | short_whole)
        .select("key", F.explode("ids").alias("id"),
                (F.col("pos") - F.col("left")).alias("low"), (F.col("pos") + F.col("right")).alias("high"))
        .select("key", "id.item_id", "low", "high")
    )


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM,
    broadcast_marks: int = BROADCAST_MARKS,
) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans for every document row.

    spans: maximal runs of hit words as [first word, word after the last].
    """
    spark = docs.sparkSession
    texts = benchmark.select(
        F.struct(F.col("item_id")).alias("key"), F.col("text").cast("string").alias("text"))
    items = keep_table(
        fingerprints(texts, [], window, gram, own_window=True).select(F.col("key.item_id").alias("item_id"),
                                                                      "n_words", "marks"), "items")
    # at most window - 1 values
    lengths = [r.n_words for r in items.where(f"n_words BETWEEN 1 AND {window - 1}")
               .select("n_words").distinct().collect()]
    marks = items.select(F.explode("marks.mark").alias("mark")).distinct()
    wanted = None
    if marks.count() <= broadcast_marks:
        known = np.sort(marks.toPandas()["mark"].to_numpy(np.int64))
        wanted = spark.sparkContext.broadcast(known)
    found = keep_table(fingerprints(tb.keyed_texts(docs), sorted(lengths), window, gram, wanted), "marks")
    runs = keep_table(hits(found, items, window, gram).distinct(), "hits")
    spans = (
        runs.groupBy("key").agg(
            F.array_sort(F.collect_set(F.struct("low", "high"))).alias("runs"),
            F.collect_set(F.struct("item_id")).alias("ids"),
        )
        .select("key", _union("runs").alias("spans"), F.size("ids").cast("long").alias("n_items"),
                F.array_sort(F.filter(F.transform("ids", lambda s: s["item_id"].cast("string")),
                                      lambda x: x.isNotNull())).alias("items"))
    )
    empty = F.array().cast("array<struct<low:bigint,high:bigint>>")
    return (
        found.select("key", "n_words").join(spans, "key", "left")
        .withColumn("spans", F.coalesce("spans", empty))
        .withColumn("n_hit", F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["high"] - s["low"]))
        .select(
            "key", F.col("key.doc_id").alias("doc_id"), "n_words", "n_hit",
            F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
            F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
            (F.col("n_hit") > 0).alias("contaminated"), "spans",
        )
    )


def _union(runs: str):
    """Sorted [low, high) runs joined to maximal ones."""
    empty = F.array().cast("array<struct<low:bigint,high:bigint>>")
    return F.aggregate(
        runs, empty,
        lambda out, r: F.when(
            (F.size(out) > 0) & (F.element_at(out, F.greatest(F.size(out), F.lit(1)))["high"] >= r["low"]),
            F.concat(
                F.slice(out, F.lit(1), F.size(out) - 1),
                F.array(F.struct(
                    F.element_at(out, F.greatest(F.size(out), F.lit(1)))["low"].alias("low"),
                    F.greatest(F.element_at(out, F.greatest(F.size(out), F.lit(1)))["high"], r["high"]).alias("high"),
                )),
            ),
        ).otherwise(F.concat(out, F.array(r))),
    )
