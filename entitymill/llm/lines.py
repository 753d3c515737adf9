"""Line dedup by winnowing over line hashes, in DataFrame functions only.

A text is cut at line feeds; lines that hold more than spaces are its units. Of each window of
`window` consecutive units the least line hash (the leftmost of equal ones) is a fingerprint. Two
texts that share `window` units in a row share the window, hence its fingerprint. Fingerprints are
joined by hash; where one occurs again, it is extended both ways to every window that chose it,
and each extension meets the first place of the same lines, not all others. A window that has
stood earlier, in a smaller doc_id or further up in its text, is repeated; the runs of repeated
windows, joined where they overlap, are deleted with the blank lines inside. The first place of
every run stays.

A text with fewer units than a window, but at least one, is a window of its own. With `words`, so is
every run of fewer units that holds as many words: a long line or two need no third one to be found
again. Short lines still do.

Line and window equality is that of two independent 64-bit hashes each.

Scale: only hashes of lines travel to find repeats; texts are shuffled once, to their deleted
lines. First places are aggregates, so a line or passage that a third of all rows hold is combined
before the shuffle, and the joins read written tables, which adaptive execution can split.

Defined cases: null and empty texts have no lines and stay as they are; a null doc_id comes after
all others; equal doc_ids are ordered by a hash of their texts, and equal rows count as one place;
extra columns stay untouched in `dedup_lines` and cannot clash with what it adds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import keep_table
from . import textbytes as tb

WINDOW = 3


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _n_words(line: Column) -> Column:
    return F.size(F.filter(F.split(line, r"[\x20\x09-\x0D]+"), lambda w: w != ""))


def line_units(texts: DataFrame, words: int | None = None) -> DataFrame:
    """(key, units) of (key, text); a unit has its line number, two hashes, and with `words` its words."""
    more = (lambda line: [_n_words(line).alias("words")]) if words else lambda line: []
    numbered = F.transform(
        _lines(F.col("text")),
        lambda line, i: F.struct(
            i.cast("int").alias("line"), F.xxhash64(line).alias("h"), F.xxhash64(F.lit("second"), line).alias("g"),
            (F.length(F.trim(line)) > 0).alias("unit"), *more(line)),
    )
    names = ["line", "h", "g", *(["words"] if words else [])]
    units = F.transform(F.filter(numbered, lambda u: u["unit"]),
                        lambda u: F.struct(*[u[n].alias(n) for n in names]))
    return texts.where("text IS NOT NULL").select("key", units.alias("units")).where(F.size("units") > 0)


def windows(units: DataFrame, window: int = WINDOW, words: int | None = None) -> DataFrame:
    """(key, mark, spot, first, last, h, g): each window with its fingerprint and content hashes.

    mark, spot: the fingerprint's hash and unit number; first, last: line numbers.
    """
    whole = F.least(F.size("units"), F.lit(window))

    def one(start: Column, size: Column = whole) -> Column:
        part = F.slice("units", start + 1, size)
        return F.struct(
            F.array_min(F.transform(
                part, lambda u, j: F.struct(u["h"].alias("mark"), (start + j).alias("spot")))).alias("least"),
            F.element_at(part, 1)["line"].alias("first"), F.element_at(part, -1)["line"].alias("last"),
            F.xxhash64(F.transform(part, lambda u: u["h"])).alias("h"),
            F.xxhash64(F.transform(part, lambda u: u["g"])).alias("g"))

    def brief(n: int) -> Column:
        """The runs of n units that hold the words; none where a window is as short."""
        held = lambda start: F.aggregate(
            F.slice("units", start + 1, F.lit(n)), F.lit(0), lambda a, u: a + u["words"])
        starts = F.when(F.size("units") > n, F.sequence(F.lit(0), F.size("units") - n)).otherwise(F.array().cast("array<int>"))
        return F.transform(F.filter(starts, lambda start: held(start) >= words), lambda start: one(start, F.lit(n)))

    # only windows leave the explosion: a very long text is not copied along with each of them
    found = F.transform(F.sequence(F.lit(0), F.size("units") - whole), lambda start: one(start))
    if words:
        found = F.concat(found, *[brief(n) for n in range(1, window)])
    return units.select("key", F.explode(found).alias("w")).select(
        "key", "w.least.mark", "w.least.spot", "w.first", "w.last", "w.h", "w.g")


def _place(key: str, first: str) -> Column:
    """Order of places: doc_id with null last, hash of the text, line."""
    return F.struct(F.col(key)["doc_id"].isNull().alias("absent"), F.col(key).alias("key"), F.col(first).alias("first"))


def repeated_windows(units: DataFrame, window: int = WINDOW, words: int | None = None) -> DataFrame:
    """(key, first, last): windows that stand earlier as well."""
    found = keep_table(windows(units, window, words), "line-windows")
    # fingerprints that occur at more than one place; both joins are the same at every size
    marks = keep_table(
        found.groupBy("mark").agg(F.min(F.struct("key", "spot")).alias("a"), F.max(F.struct("key", "spot")).alias("b"))
        .where("a <> b").select("mark"), "line-marks").hint("merge")
    met = found.join(marks, "mark")
    # the first place of every extension of a fingerprint
    firsts = keep_table(met.groupBy("mark", "h", "g").agg(F.min(_place("key", "first")).alias("origin"),
                                                          F.max(_place("key", "first")).alias("end"))
                        .where("origin <> end").drop("end"), "line-firsts").hint("merge")
    return met.join(firsts, ["mark", "h", "g"]).where(_place("key", "first") != F.col("origin")).select(
        "key", "first", "last")


def merged_runs(runs: Column) -> Column:
    """Sorted (low, high) runs, both ends included, joined where they overlap."""
    last = lambda out: F.element_at(out, -1)
    return F.aggregate(
        F.slice(runs, 2, F.greatest(F.size(runs) - 1, F.lit(0))),
        F.slice(runs, 1, 1),
        lambda out, r: F.when(
            last(out)["high"] >= r["low"],
            F.concat(F.slice(out, F.lit(1), F.size(out) - 1),
                     F.array(F.struct(last(out)["low"].alias("low"),
                                      F.greatest(last(out)["high"], r["high"]).alias("high")))),
        ).otherwise(F.concat(out, F.array(r))),
    )


def deleted_runs(texts: DataFrame, window: int = WINDOW, words: int | None = None) -> DataFrame:
    """(key, runs) of the texts that lose lines; runs are (low, high) line numbers."""
    again = repeated_windows(keep_table(line_units(texts, words), "line-units"), window, words)
    spans = F.array_sort(F.collect_set(F.struct(F.col("first").alias("low"), F.col("last").alias("high"))))
    return again.groupBy("key").agg(merged_runs(spans).alias("runs"))


def _between(lines: Column, runs: Column) -> Column:
    """The lines outside the runs, as slices between one run and the next: linear in both."""

    def gap(every: Column, j: Column) -> Column:
        low = F.coalesce(F.get(runs, j - 1)["high"] + 1, F.lit(0))
        return F.slice(every, low + 1, F.coalesce(F.get(runs, j)["low"], F.size(every)) - low)

    # a lambda's argument is computed once, the lines would be cut anew for every run otherwise
    return F.element_at(F.transform(
        F.array(lines),
        lambda every: F.flatten(F.transform(F.sequence(F.lit(0), F.size(runs)), lambda j: gap(every, j)))), 1)


def dedup_lines(docs: DataFrame, window: int = WINDOW, words: int | None = None) -> DataFrame:
    """(row, key, n_lines, n_removed, kept): every document row as it came, and what is left of it."""
    # the join of the texts is the same at every size
    runs = keep_table(deleted_runs(tb.keyed_texts(docs), window, words), "line-runs").hint("merge")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), tb.row_key())
    text = F.col("row")["text"].cast("string")
    kept = _between(_lines(text), F.col("runs"))
    return rows.join(runs, "key", "left").select(
        "row", "key",
        F.coalesce(F.size(_lines(text)), F.lit(0)).alias("n_lines"),
        F.coalesce(F.aggregate("runs", F.lit(0), lambda a, r: a + r["high"] - r["low"] + 1), F.lit(0)).alias(
            "n_removed"),
        F.when(F.col("runs").isNull(), text).otherwise(F.array_join(kept, "\n")).alias("kept"),
    )
