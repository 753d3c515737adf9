"""Toxicity: a linear-chain conditional random field tags toxic tokens, documents follow.

Tokens are runs of letters, digits and `_`-free ASCII as in `[0-9a-z]` plus everything beyond
ASCII, after lower-casing A-Z. Labels are per document, so tokens are labelled first: over the
labelled documents each hashed word gets its document counts by label; toxic documents then share
their weight among their words in proportion to how well each explains the label (a few rounds),
so that words that only come along with a toxic one lose it. Words whose share stays high are the
labelled toxic tokens of toxic documents.

The field sees of each token the binned strength of its word and of its neighbours. Forward and
backward passes give each token's probability; a document's score is a logistic function of the
largest and of the summed token probabilities, fitted to the document labels. Runs of tokens at
0.5 or more are the offending spans, with offsets in characters.

Bounded sample: the classifier is fitted on at most `SAMPLE` labelled documents, chosen by a hash
of doc_id, with `BUCKETS` hashed words; the field itself on the chains of `FIELD_SAMPLE` documents
of either label, cut to `CHAIN` tokens for fitting only. Scoring reads every whole text in one scan without a shuffle. Labels, lang, source and doc_id are no input
of a score.

Defined cases: null and empty texts have no tokens and get the score of a document without
probabilities; rows without a label are scored only; repeated labels of a document are taken at
their largest; repeated document rows are scored each, but learnt from once by doc_id (the least text hash); without a toxic or without a clean training
document every score is 0; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import keep_table
from . import crf
from . import textbytes as tb

SAMPLE = 30_000
BUCKETS = 1 << 22
# A word of fewer toxic documents of the sample speaks for nothing.
LEAST_DOCUMENTS = 2
FIELD_SAMPLE = 400
CHAIN = 256
BINS = 16
ROUNDS = 3
THRESHOLD = 0.7
SPAN_AT = 0.5


@dataclass
class Model:
    """Strength bin of each hashed word, weights of the field, and of the document score."""

    bins: np.ndarray
    weights: crf.Weights
    document: np.ndarray


def held_out(doc_id: str = "doc_id") -> Column:
    """The rows that labels are not learnt from; a null doc_id is held out as well."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(True))


def _tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Word bucket, byte start and end of each token, and the first token of each row."""
    data = tb.lower_ascii()[data]
    starts, ends, first = tb.word_bounds(data, offsets, tb.alphanumeric())
    hashes = tb.word_hashes(data, starts, ends, tb.byte_values())
    return (hashes >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64), starts, ends, first


def _features(strength: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    """Strength of the token, of the one before and of the one after; 0 at the ends."""
    before, after = np.zeros_like(strength), np.zeros_like(strength)
    before[1:], after[:-1] = strength[:-1], strength[1:]
    inner = first[(first > 0) & (first < len(strength))]
    before[inner] = 0
    after[inner - 1] = 0
    return [strength, before, after]


def _summary(own: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Of each row: 1, the largest token probability, and the log of the sum of those that count."""
    n = len(first) - 1
    row = np.repeat(np.arange(n), np.diff(first))
    largest = np.zeros(n)
    np.maximum.at(largest, row, own)
    total = np.bincount(row, np.where(own >= SPAN_AT, own, 0.0), n)
    return np.stack([np.ones(n), largest, np.log1p(total)], 1)


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def _fit_document(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Logistic weights by Newton steps, with a little pull to zero."""
    w = np.zeros(x.shape[1])
    for _ in range(40):
        p = _logistic(x @ w)
        slope = x.T @ (y - p) - ridge * w
        bend = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        move = np.linalg.solve(bend, slope)
        w += move
        if np.abs(move).max() < 1e-8:
            break
    return w


def _word_counts(known: np.ndarray | None, share: np.ndarray | None):
    """Per slice of labelled texts: (bucket, toxic, clean) document weights of its words.

    known, share: sorted words and how well each explains a toxic document so far, only these are
    counted then, for toxic documents; None counts whole documents.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = batch.column("toxic").to_numpy()
            for low, high, data, offsets in tb.slices(batch.column("text")):
                bucket, _, _, first = _tokens(data, offsets)
                row = np.repeat(np.arange(high - low), np.diff(first))
                pairs = np.unique(row * BUCKETS + bucket)
                row, word = pairs // BUCKETS, pairs % BUCKETS
                bad = labels[low:high][row] == 1
                part = np.ones(len(word))
                if known is not None:
                    at = np.minimum(np.searchsorted(known, word), len(known) - 1)
                    keep = bad & (known[at] == word)
                    row, word, bad, part = row[keep], word[keep], bad[keep], share[at[keep]]
                    total = np.bincount(row, part, high - low)[row]
                    part = np.divide(part, total, out=np.zeros_like(part), where=total > 0)
                used, place = np.unique(word, return_inverse=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(used, pa.int64()), pa.array(np.bincount(place, part * bad, len(used)), pa.float64()),
                     pa.array(np.bincount(place, part * ~bad, len(used)), pa.float64())],
                    ["bucket", "toxic", "clean"])

    return run


def _counted(sample: DataFrame, known: np.ndarray | None, share: np.ndarray | None, least: float):
    """Words with a toxic weight of at least `least`: sorted buckets, toxic and clean weights.

    They are words of the bounded sample's toxic documents, and BUCKETS at most.
    """
    sums = (sample.mapInArrow(_word_counts(known, share), "bucket bigint, toxic double, clean double")
            .groupBy("bucket").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
            .where(F.col("toxic") >= least).toPandas().sort_values("bucket"))
    return (sums[c].to_numpy() for c in ("bucket", "toxic", "clean"))


def _training_chains(bins: np.ndarray, lexicon: np.ndarray):
    """Strengths, token labels and bounds of the sample's texts, cut to chains for fitting.

    A long text gives the chains that hold labelled tokens, and its first one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = batch.column("toxic").to_numpy()
            for low, _, data, offsets in tb.slices(batch.column("text")):
                bucket, _, _, first = _tokens(data, offsets)
                chains = []
                for row in range(len(first) - 1):
                    for at in range(first[row], first[row + 1], CHAIN):
                        words = bucket[at : min(at + CHAIN, first[row + 1])]
                        marked = lexicon[words] & (labels[low + row] == 1)
                        if at == first[row] or marked.any():
                            chains.append({"strength": bins[words], "label": marked.astype(np.int8)})
                yield pa.RecordBatch.from_pylist(
                    chains, pa.schema([("strength", pa.list_(pa.int8())), ("label", pa.list_(pa.int8()))]))

    return run


def training_sample(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> DataFrame:
    """(text, toxic) of at most `most` labelled documents that are not held out, one row each."""
    chosen = (
        labels.where(~held_out() & F.col("toxic").isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    )
    # at most `most` rows of twelve bytes
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(
        F.broadcast(chosen), "doc_id")
    # a repeated doc_id gives one text, combined before the shuffle
    return found.groupBy("doc_id").agg(
        F.min(F.struct(F.xxhash64("text").alias("tie"), "text")).alias("row"), F.first("toxic").alias("toxic")).select(
        "row.text", "toxic")


def train(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> Model | None:
    """The classifier, or None if one of the two labels does not occur."""
    sample = keep_table(training_sample(docs, labels, most), "toxicity-sample")
    sizes = {r.toxic: r.n for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_toxic, n_clean = sizes.get(1, 0), sum(n for k, n in sizes.items() if k != 1)
    if not n_toxic or not n_clean:
        return None
    known, toxic, clean = _counted(sample, None, None, LEAST_DOCUMENTS)
    if not len(known):
        known, toxic, clean = np.zeros(1, np.int64), np.zeros(1), np.zeros(1)
    rate = (clean + 0.5) / (n_clean + 1)
    for _ in range(ROUNDS):
        odds = toxic / n_toxic / rate
        # a word explains by its odds and by how many toxic documents it explains
        share = np.where(odds > 1, odds * toxic, 0.0)
        found, weight, _ = _counted(sample, known, share, 0.0)
        toxic = np.zeros(len(known))
        toxic[np.searchsorted(known, found)] = weight
    odds = np.log((toxic + 0.01) / n_toxic / rate)
    strong = (odds > 1.5) & (toxic >= max(LEAST_DOCUMENTS, 0.002 * n_toxic))
    lexicon = np.zeros(BUCKETS, bool)
    lexicon[known[strong]] = True
    # strength 0 is a word that speaks for nothing
    bins = np.zeros(BUCKETS, np.int8)
    bins[known] = np.where(toxic >= 1, np.clip(np.ceil(odds * 2), 0, BINS - 1), 0)
    order = F.xxhash64("text")
    some = sample.where("toxic = 1").orderBy(order).limit(FIELD_SAMPLE).unionAll(
        sample.where("toxic <> 1").orderBy(order).limit(FIELD_SAMPLE))
    chains = some.mapInArrow(
        _training_chains(bins, lexicon), "strength array<tinyint>, label array<tinyint>").toPandas()
    strength = np.concatenate([*chains["strength"], np.zeros(0, np.int8)]).astype(np.int64)
    label = np.concatenate([*chains["label"], np.zeros(0, np.int8)]).astype(np.int64)
    first = np.cumsum([0, *map(len, chains["strength"])])
    weights = crf.fit(_features(strength, first), [BINS] * 3, label, first)
    model = Model(bins, weights, np.zeros(3))
    rows = sample.mapInArrow(_summaries(model), "toxic int, largest double, total double").toPandas()
    x = np.stack([np.ones(len(rows)), rows["largest"], rows["total"]], 1)
    model.document = _fit_document(x, (rows["toxic"] == 1).to_numpy(float))
    return model


def _probabilities(model: Model, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    bucket, starts, ends, first = _tokens(data, offsets)
    features = _features(model.bins[bucket].astype(np.int64), first)
    own, _, _ = crf.marginals(model.weights.scores(features), model.weights.pair, first)
    return own[:, 1], starts, ends, first


def _summaries(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in tb.slices(batch.column("text")):
                own, _, _, first = _probabilities(model, data, offsets)
                x = _summary(own, first)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("toxic").slice(low, high - low), pa.array(x[:, 1]), pa.array(x[:, 2])],
                    ["toxic", "largest", "total"])

    return run


def _spans(own, starts, ends, first, data, offsets) -> list[list[dict]]:
    """Offending runs of tokens per row, as offsets in characters."""
    bad = own >= SPAN_AT
    out: list[list[dict]] = [[] for _ in first[:-1]]
    if not bad.any():
        return out
    row = np.searchsorted(first, np.flatnonzero(bad), "right") - 1
    at = np.flatnonzero(bad)
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (row[1:] != row[:-1])
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(at)) - 1
    characters = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    for h, t in zip(head.tolist(), tail.tolist(), strict=True):
        base = characters[offsets[row[h]]]
        out[row[h]].append({"start": int(characters[starts[at[h]]] - base), "end": int(characters[ends[at[t]]] - base)})
    return out


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model | None = shared.value
        span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            for low, high, data, offsets in tb.slices(batch.column("text")):
                if model is None:
                    score, spans = np.zeros(high - low), [[] for _ in range(high - low)]
                else:
                    own, starts, ends, first = _probabilities(model, data, offsets)
                    score = _logistic(_summary(own, first) @ model.document)
                    spans = _spans(own, starts, ends, first, data, offsets)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).slice(low, high - low) for c in batch.schema.names]
                    + [pa.array(score), pa.array(spans, span)], [*batch.schema.names, "score", "spans"])

    return run


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """All columns of (text, ...) and score, spans of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(_score(shared), f"{kinds}, score double, spans array<struct<start:int,end:int>>")


def score_documents(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted, spans of every document row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return score(rows, train(docs, labels, most)).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        "spans")
