"""Token counts of whole texts for a byte-level BPE file, without moving any pre-token.

A text is cut into the pre-tokens of the tokenizer's own pattern; its count is the sum of their
lengths. Lengths come from two tiers, both on the map side:

- a compact table of the most frequent pre-tokens and their lengths, broadcast to all workers. It
  has `FREQUENT` entries of `LONGEST` characters at most (some 3 MB whatever the corpus holds) and
  is learned from a sample of about `SAMPLE_TEXTS` whole texts. The sample decides what is fast, never
  a count: any table, an empty one too, gives the same rows (tested);
- a worker's own memory of other pre-tokens, encoded by the library when first seen, bounded by
  `MEMORY` entries and emptied back to the frequent ones when full.

The pattern is applied by Python where letters, numbers and blanks are beyond doubt (ASCII, Latin
letters up to U+024F, general punctuation). Elsewhere a text is cut only before a space that
follows a printable ASCII sign, where the pattern always ends a pre-token, and the library does the
rest. What holds one of the file's added tokens (`<|endoftext|>`) goes to the library whole, which
counts it as one token, its default. So long texts are worked off in portions of about a megabyte.

Scale: one pass over doc_id and text, no shuffle but that of the sample's texts.

Defined cases: a null text is empty, an empty text has no tokens and no bytes; repeated rows and
null or repeated doc_ids are rows of their own; other columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import json
import os
import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
LIMIT = 512
SAMPLE_TEXTS, SAMPLE_TASKS = 4000, 8
FREQUENT = 1 << 16
MEMORY = 1_000_000
LONGEST = 48
PORTION = 1 << 20

_LETTERS, _NUMBERS = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼-¾"
# the pattern of the byte-level pre-tokenizer, for texts without doubtful characters
_CUT = re.compile(rf"'(?:[stmd]|re|ve|ll)| ?[{_LETTERS}]+| ?[{_NUMBERS}]+| ?[^\s{_LETTERS}{_NUMBERS}]+|\s+(?!\S)|\s+")
_DOUBTFUL = re.compile("[^\t-\r -~¡-ɏ‐-‧‰-⁞]")
# the byte-level alphabet: printable bytes stand for themselves, the others for the letters from U+0100 on
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_SIGNS = {b: 256 + i for i, b in enumerate(sorted(set(range(256)).difference(_PRINTABLE)))}
# no blank ends before such a space, so a pre-token does
_GAP = re.compile("(?<=[!-~])(?= )")


def checked(tokenizer_json: str) -> str:
    """The file's text, if its tokenizer cuts the way this operator does."""
    found = json.loads(tokenizer_json)
    cut = found.get("pre_tokenizer") or {}
    plain = cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space")
    if not plain or found.get("normalizer") or found.get("post_processor"):
        raise ValueError("only byte-level tokenizers without normalizer and post-processor")
    return tokenizer_json


def portions(text: str, size: int = PORTION) -> Iterator[str]:
    """The text in parts that end where a pre-token ends."""
    low = 0
    while len(text) - low > size:
        gap = _GAP.search(text, low + size)
        if gap is None:
            break
        yield text[low : gap.start()]
        low = gap.start()
    yield text[low:]


class LengthTable:
    """Token counts of texts; the frequent lengths stay, other ones are remembered for a while."""

    def __init__(self, tokenizer_json: str, frequent: dict[str, int], memory: int = MEMORY):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, added)) if added else r"(?!)")
        self.frequent, self.memory = frequent, memory
        self.known = dict(frequent)

    def cut(self, text: str) -> list[str]:
        """Parts that the tokenizer never looks across."""
        if self.special.search(text):
            return [text]
        return _GAP.split(text) if _DOUBTFUL.search(text) else _CUT.findall(text)

    def lengths(self, parts: list[str]) -> Iterator[int]:
        """The library's count of each part. A single pre-token goes straight to the model."""
        single, merge = _CUT.fullmatch, self.tokenizer.model.tokenize
        for low in range(0, len(parts), 5000):
            some = parts[low : low + 5000]
            whole = [single(p) is None or _DOUBTFUL.search(p) is not None for p in some]
            others = self.tokenizer.encode_batch_fast(
                [p for p, w in zip(some, whole, strict=True) if w], add_special_tokens=False)
            found = iter(others)
            for part, w in zip(some, whole, strict=True):
                yield len(next(found).ids) if w else len(merge(part.encode().decode("latin-1").translate(_SIGNS)))

    def counts(self, texts: list[str]) -> list[int]:
        if len(self.known) > self.memory + len(self.frequent):
            self.known = dict(self.frequent)
        split = [self.cut(t) for t in texts]
        missing = set(chain.from_iterable(split)).difference(self.known)
        fresh = [p for p in missing if len(p) <= LONGEST]
        self.known.update(zip(fresh, self.lengths(fresh), strict=True))
        if len(fresh) == len(missing):
            return [sum(map(self.known.__getitem__, parts)) for parts in split]
        long = [p for p in missing if len(p) > LONGEST]
        rare = dict(zip(long, self.lengths(long), strict=True))
        return [sum(rare[p] if p in rare else self.known[p] for p in parts) for parts in split]


def _groups(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """(row, portions of it) for a column of texts."""
    for low in range(0, len(column), 256):
        for row, text in enumerate(column.slice(low, 256).to_pylist(), low):
            yield row, list(portions(text or ""))


def _frequent_of(tokenizer_json: str):
    """One row per task: its most frequent short parts and how often they occur."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = LengthTable(tokenizer_json, {})
        seen: Counter[str] = Counter()
        for batch in batches:
            for _, texts in _groups(batch.column("text")):
                for text in texts:
                    seen.update(p for p in table.cut(text) if len(p) <= LONGEST)
        best = seen.most_common(FREQUENT)
        yield pa.RecordBatch.from_arrays(
            [pa.array([[p for p, _ in best]], pa.list_(pa.string())),
             pa.array([[n for _, n in best]], pa.list_(pa.int64()))], ["parts", "counts"])

    return run


def frequent_lengths(texts: DataFrame, tokenizer_json: str, sample: int = SAMPLE_TEXTS) -> dict[str, int]:
    """Lengths of the most frequent pre-tokens of a sample of whole texts."""
    rows = texts.count()
    if not rows or not sample:
        return {}
    some = texts.select("text").sample(min(1.0, sample / rows), seed=13).repartition(SAMPLE_TASKS)
    seen: Counter[str] = Counter()
    # SAMPLE_TASKS rows of FREQUENT short strings at most
    for row in some.mapInArrow(_frequent_of(tokenizer_json), "parts array<string>, counts array<bigint>").toLocalIterator():
        seen.update(dict(zip(row.parts, row.counts, strict=True)))
    best = [p for p, _ in seen.most_common(FREQUENT)]
    return dict(zip(best, LengthTable(tokenizer_json, {}).lengths(best), strict=True))


def packed(lengths: dict[str, int]) -> bytes:
    """The table as two compressed Arrow columns."""
    sink = pa.BufferOutputStream()
    batch = pa.RecordBatch.from_arrays(
        [pa.array(list(lengths), pa.string()), pa.array(list(lengths.values()), pa.uint32())], ["part", "length"])
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpacked(data: bytes) -> dict[str, int]:
    table = pa.ipc.open_stream(data).read_all()
    return dict(zip(table["part"].to_pylist(), table["length"].to_pylist(), strict=True))


_TABLES: dict[int, LengthTable] = {}


def _table(shared) -> LengthTable:
    """A worker keeps its table, and what it remembers, from task to task."""
    tokenizer_json, data = shared.value
    if (key := hash((tokenizer_json, data))) not in _TABLES:
        _TABLES.clear()
        _TABLES[key] = LengthTable(tokenizer_json, unpacked(data))
    return _TABLES[key]


def _count(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table(shared)
        for batch in batches:
            totals = [0] * len(batch)
            rows: list[int] = []
            held: list[str] = []
            size = 0

            def settle():
                for row, n in zip(rows, table.counts(held), strict=True):
                    totals[row] += n

            for row, texts in _groups(batch.column("text")):
                for text in texts:
                    rows.append(row)
                    held.append(text)
                    size += len(text)
                    if size > PORTION:
                        settle()
                        rows, held, size = [], [], 0
            settle()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(totals, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"])

    return run


def count_tokens(
    docs: DataFrame, tokenizer: str = TOKENIZER, limit: int = LIMIT, sample: int = SAMPLE_TEXTS
) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (n_tokens > limit) of every row of documents."""
    with open(tokenizer, encoding="utf-8") as file:  # a vocabulary file: a few megabytes
        tokenizer_json = checked(file.read())
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    table = packed(frequent_lengths(texts, tokenizer_json, sample))
    shared = docs.sparkSession.sparkContext.broadcast((tokenizer_json, table))
    sized = texts.withColumn("n_bytes", F.octet_length("text").cast("long"))
    found = sized.mapInArrow(_count(shared), "doc_id bigint, n_bytes bigint, n_tokens bigint")
    return found.withColumn("over_limit", F.col("n_tokens") > limit)
