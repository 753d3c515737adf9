"""Token-ID output: documents as shards of patched frame-of-reference blocks.

Texts are range-partitioned by doc_id (and a hash of the text, so that one id or null may hold a
third of the rows) and sorted, each task encodes its texts and cuts the ids
into shards at document ends. A shard is one file image: the ids as one stream, the document
lengths as another (see pfor). Shards are rows of a Parquet table in the shared folder: Spark's
committers keep it whole when an executor is lost. A shard is found by its first document; the
places of all documents follow from sums over the shards, one small row each.

Texts are cut a few megabytes at a time, by array steps over their bytes: at blanks and, in a run that
has only Latin letters (but no dotted capital I), digits and ASCII signs but no apostrophe and no `<|`,
also between letters, single digits and signs. The tokenizer cuts at these places itself and nothing
looks across them, so the parts' ids joined are the ids of the whole text. Each distinct part of such a
stretch is looked up once in a bounded memory, and ASCII letters of the parts cut finest are lower-cased
before that, as the tokenizer would do. A new part of ASCII alone goes to the tokenizer's model as it is, one with other
letters once it is normalised, any other part through the whole tokenizer.

Defined cases: null and empty texts give the end id alone; rows without doc_id come first, equal
doc_ids are ordered by a hash of their texts, equal rows are interchangeable; other columns are
ignored; an empty table gives an empty table of shards.
"""

from __future__ import annotations

import os
import string
import zlib
from collections.abc import Iterator
from itertools import chain, pairwise, repeat

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import keep_table
from . import pfor
from . import textbytes as tb

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
END_ID = 2
SHARD_IDS = 1_000_000
# Parts remembered by a worker, and the longest of them: some 200 MB; ids kept for them at most (besides one stretch's).
MEMORY_PARTS = 1_000_000
LONGEST_PART = 64
MEMORY_IDS = 16_000_000
# Bytes of text encoded at a time, unless one text is longer; its arrays take some 40 times that.
STRETCH = 4 << 20

_SHARDS = (f"first struct<doc_id:bigint,tie:bigint,part:bigint>, doc_ids array<bigint>, n_ids bigint, "
           "ids binary, lengths binary")


# What a byte makes of a part. Bytes after the first of a letter count as LETTER, whatever that letter is.
BLANK, LETTER, DIGIT, SIGN, WHOLE = range(5)


def _kinds() -> np.ndarray:
    kinds = np.full(256, WHOLE, np.uint8)  # control bytes, the apostrophe, letters beyond U+024F
    kinds[0x21:0x7F] = SIGN
    kinds[ord("'")] = WHOLE
    kinds[list(b" \t\n\r")] = BLANK
    kinds[list(string.digits.encode())] = DIGIT
    kinds[list(string.ascii_letters.encode())] = LETTER
    kinds[0x80:0xC0] = LETTER
    kinds[0xC3:0xCA] = LETTER  # first bytes of U+00C0 to U+027F
    return kinds


def _pairs() -> np.ndarray:
    """Two bytes that are no letter of the ranges above, or begin a special token. U+0130 becomes two
    characters in lower case, and the second one joins a sign that follows."""
    pairs = np.zeros(1 << 16, bool)
    for two in [b"<|", *(chr(c).encode() for c in (0xD7, 0xF7, 0x130, *range(0x250, 0x280)))]:
        pairs[two[0] << 8 | two[1]] = True
    return pairs


_KIND, _PAIR = _kinds(), _pairs()
_MAY_PAIR = _PAIR.reshape(256, 256).any(axis=1)
_LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)


def cut_parts(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of texts that end in a blank each, to the starts of their parts and of the blanks between
    them, the kinds of both, and the bytes as the parts have them."""
    kinds = _KIND[data]
    blank = np.concatenate([[True], kinds == BLANK])
    starts, ends = np.flatnonzero(blank[:-1] & ~blank[1:]), np.flatnonzero(~blank[:-1] & blank[1:])
    first = np.flatnonzero(_MAY_PAIR[data[:-1]])
    first = first[_PAIR[data[first].astype(np.intp) << 8 | data[first + 1]]]
    odd = np.concatenate([np.flatnonzero(kinds == WHOLE), first])
    if len(odd):  # their runs are cut at blanks only
        runs = np.unique(np.searchsorted(starts, odd, "right") - 1)
        edge = np.zeros(len(data), np.int8)
        edge[starts[runs]] = 1
        edge[ends[runs]] -= 1
        inside = np.cumsum(edge, dtype=np.int8).view(bool)
        kinds[inside] = WHOLE
        data = np.where(inside, data, _LOWER[data])
    else:
        data = _LOWER[data]
    at = np.flatnonzero(np.concatenate([[True], (kinds[1:] != kinds[:-1]) | (kinds[1:] == DIGIT)]))
    return at, kinds[at], data


class PartEncoder:
    """Ids of texts. Those of the parts in memory lie in one array, part i's from ends[i] to ends[i + 1]."""

    def __init__(self, tokenizer_json: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids, self.ends = np.zeros(0, "<u4"), np.zeros(1, np.int64)

    def _encode(self, parts: list[str]) -> Iterator[list[int]]:
        for low in range(0, len(parts), 5000):
            for found in self.tokenizer.encode_batch_fast(parts[low : low + 5000], add_special_tokens=False):
                yield found.ids

    def _words(self, words: list[str]) -> Iterator[list[int]]:
        """Words of Latin letters, normalised together: each is one piece of the tokenizer's cut and
        goes straight to the model."""
        model, normalizer = self.tokenizer.model, self.tokenizer.normalizer
        for low in range(0, len(words), 1000):
            some = words[low : low + 1000]
            plain = " ".join(some)
            plain = normalizer.normalize_str(plain) if normalizer else plain
            plain = [x for x, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(plain)]
            if len(plain) == len(some):
                yield from ([t.id for t in model.tokenize(p)] for p in plain)
            else:  # a letter that normalises to a letter and a sign
                yield from self._encode(some)

    def _learn(self, parts: list[str], whole: list[bool]) -> np.ndarray:
        """Places of parts that are not in memory."""
        groups: list[list[int]] = [[], [], []]
        for i, (part, uncut) in enumerate(zip(parts, whole, strict=True)):
            groups[2 if uncut else 0 if part.isascii() else 1].append(i)
        plain, letters, uncut = ([parts[i] for i in g] for g in groups)
        model = self.tokenizer.model
        # ASCII letters, digits and signs are the model's symbols as they are
        found = [[t.id for t in model.tokenize(p)] for p in plain]
        found += self._words(letters)
        found += self._encode(uncut)
        ids = np.fromiter(chain.from_iterable(found), "<u4")
        place = len(self.ends) - 1
        self.ids = np.concatenate([self.ids, ids])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(np.fromiter(map(len, found), np.int64))])
        self.known.update((p, i) for i, p in enumerate(chain(plain, letters, uncut), place) if len(p) <= LONGEST_PART)
        places = np.empty(len(parts), np.int64)
        places[[i for g in groups for i in g]] = np.arange(place, place + len(parts))
        return places

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after another, and how many each has."""
        if len(self.known) > MEMORY_PARTS or len(self.ids) > MEMORY_IDS:
            self._forget()
        texts = pc.binary_join_element_wise(pc.fill_null(texts.cast(pa.string()), ""), "", "\n")
        rows = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset + 1 : texts.offset + len(texts) + 1]
        at, kinds, data = cut_parts(np.frombuffer(texts.buffers()[2], np.uint8)[: rows[-1]])
        bounds, kept = np.append(at, len(data)).astype(np.int32), kinds != BLANK
        coded = pa.StringArray.from_buffers(len(at), pa.py_buffer(bounds), pa.py_buffer(data))
        coded = coded.filter(pa.array(kept)).dictionary_encode()
        codes, parts = coded.indices.to_numpy(), coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        whole = np.empty(len(parts), bool)
        whole[codes] = kinds[kept] == WHOLE
        places = np.fromiter(map(self.known.get, parts, repeat(-1)), np.int64, len(parts))
        fresh = np.flatnonzero(places < 0)
        if len(fresh):
            places[fresh] = self._learn([parts[i] for i in fresh.tolist()], whole[fresh].tolist())
        starts, sizes = self.ends[places], (self.ends[places + 1] - self.ends[places])[codes]
        before = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.ids[np.arange(before[-1]) + np.repeat(starts[codes] - before[:-1], sizes)]
        return ids, np.diff(before[np.searchsorted(at[kept], rows)], prepend=0)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian uint32 bytes."""
        if not texts:
            return []
        ids, sizes = self.encode_all(pa.array(texts, pa.string()))
        return [x.tobytes() for x in np.split(ids, np.cumsum(sizes)[:-1])]


def _stretches(texts: pa.Array, size: int = STRETCH) -> Iterator[tuple[int, pa.Array]]:
    """Consecutive texts of about so many bytes, with the place of the first."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy().astype(np.int64))
    for low, high in pairwise([0, *(np.flatnonzero(np.diff(ends // size)) + 1).tolist(), len(texts)]):
        if low < high:
            yield low, texts.slice(low, high - low)


_ENCODERS: dict[int, PartEncoder] = {}


def _encoder(shared) -> PartEncoder:
    """A worker keeps the encoder of one tokenizer."""
    text = shared.value
    if (key := hash(text)) not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = PartEncoder(text)
    return _ENCODERS[key]


def _write(shared, end_id: int, shard_ids: int):
    def shard(rows: list[tuple], part: int) -> dict:
        lengths = np.array([len(ids) for _, _, ids in rows], np.uint32)
        ids = np.concatenate([ids for _, _, ids in rows])
        return {"first": {"doc_id": rows[0][0], "tie": rows[0][1], "part": part},
                "doc_ids": [d for d, _, _ in rows], "n_ids": len(ids), "ids": pfor.encode(ids),
                "lengths": pfor.encode(lengths)}

    schema = pa.schema([
        ("first", pa.struct([("doc_id", pa.int64()), ("tie", pa.int64()), ("part", pa.int64())])),
        ("doc_ids", pa.list_(pa.int64())), ("n_ids", pa.int64()), ("ids", pa.binary()), ("lengths", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared)
        held: list[tuple] = []
        size = part = 0
        for batch in batches:
            doc_ids, ties = batch.column("doc_id").to_pylist(), batch.column("tie").to_pylist()
            for low, texts in _stretches(batch.column("text")):
                ids, sizes = encoder.encode_all(texts)
                ends = np.cumsum(sizes)
                ids, ends = np.insert(ids, ends, end_id), ends + np.arange(1, len(ends) + 1)
                for row, (first, last) in enumerate(pairwise([0, *ends.tolist()]), low):
                    held.append((doc_ids[row], ties[row], ids[first:last]))
                    size += last - first
                    if size >= shard_ids:
                        yield pa.RecordBatch.from_pylist([shard(held, part)], schema)
                        held, size, part = [], 0, part + 1
        if held:
            yield pa.RecordBatch.from_pylist([shard(held, part)], schema)

    return run


def write_shards(
    docs: DataFrame, tokenizer: str = TOKENIZER, end_id: int = END_ID, shard_ids: int = SHARD_IDS
) -> DataFrame:
    """The written table of shards."""
    spark: SparkSession = docs.sparkSession
    with open(tokenizer, encoding="utf-8") as file:  # a vocabulary file: a few megabytes
        shared = spark.sparkContext.broadcast(file.read())
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.xxhash64(F.col("text").cast("string")).alias("tie"),
                        F.col("text").cast("string").alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = texts.repartitionByRange(parts, "doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    return keep_table(ordered.mapInArrow(_write(shared, end_id, shard_ids), _SHARDS), "shards")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(len(batch)):
            ids = pfor.decode(batch.column("ids")[row].as_py()).astype("<u4")
            ends = np.cumsum(pfor.decode(batch.column("lengths")[row].as_py()).astype(np.int64))
            starts = np.concatenate([[0], ends[:-1]])
            sums = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("first").take(pa.array(np.full(len(ends), row))),
                 batch.column("doc_ids")[row].values, pa.array(starts), pa.array(ends - starts),
                 pa.array(sums, pa.int64())], ["first", "doc_id", "place", "n_tokens", "ids_crc32"])


def shard_starts(shards: DataFrame) -> DataFrame:
    """(first, before): ids of all shards before; one row per shard in one window."""
    order = Window.orderBy("first.doc_id", "first.tie", "first.part").rowsBetween(Window.unboundedPreceding, -1)
    return shards.select("first", F.coalesce(F.sum("n_ids").over(order), F.lit(0).cast("long")).alias("before"))


def read_documents(shards: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document in the shards."""
    rows = shards.select("first", "doc_ids", "ids", "lengths").mapInArrow(
        _read, "first struct<doc_id:bigint,tie:bigint,part:bigint>, doc_id bigint, place bigint, "
               "n_tokens bigint, ids_crc32 bigint")
    return rows.join(shard_starts(shards), "first").select(
        "doc_id", (F.col("before") + F.col("place")).alias("start"), "n_tokens", "ids_crc32")


def document_ids(shard: dict, doc_id: int) -> list[np.ndarray]:
    """The ids of a document in one shard row, unpacking only its blocks."""
    ends = np.cumsum(pfor.decode(shard["lengths"]).astype(np.int64))
    return [pfor.decode(shard["ids"], int(ends[i - 1]) if i else 0, int(ends[i]))
            for i, d in enumerate(shard["doc_ids"]) if d == doc_id]
