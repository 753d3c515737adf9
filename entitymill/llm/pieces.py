"""SentencePiece encoding and decoding with an Aho-Corasick automaton and Viterbi.

The pieces and scores of a SentencePiece model file are one automaton over UTF-8 bytes. A single
pass over a text follows its transitions; at each position the output links give all pieces that
end there, longest first, and each relaxes the best score of the position. The segmentation with
the highest sum of scores wins, of equal ones that with the longest last piece. A byte that no
piece covers is its byte piece, at `UNKNOWN` below the lowest score. Spaces are U+2581, and a text
that is not empty gets one in front (as the model's own settings say).

The model at hand has the scores of byte-pair merges (minus the rank). The best segmentation by
their sum is another one than the merges in order of rank would give; decoding is the same.

For speed a text is cut where no piece can span (before a run of spaces, and around line ends if
no piece holds one); equal parts are segmented once and remembered within a bound, and all new
parts of a batch run through the automaton together, one array operation per position.

Scale: no shuffle. The model (half a megabyte) is broadcast as pieces and scores, the automaton
is built once per worker; its size depends on the vocabulary only.

Defined cases: null and empty texts have no pieces; repeated rows and null doc_ids give a row
each; other columns are ignored; a literal U+2581 decodes as a space.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MODEL = public_tokenizers.path("piece_bpe_32k.model")
SPACE = "▁"
UNKNOWN = 10.0
# Parts remembered by a worker, the longest of them, and the parts of one array.
MEMORY_PARTS = 100_000
LONGEST_PART = 64
TOGETHER = 8192
# Places of one array: long parts run in smaller company.
CELLS = 1_000_000


def read_model(path: str) -> tuple[list[str], list[float], dict[int, int]]:
    """Pieces and scores by id ('' for control pieces), and the id of each byte piece."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, scores, byte_ids = [], [], {}
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            byte_ids[int(piece[1:-1], 16)] = i
        plain = not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
        pieces.append(piece if plain else "")
        scores.append(model.get_score(i))
    return pieces, scores, byte_ids


class Segmenter:
    """Best segmentation of byte strings under a vocabulary."""

    def __init__(self, pieces: list[str], scores: list[float], byte_ids: dict[int, int]):
        plain = {p.encode(): i for i, p in enumerate(pieces) if p}
        lowest = min((scores[i] for i in plain.values()), default=0.0)
        self.byte_id = np.array([byte_ids.get(b, 0) for b in range(256)], np.int32)
        self.byte_score = lowest - UNKNOWN
        self.bytes_of = [p.encode() for p in pieces]
        for b, i in byte_ids.items():
            self.bytes_of[i] = bytes([b])
        self._build(plain, scores)
        # a part ends before a run of spaces: no piece has a space after another character
        if any(SPACE in p.lstrip(SPACE) for p in pieces):
            self.parts = re.compile(r"[\s\S]+")
        elif any("\n" in p for p in pieces):
            self.parts = re.compile(r" *[^ ]+| +")
        else:
            self.parts = re.compile(r"\n| *[^ \n]+| +")
        self.known: dict[str, tuple[np.ndarray, float]] = {}

    def _build(self, plain: dict[bytes, int], scores: list[float]) -> None:
        """Trie, then failure links by breadth; transitions are complete, one row per state."""
        children: list[dict[int, int]] = [{}]
        ends = [-1]
        for piece, i in plain.items():
            state = 0
            for b in piece:
                nxt = children[state].get(b)
                if nxt is None:
                    nxt = children[state][b] = len(children)
                    children.append({})
                    ends.append(-1)
                state = nxt
            ends[state] = i
        n = len(children)
        self.go = np.zeros((n, 256), np.int32)
        self.piece = np.array(ends, np.int32)
        self.link = np.zeros(n, np.int32)  # the longest proper suffix that is a piece
        fail = [0] * n
        queue = [0]
        for state in queue:  # grows while it is read
            if state:
                self.go[state] = self.go[fail[state]]
            for b, child in children[state].items():
                fail[child] = int(self.go[state, b]) if state else 0
                f = fail[child]
                self.link[child] = f if self.piece[f] >= 0 else self.link[f]
                queue.append(child)
            for b, child in children[state].items():
                self.go[state, b] = child
        size = np.zeros(n, np.int32)
        score = np.zeros(n)
        held = np.flatnonzero(self.piece >= 0)
        size[held] = [len(self.bytes_of[i]) for i in self.piece[held]]
        score[held] = [scores[i] for i in self.piece[held]]
        self.size, self.score = size, score

    def segment(self, texts: list[bytes]) -> list[tuple[np.ndarray, float]]:
        """(ids, score) of each byte string; all advance together, the longest first."""
        lengths = np.array([len(t) for t in texts])
        order = np.argsort(-lengths, kind="stable")
        out: list = [None] * len(texts)
        low = 0
        while low < len(texts):
            rows = order[low : low + max(1, min(TOGETHER, CELLS // (int(lengths[order[low]]) + 1)))]
            low += len(rows)
            for i, found in zip(rows.tolist(), self._together([texts[i] for i in rows]), strict=True):
                out[i] = found
        return out

    def _together(self, texts: list[bytes]) -> list[tuple[np.ndarray, float]]:
        lengths = np.array([len(t) for t in texts])
        n, width = len(texts), int(lengths[0])
        data = np.zeros((width, n), np.uint8)
        flat = np.frombuffer(b"".join(texts), np.uint8)
        row = np.repeat(np.arange(n), lengths)
        data[np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths), row] = flat
        best = np.zeros((width + 1, n))
        came = np.zeros((width + 1, n), np.int32)  # length of the last piece
        last = np.zeros((width + 1, n), np.int32)  # its id
        state = np.zeros(n, np.int32)
        active = np.searchsorted(-lengths, -np.arange(width), "left")  # longer than the position
        for at in range(width):
            m = int(active[at])
            byte = data[at, :m]
            state = self.go[state[:m], byte]
            top, size, piece = np.full(m, -np.inf), np.ones(m, np.int32), self.byte_id[byte]
            rows = np.arange(m)
            out = np.where(self.piece[state] >= 0, state, self.link[state])
            while True:
                live = out > 0
                if not live.all():
                    rows, out = rows[live], out[live]
                if not len(rows):
                    break
                score = best[at + 1 - self.size[out], rows] + self.score[out]
                better = score > top[rows]
                won, node = rows[better], out[better]
                top[won], size[won], piece[won] = score[better], self.size[node], self.piece[node]
                out = self.link[out]
            single = best[at, :m] + self.byte_score
            alone = single > top
            best[at + 1, :m] = np.where(alone, single, top)
            came[at + 1, :m] = np.where(alone, 1, size)
            last[at + 1, :m] = np.where(alone, self.byte_id[byte], piece)
        place, rows = lengths.copy(), np.arange(n)
        steps, owners = [], []
        rows = rows[place > 0]
        while len(rows):
            here = place[rows]
            steps.append(last[here, rows])
            owners.append(rows)
            place[rows] = here - came[here, rows]
            rows = rows[place[rows] > 0]
        if not steps:
            return [(np.zeros(0, np.int32), 0.0)] * n
        ids, owners = np.concatenate(steps[::-1]), np.concatenate(owners[::-1])
        ids = ids[np.argsort(owners, kind="stable")]
        cuts = np.cumsum(np.bincount(owners, minlength=n))[:-1]
        return list(zip(np.split(ids, cuts), best[lengths, np.arange(n)].tolist(), strict=True))

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, float]]:
        """(ids, score) of whole texts."""
        split = [self.parts.findall(" " + t.replace(SPACE, " ")) if t else [] for t in texts]
        if len(self.known) > MEMORY_PARTS:
            self.known = {}
        fresh = list(set().union(*split).difference(self.known))
        found = self.segment([p.replace(" ", SPACE).encode() for p in fresh])
        rare = {}
        for part, x in zip(fresh, found, strict=True):
            (self.known if len(part) <= LONGEST_PART else rare)[part] = x
        out = []
        for parts in split:
            got = [self.known[p] if p in self.known else rare[p] for p in parts]
            ids = np.concatenate([g[0] for g in got]) if got else np.zeros(0, np.int32)
            out.append((ids, sum(g[1] for g in got)))
        return out

    def decode(self, ids: list[int]) -> str:
        """The text of some ids."""
        text = b"".join([self.bytes_of[i] for i in ids]).decode("utf-8", "replace").replace(SPACE, " ")
        return text[1:]


_SEGMENTERS: dict[str, Segmenter] = {}


def _segmenter(name: str, model) -> Segmenter:
    """A worker keeps the segmenter of one model, by the digest of the model file."""
    if name not in _SEGMENTERS:
        _SEGMENTERS.clear()
        _SEGMENTERS[name] = Segmenter(*model.value)
    return _SEGMENTERS[name]


def _shared(spark, path: str):
    """Digest of a model file, and its pieces as a broadcast of a few megabytes."""
    with open(path, "rb") as file:
        name = hashlib.sha1(file.read()).hexdigest()
    return name, spark.sparkContext.broadcast(read_model(path))


def _encode(name: str, model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segmenter = _segmenter(name, model)
        for batch in batches:
            for low in range(0, len(batch), 500):
                part = batch.slice(low, 500)
                texts = [t or "" for t in part.column("text").to_pylist()]
                found = segmenter.encode(texts)
                restored = [segmenter.decode(ids.tolist()) == t.replace(SPACE, " ")
                            for t, (ids, _) in zip(texts, found, strict=True)]
                ends = np.cumsum([0, *(len(ids) for ids, _ in found)]).astype(np.int32)
                ids = np.concatenate([ids for ids, _ in found])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(np.diff(ends).astype(np.int64)),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(ids, pa.int32())),
                     pa.array([s for _, s in found], pa.float64()), pa.array(restored)],
                    ["doc_id", "n_pieces", "piece_ids", "score", "restored"])

    return run


def encode_pieces(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id, n_pieces, piece_ids, score, restored of every document row.

    restored: decoding the ids gives the text back.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(_encode(*_shared(docs.sparkSession, model)),
                            "doc_id bigint, n_pieces bigint, piece_ids array<int>, score double, restored boolean")


def decode_pieces(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """(doc_id, text) of (doc_id, piece_ids); null ids give an empty text."""
    name, pieces = _shared(encoded.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segmenter = _segmenter(name, pieces)
        for batch in batches:
            texts = [segmenter.decode(ids or []) for ids in batch.column("piece_ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())],
                                             ["doc_id", "text"])

    return encoded.select("doc_id", "piece_ids").mapInArrow(run, "doc_id bigint, text string")
