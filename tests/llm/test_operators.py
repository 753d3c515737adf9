"""The operators against brute force, and on nulls, empty tables, ties and clashing columns."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from entitymill.llm import (
    crf, decontaminate, golay, lines, neighbours, pfor, pieces, simhash, substrings, suffixes, tokenfiles, toxicity,
    warc,
)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, mark long, pos int"


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


@pytest.fixture(scope="module")
def texts():
    """Odd rows: null and repeated ids, null and empty texts, copies, passages, periodic and long texts."""
    rng = random.Random(3)
    words = ["ab", "cd", "e", "füg", "日本", "x" * 9, "Hit,", "no."]
    passage = " ".join(rng.choices(words, k=90))
    rows = [(None, "a b c d"), (None, None), (1, None), (2, ""), (3, "  \n\n "), (4, "one"), (4, "two"),
            (5, passage), (5, passage), (6, passage), (None, passage)]
    for i in range(10, 40):
        own = " ".join(rng.choices(words, k=rng.randint(1, 120)))
        rows.append((i, own if i % 3 else own[:40] + " " + passage[: rng.randint(100, 400)] + "\nend " + own[40:]))
    rows.append((50, "same line\n" * 300))
    rows.append((51, "z" * 5000))
    rows.append((52, " ".join(rng.choices(words, k=30_000))))
    return rows


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "en", "s", 1, "clash", 7, 8) for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def same(frame, columns, wanted):
    got = sorted((tuple(r) for r in frame.select(*columns).collect()), key=repr)
    assert got == sorted(wanted, key=repr)


@pytest.mark.parametrize("hot", [1, 2, 4, 50_000])
def test_substrings(docs, none, texts, hot):
    window, places = 35, defaultdict(list)
    rows = [(t or "").encode().split() for _, t in texts]
    for n, words in enumerate(rows):
        for i in range(len(words) - window + 1):
            places[tuple(words[i : i + window])].append((n, i))
    gone = defaultdict(set)
    for found in places.values():
        for n, i in found if len(found) > 1 else ():
            gone[n].update(range(i, i + window))
    wanted = [(texts[n][0], len(w), len(gone[n]), sha(b" ".join(x for i, x in enumerate(w) if i not in gone[n])))
              for n, w in enumerate(rows)]
    got = substrings.dedup_substrings(docs, hot_rows=hot)
    same(got, ["doc_id", "n_words", "n_removed", "kept_sha256"], wanted)
    assert substrings.dedup_substrings(none).count() == 0


@pytest.mark.parametrize("hot", [1, 2, 4, 50_000])
def test_suffixes(docs, none, texts, hot):
    window, gram, places = 60, 12, defaultdict(list)
    rows = [(t or "").encode() for _, t in texts]
    for n, data in enumerate(rows):
        for i in range(len(data) - window + 1):
            places[data[i : i + window]].append((n, i))
    gone = [np.zeros(len(d) + 1, int) for d in rows]
    for found in places.values():
        for n, i in found if len(found) > 1 else ():
            gone[n][i] += 1
            gone[n][i + window] -= 1
    wanted = []
    for (doc_id, _), data, marks in zip(texts, rows, gone, strict=True):
        cut = np.cumsum(marks)[:-1] > 0
        kept = np.frombuffer(data, np.uint8)[~cut].tobytes()
        spans = int((cut & ~np.insert(cut[:-1], 0, False)).sum()) if len(cut) else 0
        wanted.append((doc_id, len(data), int(cut.sum()), spans, sha(kept)))
    got = suffixes.dedup_bytes(docs, window=window, gram=gram, hot_rows=hot)
    same(got, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"], wanted)
    assert suffixes.dedup_bytes(none).count() == 0


def test_loser_tree_keeps_order_and_prefixes():
    rng = random.Random(1)
    for _ in range(300):
        runs = [sorted(bytes(rng.choices(b"ab", k=rng.randint(0, 6))) for _ in range(rng.randint(0, 5)))
                for _ in range(rng.randint(1, 6))]
        order, shared = suffixes.merge_runs([suffixes.front_code(r) for r in runs])
        out = [runs[r][i] for r, i in order]
        assert out == sorted(x for r in runs for x in r)
        assert shared[1:] == [suffixes.common_prefix(a, b) for a, b in itertools.pairwise(out)]


@pytest.mark.parametrize("broadcast", [0, 1000])
def test_decontaminate(spark, docs, none, texts, broadcast):
    passage = next(t for i, t in texts if i == 6).split()
    items = [(1, " ".join(passage[3:20])), (2, "ONE!"), (2, "ONE!"), (3, " ".join(passage[5:11])), (4, None), (5, ""),
             (None, " ".join(passage[40:60])), (12, " ".join(passage[3:20]))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    cut = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = defaultdict(set)
    for item, text in items:
        w = cut(text)
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[i : i + n])].add(item)
    wanted = []
    for doc_id, text in texts:
        w, hit, found = cut(text), set(), set()
        for n in set(map(len, windows)):
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[tuple(w[i : i + n])]
        listed = ",".join(sorted(str(x) for x in found if x is not None))
        wanted.append((doc_id, len(w), len(hit), len(found), sha(listed.encode()), bool(hit)))
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    same(decontaminate.decontaminate(docs, bench, broadcast_marks=broadcast), columns, wanted)
    assert decontaminate.decontaminate(none, bench).count() == 0
    assert decontaminate.decontaminate(docs, bench.limit(0)).where("contaminated").count() == 0


def test_golay_keys_meet_within_three_bits():
    rng = np.random.default_rng(1)
    prints = rng.integers(0, 2**63, 500, dtype=np.uint64) * 2 + rng.integers(0, 2, 500).astype(np.uint64)
    for errors in (0, 1, 2, 3):
        other = prints.copy()
        for i in range(len(other)):
            for bit in rng.choice(64, errors, replace=False):
                other[i] ^= np.uint64(1) << np.uint64(bit)
        a, b = (set(zip(*(x.tolist() for x in simhash.fuzzy_keys(p)), strict=True)) for p in (prints, other))
        assert {place for place, _ in a & b} == set(range(500))
    near = golay.nearby(np.arange(1 << 12))
    assert near[:, 0].min() >= 0 and near.shape == (1 << 12, 6)


def test_simhash(docs, none, texts):
    prints = []
    for _, text in texts:
        w = re.sub("[A-Z]", lambda m: m[0].lower(), text or "").encode().split()
        pieces_ = [b" ".join(w[i : i + 3]) for i in range(max(len(w) - 2, 1))] if w else []
        h = [xxhash.xxh64_intdigest(p, 42) for p in pieces_]
        prints.append(sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)))
    group = list(range(len(prints)))
    for i, j in itertools.combinations(range(len(prints)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= 3 and group[i] != group[j]:
            group = [group[i] if g == group[j] else g for g in group]
    least = {}
    for g, (doc_id, _) in zip(group, texts, strict=True):
        least[g] = min((x for x in (least.get(g), doc_id) if x is not None), default=None)
    wanted = [(d, f"{p:016x}", least[g]) for (d, _), p, g in zip(texts, prints, group, strict=True)]
    same(simhash.near_duplicates(docs), ["doc_id", "fingerprint", "component_id"], wanted)
    assert simhash.near_duplicates(none).count() == 0


def test_links_connect_what_brute_force_connects():
    rng = np.random.default_rng(2)
    prints = np.unique(np.uint64(1) << rng.integers(0, 9, 40).astype(np.uint64) | np.uint64(1) << rng.integers(0, 9, 40).astype(np.uint64))
    links = simhash.links_within(prints)
    assert len(links) < len(prints) and all((a ^ b).bit_count() <= 3 for a, b in links)


def test_lines(spark, docs, none):
    same_lines = "a\nb\n\nc"
    rows = [(1, "x\n" + same_lines + "\ny"), (2, same_lines), (3, "q\n" + same_lines + "\nd"), (4, "solo"), (5, "solo"),
            (6, "a\nb"), (7, None), (8, ""), (None, same_lines), (9, "r\n" * 5)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.row.doc_id, r.n_lines, r.n_removed, r.kept) for r in lines.dedup_lines(frame).collect()]
    assert sorted(got, key=repr) == sorted([
        (1, 6, 0, rows[0][1]), (2, 4, 4, ""), (3, 6, 4, "q\nd"), (4, 1, 0, "solo"), (5, 1, 1, ""), (6, 2, 0, "a\nb"),
        (7, 0, 0, None), (8, 1, 0, ""), (None, 4, 4, ""), (9, 6, 4, "r\n")], key=repr)
    assert lines.dedup_lines(docs).count() == docs.count()
    assert lines.dedup_lines(none).count() == 0


def test_token_files(docs, none, texts):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(tokenfiles.TOKENIZER)
    shards = tokenfiles.write_shards(docs, shard_ids=500)
    assert shards.count() > 10
    got = tokenfiles.read_documents(shards).collect()
    ids = [[*whole.encode(t or "", add_special_tokens=False).ids, 2] for _, t in texts]
    crc = [zlib.crc32(np.array(x, "<u4").tobytes()) for x in ids]
    assert sorted((repr(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == sorted(
        (repr(d), len(x), c) for (d, _), x, c in zip(texts, ids, crc, strict=True))
    got.sort(key=lambda r: r.start)
    assert [r.start for r in got] == np.cumsum([0, *(r.n_tokens for r in got)])[:-1].tolist()
    order = [-1 if r.doc_id is None else r.doc_id for r in got]
    assert order == sorted(order)
    assert tokenfiles.read_documents(tokenfiles.write_shards(none)).count() == 0


def test_parts_give_the_ids_of_whole_texts():
    from tokenizers import Tokenizer

    with open(tokenfiles.TOKENIZER, encoding="utf-8") as file:
        encoder = tokenfiles.PartEncoder(file.read())
    whole, rng = Tokenizer.from_file(tokenfiles.TOKENIZER), random.Random(5)
    signs = "ab'.,<|>ÉßĲ1½ \n\t#_-é́日Σs t re"
    texts = ["".join(rng.choices(signs, k=rng.randint(0, 30))) for _ in range(3000)]
    texts += ["x <|endoftext|> y", "<|ENDOFTEXT|>", "it's l'été 'start", "İstanbul\x85 \r\n"]
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)] == [
        e.ids for e in whole.encode_batch(texts, add_special_tokens=False)]


def test_pfor_round_trip():
    rng = np.random.default_rng(1)
    for n, high in itertools.product((0, 1, 2047, 2048, 2049, 5000), (1, 1000, 2**32 - 1)):
        values = rng.integers(0, high + 1, n, dtype=np.uint64).astype(np.uint32)
        values[rng.random(n) < 0.02] = 2**32 - 1
        stream = pfor.encode(values)
        assert (pfor.decode(stream) == values).all()
        assert (pfor.decode(stream, 3, 2500) == values[3:2500]).all()


def test_pieces(docs, none, texts):
    plain, scores, byte_ids = pieces.read_model(pieces.MODEL)
    segmenter = pieces.Segmenter(plain, scores, byte_ids)
    score_of = {p.encode(): s for p, s in zip(plain, scores, strict=True) if p}

    def best(data: bytes) -> float:
        out = [0.0] + [-np.inf] * len(data)
        for i in range(len(data)):
            out[i + 1] = max(out[i + 1], out[i] + segmenter.byte_score)
            for j in range(i + 1, min(len(data), i + 60) + 1):
                if data[i:j] in score_of:
                    out[j] = max(out[j], out[i] + score_of[data[i:j]])
        return out[-1]

    encoded = pieces.encode_pieces(docs)
    rows = encoded.collect()
    assert len(rows) == len(texts) and all(r.restored for r in rows)
    for text in [t for _, t in texts if t and len(t) < 3000] + ["\n\n x\ny", "  a  b ", "▁", "y" * 700]:
        ids, score = segmenter.encode([text])[0]
        assert score == best((" " + text).replace(" ", "▁").encode())
        assert segmenter.decode(ids.tolist()) == text.replace("▁", " ")
    assert sorted(r.text for r in pieces.decode_pieces(encoded).collect()) == sorted(t or "" for _, t in texts)
    assert pieces.encode_pieces(none).count() == 0


def test_crf_marginals_equal_enumeration():
    rng = np.random.default_rng(0)
    emit, pair, first = rng.normal(size=(9, 2)), rng.normal(size=(2, 2)), np.array([0, 4, 4, 9])
    wanted, both, log_z = np.zeros((9, 2)), np.zeros((2, 2)), 0.0
    for a, b in ((0, 4), (4, 9)):
        total, part, moves = 0.0, np.zeros((b - a, 2)), np.zeros((2, 2))
        for y in itertools.product((0, 1), repeat=b - a):
            w = np.exp(sum(emit[a + i, v] for i, v in enumerate(y)) + sum(pair[u, v] for u, v in itertools.pairwise(y)))
            total += w
            part[range(b - a), y] += w
            for u, v in itertools.pairwise(y):
                moves[u, v] += w
        wanted[a:b] = part / total
        both += moves / total
        log_z += np.log(total)
    for step in (2, 64):
        crf.STEP = step
        got = crf.marginals(emit, pair, first)
        assert np.allclose(got[0], wanted) and np.allclose(got[1], both) and np.isclose(got[2], log_z)


def test_toxicity_held_out_and_odd_rows(spark, docs, none):
    sf = "/root/testdata/sf0.1"
    real, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.train(real, labels)
    rows = real.select("doc_id", "text").join(labels.select("doc_id", "toxic"), "doc_id")
    scored = toxicity.score(rows, model).withColumn("held", toxicity.held_out()).where("held").toPandas()
    bad, hit = scored["toxic"] == 1, scored["score"] >= toxicity.THRESHOLD
    # a part of the labels is noise: some toxic documents hold no toxic word
    assert (bad & hit).sum() >= 0.7 * bad.sum() and (hit & ~bad).sum() <= 0.02 * (~bad).sum()
    spans = scored[bad & hit].iloc[0]
    assert all(spans.text[s["start"] : s["end"]].strip() for s in spans.spans)
    odd = toxicity.score(docs.select("doc_id", "text"), model).collect()
    assert len(odd) == docs.count() and all(0 <= r.score <= 1 for r in odd)
    assert toxicity.score_documents(docs, labels.limit(0)).where("score = 0").count() == docs.count()
    assert toxicity.score_documents(none, labels).count() == 0


def test_warc(spark):
    long, other = "<p>ü</p>" * 200, "y" * 1000
    rows = [(1, "u", long), (2, "u\r\nv", long), (2, None, long), (3, "u", "tiny"), (4, "u", "tiny"), (5, "u", None),
            (None, "u", other), (None, "u", other), (9, "u", "a\r\n\r\nb" * 300), (8, "u", "a\r\n\r\nb" * 300)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload", F.lit(1))
    archive = warc.write_archive(pages)
    assert archive.payloads.count() == 5
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
                  for r in warc.read_records(archive).collect()), key=repr)
    wanted = []
    for page_id, _, html in rows:
        data = (html or "").encode()
        leader = max((i for i, _, h in rows if h == html and i is not None), default=None) if len(data) >= 1000 else None
        revisit = leader is not None and leader != page_id
        wanted.append((page_id, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response",
                       leader if revisit else None))
    assert got == sorted(wanted, key=repr)
    record = bytes(warc.records(archive).where("page_id = 3").first().record)
    assert record.startswith(b"WARC/1.1\r\nWARC-Type: response") and record.endswith(b"tiny\r\n\r\n")
    assert warc.archive_pages(pages.limit(0)).count() == 0


def test_neighbours(spark):
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(700, 8)).round(3)
    vectors[300:500] = vectors[299]  # a vector that many rows share
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    rows += [(900, None), (1000, [0.0] * 8), (1100, [1.0, None] + [0.0] * 6), (1200, [float("nan")] * 8), (None, [1.0] * 8),
             (1300, [1.0] * 3), (3, vectors[3].tolist())]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("cell", F.lit(1))
    usable = neighbours.usable_vectors(frame)
    got = neighbours.search(usable, usable.where("id % 100 = 0"), least=700).toPandas()
    hits = 0
    for query, found in got.groupby("query_id"):
        distance = np.sqrt(((vectors - vectors[query]) ** 2).sum(1))
        ids = np.delete(np.arange(700), query)
        order = ids[np.lexsort((ids, distance[ids]))[:10]]
        found = found.sort_values("rank")
        assert found["rank"].tolist() == list(range(1, 11))
        assert np.allclose(found["score"], distance[found["vec_id"]], rtol=1e-12, atol=0)
        hits += len(set(order) & set(found["vec_id"]))
    assert set(got["query_id"]) == set(range(0, 700, 100)) and hits == 70
    assert neighbours.search(usable.limit(0), usable).count() == 0
    few = usable.where("id < 4")
    assert neighbours.search(few, few.where("id = 0")).count() == 3
