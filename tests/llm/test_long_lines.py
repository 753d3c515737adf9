"""Long lines that stand again without two neighbours, in the line stage."""

from __future__ import annotations

import random

import corpus_pipeline
from entitymill.llm import lines


def brute_force(rows, words):
    """What is left of the texts: windows of three units, whole short texts, and runs that hold the words."""
    seen, gone = set(), [set() for _ in rows]
    for n, (_, text) in enumerate(rows):
        cut = text.split("\n")
        units = [i for i, x in enumerate(cut) if x.strip(" ")]
        for k in range(len(units)):
            sizes = {min(3, len(units))} if k + min(3, len(units)) <= len(units) else set()
            sizes |= {s for s in (1, 2) if k + s <= len(units) and sum(len(cut[i].split()) for i in units[k : k + s]) >= words}
            for s in sizes:
                piece = tuple(cut[i] for i in units[k : k + s])
                if piece in seen:
                    gone[n].update(range(units[k], units[k + s - 1] + 1))
                seen.add(piece)
    return [(d, "\n".join(x for i, x in enumerate(t.split("\n")) if i not in g))
            for (d, t), g in zip(rows, gone, strict=True)]


def test_lines_of_many_words(spark):
    rng = random.Random(6)
    pool = [" ".join(rng.choices(["ab", "c", "def"], k=n)) + f" {i}" for i, n in enumerate([48, 49, 60, 30, 24, 25, 3, 1, 1, 2])]
    rows = [(1, "a\n" + pool[2] + "\nb"), (2, "c\n" + pool[2] + "\nd"), (3, pool[2]), (4, "x\n" + pool[0] + "\ny"),
            (5, "p\n" + pool[0] + "\nq"), (6, "e\n" + pool[3] + "\n\n" + pool[4] + "\nf"), (7, pool[3] + "\n" + pool[4])]
    rows += [(i, "\n".join(rng.choices([*pool, "", " "], k=rng.randint(1, 9)))) for i in range(10, 60)]
    frame = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows],
                                  "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    got = sorted((r.doc_id, r.text) for r in corpus_pipeline.drop_repeated_lines(spark, frame, "").collect())
    assert got == brute_force(rows, 50)
    plain = {r.row.doc_id: r.n_removed for r in lines.dedup_lines(frame).collect()}
    assert plain[2] == plain[3] == 0 and got[1] == (2, "c\nd") and got[2] == (3, "")
