"""Names of a block's largest component are not compared with one another."""

from __future__ import annotations

from entitymill.operators import nametiles

SCHEMA = "block string, name string, at long, grp long, in_top boolean"


def test_names_of_the_largest_component_do_not_meet(spark):
    names = [("x", f"n{i}", i, 1, True) for i in range(50)] + [("x", f"m{i}", 50 + i, 2 + i % 2, False) for i in range(6)]
    placed = spark.createDataFrame(names, SCHEMA)
    new, known = ({tuple(r) for r in nametiles._sided(placed, k).select("block", "name").collect()} for k in (False, True))
    meet = {(a, b) for block, a in new for other, b in known if block == other}
    top, rest = {n[1] for n in names if n[4]}, {n[1] for n in names if not n[4]}
    # every pair of which one is outside, both ways, and no other
    assert meet == {(a, b) for a in top | rest for b in top | rest if not (a in top and b in top)}


def test_only_what_must_meet_reaches_the_tiles(spark, monkeypatch):
    """A chain of similar names is one component by its first links; two unlike names are others."""
    chain = ["".join("zyxwvuts"[(i + j) // 9 % 8] + "abcdefg"[j % 7] for j in range(12)) for i in range(40)]
    rows = [("x", n, i) for i, n in enumerate(dict.fromkeys([*chain, "qqqqqq", "kkkkkkkk"]))]
    sent = []

    def run(new, known, threshold, kind, chunk_type, name):
        if chunk_type is nametiles._Joined:
            met = new.select("block", "name").join(known.select("block", "name").withColumnRenamed("name", "other"), "block")
            sent.append(met.count())
        return run_tiles(new, known, threshold, kind, chunk_type, name)

    run_tiles = nametiles._run
    monkeypatch.setattr(nametiles, "_run", run)
    named = spark.createDataFrame(rows, "block string, name string, at long")
    found = nametiles.similar_links(named, spark.createDataFrame([], "u long, v long"), 0.85, "block").collect()
    assert len({tuple(r) for r in found}) >= len(rows) - 3
    # both ways of 2 names with all others, and among themselves
    assert sent == [2 * 2 * (len(rows) - 2) + 4]
