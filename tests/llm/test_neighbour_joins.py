"""The join of queries with the entries of the cells that they visit."""

from __future__ import annotations

import numpy as np

from entitymill.llm import neighbours


def test_neither_side_of_the_cells_is_broadcast(spark):
    rng = np.random.default_rng(3)
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.normal(size=(1500, 8)))], "id long, v array<double>")
    found = neighbours.search(rows, rows.where("id % 100 = 0"), least=300)
    assert len(found.collect()) == 15 * neighbours.TOP
    plan = found._jdf.queryExecution().executedPlan().toString()
    # the few queries are many rows once they are dealt to groups of cells
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_groups_of_cells_do_not_change_what_is_found(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.normal(size=(900, 6)))], "id long, v array<double>")
    found = {}
    for groups in (1, 5, 64, 10**6):
        monkeypatch.setattr(neighbours, "GROUPS", groups)
        found[groups] = sorted(map(tuple, neighbours.search(rows, rows.where("id % 50 = 0"), share=0.2, least=100).collect()))
    assert len(found[1]) == 18 * neighbours.TOP and found[1] == found[5] == found[64] == found[10**6]


def test_a_query_goes_once_to_a_group(spark):
    import pyarrow as pa

    class Books:
        value = [np.array([[0.0], [1.0], [2.0]]), np.array([[0.0], [1.0], [2.0]])]

    rows = pa.RecordBatch.from_arrays([pa.array([7, 8]), pa.array([[0.1, 0.1], [1.9, 1.9]])], ["id", "v"])
    out, = neighbours._visit(Books, np.ones(9, np.int64), 9, 2)(iter([rows]))
    assert out.to_pydict()["id"] == [7, 7, 8, 8] and out.to_pydict()["grp"] == [0, 1, 0, 1]
    assert out.to_pydict()["cells"] == [[0, 2, 4, 6, 8], [1, 3, 5, 7]] * 2
