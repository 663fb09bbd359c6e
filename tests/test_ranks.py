"""Global ranks of several measures in one range sort."""

import pytest

from courtline.operators.windows import ranks_by_measure


@pytest.mark.parametrize("rows_per_range", [7, 2_000_000])
def test_ranks_against_sorting(spark, rows_per_range):
    # a third of the rows tie in x, some measures and keys are NULL
    rows = [(f"k{i % 50}" if i % 41 else None, i // 50, 1.5 if i % 3 == 0 else float(i * 7 % 23), None if i % 10 == 0 else i * 13 % 17) for i in range(300)]
    df = spark.createDataFrame(rows, "a string, b int, x double, y int").dropDuplicates(["a", "b"])
    held = [tuple(r) for r in df.collect()]
    got = ranks_by_measure(df, {"by_x": "x", "by_y": "y"}, keys=["a", "b"], rows_per_range=rows_per_range)
    assert got.columns == ["a", "b", "x", "y", "by_x", "by_y"]

    def order(measure):
        return lambda r: (r[measure] is None, -(r[measure] or 0), r[0] is None, r[0] or "", r[1])

    places = [{r: n for n, r in enumerate(sorted(held, key=order(m)), 1)} for m in (2, 3)]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(((*r, places[0][r], places[1][r]) for r in held), key=str)


def test_one_narrow_range_exchange_for_all_ranks(spark, monkeypatch):
    frame, sorts, points = type(spark.range(0)), [], []
    real_range, real_point = frame.repartitionByRange, frame.checkpoint
    monkeypatch.setattr(frame, "repartitionByRange", lambda self, *a: (sorts.append(self.columns), real_range(self, *a))[1])
    monkeypatch.setattr(frame, "checkpoint", lambda self, *a, **k: (points.append(self.columns), real_point(self, *a, **k))[1])
    df = spark.range(100).selectExpr("id", "id % 7 as x", "id % 5 as y", "id % 3 as z", "'wide' as more")
    got = ranks_by_measure(df, {"r": "x", "s": "y", "t": "z"}, keys=["id"])
    assert sorts == [["id", "_r", "_m"]] and len(points) == 2
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and got.count() == 100
    assert ranks_by_measure(df.where("false"), {"r": "x"}, keys=["id"]).count() == 0
