"""Box-score documents: typed parsing gives, and raises, what parsing as text does."""

import datetime as dt
import json

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from courtline.plans import staging

DAY = dt.date(2024, 1, 2)


def staged(spark, *texts):
    return staging.stg_player_stats(spark.createDataFrame([(DAY, t) for t in texts], "partition_date date, data string"))


def box(**other):
    return json.dumps({"id": 7, "game_id": 3, "player_id": "p1", "team": {"abbreviation": "N1"}, "min": "12:00", "pts": 20, "reb": 4, "fgm": 1, "fga": 3} | other)


def test_unusual_documents_are_parsed_as_text(spark):
    texts = [box(), box(pts="20"), box(pts=" 20"), box(pts=None), box(id="a", pts="-0"), box(id=-0.5), None, box(_broken="x"), box(team=None)]
    rows = [(r.stat_id, r.player_id, r.team, r.points, round(r.fg_pct, 3)) for r in staged(spark, *texts).collect()]
    usual = ("7", "p1", "N1", 20, 0.333)
    assert rows[:4] == [usual, usual, usual, ("7", "p1", "N1", None, 0.333)]
    assert rows[4:6] == [("a", "p1", "N1", 0, 0.333), ("-0.5", "p1", "N1", 20, 0.333)]
    assert rows[6:] == [(None, None, None, None, 0.0), usual, ("7", "p1", None, 20, 0.333)]


@pytest.mark.parametrize("text", ["", " ", "{", box(pts="x"), box(pts=1.5), box(pts=3_000_000_000), box(pts=True)])
def test_broken_documents_raise(spark, text):
    with pytest.raises((PySparkException, Py4JJavaError)):
        staged(spark, box(), text).collect()


def test_integers_are_parsed_as_integers(spark):
    plan = staged(spark, box())._jdf.queryExecution().executedPlan().toString()
    assert "StructField(pts,IntegerType,true)" in plan
