"""JSON document handling: validate + parse once, extract typed fields, build.

Every leaf of the parse schemas is STRING and cast afterwards: that is the
closest Spark form of "extract as text, then cast" (``->>`` + CAST). A number
token read into a STRING field keeps its text ("12"), while an INT field would
silently turn a quoted number into NULL.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed document shapes of the three raw tables (leaf names as the API emits them).
GAME_DDL = (
    "id STRING, date STRING, season STRING, status STRING, "
    "home_team STRUCT<abbreviation: STRING, full_name: STRING>, "
    "visitor_team STRUCT<abbreviation: STRING, full_name: STRING>, "
    "home_team_score STRING, visitor_team_score STRING"
)
PLAYER_STATS_DDL = (
    "id STRING, game_id STRING, player_id STRING, team STRUCT<abbreviation: STRING>, "
    "date STRING, min STRING, pts STRING, reb STRING, ast STRING, stl STRING, blk STRING, "
    "turnover STRING, fgm STRING, fga STRING, fg3m STRING, fg3a STRING, ftm STRING, "
    "fta STRING, pf STRING"
)
TEAM_STATS_DDL = (
    "team STRUCT<abbreviation: STRING, full_name: STRING>, date STRING, wins STRING, "
    "losses STRING, pts_per_game STRING, reb_per_game STRING, ast_per_game STRING, "
    "opp_pts_per_game STRING, fg_pct STRING, fg3_pct STRING, ft_pct STRING"
)
# A landed API response: {"data": [document, ...]}; each document stays text.
RESPONSE_DDL = "data ARRAY<STRING>"
BROKEN = "_broken"  # holds the text of a document that does not fit its schema


def parse_json(text: Column, ddl: str) -> Column:
    """Validating text -> JSON cast: malformed text raises (FAILFAST), and so
    does an empty or blank document, which from_json alone would map to NULL.
    A NULL document stays NULL."""
    blank = text.isNotNull() & text.rlike(r'^\s*$')
    checked = F.when(blank, F.raise_error(F.lit("empty JSON document"))).otherwise(text)
    return F.from_json(checked, ddl, {"mode": "FAILFAST"})


def parse_documents(raw: DataFrame, ddl: str, ints: Sequence[str]) -> DataFrame:
    """partition_date with typed (``ints`` are INT) or, where that is NULL, doc (as of ``parse_json``).

    Spark writes a number out again to read it as text, which takes longer than all else, so
    documents are parsed with INT fields first. One with anything but an INT or null in such a
    field (a quoted number, a fraction, broken text) is parsed as text instead: what it
    gives, or raises, is up to ``parse_json`` and the casts alone."""
    typed = re.sub(rf"\b({'|'.join(ints)}) STRING", r"\1 INT", ddl)
    found = F.from_json("data", f"{typed}, {BROKEN} STRING", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN})
    rows = raw.select("partition_date", "data", found.alias("found"))
    usual = F.col("found").isNotNull() & F.col(f"found.{BROKEN}").isNull()
    return rows.select("partition_date", F.when(usual, F.col("found")).alias("typed"), F.when(~usual, parse_json(F.col("data"), ddl)).alias("doc"))


def json_text(doc: Column, *path: str) -> Column:
    """``doc->'a'->>'b'``: a (nested) field of a parsed document as text;
    an absent key or JSON null gives NULL."""
    out = doc
    for name in path:
        out = out.getField(name)
    return out


def json_int(doc: Column, *path: str) -> Column:
    """Field as INT (ANSI cast: non-integer text raises)."""
    return json_text(doc, *path).cast("int")


def json_float(doc: Column, *path: str) -> Column:
    """Field as FLOAT (32-bit)."""
    return json_text(doc, *path).cast("float")


def build_json(record: Column) -> Column:
    """Record -> JSON text, keys in field order, no spaces."""
    return F.to_json(record)
