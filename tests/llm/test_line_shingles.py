"""Line dedup against brute force on lines that differ late in a word or in one letter."""

import random

from courtline.llm import line_dedup
from courtline.llm.line_dedup import dedup_lines
from tests.llm.conftest import SCHEMA
from tests.llm.test_dedup import brute_lines


def check_lines(docs):
    """Rows of ``dedup_lines``, held against brute force."""
    got = dedup_lines(docs).select("doc_id", "text", "n_lines", "n_dropped").collect()
    assert sorted(map(tuple, got), key=str) == brute_lines([(r.doc_id, r.text) for r in docs.collect()])
    return got


def test_every_letter_of_a_run_counts(spark):
    pairs = [
        ("Responsibility", "Responsibilities"),
        ("Bundesverfassungsgericht", "Bundesverfassungsschutz"),
        ("acgtacgtac" + "ggacttgacc" * 5, "acgtacgtac" + "ttccagtgaa" * 5),
    ]
    rows = [(n, line, None, None) for n, line in enumerate(x for pair in pairs for x in pair)]
    got = check_lines(spark.createDataFrame(rows, SCHEMA))
    assert sum(r.n_dropped for r in got) == 0


def test_short_lines_with_one_letter_changed(spark):
    lines = [
        "the committee will publish its annual report on water supply next spring",
        "most of the old houses along the river were built before the railway came",
        "please bring your own cups and plates as the kitchen is closed on sundays",
    ]
    rows = [(n, line, None, None) for n, line in enumerate(lines)]
    rows += [(10 + n, line[:40] + "#" + line[41:], None, None) for n, line in enumerate(lines)]
    got = check_lines(spark.createDataFrame(rows, SCHEMA))
    assert sorted(r.doc_id for r in got if r.n_dropped) == [10, 11, 12]


def test_wider_bitmaps_lose_no_link(spark, monkeypatch):
    """Lines around the threshold, with wider bitmaps ahead of their sets, against brute force."""
    rng = random.Random(11)
    letters = [rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(120)]

    def changed(places):
        line = list(letters)
        for at in rng.sample(range(120), places):
            line[at] = rng.choice("0123456789")
        return "".join(line)

    rows = [(n, changed(n % 5), None, None) for n in range(60)] + [(60, "".join(letters) * 30, None, None), (61, "Ab", None, None), (62, "aB", None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    monkeypatch.setattr(line_dedup, "FINE_PAIRS", 0)
    monkeypatch.setattr(line_dedup, "LONG_LINE", 1000)
    assert 20 < sum(r.n_dropped for r in check_lines(docs)) < 62


def test_repetitive_lines_meet_short_ones(spark, monkeypatch):
    """Lines of few shingles and any number of places, and lines around the sizes at which the bands change."""
    rng = random.Random(13)
    lines = ["-" * n for n in (20, 90, 500)] + ["---- x ----", "-" * 130 + " x " + "-" * 130, "ab" * 30, "ab" * 400]
    for size in (30, 40, 44, 60, 80, 84, 90, 150):
        letters = [rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(size)]
        for at in (0, size // 2, size - 1):
            lines.append("".join(letters[:at] + ["#"] + letters[at:]))
        lines.append("".join(letters) * 9)
    docs = spark.createDataFrame([(n, line, None, None) for n, line in enumerate(lines)], SCHEMA)
    monkeypatch.setattr(line_dedup, "LONG_LINE", 450)
    check_lines(docs)


def test_a_lines_places_are_summed_by_cell(spark):
    """One row for each cell of a line, not a wide row of minima for each place; unlike lines share no band."""
    rng = random.Random(17)
    lines = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n)) for n in (30, 60, 300, 3000)]
    docs = spark.createDataFrame([(n, f"{line}\n{line}", None, None) for n, line in enumerate(lines)], SCHEMA)
    rows = {r.places: r for r in line_dedup.signatures(docs).collect()}
    assert sorted(rows) == [26, 56, 296, 2996] and {r.n for r in rows.values()} == {2}
    assert len(rows[26].bands) == 30 and 30 < len(rows[56].bands) <= 58 and len(rows[296].bands) == len(rows[2996].bands) == 28
    assert len({b for r in rows.values() for b in r.bands}) == sum(len(r.bands) for r in rows.values())
    cells = line_dedup.cell_rows(line_dedup.lines_of(docs, "doc_id", "text").select("h1", "h2", "line"))
    assert cells.count() <= 4 * line_dedup.CELLS
