"""Conversation repair: the run-length DP against whole enumeration, the query against a row-by-row version."""

import hashlib
import heapq
import random
import re
import zlib
from functools import lru_cache

import pytest

from courtline.llm import turn_repair, turn_runs
from courtline.llm.queries import QUERIES
from courtline.llm.turn_repair import repair_damaged

SCHEMA = "conv_id long, turn long, role string, text string"
WORD = re.compile(r"[^\x20\x09-\x0D]")
COLUMNS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def symbol(cls, fault):
    return chr(turn_runs.FIRST_SYMBOL + 4 * fault + "suax".index(cls))


def cheapest(rows):
    """(cost, audit, roles) of the cheapest edits of (initial, fault) rows: best first over
    whole audits, so that of equal costs the ASCII-least audit comes out first."""
    heap = [(0, "", 0, "")]  # cost, audit, rows consumed, role initials
    seen = set()
    while heap:
        cost, audit, at, roles = heapq.heappop(heap)
        if at == len(rows) and re.fullmatch("(s?(ua)+)?", roles):
            return cost, audit, roles
        if (audit, at, roles) in seen or len(roles) > len(rows) + 2:
            continue
        seen.add((audit, at, roles))
        for new in "ua":
            heapq.heappush(heap, (cost + 5, audit + "I", at, roles + new))
        if at < len(rows):
            initial, fault = rows[at]
            heapq.heappush(heap, (cost + 2, audit + "D", at + 1, roles))
            if fault in ("fine", "truncated"):
                late = 5 * (fault == "truncated")
                heapq.heappush(heap, (cost + late, audit + "K", at + 1, roles + initial))
                for new in "ua":
                    heapq.heappush(heap, (cost + late + 1, audit + "R", at + 1, roles + new))


def test_against_all_edits():
    rng = random.Random(2)
    for _ in range(250):
        rows = [(rng.choice("suuaax"), rng.choice(["fine", "fine", "fine", "truncated", "blank", "duplicate"])) for _ in range(rng.randint(0, 5))]
        symbols = "".join(symbol(c, turn_runs.FAULTS.index(f)) for c, f in rows)
        assert turn_runs.audit_of(symbols)[1::-1] == cheapest(rows)[:2], rows


def row_by_row(rows):
    """(cost, audit) by a recursion over rows and states that compares whole audits."""
    steps = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}

    @lru_cache(None)
    def best(at, state, inserted):
        found = []
        if at == len(rows) and state in ("", "a"):
            found.append((0, ""))
        if inserted < 2:
            found += [(c + 5, "I" + x) for r, q in steps[state].items() if r != "s" for c, x in [best(at, q, inserted + 1)]]
        if at < len(rows):
            initial, fault = rows[at]
            c, x = best(at + 1, state, 0)
            found.append((c + 2, "D" + x))
            if fault in ("fine", "truncated"):
                late = 5 * (fault == "truncated")
                for role, q in steps[state].items():
                    c, x = best(at + 1, q, 0)
                    found += [(c + late, "K" + x)] if role == initial else []
                    found += [(c + late + 1, "R" + x)] if role != "s" else []
        return min(found, default=(10**9, ""))

    for at in range(len(rows), -1, -1):  # no deep recursion
        for state in steps:
            best(at, state, 2), best(at, state, 1), best(at, state, 0)
    return best(0, "", 0)


def test_long_runs_and_pieces_against_row_by_row():
    rng = random.Random(4)
    for _ in range(60):
        rows = [x for _ in range(rng.randint(1, 12)) for x in [(rng.choice("suuaax"), rng.choice(turn_runs.FAULTS))] * rng.choice([1, 1, 2, 3, 17, 70])]
        symbols = "".join(symbol(c, turn_runs.FAULTS.index(f)) for c, f in rows)
        cost, audit = row_by_row(tuple(rows))
        assert turn_runs.audit_of(symbols)[1::-1] == (cost, audit)
        cut = rng.randint(0, len(symbols))
        head, tail = symbols[:cut], symbols[cut:]
        togo = turn_runs.before(turn_runs.matrix_of(tail), turn_runs.END)
        one, cost_one, state = turn_runs.audit_of(head, togo, last=False)
        two, cost_two, _ = turn_runs.audit_of(tail, state=state)
        assert (one + two, cost_one + cost_two) == (audit, cost)


def brute(turns):
    """The contract, row by row."""
    convs = {}
    for conv, turn, role, text in turns:
        rows = convs.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        hit = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
        rows += [(turn, "user" if hit == 4 else role, text)] * (0 if hit == 0 else 2 if hit == 3 else 1)
    out = []
    for conv, rows in convs.items():
        same = lambda r: hashlib.sha256(f"{'-' if conv is None else conv}:{len(r[1])}:{r[1]}{r[2]}".encode()).digest()  # noqa: B023, E731
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), same(r)))
        seen, faults = set(), []
        for _, role, text in rows:
            said = WORD.findall(text)
            faults.append("blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else "fine")
            seen.add((role, text))
        marks = tuple((role[:1] if role[:1] in tuple("sua") else "x", fault) for (_, role, _), fault in zip(rows, faults))
        cost, audit = row_by_row(marks)
        lines, at, before = [], 0, ""
        for letter in audit:
            forced = {"": "user", "s": "user", "u": "assistant", "a": "user"}[before]
            if letter == "I":
                lines.append(f"{forced}:")
                before = forced[0]
                continue
            _, role, text = rows[at]
            at += 1
            if letter != "D":
                role = forced if letter == "R" else role
                lines.append(f"{role}:{text}")
                before = role[0]
        initials = [role[:1] for _, role, _ in rows]
        turns_held = [t for t, _, _ in rows if t is not None]
        gaps = max(turns_held) - min(turns_held) + 1 - len(set(turns_held)) if turns_held else 0
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
        out.append((conv, gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def check(docs):
    got = repair_damaged(docs)
    assert got.columns == list(COLUMNS)
    rows = got.collect()
    assert sorted(map(tuple, rows), key=str) == brute(map(tuple, docs.select("conv_id", "turn", "role", "text").collect()))
    return rows


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    got = sorted(map(tuple, QUERIES["op11_turn_repair"](spark, sf).collect()), key=str)
    turns = spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    assert got == brute(map(tuple, turns))
    assert {x for r in got for x in r[7]} == set("DKR") and any(r[6] > 5 for r in got)


@pytest.mark.parametrize("rows_per_part", [turn_repair.ROWS_PER_PART, 150])
def test_a_conversation_over_many_partitions(spark, rows_per_part, monkeypatch):
    monkeypatch.setattr(turn_repair, "ROWS_PER_PART", rows_per_part)
    rng = random.Random(6)
    rows = [(7, t, rng.choice(["user", "assistant", "assistant", "system", "tool"]), rng.choice(["yes.", "no", "", f"turn {t}!", "the same?"])) for t in range(3000)]
    rows += [(c, t, "ua"[t % 2] == "u" and "user" or "assistant", f"text {c} {t}.") for c in range(20, 60) for t in range(rng.randint(1, 9))]
    rows += [(None, t, "user", f"of no conversation {t % 40}.") for t in range(900)]
    check(spark.createDataFrame(rows, SCHEMA))


def test_odd_rows(spark):
    long = "word " * 60_000 + "end."
    rows = [
        (None, None, None, None), (None, 3, "user", "a text without a conversation."), (1, None, "user", "of no turn."), (1, None, "user", "of no turn."),
        (1, 0, "assistant", None), (1, 0, None, "text?"), (2, 5, "system", "a rule."), (2, 9, "", ""), (3, 0, "user", long), (3, 1, "assistant", long),
        (4, 0, "user", " \t\n\x0b\x0c\r "), (4, 0, "user", "twice: the same row."), (4, 0, "user", "twice: the same row."), (5, 1, "sybil", "İ 中文。"),
        (6, 1, "user", "x\x85"), (6, 2, "assistant", "no break space.\xa0"), (6, 3, "user", ". "), (8, 1 << 40, "user", "u."), (8, -5, "assistant", "a."),
    ]
    docs = spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA + ", rid string, audit string")
    got = check(docs)
    assert len(got) == 8
    assert repair_damaged(docs.where("false")).count() == 0


def test_a_conversation_without_rows_left(spark):
    lost = [(c, 0) for c in range(400) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    rows = check(spark.createDataFrame([(c, t, "user", "text.") for c, t in lost], SCHEMA))
    assert len(rows) == len(lost) > 5
    assert {tuple(r)[1:] for r in rows} == {(0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
