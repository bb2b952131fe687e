"""Conversation repair against a search over all edits and whole charts."""

import hashlib
import heapq
import random
import re
import zlib

import pytest

from indistar.llm import repair
from indistar.llm.repair import Parse, chart, cheapest, damaged, conversation_rows, repair_conversations, repair_report, row_cell

SCHEMA = "conv_id long, turn long, role string, text string, sha256 string, copies int, kind string"
SHA = lambda s: hashlib.sha256(s.encode()).hexdigest()


def least(rows):
    """Cheapest, ASCII-least edits by a search over (row, roles so far); rows are (initial, must go, truncated)."""
    heap, seen = [(0, "", 0, "")], set()
    while heap:
        cost, audit, at, end = heapq.heappop(heap)
        if (at, end) in seen:
            continue
        seen.add((at, end))
        if at == len(rows) and end in ("", "a"):
            return cost, audit
        nexts = {"": "u", "s": "u", "u": "a", "a": "u"}[end]
        heapq.heappush(heap, (cost + 3, audit + "I", at, nexts))
        if at < len(rows):
            role, gone, cut = rows[at]
            heapq.heappush(heap, (cost + 4, audit + "D", at + 1, end))
            if not gone:
                heapq.heappush(heap, (cost + 3 + 3 * cut, audit + "R", at + 1, nexts))
                if role == nexts or (role == "s" and end == ""):
                    heapq.heappush(heap, (cost + 3 * cut, audit + "K", at + 1, role))


def brute(rows):
    """The whole report in plain Python."""
    convs = {}
    for conv, turn, role, text, *_ in rows:
        role, text = " " if role is None else role, " " if text is None else text
        show = lambda x: " " if x is None else str(x)
        kind = zlib.crc32(f"{show(conv)}:{show(turn)}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        convs.setdefault(conv, []).extend([(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1))
    out = []
    for conv, now in convs.items():
        digest = lambda r: hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()
        now.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), digest(r)))
        seen, units, count = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0, "": 0}
        for turn, role, text in now:
            body = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
            seen.add((role, text))
            count[fault] += 1
            units.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
        initials = [u[0] for u in units]
        turns = {r[0] for r in now if r[0] is not None}
        cost, audit = least(units)
        left, lines = iter(now), []
        size = len(audit) - audit.count("D")
        for e in audit:
            role = "user" if (len(lines) - size % 2) % 2 == 0 else "assistant"
            row = next(left) if e != "I" else None
            if e != "D":
                lines.append(f"{row[1] if e == 'K' else role}:{row[2] if row else ''}")
        out.append((conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, count["blank"], count["duplicate"],
                    count["truncated"], sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
                    cost, audit, SHA("\n".join(lines))))
    return out


def table(seed=3, convs=60):
    r = random.Random(seed)
    texts = ["Yes.", "No!", "Why?", "and then", "  ", "", None, "tab\t.\n ", "é? ", "x" * 400 + "."]
    roles = ["user", "assistant"] * 4 + ["system", "tool", None, "", "understudy", "S"]
    rows = []
    for c in range(convs):
        for t in range(r.choice((1, 2, 5, 9, 40))):
            turn = None if r.random() < .05 else t + r.choice((0, 0, 0, 3))
            role = r.choice(("user", "assistant"))[0:] if r.random() < .1 else ("user", "assistant")[t % 2]
            rows.append((c, turn, r.choice(roles) if r.random() < .3 else role, r.choice(texts) if r.random() < .5 else f"t{t}.",
                         "s", 1, "k"))
    rows += [(200, 0, "system", "Be kind.", None, None, None)] + [(201, t, ("system", "user", "assistant")[min(t, 1 + (t + 1) % 2)], f"{t}.", None, None, None) for t in range(30)]
    rows += [(None, t, "user", f"{t}.", None, None, None) for t in range(7)] + rows[:40] + [(None,) * 7] + [rows[3]] * 50
    return rows


def same(df, want):
    assert sorted(map(str, (tuple(r) for r in df.collect()))) == sorted(map(str, want))


def test_cells_against_search():
    r = random.Random(1)
    for _ in range(1500):
        rows = [(r.choice("uuaas "), r.random() < .2, r.random() < .2) for _ in range(r.randrange(0, 12))]
        parse, units = Parse(), [row_cell(a if a in "uas" else "", b, c) for a, b, c in rows]
        for u in units:
            parse.add(u)
        assert cheapest(parse.cell()) == least(rows)
        if units:
            assert parse.cell() == chart(units)  # charts of charts equal one whole chart


def test_report(spark):
    rows = table()
    for parts in (1, 7):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        same(repair_report(spark.createDataFrame(rows, SCHEMA).repartition(3)), brute(rows))
    spark.conf.set("spark.sql.shuffle.partitions", 4)


def test_one_conversation_over_many_tasks(spark):
    rows = [(1, t, "user" if t % 3 else "assistant", f"{t % 50}.", None, None, None) for t in range(3000)]
    same(repair_report(spark.createDataFrame(rows, SCHEMA).repartition(3)), brute(rows))


def test_nothing_left_and_no_table(spark):
    gone = next(t for t in range(1000) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    same(repair_report(spark.createDataFrame([(5, gone, "user", "x.", None, None, None)], SCHEMA)), [(5, 0, 0, 0, 0, 0, 0, "", SHA(""))])
    assert repair_report(spark.createDataFrame([], SCHEMA)).collect() == []


def test_sound_conversations_stay(spark):
    rows = [(1, 0, "system", "Hi."), (1, 1, "user", "A?"), (1, 2, "assistant", "B."), (2, 0, "user", "A?"), (2, 1, "assistant", "B.")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    reports, turns = repair_conversations(conversation_rows(frame))
    assert {(r.conv_id, r.cost, r.audit) for r in reports.collect()} == {(1, 0, "KKK"), (2, 0, "KK")}
    same(turns, rows)
    assert damaged(conversation_rows(frame)).count() == len(rows)
    with pytest.raises(ValueError):
        repair._parts(spark.createDataFrame([], "conv_id double"))
