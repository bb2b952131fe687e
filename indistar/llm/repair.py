"""Conversation repair by weighted CYK interval parsing.

The wanted conversations are ``(s?(ua)+)?`` over role initials.  Nonterminals
of the repair grammar in Chomsky normal form are segments named by their first
and last role: ``uu ua au aa`` alternate, ``s su sa`` start with a system row,
``E`` is a span whose rows all go.  Binary rules join two segments whose ends
fit; a row is kept, gets another role or goes; the closure of a cell puts rows
in before and after it.  A cell holds the least (cost, audit) of each segment,
and cells are filled bottom-up by span length over all splits.

A chart spans at most ``WIDTH`` units.  The cell of a whole chart is a unit of
the next chart, so a conversation of any length is parsed from charts of charts:
joining segments is associative, and audits of one span and cost are never
prefixes of each other, so (cost, audit) order survives joining and each split
of a span has the same least cell.

Rows are dealt out by ranges of (conversation, turn), so that a conversation
with a large share of all rows is parsed by many tasks; the cells of its parts
are joined afterwards.  Only the repaired texts are read by one task for each
conversation, as a stream that holds one row at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indistar.llm.common import materialise

RECAST, DELETE, INSERT, FINISH = 3, 4, 3, 3  # costs; FINISH: a row that stays truncated
WIDTH = 8
SEGMENTS = ("E", "uu", "ua", "au", "aa", "s", "su", "sa")
WANTED = ("E", "ua", "sa")
FOLLOWS = {"s": "u", "u": "a", "a": "u"}  # the role after a role
BLANKS = " \t\n\x0b\x0c\r"
_BATCH = 1000

Cell = list  # of (cost, audit) or None, for each of SEGMENTS


def _rules() -> list[tuple[int, int, int]]:
    at = {s: i for i, s in enumerate(SEGMENTS)}
    out = [(0, i, i) for i in range(len(SEGMENTS))] + [(i, 0, i) for i in range(1, len(SEGMENTS))]
    for x in SEGMENTS[1:]:
        for y in SEGMENTS[1:]:
            if FOLLOWS[x[-1]] == y[0]:
                out.append((at[x], at[y], at[x[0] + y[-1]]))
    return out


RULES = _rules()


def joined(x: Cell, y: Cell, best: Cell | None = None) -> Cell:
    """Least cell of a span split into x and y (and of ``best``, if given)."""
    best = list(best) if best else [None] * len(SEGMENTS)
    for left, right, to in RULES:
        a, b = x[left], y[right]
        if a is None or b is None:
            continue
        now, cost = best[to], a[0] + b[0]
        if now is None or cost < now[0]:
            best[to] = (cost, a[1] + b[1])
        elif cost == now[0]:
            best[to] = min(now, (cost, a[1] + b[1]))
    return best


def _put_in() -> Cell:
    """Segments of inserted rows only: ever longer ones until none gets cheaper."""
    one: Cell = [None] * len(SEGMENTS)
    one[0], one[1], one[4] = (0, ""), (INSERT, "I"), (INSERT, "I")
    cell = one
    while (longer := joined(cell, one, cell)) != cell:
        cell = longer
    return cell


PUT_IN = _put_in()


@lru_cache(maxsize=64)
def row_cell(role: str, must_go: bool, truncated: bool) -> tuple:
    """Closed cell of one row with the role initial ``u``, ``a``, ``s`` or another."""
    cell: Cell = [None] * len(SEGMENTS)
    cell[0] = (DELETE, "D")
    if not must_go:
        extra = FINISH if truncated else 0
        for name, to in (("uu", 1), ("aa", 4)):
            cell[to] = (extra, "K") if role == name[0] else (RECAST + extra, "R")
        if role == "s":
            cell[5] = (extra, "K")
    return tuple(joined(joined(PUT_IN, cell), PUT_IN))


def chart(units: list[Cell]) -> Cell:
    """The cell of all units: every span by increasing length, every split."""
    n = len(units)
    spans = {(i, i + 1): u for i, u in enumerate(units)}
    for length in range(2, n + 1):
        for i in range(n - length + 1):
            cell = None
            for k in range(i + 1, i + length):
                cell = joined(spans[i, k], spans[k, i + length], cell)
            spans[i, i + length] = cell
    return spans[0, n]


class Parse:
    """Charts of charts over a stream of units, at most WIDTH of them a level."""

    def __init__(self) -> None:
        self.levels: list[list[Cell]] = []

    def add(self, cell: Cell, level: int = 0) -> None:
        while level < len(self.levels) and len(self.levels[level]) == WIDTH - 1:
            cell = chart([*self.levels[level], cell])
            self.levels[level] = []
            level += 1
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(cell)

    def cell(self) -> Cell | None:
        """The cell of all units so far; None without any."""
        rest: list[Cell] = []
        for units in self.levels:
            if units or rest:
                rest = [chart([*units, *rest])]
        return rest[0] if rest else None


def cheapest(cell: Cell | None) -> tuple[int, str]:
    if cell is None:
        return 0, ""
    return min(cell[SEGMENTS.index(s)] for s in WANTED if cell[SEGMENTS.index(s)] is not None)


# ----------------------------------------------------------------- rows ---

def _blank_or(col: Column) -> Column:
    return F.coalesce(col.cast("string"), F.lit(" "))


def conversation_rows(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                      text_col: str = "text") -> DataFrame:
    """``conv_id, turn, role, text, copies``; null roles and texts are one space."""
    return conversations.select(F.col(id_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                                _blank_or(F.col(role_col)).alias("role"), _blank_or(F.col(text_col)).alias("text"),
                                F.lit(1).cast("long").alias("copies"))


def damaged(rows: DataFrame, kinds: int = 20) -> DataFrame:
    """Rows with faults by ``crc32(conv_id:turn) % kinds``: 0 drops a row, 1
    empties its text, 2 takes its ``.!?``, 3 repeats it, 4 makes it a user's.
    A dropped row stays with no copy, so that its conversation is known."""
    kind = F.crc32(F.concat(_blank_or(F.col("conv_id")), F.lit(":"), _blank_or(F.col("turn"))).cast("binary")) % kinds
    text = F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return rows.withColumn("kind", kind).select(
        "conv_id", "turn", F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        text.alias("text"), (F.col("copies") * F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, 2).otherwise(1)).alias("copies"))


def _distinct_rows(rows: DataFrame) -> DataFrame:
    """Equal rows of a conversation as one with their number, written once:
    ``conv_id, turn, role, text, copies, digest, blank, truncated``."""
    end = F.rtrim(F.col("text"), F.lit(BLANKS))
    once = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    key = F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    return materialise(once.select(
        "*", F.unhex(F.sha2(key, 256)).alias("digest"), (end == "").alias("blank"),
        (~F.right(end, F.lit(1)).isin(".", "!", "?")).alias("truncated")), "turns")


ORDER = ["conv_id", "turn", "role", "digest"]
_STATS = "n long, first string, last string, illegal long, blank long, duplicate long, truncated long, " \
         "lo long, hi long, turns long, first_turn long, last_turn long"


def _fits(a: str, b: str) -> bool:
    return a + b in ("su", "ua", "au")


def _added(s: dict | None, t: dict) -> dict:
    """Figures of two neighbouring parts of a conversation."""
    if s is None or not s["n"]:
        return t
    if not t["n"]:
        return s
    known = [x for x in (s["lo"], t["lo"]) if x is not None]
    tops = [x for x in (s["hi"], t["hi"]) if x is not None]
    shared = s["last_turn"] is not None and s["last_turn"] == t["first_turn"]
    return {**{k: s[k] + t[k] for k in ("n", "blank", "duplicate", "truncated")},
            "illegal": s["illegal"] + t["illegal"] + (not _fits(s["last"], t["first"])),
            "first": s["first"], "last": t["last"], "turns": s["turns"] + t["turns"] - shared,
            "lo": min(known, default=None), "hi": max(tops, default=None),
            "first_turn": s["first_turn"], "last_turn": t["last_turn"]}


def _row_figures(turn, role, blank, truncated, first, copies) -> dict:
    good = not blank and first
    return {"n": copies, "first": role, "last": role, "illegal": (copies - 1) * (not _fits(role, role)),
            "blank": copies if blank else 0, "duplicate": 0 if blank else copies - first,
            "truncated": int(good and truncated), "lo": turn, "hi": turn, "turns": int(turn is not None),
            "first_turn": turn, "last_turn": turn}


_NONE = {"n": 0, "first": None, "last": None, "illegal": 0, "blank": 0, "duplicate": 0, "truncated": 0,
         "lo": None, "hi": None, "turns": 0, "first_turn": None, "last_turn": None}


def _power(cell: Cell, n: int) -> Cell:
    """``n`` equal units in a row."""
    out = None
    while n:
        if n & 1:
            out = cell if out is None else joined(out, cell)
        n >>= 1
        cell = joined(cell, cell) if n else cell
    return out


def _parts(rows: DataFrame) -> DataFrame:
    """Cells and figures of the runs of rows that one task has of a conversation."""
    kind = rows.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, held, out = TaskContext.get().partitionId(), None, []

        def put() -> None:
            conv, parse, figures = held
            cell = parse.cell()
            out.append({"conv_id": conv, "part": task, **figures, "cell": cell and [
                None if x is None else {"cost": x[0], "audit": x[1]} for x in cell]})

        for b in batches:
            for conv, turn, role, blank, truncated, first, copies in zip(*(c.to_pylist() for c in b.columns)):
                if held is None or held[0] != conv:
                    if held is not None:
                        put()
                    held = (conv, Parse(), dict(_NONE))
                if not copies:
                    continue
                _, parse, figures = held
                parse.add(row_cell(role if role in ("u", "a", "s") else "", blank or not first, truncated))
                if copies > 1:
                    parse.add(_power(row_cell("", True, False), copies - 1))
                held = (conv, parse, _added(figures, _row_figures(turn, role, blank, truncated, first, copies)))
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=schema(b.schema.field(0).type))
                out = []
        if held is not None:
            put()
            yield pa.RecordBatch.from_pylist(out, schema=schema(conv_type))

    def schema(first: pa.DataType) -> pa.Schema:
        whole, text = pa.int64(), pa.string()
        return pa.schema([("conv_id", first), ("part", pa.int32())] + [
            (c, text if c in ("first", "last") else whole) for c in _NONE] + [
            ("cell", pa.list_(pa.struct([("cost", whole), ("audit", text)])))])

    conv_type = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}.get(kind, pa.string())
    if kind not in ("bigint", "int", "string"):
        raise ValueError(f"conversation ids are whole numbers or texts, not {kind}")
    return rows.select("conv_id", "turn", "role", "blank", "truncated", "first", "copies").mapInArrow(
        run, f"conv_id {kind}, part int, {_STATS}, cell array<struct<cost:bigint,audit:string>>")


def _whole(parts: DataFrame) -> DataFrame:
    """One row for each conversation from its parts, in order."""
    kind = parts.schema["conv_id"].dataType.simpleString()
    lists = parts.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(
        "part", *_NONE, "cell"))).alias("parts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = {c: [] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")}
            for parts_of in b.column(1):
                parse, f = Parse(), dict(_NONE)
                for p in parts_of.as_py():
                    if p["cell"]:
                        parse.add([x and (x["cost"], x["audit"]) for x in p["cell"]])
                    f = _added(f, p)
                cost, audit = cheapest(parse.cell())
                gaps = f["hi"] - f["lo"] + 1 - f["turns"] if f["turns"] else 0
                for c, v in (("gaps", gaps), ("cost", cost), ("audit", audit),
                             *((c, f[c]) for c in ("blank", "duplicate", "truncated", "illegal"))):
                    got[c].append(v)
            yield pa.RecordBatch.from_arrays(
                [b.column(0)] + [pa.array(v, pa.string() if c == "audit" else pa.int64()) for c, v in got.items()],
                names=["conv_id", *got])

    return lists.mapInArrow(run, f"conv_id {kind}, gaps long, blank long, duplicate long, truncated long, "
                                 "illegal long, cost long, audit string")


def repaired_turns(turns: DataFrame, reports: DataFrame) -> DataFrame:
    """``conv_id, position, role, text`` of the repaired conversations, in
    order within a task: each conversation's audit comes first, its rows follow
    as a sorted stream."""
    kind = turns.schema["conv_id"].dataType.simpleString()
    heads = reports.select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"),
                           F.lit("").alias("role"), F.lit(None).cast("binary").alias("digest"),
                           F.col("audit").alias("text"), F.lit(0).cast("long").alias("copies"))
    body = turns.where("copies > 0").select("conv_id", F.lit(1).alias("kind"), "turn", "role", "digest", "text", "copies")
    both = heads.union(body).repartition("conv_id").sortWithinPartitions("conv_id", "kind", "turn", "role", "digest")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, audit, at, place, lead = None, None, 0, 0, 0
        out: list[tuple] = []

        def put(role: str | None, text: str) -> None:
            nonlocal place
            role = role if role is not None else "user" if (place - lead) % 2 == 0 else "assistant"
            out.append((conv, place, role, text))
            place += 1

        def put_in() -> None:
            nonlocal at
            while audit is not None and at < len(audit) and audit[at] == "I":
                at += 1
                put(None, "")

        def flushed() -> pa.RecordBatch:
            columns = list(zip(*out))
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(columns[0], ids), pa.array(columns[1], pa.int64()),
                                               pa.array(columns[2], pa.string()), pa.array(columns[3], pa.string())],
                                              names=["conv_id", "position", "role", "text"])

        ids = None
        for b in batches:
            ids = b.schema.field(0).type
            for i in range(b.num_rows):
                if b.column(1)[i].as_py() == 0:
                    put_in()  # what the conversation before ends with
                    conv, audit = b.column(0)[i].as_py(), b.column(3)[i].as_py()
                    at, place, lead = 0, 0, (len(audit) - audit.count("D")) % 2
                    continue
                role, text = b.column(2)[i].as_py(), b.column(3)[i].as_py()
                for _ in range(b.column(4)[i].as_py()):
                    put_in()
                    edit, at = audit[at], at + 1
                    if edit != "D":
                        put(role if edit == "K" else None, text)
                    if len(out) >= _BATCH:
                        yield flushed()
            if out:
                yield flushed()
        put_in()
        if out:
            yield flushed()

    return both.select("conv_id", "kind", "role", "text", "copies").mapInArrow(
        run, f"conv_id {kind}, position long, role string, text string")


def repair_conversations(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Reports and repaired turns of conversations.

    ``rows`` are ``conversation_rows`` (perhaps ``damaged``).  The report has one
    row for each conversation: ``gaps, blank, duplicate, truncated, illegal,
    cost, audit``; the turns are ``conv_id, position, role, text``.

    Rows are taken by turn, null turns first; rows of one turn by role, then by
    digest of role and text, so equal rows are adjacent.  A null conversation
    id is a conversation of its own; null roles and texts are one space, so
    such a text is blank.  A conversation without rows left has zeros, an empty
    audit and no repaired turn, an empty table no report.  Texts are never
    held for a whole conversation; the audit, a letter for each row, is.
    Columns besides the four named ones are not read."""
    turns = _distinct_rows(rows)
    seen = turns.where("copies > 0").groupBy("conv_id", "digest").agg(F.min(F.struct("turn")).alias("t")) \
        .select(F.col("conv_id").alias("c"), F.col("digest").alias("d"), "t")
    narrow = turns.select("conv_id", "turn", F.substring("role", 1, 1).alias("initial"), "role", "digest", "blank", "truncated", "copies")
    known = narrow.join(seen, narrow.conv_id.eqNullSafe(seen.c) & (narrow.digest == seen.d), "left") \
        .withColumn("first", F.coalesce(F.col("turn").eqNullSafe(F.col("t.turn")) & F.col("t").isNotNull(), F.lit(False)))
    dealt = known.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER).select(
        "conv_id", "turn", F.col("initial").alias("role"), "blank", "truncated", "first", "copies")
    reports = materialise(_whole(_parts(dealt)), "reports")
    return reports, repaired_turns(turns, reports)


def conversation_digests(turns: DataFrame) -> DataFrame:
    """``conv_id, sha256`` of ``role:text`` lines of ``repaired_turns``, read as
    they stream out of it."""
    kind = turns.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state, ids = None, None, None
        for b in batches:
            ids, done = b.schema.field(0).type, []
            for i, at, role, text in zip(*(c.to_pylist() for c in b.columns)):
                if at == 0:
                    if state is not None:
                        done.append((conv, state.hexdigest()))
                    conv, state = i, sha256()
                state.update(f"{chr(10) if at else ''}{role}:{text}".encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], ids), pa.array([d[1] for d in done])],
                                                 names=["conv_id", "sha256"])
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([conv], ids), pa.array([state.hexdigest()])], names=["conv_id", "sha256"])

    return turns.mapInArrow(run, f"conv_id {kind}, sha256 string")


def repair_report(conversations: DataFrame, damage: bool = True) -> DataFrame:
    """Report of every conversation of a table (damaged first, if wanted) with
    ``repaired_sha256``, the SHA-256 of its repaired ``role:text`` lines."""
    rows = conversation_rows(conversations)
    reports, turns = repair_conversations(damaged(rows) if damage else rows)
    digests = conversation_digests(turns).select(F.col("conv_id").alias("c"), "sha256")
    return reports.join(digests, reports.conv_id.eqNullSafe(digests.c), "left").select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
        F.coalesce("sha256", F.lit(sha256().hexdigest())).alias("repaired_sha256"))
