"""Star model: tables, their relationships, and slicers that travel along them.

A relationship leads from the one side to the many side (and back only when
declared ``both``).  A slicer is a set of values of one column of one table; it
filters that table, then every table it can reach, hop by hop, as semi joins on
the relationship keys.  A relationship may say which columns of the one side
the many side holds too (``carries``): a slicer on such a column also becomes a
literal filter there, and on from there, which reaches the scan of the fact.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Selections = Mapping[tuple[str, str], Sequence]


@dataclass(frozen=True)
class Relationship:
    """``many.many_key`` refers to ``one.one_key`` (SQL expressions over the
    table's columns, such as ``to_date(ts)``).

    ``carries`` maps a column of the one side to an expression over the many
    side that has the same value on every related row; ``back`` the same the
    other way, for a relationship that filters ``both`` ways.
    """
    many: str
    many_key: str
    one: str
    one_key: str
    carries: Mapping[str, str] = field(default_factory=dict)
    both: bool = False
    back: Mapping[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class _Hop:
    source: str
    source_key: str
    target: str
    target_key: str
    carries: Mapping[str, str]
    to_one: bool


def _membership(column: str, values: Sequence) -> Column:
    """Rows whose value is selected; a selected None takes the blank rows."""
    known = [v for v in values if v is not None]
    cond = F.expr(column).isin(known) if known else F.lit(False)
    return cond | F.expr(column).isNull() if len(known) < len(values) else cond


class StarModel:
    """Named tables and their relationships; ``slice`` gives a new model."""

    def __init__(self, tables: Mapping[str, DataFrame], relationships: Sequence[Relationship]):
        """Relationships of tables that are not given are left out; a slicer
        that reaches a table on two paths is refused as ambiguous."""
        self.tables = dict(tables)
        self.relationships = [r for r in relationships if r.many in self.tables and r.one in self.tables]

    def __getitem__(self, table: str) -> DataFrame:
        return self.tables[table]

    def _hops_from(self, table: str) -> list[_Hop]:
        down = [_Hop(r.one, r.one_key, r.many, r.many_key, r.carries, False) for r in self.relationships if r.one == table]
        up = [_Hop(r.many, r.many_key, r.one, r.one_key, r.back, True) for r in self.relationships
              if r.both and r.many == table]
        return down + up

    def path(self, table: str) -> list[_Hop]:
        """The hops a filter on ``table`` takes, nearest first; each reached
        table once."""
        seen, hops, queue, arrived = {table}, [], deque([table]), {}
        while queue:
            at = queue.popleft()
            for hop in self._hops_from(at):
                if hop.target == arrived.get(at):
                    continue  # back over the relationship just taken
                if hop.target in seen:
                    raise ValueError(f"a filter on {table} reaches {hop.target} on more than one path")
                seen.add(hop.target)
                arrived[hop.target] = at
                hops.append(hop)
                queue.append(hop.target)
        return hops

    def slice(self, selections: Selections) -> "StarModel":
        """The model under a set of slicers, ``{(table, column): values}``.

        Slicers of one table count together and travel once; an empty list of
        values selects nothing and so leaves everything, as an untouched
        slicer does.  Rows whose key is null or has no partner drop out of the
        tables that a slicer reaches.
        """
        by_table: dict[str, dict[str, Sequence]] = {}
        for (table, column), values in selections.items():
            if table not in self.tables:
                raise KeyError(f"no table {table} in the model")
            if column not in self.tables[table].columns:
                raise KeyError(f"no column {column} in {table}")
            if values:
                by_table.setdefault(table, {})[column] = list(values)
        tables = dict(self.tables)
        for table, chosen in by_table.items():
            for column, values in chosen.items():
                tables[table] = tables[table].filter(_membership(column, values))
            literals = {table: chosen}  # per reached table: expression -> selected values
            for hop in self.path(table):
                kept = {hop.carries[c]: v for c, v in literals[hop.source].items() if c in hop.carries}
                target = tables[hop.target]
                for expression, values in kept.items():
                    target = target.filter(_membership(expression, values))
                literals[hop.target] = kept
                tables[hop.target] = self._semi(target, tables[hop.source], hop)
        return StarModel(tables, self.relationships)

    @staticmethod
    def _semi(target: DataFrame, source: DataFrame, hop: _Hop) -> DataFrame:
        keys = source.select(F.expr(hop.source_key).alias("_filter_key"))
        if hop.to_one:
            keys = keys.distinct()  # a key on a third of the fact's rows is one row of the semi join
        return target.join(keys, F.expr(hop.target_key) == F.col("_filter_key"), "left_semi")

    def values(self, table: str, column: str) -> DataFrame:
        """What a slicer's list shows: the sorted distinct values."""
        return self.tables[table].select(column).distinct().orderBy(column)
