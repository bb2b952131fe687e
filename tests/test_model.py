"""Relationship graph: slicers travel from the one side to the many side."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from indistar.operators.model import Relationship, StarModel

LINKS = [Relationship("summary", "year", "calendar", "year", {"year": "year"}),
         Relationship("fact", "y", "summary", "year", {"year": "y"}),
         Relationship("fact", "place", "place", "id", {"id": "place"}),
         Relationship("other", "place", "place", "id")]


@pytest.fixture(scope="module")
def tables(spark):
    return {"calendar": spark.createDataFrame([(2000,), (2001,), (2002,)], "year int"),
            "summary": spark.createDataFrame([(2000,), (2001,)], "year int"),
            "place": spark.createDataFrame([(1, "n"), (2, "s"), (3, None)], "id int, region string"),
            "fact": spark.createDataFrame([(2000, 1, 10), (2001, 1, 11), (2001, 2, 12), (2002, 2, 13), (2001, 9, 14),
                                           (None, 1, 15), (2001, None, 16), (2000, 3, 17)], "y int, place int, v int"),
            "other": spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (None, "c")], "place int, t string")}


def _v(model, table="fact", column="v"):
    return sorted(r[0] for r in model[table].select(column).collect())


def test_two_hops_and_conjunction(tables):
    m = StarModel(tables, LINKS)
    assert _v(m.slice({("calendar", "year"): [2001, 2002]})) == [11, 12, 14, 16]  # 2002 has no summary
    both = m.slice({("calendar", "year"): [2001], ("place", "region"): ["n", "s"]})
    assert _v(both) == [11, 12] and _v(both, "other", "t") == ["a", "b", "b"]
    assert _v(both, "calendar", "year") == [2001] and _v(both, "place", "id") == [1, 2]


def test_a_filter_on_the_many_side_stays_there(tables):
    m = StarModel(tables, LINKS).slice({("fact", "v"): [10]})
    assert _v(m) == [10] and m["summary"].count() == 2 and m["place"].count() == 3


def test_both_ways_reaches_the_other_tables(tables):
    links = [*LINKS[:2], Relationship("fact", "place", "place", "id", both=True), LINKS[3]]
    m = StarModel(tables, links).slice({("fact", "v"): [12, 13]})
    assert _v(m, "place", "id") == [2] and _v(m, "other", "t") == ["b", "b"] and m["summary"].count() == 2


def test_blank_is_a_value_and_an_empty_choice_is_none(tables):
    m = StarModel(tables, LINKS)
    assert _v(m.slice({("place", "region"): [None]})) == [17]
    assert _v(m.slice({("place", "region"): [None, "s"]})) == [12, 13, 17]
    assert _v(m.slice({("place", "region"): []})) == _v(m)


def test_unknown_table_column_and_two_paths_are_refused(tables):
    m = StarModel(tables, LINKS)
    for key in (("nowhere", "x"), ("place", "x")):
        with pytest.raises(KeyError):
            m.slice({key: [1]})
    with pytest.raises(ValueError, match="more than one path"):
        StarModel(tables, [*LINKS, Relationship("fact", "y", "calendar", "year")]).slice({("calendar", "year"): [2000]})
    # a table that is not given takes its relationships with it
    part = StarModel({k: v for k, v in tables.items() if k != "summary"}, LINKS)
    assert part.slice({("calendar", "year"): [2000]})["fact"].count() == 8


def test_slicers_equal_brute_force(spark, tables):
    facts = [tuple(r) for r in tables["fact"].collect()]
    region = {r.id: r.region for r in tables["place"].collect()}
    for years in ([], [2000], [2001, 2002]):
        for regions in ([], ["n"], ["n", None]):
            m = StarModel(tables, LINKS).slice({("calendar", "year"): years, ("place", "region"): regions})
            want = [v for y, p, v in facts if (not years or (y in years and y in (2000, 2001)))
                    and (not regions or (p in region and region[p] in regions))]
            assert _v(m) == sorted(want)


def test_literal_reaches_the_scan_of_the_fact(spark, tables, tmp_path):
    path = str(tmp_path / "fact")
    tables["fact"].write.parquet(path)
    m = StarModel({**tables, "fact": spark.read.parquet(path)}, LINKS)
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        m.slice({("calendar", "year"): [2000, 2001], ("place", "id"): [1]})["fact"].agg(F.sum("v")).explain("formatted")
    assert "In(y, [2000,2001])" in out.getvalue() and "EqualTo(place,1)" in out.getvalue()
    assert "ReadSchema: struct<y:int,place:int,v:int>" in out.getvalue() and "NestedLoop" not in out.getvalue()


def test_clashing_column_names(spark):
    """All tables may use the same column names."""
    a = spark.createDataFrame([(1, "x"), (2, "y")], "id int, name string")
    b = spark.createDataFrame([(1, "p"), (1, "q"), (2, "r")], "id int, name string")
    m = StarModel({"a": a, "b": b}, [Relationship("b", "id", "a", "id")]).slice({("a", "name"): ["x"]})
    assert _v(m, "b", "name") == ["p", "q"] and m["b"].columns == ["id", "name"]
