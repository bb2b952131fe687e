"""The pipeline's stages on a small table of documents."""

import os

import corpus_pipeline
import pytest

import __spark_entry__ as entry
from indistar.llm.decontaminate import drop_contaminated
from indistar.llm.minhash import drop_near_copies
from indistar.llm.queries import QUERIES
from tests.llm.test_operators import SCHEMA, brute_components, corpus, lower


ODD_NAMES = "doc_id long, text string, lang string, _row string, row string, _n_hit long, n_hit long, doc long, tag long, " \
            "_gone long, gone_doc long, gone_tag long, _tag long, _near_row long, kept boolean, lang_pred string, score double"


def odd_rows():
    long = " ".join(f"w{i}" for i in range(60))
    texts = ["a b c d e f", long, long + " more", long.replace("w30", "x"), None, "", "1 2 3", "a b c d e f"]
    ids = [1, 2, 3, None, None, 6, 7, 8]
    return [(i, t, "en", "r", "r", 1, 2, 3, 4, 5, 6, 7, 8, 9, True, "p", .5) for i, t in zip(ids, texts)]


def test_all_queries_are_registered():
    """A broken import inside the subpackage must not drop them quietly."""
    numbers = sorted(int(n[2:].split("_")[0]) for n in entry.queries() if n.startswith("op") and n[2].isdigit())
    assert numbers == list(range(1, 14)) and set(QUERIES) < set(entry.queries()) and "pipeline" in entry.queries()


def test_stages_keep_columns_with_clashing_names(spark, tmp_path):
    docs = spark.createDataFrame(odd_rows(), ODD_NAMES)
    items = spark.createDataFrame([("x", "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10")], "item_id string, text string")
    items.write.parquet(str(tmp_path / "benchmark.parquet"))
    near = drop_near_copies(docs)
    assert near.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text or "", r.row, r.tag) for r in near.collect()) == sorted(
        (i or 0, t or "", "r", 4) for i, t in [(1, "a b c d e f"), (None, odd_rows()[3][1]), (None, None), (6, ""), (7, "1 2 3")])
    clean = drop_contaminated(docs, items)
    assert clean.columns == docs.columns and {r.doc_id for r in clean.collect() if r.doc_id} == {1, 6, 7, 8}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns, name


@pytest.mark.parametrize("texts,items", [([], [("x", "a b")]), (["a b c", None], [])])
def test_empty_tables(spark, tmp_path, texts, items):
    rows = [(i, t, "en") for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id string, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == {i for i, t in enumerate(texts) if t}


def test_stages(spark, tmp_path):
    docs = spark.createDataFrame(corpus(1), SCHEMA)
    docs.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    texts = {r.doc_id: r.text for r in docs.collect() if r.doc_id is not None}  # two rows have no id
    spark.createDataFrame([(1, " ".join(texts[30].split()[1:14])), (2, None)], "item_id long, text string") \
        .write.parquet(str(tmp_path / "benchmark.parquet"))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "exact_copies", "near_copies", "decontaminate", "pack"]
    now, seen = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, str(tmp_path))
        if name != "pack":
            assert now.columns == docs.columns
        now.write.parquet(os.path.join(tmp_path, "out", name))
        now = spark.read.parquet(os.path.join(tmp_path, "out", name))
        seen[name] = {r.doc_id: getattr(r, "text", None) for r in now.collect()}
    assert all(any(c.isalpha() for c in t) for t in seen["language"].values())
    assert set(seen["language"]) - {None} == {i for i, t in texts.items() if any(c.isalpha() for c in t or "")}
    left = [lower(t) for t in seen["exact_copies"].values()]
    assert len(left) == len(set(left)) and set(left) == {lower(t) for t in seen["language"].values()}
    named = {i: t for i, t in seen["exact_copies"].items() if i is not None}
    assert {i for i in seen["near_copies"] if i is not None} == {
        i for i, (_, c) in brute_components(named).items() if i == c}
    assert 30 not in seen["decontaminate"] and set(seen["decontaminate"]) <= set(seen["near_copies"])
    assert set(seen["pack"]) == set(seen["decontaminate"])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0
