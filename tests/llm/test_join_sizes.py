"""What joins broadcast: tables that a count proves small, whatever size Spark expects of the others."""

import pytest

from lapstats.llm import decontaminate, exact_dedup, graph, simhash
from lapstats.llm.common import broadcast_or_shuffled, shuffled, small_or_shuffled, table
from tests.llm.helpers import on_disk

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def plans(monkeypatch):
    """The plans of the tables that an operator writes, by name."""
    seen = {}

    def watch(module):
        whole = module.materialize
        monkeypatch.setattr(module, "materialize", lambda df, name="stage": (seen.update({name: _plan(df)}), whole(df, name))[1])
        return seen

    return watch


@pytest.fixture
def large(monkeypatch):
    """Takes every table of the modules for one beyond the bound."""
    def as_large(*modules):
        for m in modules:
            for name, mark in (("small_or_shuffled", shuffled), ("broadcast_or_shuffled", lambda df, rows: shuffled(df))):
                if hasattr(m, name):
                    monkeypatch.setattr(m, name, mark)

    return as_large


def test_a_table_beyond_the_bound_is_never_broadcast(spark, tmp_path):
    written = on_disk(spark.range(100).withColumnRenamed("id", "k"), tmp_path)
    other = spark.range(100).withColumnRenamed("id", "k")
    for mark, kind in ((small_or_shuffled(written, 99), "SortMergeJoin"), (small_or_shuffled(written, 100), "BroadcastHashJoin"),
                       (broadcast_or_shuffled(written, 101, 100), "SortMergeJoin")):
        for how in ("inner", "left", "left_anti"):
            assert kind in _plan(other.join(mark, "k", how))


def test_exploded_entries_of_fingerprints_are_shuffled(spark, tmp_path, plans):
    """64 entries a fingerprint: a file of a few MB stood for a broadcast of over 1 GB."""
    seen = plans(simhash)
    prints = on_disk(spark.range(50).selectExpr("xxhash64(id) AS fp"), tmp_path)
    simhash.link_components(prints.unionByName(prints.selectExpr("fp ^ 1L AS fp"))).collect()
    assert "SortMergeJoin" in seen["simhash-entries"] and "Broadcast" not in seen["simhash-entries"]


def test_near_duplicates_beyond_the_bound_are_the_same(spark, large):
    docs = table(spark, SF, "documents")
    rows = lambda: sorted(map(tuple, simhash.near_duplicates(docs).collect()))
    kept = lambda: sorted(r.doc_id for r in simhash.keep_one(docs).collect())
    want, stay = rows(), kept()
    large(simhash, graph)
    assert rows() == want and kept() == stay


def test_components_beyond_the_bound(spark, large, plans):
    seen = plans(graph)
    large(graph)
    links = spark.createDataFrame([(i * 37 % 101, (i + 1) * 37 % 101) for i in range(100)], "a long, b long")
    assert {r.root for r in graph.components(links).collect()} == {0}
    assert all("Broadcast" not in p for p in seen.values())


def test_copies_of_a_text_are_shuffled(spark, tmp_path, plans):
    """Their file is small: it holds the text once."""
    seen = plans(exact_dedup)
    docs = on_disk(spark.range(300).selectExpr("id AS doc_id", "repeat(concat('copied ', id % 3), 2000) AS text"), tmp_path)
    assert {r.doc_id for r in exact_dedup.keep_first(docs).collect()} == {0, 1, 2}
    assert "Broadcast" not in seen["dedup-wrong"] and "Broadcast" not in seen["dedup-dropped"]


def test_exact_dedup_beyond_the_bound_is_the_same(spark, large):
    docs = table(spark, SF, "documents")
    kept = lambda: sorted(r.doc_id for r in exact_dedup.keep_first(docs).collect())
    want = kept()
    large(exact_dedup)
    assert kept() == want


def test_candidates_of_windows_beyond_the_bound(spark, large, plans):
    docs, bench = table(spark, SF, "documents"), table(spark, SF, "benchmark")
    clean = lambda: sorted(r.doc_id for r in decontaminate.keep_clean(docs, bench).collect())
    want = clean()
    large(decontaminate)
    seen = plans(decontaminate)
    assert clean() == want
    assert "SortMergeJoin" in seen["bench-hit"] and "Broadcast" not in seen["bench-hit"]
