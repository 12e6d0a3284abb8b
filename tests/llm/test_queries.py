"""Registered queries: against DuckDB where SQL can say it, on empty tables, and the pipeline by its stages."""

import compare
import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from wardflow.llm import decontam, filters, langid, lm, packing, pii, prefixes, queries, repair, secrets, simhash, substring, suffix, topk

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(queries.ORACLE))
def test_query_matches_sql(spark, monkeypatch, name):
    monkeypatch.setitem(compare.QUERIES, name, queries.QUERIES[name])
    monkeypatch.setitem(compare.ORACLE, name, queries.ORACLE[name])
    assert compare.check(spark, compare.connect(FOLDER), name, FOLDER) is None


@pytest.mark.parametrize("name", [n for n in queries.QUERIES if n not in queries.ORACLE])
def test_query_has_every_document(spark, name):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id")
    assert queries.QUERIES[name](spark, FOLDER).select("doc_id").distinct().exceptAll(documents).isEmpty()
    assert queries.QUERIES[name](spark, FOLDER).select("doc_id").distinct().count() == documents.distinct().count()


def test_all_operators():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


def test_empty_tables(spark, none):
    empty = none
    bench = spark.createDataFrame([], "item_id string, text string")
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert pii.personal_data(empty, pii.fit(empty)).isEmpty()
    assert secrets.secrets(empty).isEmpty()
    assert decontam.contamination(empty, decontam.blocks(bench)).isEmpty()
    assert lm.scores(empty).isEmpty()
    assert substring.remove_repeats(empty).isEmpty()
    assert suffix.remove_repeats(empty).isEmpty()
    assert langid.identify(empty, langid.fit(empty)).isEmpty()
    assert topk.top_k(vectors, F.col("vec_id") % 20 == 0).isEmpty()
    assert simhash.near_duplicates(empty).isEmpty()
    assert packing.pack(empty, queries.tokenizer_path()).isEmpty()
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filters.audit(filters.failures(empty, labels)).isEmpty()
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert repair.repair(repair.damaged(turns), copies_col="copies").isEmpty()
    stored = prefixes.prefix_counts(empty, queries.tokenizer_path("piece_bpe_32k.model"))
    assert stored.isEmpty()
    assert prefixes.longest_prefixes(stored, [4]).isEmpty()


def test_without_a_benchmark_nothing_is_hit(spark, docs, rows):
    bench = spark.createDataFrame([], "item_id string, text string")
    assert {r["n_hit"] for r in decontam.contamination(docs, decontam.blocks(bench)).collect()} == {0}


@pytest.mark.parametrize("shard_rows, block", [(1 << 14, 256), (40, 8)])
def test_top_k_with_ties_and_odd_vectors(spark, monkeypatch, shard_rows, block):
    monkeypatch.setattr(topk, "SHARD_VALUES", 6 * shard_rows)
    monkeypatch.setattr(topk, "BLOCK", block)
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=6).round(1)]) for i in range(150)]
    rows += [(i, [0.5] * 6) for i in range(150, 230)]
    odd = [(300, None), (301, [None] * 6), (302, [float("nan")] + [0.0] * 5), (303, [float("inf")] * 6), (None, [1.0] * 6), (320, None), (321, []), (322, [2.0]), (340, [1.0, -1.0])]
    vectors = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").withColumn("shard", F.lit(1)).withColumn("q", F.lit("x"))
    valid = {i: [int(np.floor(64 * x)) for x in v] for i, v in rows + [(321, []), (322, [2.0]), (340, [1.0, -1.0])]}
    found = {}
    for r in topk.top_k(vectors, F.col("vec_id") % 20 == 0).collect():
        found.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    expected = {}
    for q in [i for i in valid if i % 20 == 0]:
        best = sorted((-sum(a * b for a, b in zip(valid[q], v)), i) for i, v in valid.items() if i != q)[:20]
        expected[q] = {n + 1: (i, -s) for n, (s, i) in enumerate(best)}
    assert found == expected


def test_top_k_of_large_components(spark):
    """Components past 2 ** 21 count in full, also where partial sums do not fit a long; scores that do not fit are an error."""
    rows = [(0, [2.2e6, -1.0, 2.5]), (1, [2.15e6, 7.0, 0.0]), (2, [2.1e6, -2.0, 1.0]), (3, [1e9, 1e9, 1.0]), (20, [1e9, -1e9, 2.0]), (5, [0.5, 0.25, -3e6])]
    query = F.col("vec_id").isin(0, 20)
    expected = []
    for q in (0, 20):
        own = [(i, sum(int(64 * a // 1) * int(64 * b // 1) for a, b in zip(dict(rows)[q], v))) for i, v in rows if i != q]
        expected += [(q, r + 1, i, s) for r, (i, s) in enumerate(sorted(own, key=lambda x: (-x[1], x[0])))]
    assert all(abs(s) < 1 << 63 for *_, s in expected) and any(s > 1 << 54 for *_, s in expected)
    found = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), query).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in found) == sorted(expected)
    for odd in ([1e9, -1e9, 0.0], [1e18, 0.0, 0.0]):
        wide = spark.createDataFrame([*rows, (6, odd)], "vec_id long, embedding array<double>")
        with pytest.raises(Exception, match="does not fit a long"):
            topk.top_k(wide, query).collect()


def test_fewer_rows_than_k(spark):
    vectors = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (2, [3.0])], "vec_id long, embedding array<double>")
    found = [(r["query_id"], r["rank"], r["vec_id"]) for r in topk.top_k(vectors, F.col("vec_id") == 0).orderBy("rank").collect()]
    assert found == [(0, 1, 2), (0, 2, 1)]


def test_pipeline_stages(spark, docs, rows, tmp_path):
    passage = " ".join(rows[0][1].split()[-45:])
    spark.createDataFrame([("q1", passage)], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out, seen = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, out, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        out = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = out
    *kept, last = seen.values()
    assert all(x.columns == docs.columns for x in kept)
    text = lambda name: {r["doc_id"]: r["text"] for r in seen[name].collect()}
    language, near, bench, private = (text(n) for n in list(seen)[:4])
    assert not {200, 201, 202, 203} & set(language) and set(language) >= set(range(1, 119)) - {i for i, t in rows if not t}
    assert 204 in near and 205 not in near and 206 not in near
    assert set(bench) < set(near) and 0 not in bench and all(passage not in t for t in bench.values())
    assert private.keys() == bench.keys() and not any("ann.b@" in t for t in private.values())
    assert {r["doc_id"] for r in last.collect()} == set(private)


def test_pipeline_on_an_empty_table(spark, none, tmp_path):
    spark.createDataFrame([], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, str(tmp_path)).isEmpty()


def test_run(spark):
    assert corpus_pipeline.run(spark, FOLDER).count() > 0
