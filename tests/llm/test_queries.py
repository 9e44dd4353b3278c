"""The queries next to their SQL, and the pipeline against plain stages."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from checks.compare import _rows, connect
from millrace.llm import queries
from millrace.llm.oracles import ORACLES

from . import brute
from .test_operators import alike, pairs, plain_groups, rows


def test_registered():
    assert set(queries.QUERIES) | {"pipeline"} <= set(__spark_entry__.queries())
    assert set(ORACLES) <= set(__spark_entry__.oracle_sql()) and {q.split("_")[0] for q in queries.QUERIES} == {f"op{i}" for i in range(1, 14)}


@pytest.mark.parametrize("name", list(ORACLES))
def test_equals_sql(spark, sf_dir, name):
    got = queries.QUERIES[name](spark, sf_dir)
    names, left = _rows(got.columns, [tuple(r) for r in got.collect()])
    cursor = connect(sf_dir).execute(ORACLES[name])
    assert (names, left) == _rows([c[0] for c in cursor.description], cursor.fetchall())


def test_pipeline_stages(spark, sf_dir, docs):
    columns, now = docs.columns, docs
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, now, sf_dir).cache()
        if i < 4:
            assert out.columns == columns, name
        before = {d: t for d, t in pairs(now)}
        if name == "exact dedup":
            assert alike(rows(out, "doc_id"), [(d,) for d, _, _, kept in plain_groups(before.items()) if kept])
        if name.startswith("SimHash"):
            near_copies_are_out(before, {d for (d,) in rows(out, "doc_id")})
        if name.startswith("byte"):
            library = brute.tiktoken_encoding(brute.ranks())
            assert all(list(memoryview(bytes(r["ids"])).cast("I")) == library.encode_ordinary(r["text"]) for r in out.collect())
        assert {t for _, t in pairs(out)} <= set(before.values())
        now = out
    clean = docs.join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id").filter("toxic = 0").select("doc_id")
    kept = corpus_pipeline.without_toxic(spark, docs, sf_dir)
    assert kept.join(clean, "doc_id").count() >= 0.9 * clean.count()


def near_copies_are_out(before, kept):
    """Nothing kept is close to anything else kept, and whatever went had a close text."""
    sets = {d: brute.shingle_set(t) for d, t in before.items()}
    assert kept and not [(a, b) for a in kept for b in kept if a < b and brute.jaccard(sets[a], sets[b]) >= 0.85]
    # 256 bits estimate the similarity: links below 0.8 are the lesser part, and none lies far below
    best = sorted(max(brute.jaccard(sets[gone], sets[d]) for d in sets if d != gone) for gone in sets.keys() - kept)
    assert best and best[0] >= 0.5 and best[len(best) // 2] >= 0.75, best


def test_pipeline_odd_rows(spark, sf_dir, odd, empty):
    from pyspark.sql import DataFrame

    for start in (odd, empty):
        now: DataFrame = start
        for name, stage in corpus_pipeline.STAGES:
            if name == "mixing sources to target weights" and start is odd:
                assert now.filter(F.col("doc_id").isNull()).count() == 1
            now = stage(spark, now, sf_dir).cache()
            assert now.count() <= 3 * max(1, start.count())


def test_pipeline_leaves_clashing_columns_alone(spark, sf_dir, odd):
    start = odd.withColumn("place", F.concat(F.lit("p"), "doc_id")).withColumn("__scored", F.lit("x"))
    there = set(rows(start))
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, start, sf_dir)
        assert out.dtypes == start.dtypes and set(rows(out)) <= there, name
