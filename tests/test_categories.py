"""Indicator vectors over any number of values, and in a learner."""

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from millrace.operators import encode, models
from millrace.operators.encode import CategoryVector
from millrace.operators.models import Forest


def slots(df, fitted):
    hot = vector_to_array(fitted.output)
    return {r["k"]: (r["at"] if r["sum"] else None, r["n"]) for r in fitted.transform(df).select("k", F.array_position(hot, 1.0).alias("at"), F.size(hot).alias("n"), F.aggregate(hot, F.lit(0.0), lambda a, x: a + x).alias("sum")).collect()}


def test_slots_follow_the_order_of_values(spark, tmp_path):
    df = spark.createDataFrame([(c,) for c in "qdazbbbbcx"] + [(None,)], "k string").repartition(4)
    fitted = encode.fit_one_hot_vector(df, "k")
    want = {c: (i, 6) for i, c in enumerate("abcdqxz")} | {"a": (None, 6), None: (None, 6)}
    assert slots(df, fitted) == want
    fitted.save(str(tmp_path))
    assert slots(df, CategoryVector.load(spark, str(tmp_path))) == want
    with pytest.raises(ValueError, match="no values"):
        encode.fit_one_hot_vector(df.where("k is null"), "k")


def test_a_million_routes(spark):
    df = spark.range(1_000_000).select(F.concat(F.lit("r"), F.lpad(F.col("id").cast("string"), 7, "0")).alias("k"), F.col("id"))
    fitted = encode.fit_one_hot_vector(df, "k")
    assert fitted.slots == 999_999
    assert fitted.index.agg(F.countDistinct("slot"), F.min("slot"), F.max("slot")).first() == (1_000_000, -1, 999_998)
    wrong = fitted.index.where(F.substring("value", 2, 7).cast("long") != F.col("slot") + 1)
    assert wrong.count() == 0
    assert fitted.transform(df.where("id % 100000 = 7")).select("k_vector").first()[0].size == 999_999


def test_learner_with_routes(spark):
    rows = spark.range(300).select(F.col("id"), (F.col("id") % 5).cast("double").alias("x"), F.concat(F.lit("r"), F.col("id") % 6).alias("route"))
    rows = rows.withColumn("y", F.col("x") + 10 * (F.col("route") == "r3").cast("double"))
    both = encode.fit_one_hot_vector(rows, "route").transform(rows)
    data = encode.assembled(both, ["x", "route_vector"], "y", carry=["id"])
    model = models.fit_forest(Forest(5), data)
    worst = model.transform(data).agg(F.max(F.abs(F.col("prediction") - F.col("label")))).first()[0]
    assert worst < 1.0 and model.featureImportances[3] > 0.8
