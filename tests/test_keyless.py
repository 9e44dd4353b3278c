"""Tables without a row key: a key from the content, and comparison of rows without the key."""

import pytest
from pyspark.sql import functions as F

from millrace.operators import clean
from millrace.plans.experiments import make_holdout
from millrace.plans.preprocess import prepare
from millrace.roles import Roles
from millrace.sources import tables


def test_key_depends_on_content_only(spark, monkeypatch):
    monkeypatch.setattr(tables, "COPIES_AT_ONCE", 3)
    rows = [("a", 1.0, None)] * 10 + [("a", None, 1)] * 2 + [(None, None, None)] * 7 + [("b", 2.5, 3)]
    df = spark.createDataFrame(rows, "x string, y double, z int")
    one, two = tables.with_row_key(df, "id"), tables.with_row_key(df.repartition(5).orderBy(F.rand(3)), "id")
    assert one.columns == ["id", "x", "y", "z"]
    a, b = (sorted(map(tuple, d.collect()), key=str) for d in (one, two))
    assert a == b and len({r[0] for r in a}) == len(rows) and sorted((r[1:] for r in a), key=str) == sorted(rows, key=str)
    assert tables.with_row_key(df.limit(0), "id").count() == 0
    with pytest.raises(ValueError, match="has a column"):
        tables.with_row_key(df, "x")


def test_equal_rows_with_different_keys_collapse(spark):
    df = spark.createDataFrame([(3, "a", None), (1, "a", None), (2, "a", 1.0), (5, None, None), (4, None, None), (4, None, None)], "id int, x string, y double")
    assert sorted(map(tuple, clean.dedup(df, key="id").collect()), key=str) == [(1, "a", None), (2, "a", 1.0), (4, None, None)]
    assert clean.duplicate_rows(df, ["id"]).first()[0] == 3


def test_csv_without_key_to_holdout(spark, sf_dir, tmp_path):
    from millrace.sources.observations import obs

    table = obs(spark, sf_dir).withColumnRenamed("ts_text", "timestamp").drop("obs_id").limit(600)
    tables.write_dataset(table.withColumns({"hour": F.lit(None).cast("int"), "day_of_week": F.lit(None).cast("int"), "is_weekend": F.lit(None).cast("int")}), str(tmp_path / "raw"), "csv")
    roles = Roles()
    raw = tables.read_observations(spark, str(tmp_path / "raw"), key=roles.key)
    assert raw.columns[0] == roles.key and raw.select(roles.key).distinct().count() == raw.count() == 600
    run = prepare(raw, roles)
    h = make_holdout(run.labelled, roles, names=["distance_km", "duration_normal_min", "wind"])
    train, test = h.train.count(), h.test.count()
    assert train + test == run.labelled.count() <= 600 and 0.1 < test / (train + test) < 0.3
    again = prepare(tables.read_observations(spark, str(tmp_path / "raw"), key=roles.key).repartition(3), roles)
    assert {r[0] for r in make_holdout(again.labelled, roles, names=["wind"]).test.select(roles.key).collect()} == {r[0] for r in h.test.select(roles.key).collect()}
