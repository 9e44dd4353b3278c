"""Exact de-duplication by content sort.

Rows are range-partitioned by their normalised content at splitters that Spark
samples, sorted inside each range by external sort, and neighbours are compared
in full. The place in the order is the first HEAD characters of the normalised
text, then its digest, then the key: splitters stay small however long the texts
are, equal texts are adjacent, and a group of any size is cut over as many ranges
as its rows need, because the key takes part. Groups that a cut goes
through are joined again at the borders: each range reports its first and last
run, and neighbouring reports are compared in full as well.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from millrace.llm.common import partitions
from millrace.session import staged

#: Characters that do not count, and characters of the normalised text that splitters hold.
DELETED, HEAD = " \t\n\x0b\x0c\r", 64
_DELETED = DELETED.encode()
FOUND = ("keep_id", "group_size", "kept", "text_sha256")
#: Rows of results sent on at once, and the bytes of normalised text compared at once.
_OUT = 20_000


def normalised(text) -> F.Column:
    return F.translate(F.coalesce(text, F.lit("")), DELETED, "")


def _runs(key: str, carried: list[str], schema: pa.Schema):
    """Reads sorted rows and writes one row for each, with the totals of its run of equal texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        text, digest, chars, number = None, None, 0, 0  # of the current run
        keys: list = []
        best: dict = {}
        out: list[dict] = []
        held = 0

        def close(last: bool) -> None:
            nonlocal held
            edge = number == 0 or last
            for i, k in enumerate(keys):
                own = {"__key": k, "keep_id": keys[0], "group_size": len(keys), "kept": i == 0, "text_sha256": digest, "__part": part, "__run": number}
                if i == 0:
                    own |= {"__chars": chars, "__edge": text.decode("utf-8", "surrogatepass") if edge else None} | best
                out.append(own)
            held += len(keys)

        for batch in batches:
            texts = batch.column("__text").to_pylist()
            digests, sizes, ids = (batch.column(n).to_pylist() for n in ("__sha", "__n_chars", "__key"))
            values = batch.select(carried) if carried else None
            for i, raw in enumerate(texts):
                own = (raw or "").encode("utf-8", "surrogatepass").translate(None, _DELETED)
                if own != text:
                    if text is not None:
                        close(False)
                        number += 1
                    text, digest, chars, keys = own, digests[i], sizes[i], []
                    best = {n: values.column(n)[i].as_py() for n in carried} if carried else {}
                keys.append(ids[i])
                if held >= _OUT:
                    yield pa.RecordBatch.from_pylist(out, schema=schema)
                    out, held = [], 0
        if text is not None:
            close(True)
        for at in range(0, len(out), _OUT):
            yield pa.RecordBatch.from_pylist(out[at : at + _OUT], schema=schema)

    return run


def _decided(df: DataFrame, key: str, text: str, carry: bool) -> DataFrame:
    """Staged decisions. ``carry``: with the input's columns, for the rows that stay."""
    value = F.col(text).cast("string")
    carried = [f"__c{i}" for i in range(len(df.columns))] if carry else []
    source = df.select(
        F.col(key).cast("long").alias("__key"),
        value.alias("__text"),
        F.sha2(normalised(value), 256).alias("__sha"),
        F.length(F.coalesce(value, F.lit(""))).alias("__n_chars"),
        F.substring(normalised(value), 1, HEAD).alias("__head"),
        *[F.col(f"`{c}`").alias(n) for n, c in zip(carried, df.columns, strict=False)],
    )
    order = ["__head", "__sha"]
    sorted_rows = source.repartitionByRange(partitions(df), *order, "__key").sortWithinPartitions(*order, F.col("__n_chars").desc(), F.col("__key").asc_nulls_last())
    fields = [T.StructField("__key", T.LongType()), T.StructField("keep_id", T.LongType()), T.StructField("group_size", T.LongType()), T.StructField("kept", T.BooleanType())]
    fields += [T.StructField("text_sha256", T.StringType()), T.StructField("__part", T.IntegerType()), T.StructField("__run", T.LongType()), T.StructField("__chars", T.LongType()), T.StructField("__edge", T.StringType())]
    fields += [T.StructField(n, source.schema[n].dataType) for n in carried]  # null in the rows that go, whatever the input says
    schema = T.StructType(fields)
    from pyspark.sql.pandas.types import to_arrow_schema

    rows = sorted_rows.drop("__head").mapInArrow(_runs(key, carried, to_arrow_schema(schema)), schema)
    if carry:
        rows = rows.filter("kept")
    rows = staged(rows, "content-sort")
    edges = rows.filter(F.col("__edge").isNotNull()).select("__part", "__run", "__edge", "__chars", "keep_id", "group_size")
    by_place = Window.orderBy("__part", "__run")  # two rows for each range at most
    edges = edges.withColumn("__new", F.when(F.lag("__edge").over(by_place) == F.col("__edge"), 0).otherwise(1))
    edges = edges.withColumn("__group", F.sum("__new").over(by_place))
    best = F.row_number().over(Window.partitionBy("__group").orderBy(F.col("__chars").desc(), F.col("keep_id").asc_nulls_last(), "__part"))
    whole = Window.partitionBy("__group")
    edges = edges.select("__part", "__run", F.count(F.lit(1)).over(whole).alias("__pieces"), F.sum("group_size").over(whole).alias("__size"), F.first("keep_id").over(whole.orderBy(F.col("__chars").desc(), F.col("keep_id").asc_nulls_last(), "__part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("__keep"), (best == 1).alias("__first"))
    joined = rows.join(F.broadcast(edges.filter("__pieces > 1").drop("__pieces")), ["__part", "__run"], "left")  # at most two rows for each range
    merged = F.col("__size").isNotNull()
    return (
        joined.withColumn("keep_id", F.when(merged, F.col("__keep")).otherwise(F.col("keep_id")))
        .withColumn("group_size", F.coalesce("__size", "group_size"))
        .withColumn("kept", F.col("kept") & F.coalesce("__first", F.lit(True)))
        .drop("__size", "__keep", "__first", "__part", "__run", "__edge", "__chars")
    )


def content_groups(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for every input row: ``key``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when they are so after deleting DELETED; null is the empty
    text, and all empty texts are one group. The row with the most characters in the original text stays, then
    the one with the smallest key (nulls last). Of rows equal in all of this one stays. Extra columns play no part.
    """
    out = _decided(df, key, text, carry=False)
    return out.select(F.col("__key").alias(key), *FOUND)


def distinct_content(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, with all columns of the input and nothing else."""
    out = _decided(df, key, text, carry=True).filter("kept")
    return out.select(*[F.col(f"__c{i}").alias(c) for i, c in enumerate(df.columns)])
