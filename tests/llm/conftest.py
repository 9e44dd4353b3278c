import pytest
from pyspark.sql import types as T

ODD = [
    None,
    "",
    " ",
    "\n\t \x0b\x0c\r",
    "a",
    "A b  c\n\n d",
    "the same text twice",
    "the same text twice",
    "the  same\ttext twice",
    "\x1c\x85 \u3000 odd \u2028 spaces\ufeff",
    "漢字 и кириллица 😀😀 e\u0301",
    "<|endoftext|> it's we'll 'RE x'",
    "x" * 5000,
    "ab " * 4000,
    "1234567890" * 400,
    "a@b.c_d@e.f me@@x.y.z 1.2.3.4.5.6.7.8 300.1.1.1 00001.2.3.255 +1 (456) 555-2186 4173 8931-78530722 4173893178530722",
    "😀 +44 20 7946 0958, tnf.01@mail0.example.com; 99.99.99.99",
    "+" * 50 + "1" * 30 + "@" * 20 + "." * 20,
]


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls in all columns, empty and very long texts, ties, repeated rows, and columns whose names clash with results."""
    schema = T.StructType.fromDDL("doc_id long, text string, lang string, source string, n_chars long, ids string, score string, copy string, kept string, fp string, n_tokens string")
    rows = [(i, t, "en" if i % 2 else None, None if i % 5 == 0 else f"s{i % 2}", len(t or ""), "i", "s", "c", "k", "f", "n") for i, t in enumerate(ODD)]
    rows += [rows[6], rows[1], (None, "no id", None, None, None, *"abcdef"), (None, "no id", None, None, None, *"abcdef")]
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def texts(docs):
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
