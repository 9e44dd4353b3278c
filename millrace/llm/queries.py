"""One query for each operator, over its whole table with production parameters."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import ans, content_dedup, host_text, hosts, mixing, phrases, pii, prefix_bpe, rpforest, simhash, toxicity, trie_counts, vector_codes
from millrace.session import shared_dir

RANKS, TOKENIZER, END_ID = "byte_bpe_50k.tiktoken", "byte_bpe_50k.json", 2
#: (verdict, host, path); the longest that fits wins.
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    network = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs.select("doc_id", "text"), network)
    return scored.select("doc_id", toxicity.held_out("doc_id").alias("held_out"), "score", F.when(F.col("score") >= toxicity.THRESHOLD, 1).otherwise(0).alias("predicted"))


def op2_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark).rstrip('/')}/coded-{uuid.uuid4().hex}"
    ans.write_ids(table(spark, sf_dir, "documents"), path, public_tokenizers.path(TOKENIZER), public_tokenizers.PATTERN, END_ID)
    return ans.read_ids(spark, path, digest=True)


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return prefix_bpe.encode_and_check(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sources to equal weights."""
    return mixing.mix(table(spark, sf_dir, "documents"))


def op5_content_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content_dedup.content_groups(table(spark, sf_dir, "documents"))


def op6_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rpforest.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return trie_counts.token_counts(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN).select("doc_id", "n_pretokens", "n_tokens")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"), everywhere=True)


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's path ends in the number of the document made from it; a labelled document of good quality that is not toxic is a good outcome."""
    pages, labels = table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels")
    _, path = hosts.parts_of("url")
    number = F.regexp_extract(path, "^/[a-z]+/([0-9]{1,18})", 1)
    made = pages.select("page_id", F.when(number != "", number.cast("long")).alias("doc_id"))
    good = labels.select("doc_id", F.when((F.col("quality") == 1) & (F.col("toxic") == 0), 1).otherwise(0).alias("good"))
    return hosts.judge(pages, made.join(good, "doc_id").select("page_id", "good"), RULES)


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.vector_codes(table(spark, sf_dir, "embeddings"))


def op12_host_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_text.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars", "n_repeated")


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (op1_toxicity, op2_token_ids, op3_byte_bpe, op4_mixing, op5_content_sort, op6_neighbours, op7_token_counts, op8_simhash, op9_personal_data, op10_url_filter, op11_vector_codes, op12_host_text, op13_phrases)
}
