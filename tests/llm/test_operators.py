"""Each operator against a plain version, on the tables and on a table of odd rows."""

import random
import re
import sys
import uuid
import zlib
from collections import Counter
from itertools import pairwise

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
import zstandard
from pyspark.sql import functions as F
from tokenizers import models

from millrace.llm import ans, content_dedup, hosts, mixing, pii, prefix_bpe, queries, rpforest, simhash, toxicity, trie_counts
from millrace.session import shared_dir

from . import brute
from .conftest import ODD

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def rows(df, *names):
    return [tuple(r) for r in (df.select(*names) if names else df).collect()]


def pairs(df):
    return rows(df, "doc_id", "text")


def alike(a, b):
    return Counter(a) == Counter(b)


# Toxicity


def test_toxicity_gradient():
    net = toxicity.Network(3)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    words, index, mask, _ = toxicity.laid_out([["you", "idiot,", "the"], ["a", "b", "a"] * 15])
    y, words = np.array([1.0, 0.0, 1.0])[: len(index)], toxicity.Words.of(words)
    g = net.gradient(words, index, mask.astype(np.float64), y)

    def loss():
        p = 1 / (1 + np.exp(-net.forward(net.inputs(words).astype(np.float64), index, mask)))
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    for k, v in net.p.items():
        flat, own = v.reshape(-1), g[k].reshape(-1)
        i = int(np.argmax(np.abs(own)))
        old, out = flat[i], []
        for d in (0.01, -0.01):
            flat[i] = old + d
            out.append(loss())
        flat[i] = old
        assert (out[0] - out[1]) / 0.02 == pytest.approx(own[i], rel=0.02, abs=1e-5), k


def test_toxicity_windows_read_to_the_end():
    for n in (0, 1, 31, 32, 33, 56, 57, 1000):
        starts = toxicity.windows(n)
        seen = {i for s in starts for i in range(s, min(n, s + toxicity.WINDOW))}
        assert seen == set(range(n)) and all(s < max(n, 1) for s in starts)


def test_toxicity_held_out_accuracy(spark):
    got = queries.op1_toxicity(spark, "/root/testdata/sf0.1").join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id")
    found = [(r["predicted"], r["toxic"]) for r in got.filter("held_out").collect()]
    hit = sum(p and t for p, t in found)  # fitted on 250 toxic texts only; see README for larger tables
    assert hit / sum(t for _, t in found) > 0.75 and hit / sum(p for p, _ in found) > 0.8


def test_toxicity_odd_rows(spark, odd, empty, docs, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    net = toxicity.fit(docs, labels)
    got = rows(toxicity.score(odd, net), "score")
    assert len(got) == odd.count() and all(0 <= s <= 1 for (s,) in got)
    assert rows(toxicity.score(empty, net)) == []
    untrained = toxicity.fit(docs, labels.filter("toxic = 0"))
    assert {s for (s,) in rows(toxicity.score(docs, untrained), "score")} == {0.0}
    long = "fine words " * 300 + "you are a stupid moron and pathetic loser, idiot trash " + "fine words " * 300
    assert net.scores([long])[0] == pytest.approx(max(net.window_scores([long])[0]))


def test_held_out_is_never_fitted_on(spark, docs):
    got = {r["doc_id"]: r["h"] for r in docs.select("doc_id", toxicity.held_out("doc_id").alias("h")).collect()}
    assert got == {d: zlib.crc32(str(d).encode()) % 4 == 2 for d in got}


# Ids in blocks


def test_ids_round_trip(spark, sf_dir, texts):
    assert set(rows(queries.op2_token_ids(spark, sf_dir), "doc_id", "start", "n_tokens", "ids_crc32")) == brute.ids_rows(texts)


def test_ids_odd_rows(spark, odd, empty):
    own = odd.filter("doc_id is not null").dropDuplicates(["doc_id"])
    path = f"{shared_dir(spark)}/odd-ids-{uuid.uuid4().hex}"
    ans.write_ids(own, path, public_tokenizers.path(queries.TOKENIZER), PATTERN, 2)
    assert set(rows(ans.read_ids(spark, path, digest=True))) == brute.ids_rows(pairs(own))
    ans.write_ids(odd, path + "-all", public_tokenizers.path(queries.TOKENIZER), PATTERN, 2)
    assert ans.read_ids(spark, path + "-all").count() == odd.count()
    ans.write_ids(empty, path + "-none", public_tokenizers.path(queries.TOKENIZER), PATTERN, 2)
    assert rows(ans.read_ids(spark, path + "-none")) == []


def test_new_words_cost_no_python_call_each():
    r = np.random.default_rng(1)
    words = ["".join(chr(97 + c) for c in r.integers(0, 26, 9)) + mark for mark in r.choice(["", ",***", ".\nAt", "'s", "é", " \n "], 20_000)]
    texts = [" ".join(words[i : i + 500]) for i in range(0, len(words), 500)]
    encode = ans._encoder.__wrapped__(public_tokenizers.path(queries.TOKENIZER), PATTERN)
    calls = []
    sys.setprofile(lambda frame, event, what: calls.append(event) if event.endswith("call") else None)
    try:
        starts, ids = encode(pa.array(texts))
    finally:
        sys.setprofile(None)
    made = brute.Tokenizer.from_file(public_tokenizers.path(queries.TOKENIZER))
    assert [ids[a:b].tolist() for a, b in pairwise(starts.tolist())] == [made.encode(t, add_special_tokens=False).ids for t in texts]
    assert len(calls) < len(words)


def test_ids_with_a_full_memory_and_missing_bytes(monkeypatch):
    monkeypatch.setattr(ans, "TO_MODEL", 7)
    path = public_tokenizers.path(queries.TOKENIZER)
    made, encode = brute.Tokenizer.from_file(path), ans.TextIds(ans._library(path), regex.compile(PATTERN), 20)
    some = [t or "" for t in ODD if "<|endoftext|>" not in (t or "")] + ["\n\tif  x:\n\n   y \n", "  two", " one", "end \n", "\x85 \xa0 a \u3000b\x1c c"]
    for texts in (some, some[3:9], [], [""], some[::-1], some):
        starts, ids = encode(pa.array(texts, pa.string()))
        assert [ids[a:b].tolist() for a, b in pairwise(starts.tolist())] == [made.encode(t, add_special_tokens=False).ids for t in texts]
    for width, ids in ((2, [0, 65535, 2]), (4, [70_000, 0, 1 << 31])):
        assert ans._unpacked(zstandard.compress(b"".join(ans._planes(ids, width))), len(ids)).tolist() == ids
    small = brute.Tokenizer(models.BPE({"a": 0, "b": 1, "Ġ": 2, "ab": 3}, [("a", "b")]))
    small.pre_tokenizer = made.pre_tokenizer
    texts = ["ab xab", "x", "b axb  ba"]
    starts, ids = ans.TextIds(small, regex.compile(PATTERN), 20)(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in pairwise(starts.tolist())] == [small.encode(t).ids for t in texts]


def test_blocks_of_any_size_and_damage():
    r = np.random.default_rng(0)
    table = ans.Table.of(ans.quantised(np.array([1000, 10, 0, 5, 1])))
    blocks = [r.integers(0, 5, n).astype(np.uint32) for n in (0, 1, 255, 256, 257, 65536, 65537, 200_000)]
    coded = ans.encode_blocks(table, blocks)
    assert all((a == b).all() and len(a) == len(b) for a, b in zip(blocks, ans.decode_blocks(table, coded), strict=True))
    bad = bytearray(coded[-1])
    bad[-2000] ^= 1
    with pytest.raises(ValueError, match="checksum"):
        ans.decode_blocks(table, [bytes(bad)])
    assert ans.quantised(np.zeros(7, np.int64)).sum() == 1 << ans.PRECISION


# BPE


def test_bpe_equals_library(spark, sf_dir, texts):
    assert alike(rows(queries.op3_byte_bpe(spark, sf_dir)), brute.bpe_rows(texts))


def test_bpe_odd_rows(spark, odd, empty):
    got = prefix_bpe.encode_and_check(odd, RANKS, PATTERN)
    assert alike(rows(got, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256"), brute.bpe_rows(pairs(odd)))
    ids = prefix_bpe.encode_column(odd, RANKS, PATTERN)
    assert set(ids.columns) == set(odd.columns) and ids.count() == odd.count()
    assert rows(prefix_bpe.encode_column(empty, RANKS, PATTERN)) == []


def test_bpe_prefixes_appends_and_edits():
    vocabulary = brute.ranks()
    codec, library = prefix_bpe.Codec(vocabulary, PATTERN), brute.tiktoken_encoding(vocabulary)
    r, letters = random.Random(0), "ab '\n\t .1é漢strello   \x1cr\u3000"
    for _ in range(400):
        text = "".join(r.choice(letters) for _ in range(r.randint(0, 30)))
        assert codec.encode(text) == library.encode_ordinary(text)
        a = r.randint(0, len(text))
        b, new = min(len(text), a + r.randint(0, 4)), "".join(r.choice(letters) for _ in range(r.randint(0, 4)))
        assert prefix_bpe.EditableText(codec, text).replace(a, b, new).tokens() == library.encode_ordinary(text[:a] + new + text[b:])
        data = text.encode()
        table = prefix_bpe.PrefixTable(vocabulary, data[:a]).append(data[a:])
        for end in range(len(data) + 1):
            assert table.tokens(end) == prefix_bpe.PrefixTable(vocabulary, data[:end]).tokens()
            assert b"".join(vocabulary.bytes_of[t] for t in table.tokens(end)) == data[:end]
        merged = [vocabulary.ranks[p] for p in vocabulary.merged(data)] if data else []
        assert table.tokens() == merged
        assert table.replace(a, len(data), b"zz").tokens() == prefix_bpe.PrefixTable(vocabulary, data[:a] + b"zz").tokens()


# Mixing


def test_mixing_draws(odd, empty):
    got = mixing.mix(odd, weights={"s0": 3.0}, default=0.5, power=0.5)
    assert got.columns == [c for c in odd.columns if c != "copy"] + ["copy", "place"]
    place = [r["place"] for r in got.collect()]
    assert place == sorted(place) and all(0 <= p < 1 for p in place)
    assert rows(mixing.mix(empty)) == []
    assert mixing.mix(odd, default=0.0).count() == 0
    with pytest.raises(ValueError):
        mixing.mix(odd, weights={"s0": -1.0})


def test_mixing_counts_follow_the_distribution(spark):
    df = spark.range(20_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 10 < 8, "big").when(F.col("id") == 9, "one").otherwise("small").alias("source"))
    got = {r["source"]: r["n"] for r in mixing.mix(df).groupBy("source").agg(F.count("*").alias("n")).collect()}
    assert all(abs(got[s] - 20_000 / 3) < 5 * (20_000 / 3) ** 0.5 for s in ("big", "small", "one"))
    steps = spark.range(1).select(mixing.poisson_steps(F.lit(2.5)).alias("s")).first()["s"]
    assert steps[0] == pytest.approx(np.exp(-2.5)) and steps[-1] == pytest.approx(1)


def test_mixing_beyond_the_broadcast_bound(odd, monkeypatch):
    before = rows(mixing.mix(odd))
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    assert alike(before, rows(mixing.mix(odd)))


# Content sort


def plain_groups(found):
    groups = {}
    for d, t in found:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((-len(t or ""), d is None, d or 0, d))
    out = []
    for g in groups.values():
        g.sort(key=lambda x: x[:3])
        out += [(x[3], g[0][3], len(g), i == 0) for i, x in enumerate(g)]
    return out


@pytest.mark.parametrize("parts", ["1", "4", "23"])
def test_content_groups(spark, odd, docs, empty, parts):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        hot = docs.select("doc_id", "text").union(spark.range(5000, 5400).selectExpr("id", "repeat(' copy ', cast(id % 3 as int) + 1)"))
        for df in (odd.select("doc_id", "text"), hot.select("doc_id", F.when(F.col("doc_id") >= 5000, F.lit(" one copy") ).otherwise(F.col("text")).alias("text")), hot):
            got = content_dedup.content_groups(df)
            assert alike(rows(got, "doc_id", "keep_id", "group_size", "kept"), plain_groups(pairs(df)))
        kept = content_dedup.distinct_content(odd)
        assert kept.columns == odd.columns and alike(rows(kept, "doc_id"), [(d,) for d, _, _, k in plain_groups(pairs(odd)) if k])
        assert rows(content_dedup.content_groups(empty)) == [] and rows(content_dedup.distinct_content(empty)) == []
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


# Nearest neighbours


def test_neighbours_recall(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = queries.op6_neighbours(spark, "/root/testdata/sf0.1").collect()
    v = {r["vec_id"]: np.array(r["embedding"], np.float64) for r in df.collect()}
    ids = np.array(sorted(v))
    m, hit, total = np.stack([v[i] for i in ids]), 0, 0
    for q in ids[ids % 100 == 0]:
        d = np.sqrt(((m - v[q]) ** 2).sum(1))
        true = {int(ids[i]) for i in [i for i in np.lexsort((ids, d)) if ids[i] != q][:10]}
        own = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
        assert [r[0] for r in own] == list(range(1, 11)) and [(s, i) for _, i, s in own] == sorted((s, i) for _, i, s in own)
        assert all(s == pytest.approx(np.sqrt(((v[i] - v[q]) ** 2).sum()), rel=1e-12) for _, i, s in own)
        hit, total = hit + len(true & {i for _, i, _ in own}), total + 10
    assert hit / total >= 0.9


def test_neighbours_recall_without_clusters(spark):
    """Beyond the least number of vectors that a query sees, and with no structure that helps the trees."""
    r = np.random.default_rng(1)
    x = r.normal(size=(20000, 64))
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    found = rows(rpforest.nearest(df, F.col("vec_id") % 100 == 0), "query_id", "vec_id")
    known, hit = set(found), 0
    for q in range(0, len(x), 100):
        d = ((x - x[q]) ** 2).sum(1)
        d[q] = np.inf
        hit += len({(q, int(i)) for i in np.argsort(d)[:10]} & known)
    assert len(found) == 2000 and hit / 2000 >= 0.93


def test_neighbours_odd_vectors(spark, monkeypatch):
    bad = [None, [0.0, 0.0], [], [float("nan"), 1.0], [float("inf"), 1.0], [1.0, 2.0, 3.0]]
    vectors = [(i, x) for i, x in enumerate(bad)] + [(7, [1.0, None]), (None, [1.0, 1.0])]
    vectors += [(100 + i, [1.0, 1.0]) for i in range(301)] + [(1000 + i, [float(i), 2.0]) for i in range(5)] + [(1000, [0.0, 2.0])]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    monkeypatch.setattr(rpforest, "BLOCK", 2)
    got = {}
    for q, r, i, s in sorted(rows(rpforest.nearest(df, F.col("vec_id") % 100 == 0), "query_id", "rank", "vec_id", "score")):
        got.setdefault(q, []).append((r, i, s))
    good = [(i, v) for i, v in vectors if i is not None and v is not None and len(v) == 2 and None not in v and np.isfinite(v).all() and any(v)]
    for q, own in {i: v for i, v in good if i % 100 == 0}.items():
        true = sorted({(float(np.sqrt(sum((a - b) ** 2 for a, b in zip(own, v, strict=True)))), i) for i, v in good if i != q})[:10]
        assert [(s, i) for _, i, s in got.pop(q)] == true
    assert got == {}
    assert rows(rpforest.nearest(df.limit(0), F.col("vec_id") % 100 == 0)) == []
    assert rows(rpforest.nearest(df.filter("vec_id in (100, 101)"), F.col("vec_id") == 100)) == [(100, 1, 101, 0.0)]


# Token counts


def test_token_counts(spark, sf_dir, texts, odd, empty):
    vocabulary = brute.ranks()
    scores = {b: -np.log(r + trie_counts.SHIFT) for b, r in vocabulary.ranks.items()}
    import regex

    pattern, known = regex.compile(PATTERN), {}

    def count(text):
        pieces = pattern.findall(text or "")
        for p in pieces:
            if p not in known:
                known[p] = brute.unigram_count(p.encode(), scores)
        return len(pieces), sum(known[p] for p in pieces)

    short = [(d, t) for d, t in texts if len(t) < 3000]
    got = {r[0]: r[1:] for r in rows(queries.op7_token_counts(spark, sf_dir))}
    assert {d: got[d] for d, _ in short} == {d: count(t) for d, t in short} and len(got) == len(texts)
    own = odd.filter("text is null or length(text) < 1000")
    assert alike(rows(trie_counts.token_counts(own, RANKS, PATTERN), "doc_id", "n_pretokens", "n_tokens"), [(d, *count(t)) for d, t in pairs(own)])
    assert trie_counts.token_counts(odd, RANKS, PATTERN).count() == odd.count()
    assert rows(trie_counts.token_counts(empty, RANKS, PATTERN)) == []


def test_token_count_shares_prefixes(monkeypatch):
    scores = {b"a": -1.0, b"b": -1.5, b"ab": -2.0, b"abc": -2.5, b"c": -1.0, b"bc": -2.0}
    trie = trie_counts.UnigramTrie(scores)
    assert trie.count(b"abc") == brute.unigram_count(b"abc", scores)
    assert trie.computed == 3
    assert trie.count(b"abcab") == brute.unigram_count(b"abcab", scores)
    assert trie.computed == 5
    assert trie.count(b"abca") == brute.unigram_count(b"abca", scores) and trie.computed == 5
    monkeypatch.setattr(trie_counts, "MAX_DEPTH", 2)
    monkeypatch.setattr(trie_counts, "MAX_NODES", 1)
    assert trie_counts.UnigramTrie(scores).count(b"abcab") == brute.unigram_count(b"abcab", scores)


# SimHash


def test_simhash_equals_all_pairs(spark, sf_dir, texts):
    assert alike(rows(queries.op8_simhash(spark, sf_dir), "doc_id", "fingerprint", "component_id"), brute.simhash_rows(texts))


def test_simhash_odd_rows(spark, odd, empty, monkeypatch):
    monkeypatch.setattr(simhash, "CELL", 2)
    assert alike(rows(simhash.near_duplicates(odd)), brute.simhash_rows(pairs(odd)))
    assert rows(simhash.near_duplicates(empty)) == [] and rows(simhash.one_of_each(empty)) == []
    kept = simhash.one_of_each(odd)
    assert kept.columns == odd.columns
    assert Counter(r[0] for r in rows(kept, "doc_id")) == Counter({c for _, c in brute.near_rows(pairs(odd))})


def test_wide_fingerprints_follow_similarity():
    words = np.random.default_rng(3).permutation(4000).astype(str).tolist()

    def differ(a, b):
        return sum((x ^ y).bit_count() for x, y in zip(simhash.wide_fingerprint(a), simhash.wide_fingerprint(b), strict=True))

    whole, changed, half = " ".join(words[:1000]), " ".join([*words[:500], "new", *words[501:1000]]), " ".join([*words[:500], *words[2000:2500]])
    assert simhash.wide_fingerprint("") == simhash.wide_fingerprint(" \n") == (0, 0, 0, 0)
    assert simhash.wide_fingerprint(whole) == simhash.wide_fingerprint(whole.upper() + "  ")
    assert differ(whole, changed) <= 20 and simhash.WIDE_MOST < differ(whole, half) < 100 < differ(whole, " ".join(words[3000:]))


def test_near_copies_by_the_hundred(spark, monkeypatch):
    """Copies with one word in fifty changed become one row, whatever the cells, and other texts that share a third stay."""
    monkeypatch.setattr(simhash, "CELL", 16)
    rng, vocabulary = np.random.default_rng(5), np.arange(20000).astype(str)
    passage = rng.choice(vocabulary, 60).tolist()
    base = rng.choice(vocabulary, 300)
    texts = []
    for _ in range(150):
        copy = base.copy()
        copy[rng.integers(0, 300, 3)] = "other"
        texts.append(" ".join(copy))
    texts += [" ".join([*rng.choice(vocabulary, 120).tolist(), *passage]) for _ in range(40)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    assert sorted(r[0] for r in rows(simhash.one_of_each(df), "doc_id")) == [0, *range(150, 190)]


def test_trie_join_in_a_ball_of_near_copies():
    r = np.random.default_rng(1)
    values = [int(x) for x in r.integers(0, 2**63, 40)]
    for v in values[:40]:
        for _ in range(6):
            v ^= 1 << int(r.integers(0, 64))
            values.append(v)
    values = np.unique(np.array(values, np.uint64))
    for budget in (0, 1, 3, 5):
        true, got = simhash.Links(len(values)), simhash.Links(len(values))
        true.add(*np.nonzero(np.triu(np.bitwise_count(values[:, None] ^ values[None, :]) <= budget, 1)))
        got.add(*simhash.trie_join(values, None, budget))
        here = np.arange(len(values))
        assert (true.find(here) == got.find(here)).all()


# Personal data


def test_personal_data(spark, docs, texts, odd):
    for df in (docs, odd):
        got = rows(pii.personal_data(df), "doc_id", "n_email", "n_ip", "n_card", "n_phone", "spans")
        want = []
        for d, t in pairs(df):
            spans = brute.base_spans(t)
            want.append((d, *[sum(s.startswith(k) for s in spans) for k in pii.KINDS], ",".join(spans)))
        base = [(*g[:5], ",".join(s for s in g[5].split(",") if s.split(":")[0] in pii.KINDS)) for g in got]
        assert alike(base, want)


def test_personal_data_terms_and_text(spark, empty):
    rows_ = [(i, f"call zebrafone now +1 (456) 555-{2000 + i} or write x{i}@mail.example.com") for i in range(60)]
    rows_ += [(100 + i, "plain words of no interest now or call and write") for i in range(900)] + [(5000, "zebrafone alone"), (5001, None), (5002, "")]
    df = spark.createDataFrame(rows_, "doc_id long, text string")
    got = {r["doc_id"]: r for r in pii.personal_data(df, sanitised=True).collect()}
    assert len(got) == len(rows_)
    assert any(k in got[0]["spans"] for k in ("remove:5:14", "generalise:5:14")) and got[5000]["spans"] == ""
    clean = got[0]["sanitised"]
    assert "zebrafone" not in clean and "[phone]" in clean and "[email]" in clean and "@" not in clean and clean.startswith("call ") and " or " in clean
    assert got[100]["sanitised"] == "plain words of no interest now or call and write"
    assert rows(pii.personal_data(empty)) == []


def test_personal_data_terms_everywhere(spark, odd, empty, monkeypatch):
    """A disclosing term goes also where it stands alone or beside another kind; nothing else changes."""
    some = [(i, f"call zebrafone now +1 (456) 555-{2000 + i} or write x{i}@mail.example.com") for i in range(60)]
    some += [(100 + i, "plain words of no interest now or call and write") for i in range(900)]
    some += [(5000, "A zebrafone alone"), (5001, None), (5002, ""), (5003, "zebrafone at 10.0.0.1")]
    df = spark.createDataFrame(some, "doc_id long, text string")
    monkeypatch.setattr(queries, "table", lambda *a: df)
    by_query = {r["doc_id"]: r["spans"] for r in queries.op9_personal_data(spark, "").collect()}
    got = {r["doc_id"]: r for r in pii.personal_data(df, sanitised=True, everywhere=True).collect()}
    old = {r["doc_id"]: r for r in pii.personal_data(df, sanitised=True).collect()}
    assert len(got) == len(some) and by_query == {d: r["spans"] for d, r in got.items()}
    assert got[5000]["spans"] == "remove:2:11" and got[5000]["sanitised"] == "A  alone"
    assert got[5003]["spans"] == "remove:0:9,ip:13:21" and got[5003]["sanitised"] == " at [ip]"
    assert all(got[d] == old[d] for d in old if d not in (5000, 5003))
    assert alike(rows(pii.personal_data(odd, everywhere=True), "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256"), rows(pii.personal_data(odd), "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256"))
    assert rows(pii.personal_data(empty, everywhere=True)) == []


def test_personal_data_is_native(docs):
    plan = pii.personal_data(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# Hosts


def test_hosts_odd_urls(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://EXAMPLE.ORG/es/1", "x://a.example.org/en/1?q", "x://example.org/en/2", "x://fr.com/fr/#", "x://q.com/de/", "x://org", "x://h.net:80/p://z", "x://a://b/c", "x://h.net\n/p"]
    df = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)] + [(1, "", "h"), (None, "x://n.net/", "h")], "page_id long, url string, host string")
    outcomes = spark.createDataFrame([(10, 1), (10, 1), (3, 0), (99, 1), (2, None)], "page_id long, good int")
    got = hosts.judge(df, outcomes, queries.RULES)
    for r in got.collect():
        url = dict(enumerate(urls)).get(r["page_id"], "x://n.net/") or ""
        at = url.find("://")
        host = re.split("[/?#]", url[at + 3 :])[0] if at >= 0 else ""
        path = re.split("[?#]", url[at + 3 + len(host) :])[0] if at >= 0 else ""
        assert (r["host"], r["path"]) == (host.lower(), path) and r["verdict"] in ("allow", "block")
    by = {r["page_id"]: (r["rule"], r["verdict"]) for r in got.collect()}
    assert by[4] == ("example.org/es/", "block") and by[5] == ("example.org/en/1", "block") and by[6] == ("org/", "allow") and by[7] == ("com/fr/", "allow") and by[8] == ("com/de/", "block")
    assert got.count() == df.count() and by[9][0] is None
    assert rows(hosts.judge(df.limit(0), outcomes, queries.RULES)) == []


def test_hosts_shrink(spark):
    seen = [("good.a.net", 1)] * 80 + [("bad.a.net", 0)] * 80 + [("rare.a.net", 0)] + [("new.a.net", None)]
    got = {r["host"]: r for r in hosts.reputation(spark.createDataFrame(seen, "host string, good int")).collect()}
    assert got["good.a.net"]["mean"] > got["new.a.net"]["mean"] > got["rare.a.net"]["mean"] > got["bad.a.net"]["mean"]
    assert got["good.a.net"]["bound"] > 0.9 > got["new.a.net"]["mean"] > got["new.a.net"]["bound"]
