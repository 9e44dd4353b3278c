"""Personal data: fixed patterns, and terms that reveal it by what the corpus says.

Patterns give the base spans. A document that has a base span of a kind mentions
a protected entity c of that kind. A term t of such a document discloses c by
its pointwise mutual information, PMI(t; c) = log p(c|t) / p(c), against the
information of the entity itself, IC(c) = -log p(c): the degree PMI / IC is 1 if
t never occurs without c. p(c|t) is the share of t's documents that have c,
estimated with a prior of PRIOR documents at p(c), so that rare terms prove
nothing. From GENERALISE on a term is generalised, from REMOVE on it is removed.

Everything is a DataFrame expression. Counts of terms cover all documents; texts
with a base span are staged once, and only those are looked at for terms.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.session import staged

#: Fixed values of the base patterns. Possessive forms match the same text as the greedy ones
#: and need no stack; looking back keeps a search from starting inside a run that has failed.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9]++(?:[\x20-][0-9]++)*+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone")
PATTERNS = (EMAIL, IP, CARD, PHONE)
MORE_KINDS = ("generalise", "remove")
#: Degrees of disclosure, and the weight of the prior in documents.
GENERALISE, REMOVE, PRIOR = 0.6, 0.8, 20.0
#: Disclosing terms up to which their table is sent to all tasks; beyond, Spark joins it by exchange.
BROADCAST_TERMS = 100_000
_NO_WORD = r"[^\p{L}\p{N}]+"


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, r"[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i + 1, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 1, d).otherwise(d * 2 - F.when(d > 4, 9).otherwise(0))

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _valid(kind: str, x: Column) -> Column:
    if kind == "ip":
        part = "0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9][0-9]?)?"
        return x.rlike(rf"^{part}\.{part}\.{part}\.{part}$")
    if kind == "card":
        digits = _digits(x)
        return F.when(F.length(digits).between(14, 19), _luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(_digits(x)).between(10, 15)
    return F.lit(True)


def _found(text: Column, kind: str, pattern: str) -> Column:
    """All matches of a kind that hold."""
    return F.filter(F.regexp_extract_all(text, F.lit(pattern), 0), lambda x: _valid(kind, x))


def _flags(text: Column) -> list[Column]:
    """Whether a text has a base span, by kind."""
    return [F.size(_found(text, k, p)) > 0 for k, p in zip(KINDS, PATTERNS, strict=True)]


def _pieces(text: Column, number: int, matches: Column, gaps: Column, kind: str | None) -> Column:
    """Per match: kind's number, place, characters between it and the match before, its characters, whether it holds."""
    both = F.zip_with(gaps, matches, lambda gap, x: F.struct(F.length(gap).alias("gap"), F.length(x).alias("size"), (_valid(kind, x) if kind else F.lit(True)).alias("ok")))
    numbered = F.transform(both, lambda s, i: F.struct(F.lit(number).alias("kind"), i.alias("i"), s["gap"].alias("gap"), s["size"].alias("size"), s["ok"].alias("ok")))
    return F.filter(numbered, lambda s: s["size"].isNotNull())


def _terms(text: Column, flag: Column) -> Column:
    """Distinct lower-case words of a text without what its base patterns match."""
    masked = text
    for p in PATTERNS:
        masked = F.regexp_replace(masked, p, " ")
    words = F.split(F.lower(F.when(flag, masked).otherwise(text)), _NO_WORD)
    return F.array_distinct(F.filter(words, lambda w: F.length(w) > 1))


def disclosing(docs: DataFrame, marked: DataFrame, n: int, with_kind: list[int]) -> DataFrame:
    """``term``, ``kind`` (number), ``degree`` of all terms from GENERALISE on.

    ``docs``: ``terms``; ``marked``: ``terms`` and the flags. A term is one row for each task
    before the exchange. Terms that could not reach GENERALISE even if all their
    documents had the entity are left out before the join; that changes no result.
    """
    counts = docs.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    sums = [F.sum(F.col(f"f{i}").cast("long")).alias(f"n{i}") for i in range(len(KINDS))]
    joint = marked.select(F.explode("terms").alias("term"), *[f"f{i}" for i in range(len(KINDS))]).groupBy("term").agg(*sums)
    own = F.posexplode(F.array(*[F.col(f"n{i}") for i in range(len(KINDS))])).alias("kind", "joint")
    share = F.element_at(F.array(*[F.lit(w / n if n else 0.0) for w in with_kind]), F.col("kind") + 1)
    joint = joint.select("term", own).withColumn("share", share).filter("joint > 0 and share < 1")

    def degree(documents: Column) -> Column:
        return F.log((F.col("joint") + PRIOR * F.col("share")) / (documents + PRIOR) / F.col("share")) / -F.log("share")

    joint = joint.filter(degree(F.col("joint")) >= GENERALISE)
    return joint.join(counts, "term").withColumn("degree", degree(F.col("n"))).filter(F.col("degree") >= GENERALISE).select("term", "kind", "degree")


def _marked(df: DataFrame, key: str, text: str, everywhere: bool) -> tuple[DataFrame, DataFrame]:
    """Documents without a base span (``key``) and, staged, those with one: ``__row``, key, text, flags; ``everywhere``: all are among the latter."""
    value = F.coalesce(F.col(text).cast("string"), F.lit(""))
    source = df.select(F.col(key).alias("__id"), value.alias("__text"))
    flags = _flags(F.col("__text"))
    some = flags[0] | flags[1] | flags[2] | flags[3]
    if everywhere:
        some = F.lit(True)
    with_spans = source.filter(some).select("__id", "__text", *[f.alias(f"f{i}") for i, f in enumerate(flags)], F.monotonically_increasing_id().alias("__row"))
    return source.filter(~some).select("__id"), staged(with_spans, "protected")


def _all_spans(df: DataFrame, marked: DataFrame, text: str, everywhere: bool) -> DataFrame:
    """``__row``, ``kind`` (number), ``start``, ``end`` of all spans of the marked documents; one exchange by document.

    A term counts where its document has a base span of the kind that it discloses, or ``everywhere``.
    """
    value = F.coalesce(F.col(text).cast("string"), F.lit(""))
    some = F.col("f0") | F.col("f1") | F.col("f2") | F.col("f3")
    flags = _flags(F.col("__text"))
    docs = df.select(value.alias("__text")).select(_terms(F.col("__text"), flags[0] | flags[1] | flags[2] | flags[3]).alias("terms"))
    own = marked.select("__row", *[f"f{i}" for i in range(len(KINDS))], _terms(F.col("__text"), some).alias("terms"))
    n = df.count()
    with_kind = [x or 0 for x in marked.agg(*[F.sum(F.col(f"f{i}").cast("long")) for i in range(len(KINDS))]).first()]
    known = staged(disclosing(docs, own.filter(some) if everywhere else own, n, with_kind), "terms")
    hint = F.broadcast(known) if known.limit(BROADCAST_TERMS + 1).count() <= BROADCAST_TERMS else known
    here = own.select("__row", F.array(*[F.col(f"f{i}") for i in range(len(KINDS))]).alias("flags"), F.explode("terms").alias("term")).join(hint, "term")
    here = here if everywhere else here.filter("flags[kind]")
    worst = here.groupBy("__row", "term").agg(F.max("degree").alias("degree"))
    lists = worst.groupBy("__row").agg(*[F.concat_ws("|", F.sort_array(F.collect_list(F.when(c, F.col("term"))))).alias(a) for a, c in (("g", F.col("degree") < REMOVE), ("r", F.col("degree") >= REMOVE))])
    joined = marked.join(lists, "__row", "left")
    pieces = [_pieces(F.col("__text"), i, F.regexp_extract_all("__text", F.lit(p), 0), F.split("__text", p, -1), k) for i, (k, p) in enumerate(zip(KINDS, PATTERNS, strict=True))]
    for i, name in enumerate(("g", "r")):
        pattern = F.concat(F.lit(r"(?iu)(?<![\p{L}\p{N}])(?:"), F.col(name), F.lit(r")(?![\p{L}\p{N}])"))
        more = _pieces(F.col("__text"), len(KINDS) + i, F.regexp_extract_all("__text", pattern, 0), F.split("__text", pattern, -1), None)
        pieces.append(F.when(F.length(name) > 0, more))
    empty = F.array().cast("array<struct<kind:int,i:int,gap:int,size:int,ok:boolean>>")
    rows = joined.select("__row", F.explode(F.concat(*[F.coalesce(p, empty) for p in pieces])).alias("s")).select("__row", "s.*").repartition("__row")
    before = Window.partitionBy("__row", "kind").orderBy("i")
    rows = rows.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(before)).withColumn("start", F.col("end") - F.col("size")).filter("ok")
    base = F.col("kind") < len(KINDS)
    by_place = Window.partitionBy("__row").orderBy("start", "kind")
    rows = rows.withColumn("to", F.max(F.when(base, F.col("end"))).over(by_place.rowsBetween(Window.unboundedPreceding, -1)))
    rows = rows.withColumn("next", F.min(F.when(base, F.col("start"))).over(by_place.rowsBetween(1, Window.unboundedFollowing)))
    apart = (F.coalesce("to", F.lit(0)) <= F.col("start")) & (F.col("next").isNull() | (F.col("next") >= F.col("end")))
    rows = rows.filter(base | apart).select("__row", "kind", "start", "end")
    return rows.withColumn("done", F.coalesce(F.max("end").over(by_place.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))


def _count(kind: int) -> Column:
    return F.size(F.filter("all", lambda s: s["kind"] == kind))


def _written(spans: Column, kinds: int) -> Column:
    names = F.array(*[F.lit(k) for k in (*KINDS, *MORE_KINDS)])
    own = F.filter(spans, lambda s: s["kind"] < kinds)
    return F.array_join(F.transform(own, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")


def personal_data(df: DataFrame, key: str = "doc_id", text: str = "text", sanitised: bool = False, everywhere: bool = False) -> DataFrame:
    """One row for every document: ``key``, ``n_email``, ``n_ip``, ``n_card``, ``n_phone``, ``base_sha256``, ``spans``; ``sanitised``: also the text without them.

    Positions are code points, ends exclusive; spans are in the order of start, then kind. In the
    sanitised text a base span becomes its kind in brackets, a generalised term ``[term]``, and a removed
    term nothing. Terms are looked for in documents with a base span of the kind that they disclose; ``everywhere``: in
    all documents, also where a term stands alone. Null and empty texts have no spans, repeated rows repeat, an empty table stays empty, extra columns play no part.
    """
    clean, marked = _marked(df, key, text, everywhere)
    spans = _all_spans(df, marked, text, everywhere)
    grouped = spans.groupBy("__row").agg(F.sort_array(F.collect_list(F.struct("start", "kind", "end", "done"))).alias("all"))
    full = marked.select("__row", "__id", *(["__text"] if sanitised else [])).join(grouped, "__row", "left" if everywhere else "inner")
    if everywhere:
        full = full.withColumn("all", F.coalesce("all", F.array().cast(grouped.schema["all"].dataType)))
    counts = [_count(i).cast("long").alias(f"n_{k}") for i, k in enumerate(KINDS)]
    result = [F.col("__id").alias(key), *counts, F.sha2(_written(F.col("all"), len(KINDS)), 256).alias("base_sha256"), _written(F.col("all"), len(KINDS) + 2).alias("spans")]
    nothing = [F.col("__id").alias(key), *[F.lit(0).cast("long").alias(f"n_{k}") for k in KINDS], F.sha2(F.lit(""), 256).alias("base_sha256"), F.lit("").alias("spans")]
    if sanitised:
        result.append(_cleaned().alias("sanitised"))
    if everywhere:
        return full.select(result)
    if sanitised:
        return full.select(result).unionByName(_whole(df, key, text).select(*nothing, F.col("__text").alias("sanitised")))
    return full.select(result).unionByName(clean.select(nothing))


def _whole(df: DataFrame, key: str, text: str) -> DataFrame:
    value = F.coalesce(F.col(text).cast("string"), F.lit(""))
    flags = _flags(F.col("__text"))
    return df.select(F.col(key).alias("__id"), value.alias("__text")).filter(~(flags[0] | flags[1] | flags[2] | flags[3]))


def _cleaned() -> Column:
    """The text with its spans replaced; of spans that overlap the first is replaced, and what the others have beyond it is dropped."""
    tags = F.array(*[F.lit(f"[{k}]") for k in KINDS], F.lit("[term]"), F.lit(""))
    text, spans = F.col("__text"), F.col("all")

    def piece(s: Column) -> Column:
        gap = F.greatest(s["start"] - s["done"], F.lit(0))
        return F.concat(F.substring(text, (s["done"] + 1).cast("int"), gap.cast("int")), F.when(s["start"] >= s["done"], F.element_at(tags, s["kind"] + 1)).otherwise(F.lit("")))

    end = F.coalesce(F.array_max(F.transform(spans, lambda s: s["end"])), F.lit(0).cast("long"))
    rest = F.substring(text, (end + 1).cast("int"), F.length(text))
    return F.concat(F.array_join(F.transform(spans, piece), ""), rest)
