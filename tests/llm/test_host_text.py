"""Page extraction against a plain reading of the layouts, and the suffix array against all sequences."""

import re
from collections import Counter, defaultdict
from html import unescape

import pytest
from pyspark.sql import functions as F

from millrace.llm import host_text

BODY = "Words of the story go on &amp; on, with <a href='/x'>links</a> and <b>bold <i>type</i></b>."


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("plain words only", "plain words only"),
        (f"<nav>Home</nav><article><h1>Title</h1><p>{BODY}</article><footer>&copy; x</footer>", "Title Words of the story go on & on, with links and bold type."),
        ("<article><p>one<br>two<p>three<div class=ad>buy</div><aside>see</aside><p>four</article>", "one two three four"),
        ("<article><header><div>by me</div><h1>Head</h1></header>a<form>b</form><section class='comments'><article class=comment>c</article></section>d</article>", "Head a d"),
        ("<body><div id='sidebar'>x</div><main><p>kept</p><ul class='share-links'><li>y</ul></main><div>not kept</div>", "kept"),
        ("<form><div class='widget'><article>in a form</article></div></form>", "in a form"),
        ("<div class='with-sidebar no-comments'><article>a<script>var t='</p>';</script>b<style>p{}</style>c<!-- d -->e</article>", "abce"),
        ("<article>a &lt;b&gt; &#233;&nbsp;&#x1F600; x &unknown; 1<2 & 3</article>", "a <b> é 😀 x &unknown; 1<2 & 3"),
        ("<article>cut off <b>here <a hre", "cut off here"),
        ("<article title='a>b'>t<img alt='>'>u</article>", "tu"),
        ("<article><p>a</div><p>b</nav></p>c</article><p>out", "a b c"),
        ("<div hidden>a</div><div style='display: none'>b</div><div role=navigation>c</div><p>d", "d"),
        ("<table><tr><td>a<td>b<tr><td>c</table>", "a b c"),
        ("<article><ul><li>a<li>b<ul><li>c</ul><li class=ad>d<li>e</ul></article>", "a b c e"),
        ("<p>x" * 3000, " ".join("x" * 3000)),
    ],
)
def test_page(page, text):
    assert host_text.main_text(page or "", set()) == (text, 0)


def test_quotes_that_never_close_take_no_time():
    assert host_text.blocks_of("y" + '<a b="' * 3001 + "x") == [(host_text.UNMARKED, "y")]
    assert len(host_text.blocks_of("<" * 100_000)) == 1


def plain_sequences(streams, least, run):
    on = defaultdict(set)
    for i, s in enumerate(streams):
        for j in range(len(s) - run + 1):
            on[" ".join(s[j : j + run])].add(i)
    return sorted(x for x, pages in on.items() if len(pages) >= least)


@pytest.mark.parametrize("run", [1, 2, 3, 5, 6, 7, 8])
def test_suffix_array(run):
    import random

    draw = random.Random(run)
    streams = [[draw.choice("abc") for _ in range(draw.choice([0, 1, 5, 40]))] for _ in range(12)] + [list("abcabcabcabc")] * 3
    for least in (1, 2, 4):
        assert sorted(host_text.frequent_sequences(streams, least, run)) == plain_sequences(streams, least, run)
    assert host_text.frequent_sequences([], 1, run) == [] and host_text.frequent_sequences([[]], 1, run) == []


def site(n, host, menu="Home News Sport Weather About us Contact us"):
    """Pages without an article: an unmarked menu, a notice, a unique text, and a passage that only two pages share."""
    out = []
    for i in range(n):
        text = " ".join(f"word{i}x{j}" for j in range(30)) + (" passage shared by two pages of this one host" if i < 2 else "")
        out.append((f"http://{host}/{i}", f"<div><p>{menu}</p><p>We use small files to make this site work</p><p>{text}</p></div>", text))
    return out


def extracted(spark, pages, **more):
    frame = spark.createDataFrame([(i, u, h, "t", "n") for i, (u, h) in enumerate(pages)], "page_id long, url string, html string, text string, host string").repartition(3)
    out = host_text.extract(frame, **more)
    assert out.columns == ["page_id", "url", "html", "host", "text", "n_chars", "n_repeated"]
    return {r["page_id"]: r for r in out.collect()}


@pytest.mark.parametrize(("group", "most"), [(4096, 250_000), (7, 250_000), (2, 0)])
def test_repeated_runs_go(spark, monkeypatch, group, most):
    """Also where the host's pages are dealt into groups: then they are counted over all of them."""
    monkeypatch.setattr(host_text, "GROUP", group)
    monkeypatch.setattr(host_text, "BROADCAST_SEQUENCES", most)
    pages = site(30, "a.org") + site(2, "b.org", "Start Aktuelles Sport Wetter Impressum Kontakt")
    got = extracted(spark, [(u, h) for u, h, _ in pages])
    for i, (_, h, text) in enumerate(pages):
        want = text if i < 30 else " ".join(re.sub("<[^>]*>", " ", h).split())
        assert got[i]["text"] == want and got[i]["n_chars"] == len(want), i
        assert got[i]["n_repeated"] == (17 if i < 30 else 0)


def test_copies_and_declared_articles_stay(spark):
    """A page whose unmarked blocks are all on other pages is a copy; what stands in an article stays, shared or not."""
    copy = "<p>" + " ".join(f"c{j}" for j in range(20)) + "</p>"
    shared = "<article><p>" + " ".join(f"s{j}" for j in range(60)) + "</p></article><p>one two three four five six seven</p>"
    got = extracted(spark, [("http://x.net/1", copy)] * 4 + [("http://y.net/1", shared)] * 4)
    assert {r["text"] for i, r in got.items() if i < 4} == {" ".join(f"c{j}" for j in range(20))}
    assert {(r["text"], r["n_repeated"]) for i, r in got.items() if i >= 4} == {(" ".join(f"s{j}" for j in range(60)), 7)}


def test_odd_pages(spark):
    rows = [(None, None), (None, "<p>a"), ("no host", "<p>b"), ("http://h/x", None), ("http://h/x", ""), ("http://h/x", "<p>" + "long word " * 20000), ("http://h/x", "<article>" * 2000 + "deep")]
    got = extracted(spark, rows + rows[:3])
    assert [got[i]["text"] for i in (0, 1, 2, 3, 4, 6)] == ["", "a", "b", "", "", "deep"]
    assert got[5]["text"] == ("long word " * 20000).strip()
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert host_text.extract(empty).count() == 0


def test_given_pages(spark, sf_dir):
    """The text of a given page is what stands between its article tags, read plainly."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    block = "p|h1|br|div"
    for r in host_text.extract(pages).select("html", "text", "n_chars").collect():
        inner = re.search(r"(?s)<article>(.*)</article>", r["html"])[1]
        want = " ".join(unescape(re.sub(r"<[^>]*>", "", re.sub(rf"</?(?:{block})\b[^>]*>", " ", inner))).split())
        assert (r["text"], r["n_chars"]) == (want, len(want))


def test_support_over_groups_equals_one_group(spark, sf_dir, monkeypatch):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").withColumn("html", F.regexp_replace("html", "</?article>", ""))
    pages = pages.withColumn("url", F.concat(F.lit("http://one.org/"), F.col("page_id")))
    whole = Counter((r["text"], r["n_repeated"]) for r in host_text.extract(pages).collect())
    monkeypatch.setattr(host_text, "GROUP", 9)
    assert whole == Counter((r["text"], r["n_repeated"]) for r in host_text.extract(pages).collect())
