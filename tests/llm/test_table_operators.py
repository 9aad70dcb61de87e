"""Sharding, mixing, pages and the pipeline."""

import collections
import time
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from brute import groups_by_brute_force, leaked_by_brute_force
from spanloom.llm import html, mixing, sharding, toxicity
from spanloom.llm.queries import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"


def test_shards_equal_sql_and_fit(spark):
    rng = random.Random(1)
    rows = [(i, "x" * rng.randrange(200), 7) for i in range(400)] + [(None, None, 1), (5, ""), (900, "y" * 5000, 2), (901, "dup", 3), (901, "dup", 4)]
    rows = [(*r, 0)[:3] for r in rows]
    table = spark.createDataFrame(rows, "doc_id long, text string, shard_id long")
    con = duckdb.connect()
    con.register("documents", table.select("doc_id", "text").toArrow())
    for limit in (10**9, 2000, 300):
        out = sharding.assign_shards(table, limit)
        assert out.columns == ["doc_id", "text", "shard_depth", "shard_prefix", "shard_id"]
        got = sorted((repr(r.doc_id), r.shard_id) for r in out.collect())
        want = sorted((repr(i), s) for i, s in con.sql(f"SELECT doc_id, shard_id FROM ({sharding.shard_sizes_sql(limit)})").fetchall())
        assert got == want
        for r in out.groupBy("shard_id").agg(F.sum(F.octet_length("text")).alias("b"), F.count("*").alias("n"), F.max("shard_depth").alias("d")).collect():
            assert (r.b or 0) <= limit or r.n == 1 and r.d == 60
    assert sharding.assign_shards(table.limit(0)).count() == 0
    named = table.withColumns({"__key": F.lit(5), "__shard_key": F.lit(6), "key": F.lit(7), "p": F.lit(8), "depth": F.lit(9)})
    assert {tuple(r) for r in sharding.assign_shards(named, 2000).select("__key", "__shard_key", "key", "p", "depth").collect()} == {(5, 6, 7, 8, 9)}


def targets_by_brute_force(sizes, weights, share, cap):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, full, out = share * sum(sizes.values()), set(), {}
    while True:
        open_ = [s for s in order if s not in full]
        unit = (left - sum(cap * sizes[s] for s in full)) / sum(w[s] for s in open_) if open_ else 0
        over = [s for s in open_ if unit * w[s] > cap * sizes[s]]
        if not over:
            return {s: cap * sizes[s] if s in full else unit * w[s] for s in order}
        full |= set(over)


@pytest.mark.parametrize("seed", range(3))
def test_mix_hits_targets(spark, seed):
    rng = random.Random(seed)
    sources = ["b", "a", "é", "Z", None, "tiny"]
    rows = [(i, " ".join("w" * 3 for _ in range(rng.randrange(1, 60))), rng.choices(sources, [50, 10, 10, 5, 5, 0.1])[0], 1) for i in range(1500)]
    rows += [(None, None, "a", 1), (7000, "", "b", 1), (7001, "same words", "a", 1), (7001, "same words", "a", 1)]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string, size long")
    out = mixing.mix(table).collect()
    sizes, taken, target = collections.Counter(), collections.Counter(), {}
    for r in out:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.copies * r.size
    want = targets_by_brute_force(dict(sizes), (3, 1, 2), 1.5, 2.0)
    assert len(out) == len(rows) and target == pytest.approx(want)
    assert all(abs(taken[s] - want[s]) <= 60 for s in want)
    again = {(r.doc_id, r.text): r.taken for r in mixing.mix(table.repartition(7)).collect()}
    assert all(again[r.doc_id, r.text] == r.taken for r in out if r.doc_id != 7001)
    copies = mixing.mixed_copies(table)
    assert copies.columns == table.columns and copies.count() == sum(r.copies for r in out)
    assert mixing.mix(table.limit(0)).count() == 0


def test_mix_by_a_size_column_with_many_repeats(spark):
    rows = [(None, "a", 7)] * 700 + [(3, None, 4)] * 90 + [(3, "\x00", 4)] * 90 + [(i, "b", i % 9) for i in range(300)]
    table = spark.createDataFrame(rows, "doc_id long, source string, words long").repartition(5)
    out = mixing.mix(table, size="words")
    assert out.columns == ["doc_id", "source", "words", "size", "source_size", "target", "copies", "taken"]
    out = out.collect()
    sizes, taken = collections.Counter(), collections.Counter()
    for r in out:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 2 * r.size
    want = targets_by_brute_force(dict(sizes), (3, 1, 2), 1.5, 2.0)
    assert len(out) == len(rows) and {r.source: r.target for r in out} == pytest.approx(want)
    assert all(abs(taken[s] - want[s]) <= 9 for s in want)
    assert sorted(collections.Counter((r.doc_id, r.source, r.words) for r in out).values())[-1] == 700


def test_mix_of_a_lazy_input_with_repeats_loses_no_row(spark):
    """Steps that see the input in other partitions, as AQE coalesces shuffles by the widths they carry."""
    conf = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "400k", "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false", "spark.sql.shuffle.partitions": "40"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        rows = spark.range(4000).selectExpr("id % 500 AS doc_id", "concat('word ', id % 500) AS text", "'one' AS source", "repeat(cast(id AS string), 200) AS wide", "id % 97 AS kk")
        lazy = rows.repartition("kk")
        out = mixing.mix(lazy).groupBy("doc_id").agg(F.count("*").alias("n"), F.sum("copies").alias("c"), F.count_distinct("wide").alias("w")).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(out) == 500 and {r.n for r in out} == {8} == {r.w for r in out} and sum(r.c for r in out) == 6000


def test_many_repeats_of_one_row(spark):
    rows = spark.range(20_000).selectExpr("7L AS doc_id", "'one' AS source", "3L AS size").unionByName(spark.range(900).selectExpr("id AS doc_id", "'two' AS source", "1L AS size"))
    out = mixing.mix(rows, size="size").groupBy("source").agg(F.count("*").alias("n"), F.sum("taken").alias("t"), F.first("target").alias("target"), F.max("copies").alias("most")).collect()
    assert {r.source: r.n for r in out} == {"one": 20_000, "two": 900} and all(abs(r.t - r.target) <= 3 and r.most <= 2 for r in out)


def test_pivot_keeps_words_and_odds():
    hits = collections.Counter()
    for trial in range(3000):
        rows = [(trial * 10 + i, s, p) for i, (s, p) in enumerate([(5, 0.3), (9, 0.6), (2, 0.5), (30, 0.25)])]
        done, held = mixing.pivot(rows)
        total = sum(s * done[i] for i, s, _ in rows if i in done) + (held[1] * held[2] if held else 0)
        assert total == pytest.approx(sum(s * p for _, s, p in rows))
        for i, _, _ in rows:
            hits[i % 10] += done[i] if i in done else held[2]
    assert [hits[k] / 3000 for k in range(4)] == pytest.approx([0.3, 0.6, 0.5, 0.25], abs=0.04)


def page(body, extra=""):
    return f"<!DOCTYPE html><html><head><title>T</title><script>var a='<p>no</p>';</script></head><body><nav><a href='/'>Home</a></nav>{body}<aside class='sidebar'><p>Side text that is rather long and goes on for some time, indeed.</p></aside>{extra}<footer>&copy; me</footer></body></html>"


def path_of(spelled):
    node = None
    for label in spelled.split("/"):
        node = html._Node("", node, label, False)
    return node.path


def test_pages(spark):
    article = "<div class='post-1 body'><h1>Title &amp; more</h1><p>One\n <b>bold</b>&nbsp;and <a href='#'>link</a><p>Two<br>lines<ul><li>x<li>y</ul><div class='ad'>Buy</div><form><p>Sign</p></form><section class='comments'><p>I disagree with all of this, long and loud, again and again.</p></section></div>"
    want = "Title & more\nOne bold and link\nTwo lines\nx\ny"
    rows = [(1, "http://a.b/1", page(article)), (2, "HTTP://A.b:80/2", page(article.replace("post-1", "post-22"))), (3, None, page("<article><p>Alone</p></article>")), (4, "http://c/", None), (5, "http://c/", ""), (None, "odd url", "plain &lt;text&gt;"), (1, "http://a.b/1", page(article))]
    table = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, text string")
    got = [(r.page_id, r.text, r.n_chars) for r in html.extract_pages(table).collect()]
    texts = [(i, t) for i, t, _ in got]
    assert sorted(map(repr, texts)) == sorted(map(repr, [(1, want), (2, want), (1, want), (3, "Alone"), (4, ""), (5, ""), (None, "plain <text>")]))
    assert all(n == len(t) for _, t, n in got)
    paths = {r.host: r.path for r in html.host_paths(table).collect()}
    assert paths["a.b"] == path_of("/html/body/div.body.post-")
    assert html.extract_pages(table.limit(0)).count() == 0


def test_consensus_overrules_one_page():
    main = "<div id='x' class='main-7'>" + "<p>word word word, word.</p>" * 4 + "</div>"
    odd = "<html><body>" + main + "<div class='other'>" + "<p>noise noise noise noise.</p>" * 5 + "</div></body></html>"
    own, path = html.extract(odd)
    voted, voted_path = html.extract(odd, path_of("/html/body/div.main-"))
    assert path == "/html/body/div.other" and voted_path == "/html/body/div.main-" and "word" in voted and "noise" in own
    assert html.extract(odd, path_of("/html/body/section.gone"))[1] == path


def test_sections_and_leads_are_kept(spark):
    def body(word, n=9):
        return "<div class='body'>" + f"<p>{word} word word, word.</p>" * n + "</div>"

    links = "<div class='more'><ul>" + "<li><a href='/'>linked linked</a></li>" * 3 + "</ul></div>"
    lead, tail = "<div class='lead'><p>The lead.</p></div>", "<div class='tail'><p>The last section.</p></div>"
    ones = [(i, "http://a/", page(f"<div class='wrap'>{body(f'one{i}')}</div>")) for i in range(5)]
    sides = [(20 + i, "http://b/", page(f"{lead}{body('first')}{tail}{links}")) for i in range(5)]
    rows = [*ones, (10, "http://a/", page(f"<div class='wrap'>{body('first')}{body('second', 8)}</div>")), (11, "http://a/", page(f"<div class='wrap'>{lead}{body('first')}{tail}{links}</div>")), *sides]
    rows += [(30, "http://b/", page(f"{lead.replace('The lead.', 'The longest lead. ' * 20)}{body('first')}")), (31, "http://b/", page(f"<div class='odd'>{'<p>noise noise noise.</p>' * 12}</div>{body('first')}"))]
    got = {r.page_id: r.text for r in html.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    first = "\n".join(["first word word, word."] * 9)
    assert got[0] == first.replace("first", "one0")
    assert got[10] == first + "\nsecond word word, word." * 8
    assert got[11] == got[20] == f"The lead.\n{first}\nThe last section."
    assert got[30] == " ".join(["The longest lead."] * 20) + "\n" + first and got[31] == first
    inner = f"<main>{body('first', 4)}<article>{body('first', 5)}</article></main>"
    assert html.extract(inner, path_of("/main/article")) == (first, "/main")
    twice = f"<article>{body('first')}</article><article>{body('second', 2)}</article>"
    assert html.extract(twice)[0] == first + "\nsecond word word, word." * 2


@pytest.mark.parametrize(
    "wrapper",
    ["div class='page has-sidebar'", "div class='content with-nav'", "section class='post share-enabled comments-open'", "div id='noSidebar'", "div class='widget layout'", "div class='sidebar-right'", "div class='wrap' id='search'"],
)
def test_words_of_wrappers(wrapper):
    story = "<h1>Title</h1>" + "<p>word word word, word.</p>" * 9
    aside = "<div class='sidebar'><p>Side text.</p></div><div class='related'><article><p>Another story.</p></article></div><div class='comments'><article class='comment'><p>I see.</p></article></div>"
    want, end = "Title" + "\nword word word, word." * 9, wrapper.split()[0]
    for inner in (story, f"<article>{story}</article>", f"<main>{story}</main>", f"<div role='main'>{story}</div>"):
        for text in (f"<{wrapper}>{inner}{aside}</{end}>", f"<{wrapper}>{inner}</{end}>{aside}"):
            if inner is story:  # no other article
                text = text.replace("<article>", "").replace("</article>", "")
            assert html.extract(page(text))[0] == want
    few = f"<div class='with-teaser'>{'<p>Much of another kind.</p>' * 30}</div>"
    assert html.extract(page(f"<{wrapper}><article>{story}</article></{end}>{few}"))[0].startswith(want)  # around less than most of the text


def test_words_that_hold():
    story, thread = "<p>word word word, word.</p>" * 4, "<p>I disagree with all of this, at length.</p>" * 9
    for text in (f"<div class='post'>{story}</div><div id='comments'><article>{thread}</article></div>", f"<article>{story}</article><div class='related'><article>{thread[:60]}</article></div>"):
        assert html.extract(page(text))[0] == "\n".join(["word word word, word."] * 4)
    assert html.extract(f"<div class='comments'>{thread}</div>")[0].count("disagree") == 9  # nothing else


def test_words_inside_an_article():
    body = "<p>Before it.</p><h2 id='discussion'>Discussion</h2><p class='alert'>Alarming.</p><section id='related-work'><p>Others did this.</p></section><section id='responses'><p>We answer.</p></section><h3 class='share'>Sharing</h3>"
    noise = "<div id='comments'><p>I see.</p></div><div class='alert'><p>Cookies!</p></div><div id='related-posts'><p>More</p></div><p class='advert'>Buy</p><div class='search'><p>Find</p></div>"
    assert html.extract(page(f"<article>{body}{noise}</article>"))[0] == "Before it.\nDiscussion\nAlarming.\nOthers did this.\nWe answer.\nSharing"


@pytest.mark.parametrize(
    "text",
    ["<a " * 350_000, '<script "' * 120_000, "<a \"" * 250_000 + ">", "<!--" * 250_000, "</" * 500_000, "<div>" * 100_000 + "deep" + "</div>" * 100_000, "<div><p>word</p>" * 60_000, "<article class=comment>x" * 40_000, "<b>" * 300_000 + "</i>" * 300_000, "<td>" * 100_000 + "</p>" * 100_000, "<div id='x' class='a b c'>" + "<section>text here" * 50_000],
    ids=range(11),
)
def test_time_grows_with_length(text):
    start = time.process_time()
    html.extract(text, b"x")
    assert time.process_time() - start < 15


def test_ties_of_votes(spark):
    one, two = "<div class='a'><p>word word word</p></div>", "<div class='b'><p>word word word</p></div>"
    rows = [(i, "http://t/", f"<html><body>{(one, two)[i % 2]}</body></html>") for i in range(6)]
    for order in (rows, rows[::-1]):
        got = html.host_paths(spark.createDataFrame(order, "page_id long, url string, html string")).collect()
        assert [(r.host, r.votes, r.path) for r in got] == [("t", 3, max(path_of("/html/body/div.a"), path_of("/html/body/div.b")))]


def test_unclosed_and_hostile_markup():
    assert html.extract("<p>" * 3000 + "deep" + "<div>" * 3000 + "deeper")[0].split("\n")[-1] in ("deep", "deeper")
    assert html.extract("<article><p>a < b and c > d<!-- open <p>lost")[0].startswith("a < b")
    assert html.extract("<script>never closed <p>x")[0] == ""
    assert html.extract("<article><p>" + "long " * 100_000)[0].count("long") == 100_000


def test_pipeline_stages_equal_brute_force(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "decontamination", "mixing", "sharding"]
    documents, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    model = toxicity.fit(documents.where(~toxicity.held_out(F.col("doc_id"))), labels)
    scores = {r.doc_id: r.score for r in toxicity.score(documents, model).collect()}
    out = documents
    for name, stage in corpus_pipeline.STAGES:
        before = [r.asDict() for r in out.collect()]
        out = stage(spark, out, SMALL).cache()
        after = [r.asDict() for r in out.collect()]
        ids = sorted(r["doc_id"] for r in after)
        if name != "sharding":
            assert out.columns == documents.columns
        if name == "toxicity":
            assert ids == sorted(r["doc_id"] for r in before if scores[r["doc_id"]] < 0.5)
        elif name == "near_dedup":
            groups = groups_by_brute_force([(r["doc_id"], r["text"]) for r in before], 5, 80)
            assert ids == sorted(i for i, g in groups.items() if i == g) and len(ids) < len(before)
        elif name == "decontamination":
            assert ids == sorted(r["doc_id"] for r in before if not leaked_by_brute_force(r["text"], bench)) and len(ids) < len(before)
        elif name == "mixing":
            size = {r["doc_id"]: len([w for w in re.split(r"[\x20\x09-\x0D]+", r["text"]) if w]) for r in before}
            by_source, taken = collections.Counter(), collections.Counter()
            for r in before:
                by_source[r["source"]] += size[r["doc_id"]]
            for r in after:
                taken[r["source"]] += size[r["doc_id"]]
            want = targets_by_brute_force(dict(by_source), (3, 1, 2), 1.5, 2.0)
            largest = max(size.values())
            assert all(abs(taken[s] - want[s]) <= largest for s in want) and max(collections.Counter(ids).values()) <= 2
        else:
            assert ids == sorted(r["doc_id"] for r in before)
    rows = corpus_pipeline.run(spark, SMALL)
    assert sorted(map(repr, rows.select("doc_id", "shard_id").collect())) == sorted(map(repr, out.select("doc_id", "shard_id").collect()))
    assert corpus_pipeline.ORACLE_SQL is None


def test_pipeline_stages_take_odd_tables(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, size long, __k long, shard_id string, key string"
    odd = [(None, None, None, None, None, 1, 2, "own", "k"), (None, "two words", None, None, 9, 1, 2, "own", None), (5, "", "en", "s", 0, 1, 2, None, "k")]
    odd += [(6, "some five words stand here", "en", None, 26, 3, 4, "own", "k")] * 3 + [(7, "word " * 30_000, "en", "s", None, None, None, None, None)]
    table = spark.createDataFrame(odd, schema)
    for docs in (table, table.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SMALL)
            rows = sorted(map(repr, (tuple(r)[:7] for r in out.select(*docs.columns).collect())))
            want = sorted(map(repr, (tuple(r)[:7] for r in docs.collect())))
            if name == "mixing":  # texts without words go; the others stay as often as the mix takes them
                assert set(rows) <= set(want) and out.columns == docs.columns and not any("''" in r for r in rows)
            else:
                assert rows == want and (name == "sharding" or out.columns == docs.columns)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    got, want = QUERIES[name](spark, SMALL).toPandas(), con.sql(ORACLES[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    assert sorted(map(repr, got[columns].itertuples(index=False, name=None))) == sorted(map(repr, want[columns].itertuples(index=False, name=None)))


_LONG = "<p>A long paragraph of an article that goes on for a while and says a lot of things, indeed.</p>" * 3


def main_text(body):
    return html.extract(f"<html><body>{body}</body></html>")[0]


def test_forms_and_headers_of_pages():
    """A form around the page is no form of it; headers of the page go, those of the article stay."""
    assert main_text(f"<form action='/'>{_LONG}</form>").count("A long paragraph") == 3
    assert "Sign up" not in main_text(f"<form><article>{_LONG}<form><p>Sign up</p></form></article></form>")
    for header in ("<header>Site</header>", "<div id='header'>Site</div>", "<div class='site-header'>Site</div>"):
        assert "Site" not in main_text(f"{header}<div>{_LONG}</div>")
    assert main_text(f"<article><header><h1>Title</h1></header>{_LONG}</article>").startswith("Title\n")
    assert main_text(f"<div><div class='post-header'><p>By me</p></div>{_LONG}</div>").startswith("By me\n")


def test_words_of_classes():
    """A word that goes on with another, or a box of links that holds none, is the article's own."""
    box = lambda c: main_text(f"<article>{_LONG}<div class='{c}'><p>Text of its own.</p></div></article>")
    assert all("Text of" in box(c) for c in ("share-price", "social-history", "ad-hoc", "comments-on-law", "sponsor-countries"))
    assert not any("Text of" in box(c) for c in ("ad", "ad-slot", "ad-300x250", "sidebar-primary", "share-buttons", "related-posts", "comments-list", "ad__wrapper", "newsletter", "cookie-notice"))
    assert "kept" in main_text(f"<div>{_LONG}<section class='related'>{_LONG.replace('A long', 'kept')}</section></div>")
    assert "away" not in main_text(f"<div>{_LONG}<section class='related'><p><a href='/x'>away to other places and so on</a></p></section></div>")
