"""Page, URL and conversation operators, the pipeline, and the subpackage's isolation."""

import re
from html import unescape
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from riskwise.llm import chat_format, html_extract, queries, url_filter

SF = "/root/testdata/sf0.001"
ROOT = Path(__file__).resolve().parents[2]


def article_text(html):
    """Brute force for the test pages: the blocks between <article> and its end."""
    a, b = html.find("<article>") + 9, html.find("</article>")
    x = re.sub(r"<(?:br|/?b)>", " ", html[a:b if b >= 0 else len(html)])
    return "\n\n".join(t for q in re.split(r"</?(?:p|h1)>", x) if (t := " ".join(unescape(re.sub(r"<[^>]*>", "", q)).split())))


def test_extraction_matches_articles(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    html = {r["page_id"]: r["html"] for r in pages.collect()}
    got = queries.op1_html_extract(spark, SF).collect()
    assert len(got) == len(html)
    assert sum(r["text"] != article_text(html[r["page_id"]]) for r in got) == 0
    assert all(r["n_chars"] == len(r["text"]) for r in got)


BOILER = {
    "header": '<header class="page-header"><a href="/">Home</a> <span>Site name here</span></header>',
    "cookie": '<div class="cookie-banner"><p>We use cookies to improve your visit to these pages.</p><button>OK</button></div>',
    "side": '<aside class="sidebar"><h3>Latest</h3><ul><li><a href="/x">One story</a></li><li><a href="/y">Other story</a></li></ul></aside>',
    "form": '<form action="/s"><label>Search</label><input name="q"><p>Send us your mail address today.</p></form>',
    "comments": '<div id="comments"><h2>Comments</h2><div class="comment"><p>I liked reading this a lot, thanks.</p></div></div>',
}


def page(*, head=(), tail=(), wrap=("<article>", "</article>")):
    body = "".join(f"<p>Sentence {i} of the main text, which is long enough to count &amp; reads <b>well</b>\n  enough.</p>"
                   for i in range(8))
    return ("<!DOCTYPE html><html><head><title>T</title><script>var a='<p>no</p>';</script></head><body><nav><ul><li>"
            "<a href='/a'>Menu entry</a></li></ul></nav>" + "".join(BOILER[b] for b in head) + wrap[0] + "<h1>Title line</h1>"
            + body + wrap[1] + "".join(BOILER[b] for b in tail) + "<footer>&copy; Owner of this site</footer></body></html>")


WANT = "\n\n".join(["Title line"] + [
    f"Sentence {i} of the main text, which is long enough to count & reads well enough." for i in range(8)])


@pytest.fixture(scope="module")
def trees(spark):
    return html_extract.fit_trees(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"))


@pytest.mark.parametrize("source", [
    page(), page(head=["header", "cookie"]), page(tail=["side", "comments"]), page(head=["form"], tail=["comments"]),
    page(head=["cookie"], tail=["side"], wrap=('<div class="content">', "</div>")),
    page(head=["header"], tail=["comments"], wrap=('<main>', "</main>"))])
def test_furniture_is_dropped(trees, source):
    assert html_extract.extract_many([source], trees) == [WANT]


def test_decoding_allows_no_kept_node_below_a_rejected_one(trees):
    p = html_extract.Page(page(head=["cookie"], tail=["comments"]))
    keep = html_extract.decode(p, trees.margin(html_extract.node_features(p)))
    assert all(keep[p.parent[i]] or not keep[i] for i in range(1, len(p.tag)))


def test_copies_of_a_page_do_not_fill_the_training_sample(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("html")
    first = pages.orderBy(F.xxhash64("html")).limit(1)
    copies = pages.unionByName(first.crossJoin(spark.range(50)).select("html"))

    def rows(p):
        return sorted((r["label"], tuple(r["features"])) for r in html_extract.training_rows(p, "html", 5).collect())

    assert rows(copies) == rows(pages) and len(rows(pages)) > 0


def test_extraction_edges(spark, trees):
    assert html_extract.extract_many([None, "", "<p", "</p></div>", "<!-- x"], trees)[:2] == ["", ""]
    deep = "<div>" * 3000 + "x" + "</div>" * 3000
    assert len(html_extract.extract_many([deep, "<p>a" * 20_000, '<a href="x>' * 50, "&#0;&bogus;&lt;b"], trees)) == 4
    df = spark.createDataFrame([(1, None, "t", 5), (2, "", "t", 5), (None, "<p>Plain &eacute;&nbsp;x<br>y</p>", "t", 5)],
                               "page_id long, html string, text string, n_chars int")
    out = html_extract.extract_main_text(df)          # nothing to learn from: all visible text
    assert out.columns == ["page_id", "n_chars", "text"]
    assert sorted(r["text"] for r in out.collect()) == ["", "", "Plain é x y"]
    assert html_extract.extract_main_text(df.limit(0)).count() == 0


def test_url_parts_and_rules(spark):
    urls = {"HTTP://Www.Example.COM/en/x?q#f": ("www.example.com", "/en/x", "www.example.com/en/", "allow"),
            "http://m.example.com/en/": ("m.example.com", "/en/", "example.com/en/", "block"),
            "http://badexample.com/en/": ("badexample.com", "/en/", "com/", "allow"),
            "x://a.net/es/1": ("a.net", "/es/1", "net/es/", "block"), "x://net/fr/": ("net", "/fr/", "net/fr/", "block"),
            "x://a.com": ("a.com", "", None, "allow"), "x://a.com:80/": ("a.com:80", "/", None, "allow"),
            "no scheme": ("", "", None, "allow"), "": ("", "", None, "allow"), None: ("", "", None, "allow"),
            "x://": ("", "", None, "allow"), "a://b?c://d/e": ("b", "", None, "allow"),
            "x://listed.org/p.html?z": ("listed.org", "/p.html", None, "block"),
            "x://www.listed.org/p/": ("www.listed.org", "/p/", None, "block"), "x://listed.org/p2": ("listed.org", "/p2", None, "allow")}
    rows = [(i, u, "mine") for i, u in enumerate(urls)] * 2
    pages = spark.createDataFrame(rows, "page_id long, url string, key string")
    listed = spark.createDataFrame([("y://LISTED.org/p",), (None,), ("junk",), ("y://LISTED.org/p",)], "url string")
    got = url_filter.judge_urls(pages, listed).collect()
    assert len(got) == len(rows) and all(r["key"] == "mine" for r in got)
    for r in got:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == urls[r["url"]]
    assert url_filter.judge_urls(pages, listed.limit(0)).where("verdict = 'block'").count() == 2 * 3
    assert url_filter.judge_urls(pages.limit(0), listed).count() == 0


def test_bloom_filter_misses_nothing_and_passes_little(spark):
    keys = spark.range(4000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("key"))
    blocks = 4000 * url_filter.BITS_PER_KEY // url_filter.BLOCK_BITS
    bloom = url_filter.bloom_filter(keys.where("substr(key, 2) % 2 = 0"), blocks)
    hit = [F.col(f"w{i}").bitwiseAND(b) == b for i, b in enumerate(url_filter._bits(F.col("key")))]
    asked = keys.withColumn("block", url_filter._block(blocks)).join(bloom, "block", "left").select(
        "key", F.coalesce(hit[0] & hit[1] & hit[2] & hit[3], F.lit(False)).alias("hit"))
    n = {r["even"]: r["n"] for r in asked.groupBy((F.expr("substr(key, 2) % 2 = 0")).alias("even")).agg(
        F.count_if("hit").alias("n")).collect()}
    assert n[True] == 2000 and n[False] < 200


def render(turns, who):
    """Brute-force rendering of sorted (turn, speaker, text) triples."""
    text, mask = "", []
    for _, s, t in turns:
        text += "<|im_start|>" + ("system" if s == "system" else "assistant" if s == who else f"user name={s}") + "\n"
        if s == who:
            mask.append([len(text), len(text) + len(t) + len("<|im_end|>\n")])
        text += t + "<|im_end|>\n"
    return text, mask


def test_perspectives(spark):
    turns = spark.read.parquet(f"{SF}/conversations.parquet")
    convs = {}
    for r in turns.collect():
        convs.setdefault(r["conv_id"], set()).add((r["turn"], r["role"], r["text"]))
    got = queries.op4_chat_format(spark, SF).collect()
    assert len(got) == sum(len({s for _, s, _ in c} - {"system"}) for c in convs.values())
    for r in got:
        text, mask = render(sorted(convs[r["conv_id"]]), r["perspective"])
        assert (r["text"], [[m["start"], m["end"]] for m in r["mask"]]) == (text, mask)


def test_perspective_edges(spark, monkeypatch):
    schema = "conv_id long, turn long, role string, text string, part string, mask string"
    rows = [(1, 0, "ann", "hi é", "p", "m"), (1, 0, "ann", "hi é", "p", "m"), (1, None, "bob", None, "p", "m"), (1, 1, None, "", "p", "m"),
            (None, 2, "ann", "x", "p", "m"), (2, 0, "system", "only", "p", "m")]
    got = {(r["conv_id"], r["perspective"], r["part"]): r for r in
           chat_format.rotate_perspectives(spark.createDataFrame(rows, schema)).collect()}
    assert set(got) == {(1, s, p) for s in ("ann", "bob", "unknown") for p in (0, None)} | {(None, "ann", 0)}
    assert got[1, "ann", 0]["n_rows"] == 3 and got[1, "ann", 0]["n_turns"] == 2
    assert chat_format.rotate_perspectives(spark.createDataFrame([], schema)).count() == 0
    monkeypatch.setattr(chat_format, "PART_ROWS", 4)
    hot = [(1, t, s, f"{t} {k}", "", "") for t in range(20) for s in "ab" for k in range(1 + 10 * (t == 7))]
    out = chat_format.rotate_perspectives(spark.createDataFrame(hot, schema)).collect()
    assert max(r["n_turns"] for r in out) <= 15 and sum(r["n_turns"] for r in out) == 2 * len(hot)
    order = sorted((r for r in out if r["perspective"] == "a"), key=lambda r: (r["part"], r["fine"], r["cut"]))
    said = [int(x) for r in order for x in re.findall(r"\n(\d+) \d+<", r["text"])]
    assert said == sorted(said) and len(said) == len(hot)


def test_pipeline_keeps_clean_documents_and_packs_them(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, SF)
        assert kept.columns == docs.columns, name
    from riskwise.llm import decontaminate, jaccard_join, secret_scan
    component = {r["doc_id"]: r["component_id"] for r in jaccard_join.jaccard_components(docs).collect()}
    dirty = {r["doc_id"] for r in decontaminate.benchmark_matches(
        docs, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    want = {d for d, c in component.items() if d == c} - dirty
    pieces = corpus_pipeline.run(spark, SF)
    assert {r["doc_id"] for r in pieces.select("doc_id").distinct().collect()} == want
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(queries.TOKENIZER)
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in pieces.select("doc_id", "doc_tokens").distinct().collect():
        clean = secret_scan.redacted(text[r["doc_id"]], secret_scan.find_secrets(text[r["doc_id"]]))
        assert r["doc_tokens"] == len(tok.encode(clean, add_special_tokens=False).ids) + 1


def test_pipeline_keeps_documents_without_any_language(spark):
    rows = [(1, "clean text", None), (2, None, None), (3, "", None), (4, " 12 ! ", None), (5, "\u65e5\u672c", None), (None, "a", None)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = corpus_pipeline.identify_language(spark, d, SF)
    assert kept.columns == d.columns and {r["doc_id"] for r in kept.collect()} == {1, 5, None}


def test_nothing_else_imports_the_subpackage():
    for f in (ROOT / "riskwise").rglob("*.py"):
        if "llm" not in f.relative_to(ROOT).parts:
            assert "riskwise.llm" not in f.read_text() and "from .llm" not in f.read_text()


def _replaced(column, *pairs):
    for a, b in pairs:
        column = F.replace(column, F.lit(a), F.lit(b))
    return column


SHAPES = {      # ordinary pages that tell their main text in other ways, or hold traps in attribute values
    "longer than 60,000 characters": lambda h: F.concat(h, F.lit("<script>" + "var x = 1;" * 8000 + "</script>")),
    "a box named for content": lambda h: _replaced(h, ("<article>", '<div class="post-content">'), ("</article>", "</div>")),
    "a box without a name": lambda h: _replaced(h, ("<article>", "<div>"), ("</article>", "</div>")),
    "main with attributes": lambda h: _replaced(h, ("<article>", '<main id="x">'), ("</article>", "</main>")),
    "role main": lambda h: _replaced(h, ("<article>", "<div role=main>"), ("</article>", "</div>")),
    "hidden in a data value": lambda h: _replaced(h, ("<article>", '<article data-t="a hidden gem">')),
    "hidden in title and class": lambda h: _replaced(h, ("<article>", '<article title="A hidden gem" class="overflow hidden lg:block">')),
}


@pytest.fixture(scope="module")
def plain_texts(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "html")
    return pages, {r["page_id"]: r["text"] for r in html_extract.extract_main_text(pages).collect()}


@pytest.mark.parametrize("shape", SHAPES)
def test_main_text_whatever_the_page_looks_like(plain_texts, shape):
    pages, want = plain_texts
    got = html_extract.extract_main_text(pages.withColumn("html", SHAPES[shape](F.col("html"))).withColumn("__html", F.lit(1)))
    assert {r["page_id"]: r["text"] for r in got.collect()} == want


def test_hidden_is_an_attribute_not_a_word():
    page = html_extract.Page('<p hidden>a</p><p style="color:red; display : none">b</p><p aria-hidden="true">c</p><p class="hidden x">d</p>'
                             '<p title="so hidden here">e</p><p data-hidden=1>f</p><p hidden="">g</p><p aria-hidden=false>h</p>')
    assert page.hidden[1:] == [True, True, True, False, False, False, True, False]


def test_fixed_rule_where_nothing_can_be_learned(spark):
    html = ['<div class="menu"><a href="/">Home</a></div><b>Some words.</b><footer>imprint</footer>', "just text", "<p></p>", None, ""]
    pages = spark.createDataFrame(list(enumerate(html)), "page_id int, html string")
    got = {r["page_id"]: r["text"] for r in html_extract.extract_main_text(pages).collect()}
    assert got == {0: "Some words.", 1: "just text", 2: "", 3: "", 4: ""}


def test_what_tells_the_main_text():
    told = [html_extract.semantic_labels(html_extract.Page(h)) for h in (
        "<div class=content><p>a</p></div><article><p>b</p></article>", "<div class=content><p>a</p></div><div><p>long text</p></div>",
        "<div><p>a</p></div><div><p>long text</p></div><nav><p>a much longer menu text</p></nav>", "<b>x</b>")]
    assert [t and t[0] for t in told] == [0, 1, 2, None]
    assert told[0][1].tolist() == [1, 0, 0, 1, 1] and told[1][1].tolist() == [1, 1, 1, 0, 0]
    assert told[2][1].tolist() == [1, 0, 0, 1, 1, 0, 0]
