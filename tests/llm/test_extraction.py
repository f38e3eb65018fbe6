from __future__ import annotations

import html
import re

from .conftest import SF

from marketstream.llm.extraction import deduce, extracted, main_text, parse

PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var t="</p>";</script></head><body>
<header class="masthead"><h1>Site</h1></header><nav><ul><li><a href=/>Home</a></ul></nav>
<div class="cookie-notice">We use cookies</div><!-- <p>hidden</p> -->
<div class="story"><h1>Head &amp; shoulders</h1><p><b>One&nbsp;two
three.<br>four<p title="a > b">Five &lt;six&gt; &copy &am;</p><form><p>f</p></form>
<div class="ad">Buy</div><aside>also</aside><ul><li>i<li>j</ul><pre>x
 y</pre></div><section id="comments"><article>Nice!</article><p>me too</p></section>
<footer>&copy; site</footer></body></html>"""


def test_one_page_by_markup():
    assert main_text(PAGE, None, None).split("\n") == [
        "Head & shoulders", "One two three. four", "Five <six> © &am;", "i", "j", "x y"]


def test_odd_pages():
    for page, want in [("", ""), ("plain < 3 text <b", "plain < 3 text"), ("<p>a</div></p>b", "a\nb"),
                       ("<script>x", ""), ("<!-- x", ""), ("<p a='>b", "b"), ("<br>" * 3, ""),
                       ("<div>" * 2000 + "deep", "deep")]:
        assert main_text(page, None, None) == want, page


def test_own_article_wins():
    page = "<body><p>teaser</p><article><p>a</p><p>b</p></article><p>more</p></body>"
    assert main_text(page, None, None) == "a\nb"


def test_template_of_a_host(spark):
    """Without telling names: fixed texts and the slot come from the host's other pages."""
    def page(k):
        return (f"<html><body><div class='qa'><p>Welcome all</p><p>Offer {k}</p></div>"
                f"<div class='qb'><h2>Head {k}</h2><p>{'long text of the page ' * 9}{k}</p></div>"
                "<div class='qc'><p>Find us here</p></div></body></html>")

    rows = [(k, f"https://h.example.org/{k}", page(k)) for k in range(9)]
    rows += [(20, "https://single.example.org/", page(20)), (21, None, page(21)),
             (22, "no url", None), (None, "https://h.example.org/x", ""), (8, rows[8][1], rows[8][2])]
    df = (spark.createDataFrame(rows, "page_id long, url string, html string")
          .selectExpr("*", "'c' AS text", "'c' AS slot", "'c' AS host", "1 AS id").repartition(4))
    got = {(r.page_id, r.url): r.text for r in extracted(df).collect()}
    for k in range(9):
        assert got[k, f"https://h.example.org/{k}"] == (
            f"Head {k}\n{('long text of the page ' * 9 + str(k))}")
    # what all pages share serves hosts of too few pages, and pages without a host
    for url, k in (("https://single.example.org/", 20), (None, 21)):
        assert got[k, url] == f"Head {k}\n{('long text of the page ' * 9 + str(k))}"
    assert got[22, "no url"] == "" and got[None, "https://h.example.org/x"] == ""
    assert extracted(df).count() == len(rows)
    assert extracted(df.where("false")).collect() == []


def texts_of(spark, pages):
    rows = [(k, f"https://h.example.org/{k}", p) for k, p in enumerate(pages)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    return [r.text.split("\n") for r in extracted(df).orderBy("page_id").collect()]


def test_template_inside_article_elements(spark):
    """Fixed texts and the slot decide there too; no class tells anything."""
    for name in ("article", "main"):
        pages = [f"<html><body><{name}><h1>Head {k}</h1><div class=qa><p>Offer {k}</p>"
                 "<p>All texts are ours</p></div><div class=qb>"
                 f"<p>{'long text of the page ' * 30}{k}</p><p>Write to us now</p><p>Part {k}</p>"
                 f"</div></{name}></body></html>" for k in range(9)]
        assert texts_of(spark, pages) == [
            [f"Head {k}", f"{'long text of the page ' * 30}{k}", f"Part {k}"] for k in range(9)]


def test_article_elements_beside_the_slot(spark):
    """Cards in article elements are not the text; two parts of an article both are."""
    cards = [f"<body><div class=qa><article><p>Card {k}</p></article><article><p>Other {k}</p>"
             f"</article></div><div class=qb><h1>Head {k}</h1><p>{'long text ' * 30}{k}</p></div>"
             for k in range(6)]
    assert texts_of(spark, cards) == [[f"Head {k}", f"{'long text ' * 30}{k}"] for k in range(6)]
    parts = [f"<body><div class=qa><p>Teaser {k}</p></div><article><div class=qb><p>Start {k} "
             f"{'of it ' * 9}</p></div><div class=qc><p>{'long text ' * 9}{k}</p></div></article>"
             for k in range(6)]
    assert texts_of(spark, parts) == [[f"Start {k} {'of it ' * 9}".strip(), f"{'long text ' * 9}{k}"]
                                      for k in range(6)]


def test_copies_of_one_page_keep_their_article(spark):
    page = "<body><article><p>one</p><p>two</p></article><p>more</p></body>"
    assert texts_of(spark, [page] * 6) == [["one", "two"]] * 6


def test_pages_against_their_articles(spark):
    df = spark.read.parquet(f"{SF}/pages.parquet")
    pages = {r.page_id: r.html for r in df.collect()}
    for r in extracted(df).collect():
        own = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S)[1]
        want = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", x)).split())
                for x in re.split(r"</?p>|</?h1>", own)]
        assert r.text == "\n".join(x for x in want if x)


def test_vectors_are_sums(spark):
    rows = [(k, "h", "<body><p>fixed</p><div><p>own words " + str(k) + "</p></div></body>")
            for k in range(8)]
    df = spark.createDataFrame(rows, "id long, host string, html string").repartition(5)
    t = deduce(df).where("host = 'h'").collect()
    blocks, _ = parse(rows[0][2])
    assert len(t) == 1 and t[0].slot == blocks[1][1][1] and len(t[0].fixed) == 1


def test_attributes_names_and_inline_elements():
    for inner, want in [
            ('<p title="a hidden gem">text</p>', "text"), ("<p hidden-label=x>text</p>", "text"),
            ('<p data-x=\'role="form" hidden\'>text</p>', "text"), ("<p hidden>text</p>", ""),
            ('<p class="share-price">5 up</p>', "5 up"), ('<div id="related-work">w</div>', "w"),
            ('<p class="notice-period">n</p>', "n"), ('<p id="menu-of-the-day">soup</p>', "soup"),
            ('<p class="alert-level">red</p>', "red"), ('<div class="lead ad-box">Buy</div>', ""),
            ('<div class="comment-list">me</div>', ""), ('<div id=cookie-notice>c</div>', ""),
            ('<p>one <span class="ad">BUY NOW</span> two <span hidden>x <span>y</span> z</span>three',
             "one two three"), ('<p>a <span hidden>b</p><p>c</p>', "a\nc"),
            ('<p>a <a class="share" href=x>tell</a>b</p>', "a b")]:
        page = f"<title>T</title><body><article><h1>H</h1>{inner}</article></body>"
        assert main_text(page, None, None) == ("H\n" + want).strip(), inner


def test_pages_without_article_elements_and_names(spark):
    """The whole table again with ``article`` renamed and classes, ids and roles gone: what is
    left is the template, which must still find every article and leave the adverts out."""
    df = spark.read.parquet(f"{SF}/pages.parquet")
    want = {r.page_id: r.text for r in extracted(df).collect()}
    bare = df.selectExpr("page_id", "url", """regexp_replace(regexp_replace(html,
        '<(/?)article', '<$1div'), ' (class|id|role)="[^"]*"', '') AS html""")
    got = {r.page_id: r.text for r in extracted(bare).collect()}
    alone = {r.page_id: r.text for r in extracted(bare.selectExpr("page_id", "null AS url", "html"))
             .collect()}
    assert got == want == alone
    pages = {r.page_id: r.html for r in bare.collect()}
    markup = [main_text(pages[k], None, None) == want[k] for k in want]
    assert sum(markup) < 0.05 * len(want)                     # markup alone cannot


def test_templates_against_plain_loops(spark):
    """Vectors, classes, slot and fixed texts of every host, token by token."""
    from marketstream.llm import extraction as X

    df = spark.read.parquet(f"{SF}/pages.parquet")
    rows = df.select("page_id", "html", X._host(df.url).alias("host")).collect()
    hosts = {}
    for r in rows:
        parsed = (r.page_id, *parse(r.html or ""))
        for host in {r.host, ""}:
            hosts.setdefault(host, []).append(parsed)
    want = {}
    for host, pages in hosts.items():
        if len(pages) < X.LEAST_PAGES:
            continue
        vector, depth, mass, slots, whole, inside, inner = {}, {}, {}, set(), 0, 0, set()
        for i, blocks, elements in pages:
            for p, (d, occ, slot, within) in elements.items():
                vector.setdefault(("e", p), {})[i] = occ
                depth[p] = d
                slots |= {p} if slot else set()
                inner |= {p} if within else set()
            for text, path, article, other, _, t in blocks:
                v = vector.setdefault(("t", t), {})
                v[i] = v.get(i, 0) + 1
                if not other:
                    whole += len(text)
                    inside += len(text) if article else 0
                    for p in set(path):
                        mass[p] = mass.get(p, 0) + len(text)
        classes = {}
        for token, v in vector.items():
            if 2 * len(v) >= len(pages):
                classes.setdefault(tuple(sorted(v.items())), []).append(token)
        valid = [t for c in classes.values() if len(c) >= X.CLASS_TOKENS and any(k == "e" for k, _ in c)
                 for t in c]
        best = [(depth[p], mass.get(p, 0) if p in slots else 0, p) for k, p in valid if k == "e"
                and sum(vector[k, p].values()) == len(vector[k, p]) and whole
                and (mass.get(p, 0) if p in slots else 0) >= X.SLOT_SHARE * whole
                and (p not in inner or mass.get(p, 0) >= X.INNER_SHARE * inside)]
        want[host] = (max(best)[2] if best else None, sorted(t for k, t in valid if k == "t"))
    pages = df.select(df.page_id.alias("id"), X._host(df.url).alias("host"), "html")
    got = {r.host: (r.slot, sorted(r.fixed)) for r in deduce(pages).collect()}
    assert got == {h: v for h, v in want.items() if h in got}
    assert all(h in got for h, (slot, fixed) in want.items() if slot or fixed)
