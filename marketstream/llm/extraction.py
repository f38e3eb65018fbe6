"""Main text of web pages by template deduction over the pages of a host.

Tokens of a page are its elements (by path, with the place among siblings of one name) and its
text blocks (by path without places, and text).  The
occurrence vector of a token over a host's pages is kept as a pair of sums over hashed
page ids, so vectors are built by ordinary distributed sums, however many pages a host
has.  Tokens of one host with equal vectors form an equivalence class; classes that hold
several tokens and cover at least half of the host's pages are valid.  Nested by path,
they are the host's template: its fixed texts, and the slots between its elements, of which
the deepest one that carries most of the running text is the article's.

The pages of all hosts together are deduced in the same way (under the empty host); what
they share, if anything, serves hosts of too few pages and pages without a host.

A page's text is then what stands in its deduced slot, without template texts, wherever they
stand, and without the parts that markup names as something else (navigation, forms, adverts
...).  ``article`` and ``main`` elements are evidence: inside one the slot narrows only to an
element with nearly all of its text, and a wider slot narrows to a page's article.  Pages
without a deduced slot are read from such an element, else from the body.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketstream.llm.common import arrow_map, table, texts
from marketstream.session import cut

LEAST_PAGES = 4           # a host with fewer pages has no template
SLOT_SHARE = 0.6          # of the running text, in the article's slot
INNER_SHARE = 0.9         # of the text in article elements, in a slot inside one
CLASS_TOKENS = 3          # tokens that a valid class holds at least
BROADCAST_HOSTS = 20_000  # templates beyond this many hosts are joined by shuffle
SALTS = 32                # for the pages of one host in that join

# Fixed values of HTML: elements without content, and elements that end a line of text.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("""a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd
    label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr""".split())
_SAME_CLOSES = frozenset("li dt dd tr td th option p".split())
# Elements that hold text rather than blocks; a slot is none of these.
_LEAF = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre td th caption figcaption summary legend".split())
# What is not the article, by element, by role and by words of class or id.
_OTHER = frozenset("""head title nav footer aside form script style noscript template button select
    textarea svg iframe object canvas menu dialog audio video map""".split())
_ROLES = frozenset("""navigation banner contentinfo complementary search form alert
    alertdialog dialog menu menubar""".split())
_WORDS = frozenset("""ad ads advert adverts advertisement advertising adsense banner sponsor
    sponsored sponsors promo promos promotion sidebar menu submenu nav navbar navigation
    breadcrumb breadcrumbs footer masthead topbar comment comments commentlist disqus replies
    discussion notice notices cookie cookies consent gdpr newsletter subscribe subscription signup
    popup modal overlay share sharing social related recommended widget login search toolbar
    pagination pager alert""".split())
# Words that may stand beside them in one name (ad-box, comment-list); any other word beside
# them makes a name of its own (share-price, notice-period).
_BESIDE = frozenset("""area bar block body bottom box btn button buttons center col column container
    content desktop div first form google group head header holder icon id inline inner inside item
    items js large last left lg link links list main md mobile outer outside page panel placeholder
    region right row section slot sm small space text the title top unit wrap wrapper xl xs zone""".split())
# Words that tell readers' articles from the page's own.
_READERS = frozenset("comment comments reply replies".split())
# These are the article's own inside it.
_OUTSIDE = frozenset(["header"])
_ARTICLE = frozenset(["article", "main"])
_HEADINGS = frozenset(["h1", "h2"])

_TOKEN = re.compile(r"""
    <!--(?:.*?-->|.*\Z) | <!\[CDATA\[.*?(?:\]\]>|\Z) | <[!?][^>]*(?:>|\Z)
  | <(?P<raw>script|style)\b[^>]*(?:>.*?(?:</(?P=raw)\s*>|\Z)|\Z)
  | <(?P<end>/?)(?P<name>[a-z][^\s/>]*)
      (?P<attrs>(?:[^"'>]|"[^"]*"|'[^']*')*+|[^>]*)(?:>|\Z)
""", re.X | re.S | re.I)
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_PARTS = re.compile(r"[a-z]+")


def _named(parts: list[str], words: frozenset) -> bool:
    """Whether a name is one of ``words``, alone or with words that may stand beside them."""
    return not words.isdisjoint(parts) and all(p in words or p in _BESIDE or p in _WORDS for p in parts)


def _described(name: str, attrs: str) -> tuple[str, bool, bool]:
    """An element's name in paths, whether it is no part of an article, and whether that
    holds only outside one."""
    other, outside, label = name in _OTHER, name in _OUTSIDE, name
    if attrs:
        for k, v in _ATTRIBUTE.findall(attrs):
            k, v = k.lower(), v.strip("\"'").lower()
            if k == "role":
                other |= v in _ROLES
            elif k == "hidden":
                other = True
            elif k in ("class", "id"):
                label += "." + "".join(_PARTS.findall(v))
                for parts in map(_PARTS.findall, v.split()):
                    if name in _ARTICLE:
                        other |= not _READERS.isdisjoint(parts)
                    elif name not in ("body", "html"):
                        other |= _named(parts, _WORDS)
                        outside |= _named(parts, _OUTSIDE)
    return label, other, outside


class _Open:
    """An open element; ``path`` has the places among siblings, ``plain`` has not; ``article``
    is the number of the outermost article or main element that it is in, or 0; ``inside``
    counts its elements by name."""

    __slots__ = ("name", "path", "plain", "depth", "other", "article", "inside")

    def __init__(self, name, path, plain, depth, other, article):
        self.name, self.path, self.plain, self.depth = name, path, plain, depth
        self.other, self.article = other, article
        self.inside = {}


def parse(page: str) -> tuple[list[tuple[str, list[int], int, bool, bool, int]], dict[int, list[int]]]:
    """A page's blocks in order -- (text, path of open elements from the root, number of the
    outermost article element it is in or 0, part of something else, a heading, token of the
    text) -- and per
    path its depth, occurrences, whether it can be a slot and whether it is inside an article
    element.

    Any text is accepted: unknown or unclosed elements, stray ends and cut tags."""
    import xxhash

    blocks, elements, known = [], {}, {}
    stack = [_Open("", 0, 0, 0, False, 0)]
    articles = 0
    parts: list[str] = []
    muted: list[str] = []       # open inline elements that are no part of an article
    level = 0                   # open elements around the first of them

    def flush():
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            parts.clear()
            if text:
                top = stack[-1]
                blocks.append((text, [o.path for o in stack[1:]], top.article, top.other,
                               top.name in _HEADINGS, _text_token(top.plain, text)))

    pos = 0
    for m in _TOKEN.finditer(page):
        if m.start() > pos and not muted:
            parts.append(page[pos:m.start()])
        pos = m.end()
        name = m["name"]
        if not name:
            continue
        name = name.lower()
        if name == "br":
            parts.append(" ")
            continue
        if name not in _INLINE:
            flush()
        if m["end"]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].name == name:
                    del stack[k:]
                    break
            if muted and name == muted[-1]:
                muted.pop()
            if len(stack) < level:
                muted.clear()       # never closed
            continue
        if name in _VOID:
            continue
        if name in _INLINE:         # inline elements part no blocks and name no slots
            if muted:
                muted += [name] if name == muted[-1] else []
            elif m["attrs"]:
                _, other, outside = _described(name, m["attrs"])
                if other or (outside and not stack[-1].article):
                    muted, level = [name], len(stack)
            continue
        if name in _SAME_CLOSES or stack[-1].name == "p":
            top = stack[-1].name
            if top == name or top == "p":
                stack.pop()
        top, attrs = stack[-1], m["attrs"]
        got = known.get((name, attrs))
        if got is None:
            got = known[name, attrs] = _described(name, attrs)
        label, other, outside = got
        nth = top.inside[label] = top.inside.get(label, 0) + 1
        plain = xxhash.xxh3_64_intdigest(label, seed=top.plain) >> 1
        path = xxhash.xxh3_64_intdigest(f"{label} {nth}" if name not in _LEAF else label,
                                        seed=top.path) >> 1
        depth = top.depth + 1
        article = top.article
        if not article and name in _ARTICLE:
            articles += 1
            article = articles
        stack.append(_Open(name, path, plain, depth, top.other or other or (outside and not article),
                           article))
        seen = elements.get(path)
        if seen is None:
            elements[path] = [depth, 1, name not in _LEAF, int(top.article > 0)]
        else:
            seen[1] += 1
    if pos < len(page) and not muted:
        parts.append(page[pos:])
    flush()
    return blocks, elements


def _text_token(path: int, text: str) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(text, seed=path) >> 1


_TOKENS = ("host string, kind string, token long, occ long, v1 long, v2 long, depth int, "
           "mass long, inner long, pages long")


def _page_tokens():
    """Per batch: tokens of each host with their vectors' sums (summed over the batch)."""
    import xxhash

    def step(b: pa.RecordBatch):
        sums: dict[tuple, list[int]] = {}

        def add(host, *what):
            add_to(host, *what)
            if host:
                add_to("", *what)

        def add_to(host, kind, token, occ, h1, h2, depth, mass, inner):
            got = sums.get((host, kind, token))
            if got is None:
                sums[host, kind, token] = [occ, occ * h1, occ * h2, depth, mass, inner, 1]
            else:
                got[0] += occ
                got[1] += occ * h1
                got[2] += occ * h2
                got[4] += mass
                got[5] += inner
                got[6] += 1

        ids = b.column("id").to_pylist()
        for i, host, page in zip(ids, b.column("host").to_pylist(), texts(b, "html"), strict=True):
            h = xxhash.xxh3_64_intdigest(str(i))
            h1, h2 = h & 0x3FFFFFFF, h >> 34     # 30 bits each: sums stay far below 2**63
            blocks, elements = parse(page)
            mass: dict[int, int] = {}
            total, inside, fixed = 0, 0, {}
            for text, path, article, other, _, t in blocks:
                if not other:
                    total += len(text)
                    inside += len(text) if article else 0
                    for p in dict.fromkeys(path):
                        mass[p] = mass.get(p, 0) + len(text)
                fixed[t] = fixed.get(t, 0) + 1
            # inner: the text in article elements, and per element inside one a number over 0
            add(host, "page", 0, 1, h1, h2, 0, total, inside)
            for p, (depth, occ, slot, inner) in elements.items():
                add(host, "element", p, occ, h1, h2, depth, mass.get(p, 0) if slot else 0, inner)
            for t, occ in fixed.items():
                add(host, "text", t, occ, h1, h2, 0, 0, 0)
        if not sums:
            return None
        keys, vals = zip(*sums.items(), strict=True)
        host, kind, token = zip(*keys, strict=True)
        return [host, kind, token, *(x for x in zip(*vals, strict=True))]

    return step


def _host(url):
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")),
                                    r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


def deduce(pages: DataFrame) -> DataFrame:
    """Templates from ``pages`` (id, host, html): one row per host, and one of all pages under
    the empty host, with ``slot`` (the path of the article's slot, or null) and ``fixed``
    (tokens of template texts)."""
    tokens = (arrow_map(pages, _page_tokens, _TOKENS)
              .groupBy("host", "kind", "token")
              .agg(*[F.sum(c).alias(c) for c in ("occ", "v1", "v2", "mass", "inner", "pages")],
                   F.max("depth").alias("depth")))
    tokens = cut(tokens)
    hosts = (tokens.where("kind = 'page'")
             .select("host", F.col("pages").alias("of"), F.col("mass").alias("whole"),
                     F.col("inner").alias("inside"))
             .where(F.col("of") >= LEAST_PAGES))
    # half of LEAST_PAGES pages or more, before anything is dealt by host: most tokens are
    # texts of a single page
    several = tokens.where((F.col("kind") != "page") & (2 * F.col("pages") >= LEAST_PAGES))
    # of all pages together only what half of them have: the empty host is no large group
    whole = tokens.where("host = '' AND kind = 'page'").first()
    several = several.where((F.col("host") != "") | (2 * F.col("pages") >= (whole["pages"] if whole else 0)))
    wide = several.join(hosts, "host").where("2 * pages >= of")
    # at least half of the pages: at most twice as many tokens per host as a page has
    classes = (wide.groupBy("host", "v1", "v2")
               .agg(F.count(F.lit(1)).alias("size"),
                    F.count_if(F.col("kind") == "element").alias("elements")))
    valid = wide.join(classes.where((F.col("size") >= CLASS_TOKENS) & (F.col("elements") > 0)),
                      ["host", "v1", "v2"])
    once = (F.col("kind") == "element") & (F.col("occ") == F.col("pages"))
    nearly = (F.col("inner") == 0) | (F.col("mass") >= INNER_SHARE * F.col("inside"))
    deep = F.when(once & nearly & (F.col("mass") >= SLOT_SHARE * F.col("whole"))
                  & (F.col("whole") > 0),
                  F.struct("depth", "mass", "token"))
    return (valid.groupBy("host")
            .agg(F.max(deep)["token"].alias("slot"),
                 F.sort_array(F.collect_set(F.when(F.col("kind") == "text", F.col("token"))))
                 .alias("fixed")))


def main_text(page: str, slot: int | None, fixed) -> str:
    """The article's blocks of one page, one per line."""
    blocks = [x for x in parse(page)[0] if not x[3]]
    inside = [x for x in blocks if slot in x[1]] if slot is not None else []
    slotted = bool(inside)
    inside = inside or blocks
    articles = {x[2] for x in inside if x[2]}
    # a deduced slot gives way to the page's only article, or to several with most of its text
    marked = [x for x in inside if x[2]]
    own = bool(marked) and (not slotted or len(articles) == 1 or
                            sum(len(x[0]) for x in marked)
                            >= SLOT_SHARE * sum(len(x[0]) for x in inside))
    # a heading stands before the slot in the same article
    kept = [x for x in blocks if (not slotted or slot in x[1] or (x[4] and x[2] in articles))
            and (x[2] or not own)]
    if fixed:
        new = [x for x in kept if x[5] not in fixed]
        # an article of which every text is on most pages of its host is a copied page
        if new or not own:
            kept = new
    return "\n".join(x[0] for x in kept)


def extracted(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
              html_col: str = "html") -> DataFrame:
    """Per row of ``pages``: id, url and ``text`` (empty if there is none, also for a null
    or empty page).

    Pages without a host (null or malformed url) and those of a host without a template are
    read by the template of all pages, if there is one, else by their markup alone.  Repeated rows repeat, other columns are left aside, and an empty table
    gives no rows.  Pages of one host never meet in a task: vectors are sums, and the
    template goes to the pages by broadcast, or by a salted join if there are many hosts."""
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"),
                        F.col(html_col).cast("string").alias("html"),
                        _host(F.col(url_col).cast("string")).alias("host"))
    templates = cut(deduce(rows.select("id", "host", "html")))
    # at most twice as many tokens as a page has
    shared = templates.where("host = ''").first()
    templates = templates.where("host <> ''")
    if templates.count() <= BROADCAST_HOSTS:
        joined = rows.join(F.broadcast(templates), "host", "left")
    else:
        salted = templates.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = (rows.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int"))
                  .join(salted, ["host", "salt"], "left"))

    common = None if shared is None else (shared["slot"], list(shared["fixed"]))

    def make():
        def step(b: pa.RecordBatch):
            text = []
            for page, slot, fixed in zip(texts(b, "html"), b.column("slot").to_pylist(),
                                         b.column("fixed").to_pylist(), strict=True):
                if fixed is None and common is not None:
                    slot, fixed = common
                text.append(main_text(page, slot, set(fixed) if fixed else None))
            return b.column("id"), b.column("url"), text

        return step

    out = arrow_map(joined.select("id", "url", "html", "slot", "fixed"), make,
                    f"id {rows.schema['id'].dataType.simpleString()}, url string, text string")
    return out.withColumnRenamed("id", id_col).withColumnRenamed("url", url_col)


def op2_html_extraction(spark, sf_dir: str) -> DataFrame:
    return extracted(table(spark, sf_dir, "pages")).select(
        "page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
