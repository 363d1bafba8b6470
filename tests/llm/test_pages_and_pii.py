from __future__ import annotations

import html
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from snapledger.llm import pii, site_tree
from snapledger.llm.markup import MAIN, NOISE, OPEN, read_page, text_hash
from snapledger.llm.pii_training import examples
from snapledger.llm.queries import QUERIES
from snapledger.llm.site_tree import extract_text


def test_pages_query(spark, tables):
    source = {r.page_id: r.html for r in spark.read.parquet(f"{tables}/pages.parquet").collect()}
    rows = QUERIES["op8_html_text"](spark, tables).collect()
    judged = sum(r.n_judged for r in rows)
    print(f"{judged} blocks judged by the tree, {sum(r.n_site_blocks for r in rows)} of them the site's")
    assert judged > 2 * len(rows)
    for r in rows:
        article = re.search(r"<article>(.*)</article>", source[r.page_id], re.S)[1]
        plain = re.sub(r"</?b>", "", article).replace("<br>", " ")
        blocks = (" ".join(html.unescape(b).split()) for b in re.split(r"</?(?:h1|p)>", plain))
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


@pytest.mark.parametrize(
    ("source", "want"),
    [
        ("", []),
        ("a<b", [("a", OPEN)]),
        ("<!-->x<!-- <p>no</p> -->y", [("xy", OPEN)]),
        ("<!-- open <p>x", []),
        ("</p>x<p", [("x", OPEN)]),
        ("<script>var a='</p><p>';</script>x<style>p{}", [("x", OPEN)]),
        ("&#x41;&nbsp;&bogus;&am", [("A &bogus;&am", OPEN)]),
        ("<main><p>a<p>b <b>c</b>d<br>e", [("a", MAIN), ("b cd e", MAIN)]),
        ("<main><ul><li>x<li>y</ul><div class=share>s</div></main>", [("x", MAIN), ("y", MAIN), ("s", NOISE)]),
        ("<article><p>t</p><section id='comments'><article class='comment'><p>c", [("t", MAIN), ("c", NOISE)]),
        ("<div class='has-sidebar'><article><p>t</article><div class='sidebar'>s", [("t", MAIN), ("s", NOISE)]),
        ("<p>a <span class=ad>no<i>no</i></span>b<a title='x>y'>c</a>", [("a bc", OPEN)]),
        ("<body class=nav><header>h</header><form>f</form><p>x</p><footer>f", [("h", NOISE), ("f", NOISE), ("x", OPEN), ("f", NOISE)]),
    ],
)
def test_markup(source, want):
    assert [(b.text, b.status) for b in read_page(source)[0]] == want


@pytest.mark.parametrize(
    ("source", "want"),
    [
        ("<form><p>f</p><main><p>a</main></form>", [("f", NOISE), ("a", MAIN)]),
        ("<div class='elementor-widget-container'>w<article><p>a", [("w", NOISE), ("a", MAIN)]),
        ("<form><article class=comment><p>c</article><nav><article><p>n", [("c", NOISE), ("n", NOISE)]),
        ("<form><article><p>a<form>x</form><aside>y</aside>", [("a", MAIN), ("x", NOISE), ("y", NOISE)]),
    ],
)
def test_main_elements_in_wrappers(source, want):
    assert [(b.text, b.status) for b in read_page(source)[0]] == want


def test_numbers_in_names_are_alike():
    one, two = (read_page(f"<div id=post-{k} class='p{k} x'><p>t")[0][0].branch for k in (1, 22))
    assert one == two != read_page("<div id=post class='p x'><p>t")[0][0].branch


def _plain_importance(pages):
    """Content and presentation importance of each branch, and texts on almost all pages, computed page by page."""
    sites = {}
    for url, source in pages:
        blocks, styles = read_page(source)
        article = "\n".join(b.text for b in blocks if b.status == MAIN)
        content, style = sites.setdefault(url.split("/")[2], ({}, {}))
        page = article or (url, source)
        for b in blocks:
            if b.status != NOISE:
                content.setdefault((b.branch, b.parent), {}).setdefault(b.text, set()).add(page)
        for branch, children in styles:
            style.setdefault(branch, {}).setdefault(children, set()).add(page)
    for host, (content, style) in sites.items():
        for (branch, parent), texts in content.items():
            m = len(set.union(*texts.values()))
            n = [len(p) for p in texts.values()]
            text = 1 - sum(k * math.log(k, m) for k in n) / sum(n) if m > 1 else 1.0
            styles = [len(p) for p in style.get(parent, {}).values()]
            shown = len(set.union(*style[parent].values())) if styles else 1
            looks = -sum(k / sum(styles) * math.log(k / sum(styles), shown) for k in styles) if shown > 1 else 1.0
            often = {t for t, p in texts.items() if m >= 5 and len(p) >= 5 and 1 - math.log(len(p), m) < 0.05}
            yield host, branch, m, 0.8 * text + 0.2 * looks, often


def test_importance_against_a_plain_computation(spark, tables):
    """Over the given pages, and over sites with furniture of all kinds."""
    rows = [(r.url, r.html) for r in spark.read.parquet(f"{tables}/pages.parquet").collect()]
    r = random.Random(5)
    for k in range(60):
        page = f"<div id=a{k}>Hello</div><main><p>{r.choice('xyz')} own {k}</p><p>Subscribe now</p></main><div><p>{r.choice(['l', 'm'])}</div>"
        rows.append((f"http://s{k % 3}.test/{k}", page))
    frame = spark.createDataFrame([(i, *x) for i, x in enumerate(rows)], "_k1 long, _url string, _html string").withColumn("_k2", F.lit(0).cast("long"))
    nodes = site_tree._nodes(frame).cache()
    found = {(x.host, x.branch): (x.n_pages, x.importance) for x in site_tree.node_importance(nodes).collect()}
    texts = {(x.host, x.branch, x.feature) for x in site_tree.site_texts(nodes).collect()}
    nodes.unpersist()
    expected, often = {}, set()
    for host, branch, m, importance, repeated in _plain_importance(rows):
        expected[host, branch] = (m, importance)
        often |= {(host, branch, text_hash(t)) for t in repeated}
    assert set(found) == set(expected) and texts == often and len(often) >= 6
    assert all(found[k][0] == m and found[k][1] == pytest.approx(x, abs=1e-9) for k, (m, x) in expected.items())


def test_furniture_inside_main_elements(spark):
    """A line below every article goes; articles that a site has several times, or almost, stay whole."""
    article = "<div id=post-{k}><main><h1>Title {k}</h1><p>Text number {k} of its own</p><p>Subscribe to our letter</p></main></div>"
    rows = [(k, f"http://a.test/{k}", article.format(k=k)) for k in range(12)]
    rows += [(100 + k, f"http://b.test/{k}", "<main><p>One article</p><p>Many times</p></main>") for k in range(12)]
    rows += [(200 + k, f"http://c.test/{k}", f"<main><p>One article that is long enough</p><p>Edited {k}</p></main>") for k in range(12)]
    rows += [(300 + k, f"http://d.test/{k}", article.format(k=k)) for k in range(4)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r.page_id: r for r in extract_text(pages).collect()}
    assert found[3].text == "Title 3\nText number 3 of its own" and (found[3].n_judged, found[3].n_site_blocks) == (3, 1)
    assert found[105].text == "One article\nMany times" and found[205].text == "One article that is long enough\nEdited 5"
    # Too few pages tell nothing.
    assert found[302].text.endswith("Subscribe to our letter")


def test_deep_and_long_pages():
    deep = "<div>" * 20_000 + "<b>" * 20_000 + "x" + "</div>" * 20_000
    assert [b.text for b in read_page(deep)[0]] == ["x"]
    assert len(read_page("<p>t" * 30_000)[0]) == 30_000
    assert read_page("<a href='" + "x" * 100_000)[0] == []


def test_furniture_by_statistics(spark):
    """Branches without telling names go if they are alike on all pages of their host."""
    body = "<body><div id=x1>Welcome to us</div><div id=x2><p>Own text {i} here</p><p>More {j}</p></div><div id=x3><ul><li>Home<li>Away</ul></div>"
    rows = [(i, f"http://h.example.com/{i}", body.format(i=i, j=i * 7)) for i in range(30)]
    rows += [(100, "http://o.example.com", "<p>x"), (None, None, None), (5, "::bad", ""), (5, "::bad", "")]
    # Copies of one article stay: running text in a main element is no furniture.
    rows += [(200 + i, "http://c.example.com/", "<nav>n</nav><article><p>Same</article>") for i in range(20)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("old")).withColumn("_html", F.lit(1))
    found = extract_text(pages)
    assert found.columns == ["page_id", "url", "_html", "text", "n_judged", "n_site_blocks"] and found.count() == len(rows)
    texts = {(r.page_id, r.url): r.text for r in found.collect()}
    assert all(texts[i, f"http://h.example.com/{i}"] == f"Own text {i} here\nMore {i * 7}" for i in range(30))
    assert texts[100, "http://o.example.com"] == "x" and texts[None, None] == "" and texts[5, "::bad"] == ""
    assert texts[205, "http://c.example.com/"] == "Same"
    assert extract_text(pages.limit(0)).collect() == []


def _base(text):
    found = [(*m.span(), "email") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            found.append((*m.span(), "ip"))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        total = sum((d := int(c) * (1 + i % 2)) - 9 * (d > 9) for i, c in enumerate(reversed(digits)))
        if 16 <= len(digits) <= 19 and total % 10 == 0:
            found.append((*m.span(), "card"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            found.append((*m.span(), "phone"))
    return found


def test_base_patterns():
    r = random.Random(1)
    for _ in range(20_000):
        text = "".join(r.choice("a@.@b_%+- 0123456789()\n٣") for _ in range(r.randrange(40)))
        assert pii.base_spans(text) == _base(text)
    assert pii.base_spans("7" * 200_000 + " a" * 100_000) == []


def test_the_field_on_held_out_examples():
    model, right, wrong, missed = pii.trained_model(), 0, 0, 0
    for text, entities in examples(400, seed=77):
        found, want = set(model.decode(text)), set(entities)
        right, wrong, missed = right + len(found & want), wrong + len(found - want), missed + len(want - found)
    assert right / (right + wrong) > 0.95 and right / (right + missed) > 0.95


def test_personal_data_query(spark, tables, texts):
    found = {r.doc_id: r for r in QUERIES["op10_personal_data"](spark, tables).collect()}
    for i, text in texts.items():
        base = _base(text)
        counts = [sum(k == kind for *_, k in base) for kind in pii.BASE_KINDS]
        assert [found[i][f"n_{k}"] for k in pii.BASE_KINDS] == counts
        assert found[i].base_sha256 == pii.digest(base)
        listed = found[i].spans.split(",") if found[i].spans else []
        assert {f"{k}:{b}:{e}" for b, e, k in base} <= set(listed)
        order = [(pii.KINDS.index(s.split(":")[0]), int(s.split(":")[1])) for s in listed]
        assert order == sorted(order)


def test_personal_data_edges(spark, odd, empty):
    found = pii.find_personal_data(odd)
    assert found.columns == [*odd.columns, "base_spans", "all_spans"] and found.count() == odd.count()
    assert found.filter("size(all_spans) > 0").isEmpty() and pii.find_personal_data(empty).collect() == []
    text = 'Mail jo.1@mail.example.com, call (407) 555-7710 now; token = "cb1a9fee807a05366fcb8b6c95c7c565ede51a72"'
    long = "1 " * 30_000 + "a@b.co" + "\n" + "12 " * 30_000
    df = spark.createDataFrame([(1, text), (2, long)], "doc_id long, text string")
    found = pii.find_personal_data(df)
    spans = {r.doc_id: [(s.kind, (text if r.doc_id == 1 else long)[s.begin : s.end]) for s in r.all_spans] for r in found.collect()}
    assert spans[1] == [("email", "jo.1@mail.example.com"), ("phone", "(407) 555-7710"), ("secret", "cb1a9fee807a05366fcb8b6c95c7c565ede51a72")]
    assert ("email", "a@b.co") in spans[2]
    redacted = pii.redact(found.filter("doc_id = 1")).first().text
    assert redacted == 'Mail <email>, call <phone> now; token = "<secret>"'
