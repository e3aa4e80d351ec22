"""Article text against a plain reading of the pages, and the template rules on small pages."""

import html
import re

import pytest

from cohortrec.llm import html_template as ht
from cohortrec.llm.html_blocks import MAIN, parse
from compare import DATA


def plain(page):
    """The text of the one article of a generated page, by cutting at tags."""
    page = re.sub(r"<!--.*?-->|<(script|style)\b.*?</\1>", "", page or "", flags=re.S)
    m = re.search(r"<article[^>]*>(.*?)(?:</article>|\Z)", page, re.S)
    pieces = re.split(r"<[a-zA-Z/!][^>]*(?:>|\Z)", re.sub(r"</?b>", "", m[1])) if m else []
    return " ".join(t for t in (" ".join(html.unescape(p).split()) for p in pieces) if t)


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
def test_all_pages(spark, scale):
    pages = spark.read.parquet(f"{DATA}/{scale}/pages.parquet")
    found = {r.page_id: r.text for r in ht.extract_articles(pages).collect()}
    wanted = {r.page_id: plain(r.html) for r in pages.collect()}
    assert len(wanted) >= 50 and all(wanted.values())
    assert found == wanted


def text(page, slots=(), content=(), fixed=()):
    return " ".join(b.text for b in ht.article_blocks(page, set(slots), set(content), set(fixed)))


def test_markup():
    assert text("<article><p>a<b>b</b> &lt;c&gt; &amp;amp; &am <i>d</i><br>e<p>f\n\n g") == "ab <c> &amp; &am d e f g"
    assert text('<article><a title="x>y">z</a><script>var t="</p><p>no";</script ><STYLE>p{}</STYLE>w <!-- > --> v</article>out') == "z w v"
    assert text("<nav>n</nav><header>h</header><main><header>title</header><aside>s</aside><p>t<form>f</form>u</main>") == "title t u"
    assert text("<article>t<div class='comment-list'>c</div><div id=sidebar>s</div><div class='has-sidebar x'>k</div></article>") == "t k"
    assert text("x < y &#233;&nbsp;&hearts; <3 <p>tail <b") == "x < y é ♥ <3 tail"
    assert text("") == "" and text("<article></article>") == "" and text("<!-- open") == "" and text("<article>a<script>b") == "a"
    assert text("<article><ul><li>one<li>two</ul><table><tr><td>3<td>4</table></article>") == "one two 3 4"
    deep = "<div>" * 20_000 + "x" + "</div>" * 20_000
    assert text(deep) == "x"


def test_flags_and_paths():
    blocks, elements = parse("<body><article id=p17><p>a</p><p>b</p></article><article id=p18><p>c</p></article></body>")
    assert [b.flags & MAIN for b in blocks] == [MAIN] * 3 and len({b.path for b in blocks}) == 1
    assert elements[blocks[0].path][2] == 3


def page(i, body):
    return f"<html><body><div id=top><a href=/>Home</a> <a href=/x>News</a></div><div id=story><h2>T{i}</h2>{body}</div><div id=low>All rights reserved by us</div></body></html>"


def test_template_without_semantic_elements(spark):
    rows = [(i, f"http://Plain.example.org/{i}", page(i, f"<p>Body {i}</p>" * (1 + i % 2)), "u") for i in range(8)]
    rows += [(20, "https://plain.example.org:80/odd", "<p>odd &amp; alone</p>", "u"), (21, None, None, "u"), (22, "nonsense", "", "u")]
    rows += [(3, rows[3][1], rows[3][2], "u")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    found = sorted((r.page_id, r.url, r.text) for r in ht.extract_articles(pages).collect() if r.url)
    for page_id, url, got in found:
        body = " ".join([f"Body {page_id}"] * (1 + page_id % 2))
        assert got == {20: "odd & alone", 22: ""}.get(page_id, f"T{page_id} {body}")
    assert len(found) == 11
    assert ht.extract_articles(pages.limit(0)).collect() == []


def test_classes_share_vectors():
    tokens = []
    for path, parent, vector, pages, text in [(1, 0, 7, 4, 0), (2, 1, 7, 4, 0), (3, 2, 9, 3, 0), (5, 4, 8, 4, 0), (2, 2, 7, 4, 99)]:
        tokens.append(dict(path=path, parent=parent, vector=vector, pages=pages, text=text, flags=0, place=path * pages, chars=10, linked=8 if path == 3 else 0))
    slots, content, fixed = ht.deduce(tokens)
    assert set(slots) == {1, 2, 3} and set(content) == {1, 2} and fixed == [99]  # 5 nests in nothing


def extracted(spark, bodies, host="http://h.example.org/"):
    rows = [(i, f"{host}{i}", body) for i, body in enumerate(bodies)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    return [r.text for r in sorted(ht.extract_articles(pages).collect(), key=lambda r: r.page_id)]


def test_heading_below_a_repeated_element(spark):
    cols = "<div class=top><a href=/>Home</a></div><div class=col><h2>T{0}</h2><p>One {0}</p></div><div class=col><p>Two {0}</p><p>Call us now</p></div>"
    rows = "<table><tr><td><h1>T{0}</h1></td><td>One {0}</td></tr><tr><td>Two {0}</td><td>Call us now</td></tr></table>"
    for body in (cols, rows):
        found = extracted(spark, [f"<html><body>{body.format(i)}</body></html>" for i in range(5)])
        assert found == [f"T{i} One {i} Two {i}" for i in range(5)]


def test_template_inside_main_elements(spark):
    notice = "<div class=box>Read our daily letter</div><ul class=more><li><a href=/{0}>Other {0}</a></li></ul>"
    body = "<body><h1><a href=/>Site</a></h1><article><h2><a href=/{0}>T{0}</a></h2><p>One {0}</p>" + notice + "</article></body>"
    assert extracted(spark, [body.format(i) for i in range(5)]) == [f"T{i} One {i}" for i in range(5)]
    second = "<body><a href=/>Site</a><article><p>One and some more {0}</p></article>{1}</body>"
    bodies = [second.format(i, "<article class=rare><p>Two 3</p></article>" if i == 3 else "") for i in range(5)]
    assert extracted(spark, bodies) == [f"One and some more {i}" + " Two 3" * (i == 3) for i in range(5)]


def test_marks_do_not_empty_a_page():
    article = "<article><h1>T</h1><p>Body of it</p></article>"
    assert text(f"<form><div class=menu>m</div>{article}<div id=sidebar>s</div></form>") == "T Body of it"
    for name in ("page-with-sidebar", "layout-sidebar-right", "has-menu-x content-sidebar"):
        assert text(f"<div class='{name}'>{article}<div class=sidebar>side</div></div>") == "T Body of it"
        assert text(f"<div class='{name}'><p>Body of it</p><div class=widget>w</div></div><p>x</p>") == "Body of it x"
        assert text(f"<p>{'long ' * 20}</p><div class='{name}'>{article}</div>") == "T Body of it"
    assert text(f"{article}<section class=related-posts><article>other</article></section><div class=sidebar><article>side</article></div>") == "T Body of it"
    assert text(f"<nav><form>{article}</form></nav><p>k</p>") == "k"
    assert text("<article>the text<div class=comments><article>reply</article></div></article>") == "the text"
    assert text("<article>the text<div class=newsletter>join</div></article>") == "the text"


def test_copies_of_a_page_count_once(spark):
    frame = "<body><div class=top>About this site</div><div class=story><h2>T{0}</h2><p>One {0}</p></div></body>"
    numbers = [0, 0, 0, 0, 0, 1, 2, 3]
    bodies = [frame.format(n) for n in numbers]
    assert extracted(spark, bodies) == [f"T{n} One {n}" for n in numbers]
    assert extracted(spark, bodies, host="/relative/") == [f"T{n} One {n}" for n in numbers]
