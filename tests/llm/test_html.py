import html as entities
import re

import pytest

from firmbook.llm import html
from firmbook.llm.queries import QUERIES


def plain(page: str) -> str:
    """The article of a page of the given table, by its known markup."""
    start = page.index("<article>") + 9
    inner = page[start : page.index("</article>")] if "</article>" in page else page[start:]
    blocks = [" ".join(entities.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split(r"</?p>|</?h1>", inner)]
    return "\n".join(b for b in blocks if b)


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_equals_known_markup(spark, folder):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    found = QUERIES["op2_html_extraction"](spark, folder).collect()
    assert {r.page_id: r.text for r in found} == {i: plain(p) for i, p in pages.items()}
    assert all(r.n_chars == len(r.text) for r in found)


def page(title: str, paragraphs: list[str], extra: str = "") -> str:
    body = "".join(f"<p>{p}" for p in paragraphs)
    return (
        f"<html><head><title>{title}</title></head><body><div class='top'><a href=/>Home</a><span>My site</span></div>"
        f"<table><tr><td class=left><b>Latest news</b> every day</td><td class=mid><h2>{title}</h2>{body}{extra}"
        "<div>Rate this page</div></td></tr></table><div class=end>All the best</div></body></html>"
    )


def test_template_of_a_host_without_telling_names(spark):
    """Nothing names the boilerplate here: only that it is the same on all pages."""
    rows = [(i, f"http://h.example/{i}", page(f"Title {i}", [f"Some text {i}", f"and more {i * i} &amp; x"])) for i in range(12)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.page_id: r.text for r in html.extract(df).collect()} == {
        i: f"Title {i}\nSome text {i}\nand more {i * i} & x" for i in range(12)
    }


def test_noise_inside_and_around_the_article(spark):
    text = """<!doctype html><html><body><header><h1>Site</h1></header><nav><ul><li>Menu</ul></nav>
      <div id="cookie-notice">We use cookies</div><main><article><h2>A &eacute; &#8212; B</h2>
      <p>one<br>two&nbsp;&nbsp;three <b>bold <i>both</b> x</i><p>four<ul><li>five<li>six</ul>
      <aside>aside</aside><form><p>name <input></form><script>if (a < b) { "</p>" }</script><style>p{}</style>
      <div class="ad-box"><p>buy</p></div><section id="comments"><p>first!</p></section>
      <table><tr><td>c1<td>c2</table><p hidden>no</p><div style="display: none">no</div></article></main>
      <div class="sidebar">side</div><footer>&copy;</footer>"""
    df = spark.createDataFrame([(1, "http://x.example/a", text)], "page_id long, url string, html string")
    assert html.extract(df).first().text == "A é — B\none two three bold both x\nfour\nfive\nsix\nc1\nc2"


def test_odd_pages(spark):
    deep = "<div>" * 3000 + "deep" + "</div>" * 3000
    long = "<body><article>" + "<p>word " * 50_000 + "</article>"
    rows = [
        (1, None, None, 1), (2, "http://a.example/", "", 1), (3, "no url", "just text", 1), (4, "http://[bad", "<p>a</b><p>b", 1),
        (5, "http://a.example/x", deep, 1), (6, "http://a.example/y", long, 1), (None, None, "<p>n", 1), (None, None, "<p>n", 1),
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host int")
    found = html.extract(df).collect()
    texts = {r.page_id: r.text for r in found}
    assert len(found) == 8
    assert [texts[i] for i in (1, 2, 3, 4, 5, None)] == ["", "", "just text", "a\nb", "deep", "n"]
    assert texts[6] == "\n".join(["word"] * 50_000)
    assert html.extract(df.where("false")).count() == 0


def test_simple_tree_matching():
    a = ["x", 0, [["p", 0, []], ["q", 0, [["r", 0, []]]], ["s", 0, []]]]
    b = ["x", 0, [["q", 0, [["r", 0, []], ["t", 0, []]]], ["p", 0, []], ["s", 0, []]]]
    size, pairs = html.match(a, b, {})
    assert size == 4 and sorted(pairs) == [(0, 0), (2, 1), (3, 2), (4, 5)]
    assert html.match(a, ["y", 0, []], {}) == (0, [])


def test_content_beside_the_story_is_kept(spark):
    """A lede, a closing line and a table beside the story; one page has blocks that no other has."""
    rows, want = [], {}
    for i in range(12):
        story = [f"Story {i} has a long paragraph {k} " + f"of words {i * k} " * 30 for k in range(4)]
        extra = "<section><p>Only here</section>" if i == 3 else ""
        rows.append((i, "http://h.example/%d" % i, (
            f"<body><div class=top>My site <p>Home</div><div class=all><p class=lede>Lede {i}</p>"
            f"<div class=story>{''.join(f'<p>{p}</p>' for p in story)}</div><h4>Facts {i}</h4><table><tr><td>{i * 7}</table>"
            f"<div class=more>More {i}</div></div>{extra}<div class=end>All the best</div></body>"
        )))
        lines = [f"Lede {i}", *(" ".join(p.split()) for p in story), f"Facts {i}", str(i * 7), f"More {i}"]
        want[i] = "\n".join(lines + (["Only here"] if i == 3 else []))
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.page_id: r.text for r in html.extract(df).collect()} == want


@pytest.mark.parametrize("pages, kept", [(4, True), (5, False)])
def test_template_is_told_from_five_pages_on(spark, pages, kept):
    rows = [(i, "http://h.example/", f"<body><div class=x>All the best</div><div class=y><p>Text {i}</div>") for i in range(pages)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.text for r in html.extract(df).collect()} == {("All the best\n" if kept else "") + f"Text {i}" for i in range(pages)}
