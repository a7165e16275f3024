import itertools
import random
import re
from html import unescape

from pyspark.sql import functions as F

from ledgerlink.llm import main_text as op
from ledgerlink.llm.main_text_query import op11_main_text

SF = "/root/testdata/sf0.001"


def cost(side, unary, edges):
    return sum(max(u, 0) if not s else max(-u, 0) for s, u in zip(side, unary, strict=True)) + sum(w for (i, j), w in edges.items() if side[i] != side[j])


def test_cut_is_minimal_and_least():
    rng = random.Random(7)
    for _ in range(1500):
        n = rng.randint(0, 8)
        unary = [rng.randint(-9, 9) for _ in range(n)]
        edges = {(i, j): rng.randint(1, 9) for i, j in itertools.combinations(range(n), 2) if rng.random() < 0.4}
        sides = list(itertools.product([False, True], repeat=n))
        least = min(cost(s, unary, edges) for s in sides)
        best = min((s for s in sides if cost(s, unary, edges) == least), key=sum)
        assert tuple(op.minimum_cut(unary, edges)) == best


def test_flow_runs_on_what_merging_leaves_open():
    n = 400  # alternating weak evidence under strong smoothness: no node is decided by itself
    unary = [3 if i % 3 else -5 for i in range(n)]
    edges = {(i, i + 1): 7 for i in range(n - 1)}
    assert op.minimum_cut(unary, edges) == [True] * n


def test_every_article_of_the_given_pages(spark):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = op11_main_text(spark, SF).collect()
    assert len(rows) == len(pages)
    for r in rows:
        inner = re.search(r"<article>(.*?)</article>", pages[r["page_id"]], re.S)[1]
        inner = re.sub("<[^>]*>", "", re.sub(r"</?(?:p|h1|br)[^>]*>", " ", inner))
        assert r["text"] == " ".join(unescape(inner).split()) and r["n_chars"] == len(r["text"])


LONG = "It rained for most of the week, and the river rose above the lower road before anyone had moved the boats."


def test_page_furniture_is_left_out():
    page = f"""<html><head><title>Head</title><style>p{{}}</style></head><body class="has-sidebar">
      <div id="top-nav"><a href="/">Home</a> <a href="/a">About us all</a></div><header><p>{LONG} Header.</p></header>
      <div class="main-content"><h1>The &eacute;lan&nbsp;of
         rivers</h1><p>{LONG} One.<div class="cookie-notice">We use cookies, and we would like you to agree to this long sentence.</div>
      <p>{LONG} <b>Two &amp;amp; <i>three</i></b>.<div class=ad>{LONG} Buy it.</div><ul><li>first item<li>second item</ul>
      <script>var s = "<p>no</p>";</script><table><tr><td>cell a<td>cell b</table></div>
      <div class="sidebar"><p>{LONG} Aside.</p></div><section id="comments"><article class="comment"><p>{LONG} Agreed!</p></article></section>
      <form><label>Your name</label><textarea>x</textarea><button>Send</button></form><footer>&copy; 2020 {LONG}</footer>"""
    assert op.extract(page) == f"The élan of rivers {LONG} One. {LONG} Two &amp; three. first item second item cell a cell b"


def test_pages_without_hints_go_by_shape():
    menu = "".join(f'<div><a href="/{i}">Link {i}</a></div>' for i in range(8))
    assert op.extract(f"<body>{menu}<div>{LONG}</div><div>{LONG} More.</div>{menu}") == f"{LONG} {LONG} More."
    assert op.extract(f"<form action=/><article><p>{LONG}</p></article></form>") == LONG  # a form that holds the page
    assert op.extract(f'<div hidden><p>{LONG}</p></div><p style="display: none">{LONG}</p>') == ""


def test_malformed_markup():
    assert op.extract("a < b and c > d; it is so.") == "a < b and c > d; it is so."
    assert op.extract("<p>one</b> two</div> three and four.") == "one two" + " three and four."
    assert op.extract("<!-- open " + LONG) == "" and op.extract("<script>" + LONG) == ""
    assert op.extract(f'<p class="x>{LONG}') in ("", LONG)
    assert op.extract("<article>" + "<div>" * 3000 + LONG) == LONG
    deep = op.extract("<article>" + "".join(f"<p>{LONG} {i}" for i in range(20_000)))  # a very long page
    assert deep.count(LONG) == 20_000 and deep.endswith("19999")


def test_null_empty_repeated_and_extra_columns(spark):
    rows = [(1, "u", f"<article><p>{LONG}</article>"), (1, "u", f"<article><p>{LONG}</article>"), (2, None, None), (None, "v", ""), (3, "w", "<br>\n&nbsp;")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("TEXT", F.lit("x")).withColumn("_text", F.lit(1))
    out = op.main_text(pages)
    assert out.columns == ["page_id", "url", "html", "TEXT", "_text", "__text"]
    assert sorted((r["page_id"] or 0, r["__text"]) for r in out.collect()) == [(0, ""), (1, LONG), (1, LONG), (2, ""), (3, "")]
    assert op.main_text(pages.limit(0)).count() == 0
