"""Main text: the sample pages against their own markup, trees against plain counting, and sites without helpful markup."""

import html
import math
import re
from collections import defaultdict
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.llm.tables import prose
from tillhouse.llm import site_tree
from tillhouse.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "page_id long, url string, html string, host string, nodes string, main_text string"


def extracted(spark, rows, **options):
    docs = spark.createDataFrame([(k, url, page, "h", "n", "m") for k, (url, page) in enumerate(rows)], SCHEMA)
    found = site_tree.extract_main_text(docs.repartition(3), **options)
    assert found.columns == [*docs.columns, "_main_text"]
    return {row["page_id"]: row["_main_text"] for row in found.collect()}


def main_text(page):
    return "\n\n".join(site_tree.kept_texts(site_tree.parse(page), {}, 0.9, 0.4))


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="no sample data")
def test_sample_pages(spark):
    def plain(page):
        article = re.search(r"<article>(.*?)</article>", page, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:h1|p)>", article)]
        return "\n\n".join(filter(None, blocks))

    pages = {row["page_id"]: row["html"] for row in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    rows = QUERIES["op11_html_extraction"](spark, FOLDER).collect()
    assert {row["page_id"]: row["text"] for row in rows} == {key: plain(page) for key, page in pages.items()}
    assert all(row["n_chars"] == len(row["text"]) for row in rows)


@pytest.mark.parametrize(
    "page, text",
    [
        ("plain &amp; &lt;simple&gt; &copy 2 &bogus; &am", "plain & <simple> © 2 &bogus; &am"),
        ("<p>one<p>two<br>three\n\t four&nbsp;five</p>six", "one\n\ntwo three four five\n\nsix"),
        ("<ul><li>a<li>b</ul><table><tr><td>c<td>d<tr><td>e</table>", "a\n\nb\n\nc\n\nd\n\ne"),
        ("<p><b>un<i>clo</b>sed<p>next</i> one", "unclosed\n\nnext one"),
        ("<script>var a = '<p>no</p>';</script><style>p{}</style><title>no</title>yes<!-- <p>no -->!", "yes!"),
        ("a < b <3 c <p title='x > y'>d</p", "a < b <3 c\n\nd"),
        ("<div>x</p>y</div></div>z <a href=", "xy\n\nz"),
        ("<script>never closed <p>no", ""),
        ("<nav>no<p>no</p></nav><article><header><h1>t</h1></header><p>a</p><aside>no</aside><form>no</form></article>", "t\n\na"),
        ("<div class='with-sidebar'><main><h1>t</h1>a</main><div id=sideBar>no</div></div>", "t\n\na"),
        ("<article>a</article><section class=comments><article class=comment>no</article></section>", "a"),
        ("<p>a <span class='ad'>no <b>no</b></span>b</p><div hidden>no</div><div class=cookie-notice>no</div>", "a b"),
        ("<div class=adventure>a<p id=commentary>b</div>", "a\n\nb"),
        ("", ""),
    ],
)
def test_markup(page, text):
    assert main_text(page) == text


def test_deep_and_long_pages():
    assert main_text("<div>" * 5_000 + "deep" + "</div>" * 4_000) == "deep"
    long = prose(1, 200_000)
    assert main_text(f"<p>{long}</p>" + "<" * 1_000 + "<a" * 20_000) == f"{long}\n\n" + "<" * 1_000
    assert len(main_text("<p>x" * 50_000).split("\n\n")) == 50_000


def plain_trees(pages, least):
    """{host: {node: (importance, styles)}} of (host, html)."""
    counts = defaultdict(lambda: defaultdict(set))
    for host, page in pages:
        main, found = site_tree.features(site_tree.parse(page))
        for node, feature in found:
            counts[host, node][feature].add(main)
    out = defaultdict(dict)
    for (host, node), found in counts.items():
        sizes = {feature: len(mains) for feature, mains in found.items()}
        total = sizes[0] if node & 1 else sum(sizes.values())
        if total < max(least, 2):
            continue
        if node & 1:
            shared = [math.log(n) / math.log(total) for feature, n in sizes.items() if feature]
            value = 1 - sum(shared) / len(shared)
        else:
            value = -sum(n / total * math.log(n / total) for n in sizes.values()) / math.log(total)
        if value < 1 - 1e-9:
            out[host][node] = (value, len(sizes))
    return out


def unmarked(k, paragraphs):
    """A page whose parts are told apart by nothing but how they repeat."""
    body = "".join(f"<p>{prose(100 * k + j, 25)}</p>" for j in range(paragraphs))
    return (
        f"<html><body><div id=a1>Start {'Shop' if k % 2 else 'Store'} Contact</div><div id=b><h2>About {k} {prose(k, 3)}</h2>"
        f"{body}</div><div id=c><p>All rights reserved</p><p>Made by us</p></div></body></html>"
    )


def test_site_without_helpful_markup(spark):
    rows = [("https://a.example/x", unmarked(k, 2 + k % 5)) for k in range(40)]
    rows += [("http://B.example:80/", unmarked(k, 3)) for k in range(3)]
    found = extracted(spark, rows)
    for k in range(40):
        body = [f"About {k} {prose(k, 3)}", *(prose(100 * k + j, 25) for j in range(2 + k % 5))]
        assert found[k] == "\n\n".join(body)
    assert found[40].startswith("Start Store Contact")  # three pages say nothing about what repeats

    docs = spark.createDataFrame(rows, "url string, html string").repartition(4)
    trees = {
        row["host"]: {x["node"] % (1 << 64): (x["importance"], x["styles"]) for x in row["nodes"]}
        for row in site_tree.site_trees(docs, least_pages=2).collect()
    }
    expected = plain_trees([(url.split("/")[2].split(":")[0].lower(), page) for url, page in rows], 2)
    assert trees.keys() == expected.keys()
    for host, nodes in expected.items():
        assert trees[host].keys() == nodes.keys()
        for node, (value, styles) in nodes.items():
            assert trees[host][node] == (pytest.approx(value, abs=1e-9), styles)


def test_copies_of_an_article_are_no_boilerplate(spark):
    rows = [("https://a.example/", unmarked(7, 4))] * 60 + [("https://a.example/", unmarked(k, 3)) for k in range(20, 40)]
    found = extracted(spark, rows)
    assert {found[k] for k in range(60)} == {"\n\n".join([f"About 7 {prose(7, 3)}", *(prose(700 + j, 25) for j in range(4))])}


def test_awkward_rows(spark):
    rows = [(None, None), (None, "<p>a</p>"), ("no host", "b"), ("https://a.example/", None), ("https://a.example/", "")]
    assert extracted(spark, rows) == {0: "", 1: "a", 2: "b", 3: "", 4: ""}
    docs = spark.createDataFrame([(1, "u", "<p>x</p>")] * 3, "page_id long, url string, html string")
    assert [row["main_text"] for row in site_tree.extract_main_text(docs).collect()] == ["x"] * 3
    assert site_tree.extract_main_text(docs.limit(0)).count() == 0
    assert site_tree.extract_main_text(docs.withColumn("n", F.lit(None).cast("int"))).first()["n"] is None
