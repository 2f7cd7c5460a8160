"""Operator 13: blocks of markup, the labeller, and the text of pages against what the markup of the given pages says."""

import html as markup_rules
import json
import pickle

import numpy as np
import pyarrow.parquet as pq
import pytest

from lakeweave.llm import catalog, pages
from lakeweave.llm.labeller import Blocks, Network, path_tokens, read_blocks, sample_page, teach, vary, verdict
from lakeweave.llm.markup import DEEPEST, INNER, OUTER, leaves

GIVEN = "/root/testdata/sf0.01/pages.parquet"
LONG = "The of theaea thingly anere edti and the theaeres thhe inonha, re at onwh retien of and ershen for inoning."
OTHER = "Ouwh anedinst atention it the ble ofesheen the. Ndstst onnt rehe ononenen atenan. This are."


def texts(html):
    return [leaf.text for leaf in leaves(html)]


@pytest.mark.parametrize("html, found", [
    ("", []), ("  \n ", []), ("<p>a<b>c</b> &lt;x&gt; <i>d<br>e</i><p>f</p>g<!-- x", ["ac <x> d e", "f", "g"]),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>e", ["a", "b", "c", "d", "e"]),
    ("1 < 2 & 3 &amp &copy; &#233;&nbsp;x", ["1 < 2 & 3 & © é x"]),
    ("<head><title>t</title><p>x</p></head><body>y<svg><text>s</text></svg>w", ["y", "w"]),
    ("<script>var a = '<p>x</p>'</script >y<SCRIPT src='a>b'>if (a<b)</SCRIPT>z<style>p{}", ["y", "z"]),
    ("<p title='a>b'>x</p><!doctype html>q<![CDATA[r]]>s<?php y ?>t</p>u</div>v", ["x", "qst", "u", "v"]),
    ("a<!-->b<!-- c --!>d<template>e</template>f<a", ["abd", "f"]), ("<<<", ["<<<"]),
    ("<table><tr><td>a<td>b<tr><th>c</table><dl><dt>d<dd>e<dt>f</dl>", ["a", "b", "c", "d", "e", "f"])])
def test_blocks(html, found):
    assert texts(html) == found


def test_paths_and_links():
    found = leaves('<html><body><div class="mainNav top-2" id=x><ul><li><a href="#">one</a> two</li></ul></div><p>three')
    assert found[0].path == (("html", ()), ("body", ()), ("div", ("main", "nav", "top", "2", "x")), ("ul", ()), ("li", ()))
    assert [(leaf.text, leaf.linked) for leaf in found] == [("one two", 3), ("three", 0)]
    deep = leaves("<div>" * 3000 + "x" + "</div>" * 3000 + "y")
    assert [leaf.text for leaf in deep] == ["x", "y"] and len(deep[0].path) == OUTER + INNER and DEEPEST > OUTER + INNER


@pytest.mark.parametrize("piece", ["<!--", "<script>", '<p "', "<a x='", "<", "</", "<div>x", "<li>x"])
def test_unfinished_markup_takes_linear_time(piece):
    leaves(piece * 20_000)


def given():
    return pq.read_table(GIVEN).to_pylist()


def learn_from(htmls):
    return [json.loads(sample_page(found, 192, 48)) for found in map(leaves, htmls) if found]


def blocks_of(sampled):
    every = [leaf for page in sampled for leaf in page]
    fixed = [tuple((tag, tuple(words)) for tag, words in leaf["path"]) for leaf in every]
    return Blocks([path_tokens(p) for p in fixed], np.concatenate([leaf["hashes"] for leaf in every]), np.array([len(leaf["hashes"]) for leaf in every]),
                  np.array([leaf["measures"] for leaf in every]), [len(p) for p in sampled])


def test_gradients_are_those_of_the_loss():
    sampled = learn_from([r["html"] for r in given()[:3]])
    blocks, network = blocks_of(sampled), Network()
    labels = np.array([bool(x) for page in sampled for x in teach(page)])
    known = np.arange(len(labels)) % 5 > 0
    network.w = {k: v.astype(np.float64) for k, v in network.w.items()}
    _, grads = network.gradients(blocks, labels, known)
    for key, grad in grads.items():
        at = np.unravel_index(np.argmax(np.abs(grad)), grad.shape)
        sides = []
        for step in (1e-4, -2e-4):
            network.w[key][at] += step
            sides.append(network.gradients(blocks, labels, known)[0])
        network.w[key][at] += 1e-4
        assert abs((sides[0] - sides[1]) / 2e-4 - grad[at]) < 1e-3 * abs(grad[at]) + 1e-6, key


def test_labels_do_not_rest_on_the_batch():
    found = [leaves(r["html"]) for r in given()[:20]] + [[], leaves("<p>x</p>" * 700)]
    network = Network()
    whole = network.label(read_blocks(found))
    alone = np.concatenate([network.label(read_blocks([page])) for page in found])
    few = network.label(read_blocks(found), cells=50)
    assert np.allclose(whole, alone, atol=1e-5) and np.allclose(whole, few, atol=1e-5)


def test_varied_pages_keep_their_labels():
    rng = np.random.default_rng(0)
    sampled = learn_from([r["html"] for r in given()[:5]])
    stock = [leaf for page in sampled for leaf, label in zip(page, teach(page)) if label]
    for page in sampled * 20:
        varied, labels = vary(page, teach(page), stock, rng)
        assert len(varied) == len(labels) and labels.count(True) >= teach(page).count(True)


@pytest.fixture(scope="module")
def model(spark, nothing):
    return pages.fit(spark.read.parquet(GIVEN))


def text_of(model, html):
    found = leaves(html)
    return [leaf.text for leaf, p in zip(found, Network(pickle.loads(model)).label(read_blocks([found]))) if p >= 0.5]


def test_other_layouts(model):
    """Parts that no given page has."""
    assert text_of(model, f"""<html><head><title>T</title></head><body><div id="header"><h2>Daily News</h2></div>
        <div class="menu"><ul><li><a href=x>Home</a></li><li><a href=y>Sport</a></li></ul></div>
        <div id="content"><h1>Title of the thing</h1><p>{LONG}</p><p>{OTHER}</p></div>
        <div id="sidebar"><h3>Related</h3><ul><li><a href=z>Some other article here</a></li></ul></div>
        <div id="comments"><h3>2 comments</h3><div class="comment"><p>{OTHER}</p></div><div class="comment"><p>I do not agree.</p></div></div>
        <div id="footer">&copy; 2024 All rights reserved</div></body></html>""") == ["Title of the thing", LONG, OTHER]
    assert text_of(model, f"""<html><body><header><a href=/>Site</a></header><div class="cookie-banner"><p>We use cookies. {OTHER}</p><button>Accept</button></div>
        <main><article><h1>Title</h1><p>{LONG}</p><div class="ad">Buy now</div><p>{OTHER}</p><form><label>Name</label><input><button>Send</button></form></article>
        <section class="comments"><article class="comment"><p>{LONG}</p></article></section></main><footer><p>{OTHER}</p></footer></body></html>""") == ["Title", LONG, OTHER]
    assert text_of(model, f"<html><body><article><h1>A b</h1><p>Short.</p><p>{LONG}</p><p>All rights reserved.</p></article></body></html>") == ["A b", "Short.", LONG, "All rights reserved."]


def expected(html):
    """The text as the markup of the given pages names it."""
    return "\n".join(leaf.text for leaf in leaves(html or "") if verdict(leaf.path))


def test_all_given_pages(spark, model):
    rows = given()
    got = {r["page_id"]: (r["url"], r["text"], r["n_chars"]) for r in catalog.QUERIES["op13_labeller"](spark, GIVEN.rsplit("/", 1)[0]).collect()}
    assert got == {r["page_id"]: (r["url"], expected(r["html"]), len(expected(r["html"]))) for r in rows}
    one = next(r["html"] for r in rows if "<footer>" in r["html"] and "&" in r["html"])
    inner = one[one.index("<article>"):one.index("</article>")]
    plain = [" ".join(markup_rules.unescape(p.replace("<b>", "").replace("<br>", " ").replace("<p>", " ").replace("</b>", "")).split())
             for p in inner.replace("<article><h1>", "").replace("</h1>", "</p>").replace("<br><p>", "</p>").split("</p>")]
    assert expected(one) == "\n".join(p for p in plain if p)


def test_awkward_rows(spark, model):
    rows = given()[:30]
    rows = [(r["page_id"], r["url"], r["html"], "t", 1, 2) for r in rows]
    rows += [(None, None, None, None, None, None), (1, "u", "", "t", 1, 2), (2, None, "<!-- -->", "t", 1, 2), rows[3], rows[3],
             (3, "l", "<article>" + "".join(f"<p>{LONG} {i}</p>" for i in range(20_000)) + "</article>", "t", 1, 2)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string, c0 int, `a.b` int").repartition(3)
    got = pages.extract(df, model)
    assert got.columns == ["page_id", "url", "html", "c0", "a.b", "text"]
    assert sorted(((r["page_id"], r["html"], r["text"], r["c0"]) for r in got.collect()), key=repr) == sorted(
        ((r[0], r[2], expected(r[2]), r[4]) for r in rows), key=repr)


def test_samples(spark, nothing):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert pages.fit(empty) is None and catalog.BUILDS["op13_labeller"](empty).collect() == []
    bare = spark.createDataFrame([(i, "u", None if i % 2 else "") for i in range(9)], "page_id long, url string, html string")
    assert {tuple(r) for r in catalog.BUILDS["op13_labeller"](bare).select("text", "n_chars").collect()} == {("", 0)}
    few = spark.createDataFrame([(i, "u", f"<p>{LONG}" if i == 5000 else None) for i in range(6000)], "page_id long, url string, html string")
    assert len(pages.sample(few, "html", ("page_id", "url"), 40, 192, 48)) == 1
    same = spark.createDataFrame([(1, "u", f"<p>{LONG}")] * 90, "page_id long, url string, html string")
    assert len(pages.sample(same, "html", ("page_id", "url"), 40, 192, 48)) == 40
