import html
import itertools
import re

import pandas as pd
import pytest

from evenledger.llm import htmltext
from evenledger.llm.queries import op2_crf


@pytest.fixture(scope="module")
def model():
    return htmltext.train(htmltext.labelled_pages(htmltext.PAGES))


def test_blocks_and_references():
    page = "<body><p>a&amp;b <b>c</b>d<br>e<p>f &#233; &lt;x&gt;<!-- no --><script>var t='</p>'</script></p>g<li>h<li>i</body>"
    assert [t for _, t, _ in htmltext.blocks(page)] == ["a&b cd e", "f é <x>", "g", "h", "i"]


def test_viterbi_against_all_paths():
    scores, moves = [0.3, -1.2, 2.0, -0.4, 0.1], [[0.5, -0.2], [-0.7, 0.4]]

    def value(path):
        return sum(s * p for s, p in zip(scores, path)) + sum(moves[a][b] for a, b in itertools.pairwise(path))

    assert tuple(htmltext.viterbi(scores, moves)) == max(itertools.product((0, 1), repeat=5), key=value)


def test_held_out_pages(model):
    right = total = 0
    for page in htmltext.labelled_pages(150, seed=77):
        found = htmltext.blocks(page)
        got = htmltext.main_text(page.replace(htmltext.MARK, ""), model)
        for _, text, _ in found:
            if len(text) > 25:
                right += (text.replace(htmltext.MARK, "") in got) == (htmltext.MARK in text)
                total += 1
    assert right / total > 0.9


def test_a_page_of_every_part(model):
    page = """<html><head><title>T</title></head><body><header><h1>Site of mine</h1></header><nav><ul><li><a href=x>Home</a><li><a href=y>About</a></ul></nav>
    <div class="cookie-notice">We use cookies. <button>OK</button></div><main><article><h1>The tale of a fox</h1><p>A fox went out, and came home. It was late.</p>
    <div class=ad>Buy now.</div><p>Then it slept &mdash; at last, after all that had been.</p></article><section id="comments"><h3>Comments</h3><div class=comment><p>Nice one, thanks.</p></div></section></main>
    <aside class=sidebar><h3>Related</h3><ul><li><a href=z>Other</a></ul></aside><form><label>Mail</label><input></form><footer>&copy; me</footer></body></html>"""
    assert htmltext.main_text(page, model) == "The tale of a fox A fox went out, and came home. It was late. Then it slept — at last, after all that had been."


def test_tables_pages(spark):
    pages = pd.read_parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r for r in op2_crf(spark, "/root/testdata/sf0.01").collect()}
    assert len(got) == len(pages)
    for key, url, page in zip(pages.page_id, pages.url, pages.html):
        inner = re.search(r"<article>(.*?)(</article>|<footer>|$)", page, re.S)[1]
        want = " ".join(html.unescape(re.sub(r"<(?!/?b>)[^>]*>", " ", inner).replace("<b>", "").replace("</b>", "")).split())
        assert (got[key].url, got[key].text, got[key].n_chars) == (url, want, len(want))


def test_odd_pages(spark, tmp_path, model):
    odd = [None, "", "<", "<p", "plain words", "<div>" * 3000 + "deep" + "</div>" * 10, "&am &quo; <b", "<p>" + "w " * 200_000, "</p></div>x<script>never ends"]
    rows = [(k, None if k == 2 else "u", x, "x", 3) for k, x in enumerate(odd)]
    spark.createDataFrame(rows, "page_id long, url string, html string, text string, key int").write.parquet(f"{tmp_path}/pages.parquet")
    got = {r.page_id: r for r in op2_crf(spark, str(tmp_path)).collect()}
    assert len(got) == len(odd) and got[0].text == got[1].text == ""
    assert all(r.n_chars == len(r.text) for r in got.values()) and got[2].url is None
