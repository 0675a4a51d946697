"""Main text of pages: planted templates, odd mark-up, and the cut against all labellings."""

import html
import itertools
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from shopsignal.llm import extract
from tests.conftest import SF_MID

STORY = ["A headline of some words", "The first paragraph says what happened, and to whom it did. It has two sentences.",
         "Short one.", "The last paragraph, which is longer again, tells the reader what may come of it in the end."]
NOISE = "Please read what our partners have to say about this, it is worth it. Really."


def article(blocks=STORY):
    return f"<h1>{blocks[0]}</h1>" + "".join(f"<p>{b}</p>" for b in blocks[1:])


TEMPLATES = {
    "semantic": "<html><body><header><p>{n}</p><nav><ul><li><a href=/>Home</a><li><a href=/x>Other</a></ul></nav></header>"
                "<main><article>{a}</article></main><aside><p>{n}</p></aside><footer><p>{n}</p></footer></body></html>",
    "classes": "<body class='has-sidebar'><div id=siteHeader>{n}</div><div class='cookie-notice'><p>{n}</p></div>"
               "<div class='post-content'>{a}</div><div class='sidebar'><p>{n}</p><p>{n}</p></div>"
               "<div class='comments'><div class='comment-content'><p>{n}</p></div><article><p>{n}</p></article></div></body>",
    "nested": "<article><header>{a}</header><div class='ad-slot'>{n}</div><section><p>Inside a section.</p></section>"
              "<form><p>{n}</p><input value='x'><button>Send</button></form><footer><p>{n}</p></footer></article>",
    "unclosed": "<nav><ul><li><a href=/>Home</a></ul><article>{a}</article><p hidden>{n}</p><div style='display: none'>{n}</div>"
                "<div role=dialog>{n}</div><div class=newsletter><p>{n}</div>",
    "form around": "<form>{n}<main>{a}</main></form>",
}


@pytest.mark.parametrize("name", TEMPLATES)
def test_planted_templates(name):
    got = extract.main_text(TEMPLATES[name].format(a=article(), n=NOISE)).split("\n\n")
    assert got == STORY + ["Inside a section."] * (name == "nested")


def test_pages_without_telling_marks(spark):
    """Weights learned from marked pages serve pages of plain divisions."""
    pages = spark.read.parquet(f"{SF_MID}/pages.parquet")
    weights = extract.fit(pages)
    page = ("<body><div><a href=/a>Home</a> <a href=/b>Shop</a> <a href=/c>Contact us</a></div><div>"
            + "".join(f"<div>{b} {b}</div>" for b in STORY[1:2] * 6) + "</div><div><a href=/t>Terms</a></div></body>")
    got = extract.main_text(page, weights).split("\n\n")
    assert got == [f"{STORY[1]} {STORY[1]}"] * 6
    assert weights == extract.fit(pages.repartition(7))


def test_whole_table(spark):
    """Each page's article as a regular expression finds it in this table's one template."""
    pages = spark.read.parquet(f"{SF_MID}/pages.parquet")
    got = {r["page_id"]: (r["url"], r["text"], r["n_chars"]) for r in extract.extract(pages).collect()}
    for r in pages.collect():
        inside = re.sub("</?(p|h1)>", "\0", re.search("<article>(.*?)</article>", r["html"], re.S)[1])
        blocks = (" ".join(html.unescape(re.sub("<[^>]+>", " ", b)).split()) for b in inside.split("\0"))
        text = "\n\n".join(b for b in blocks if b)
        assert got[r["page_id"]] == (r["url"], text, len(text))


def test_odd_rows(spark):
    schema = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("html", T.StringType()),
                           T.StructField("text", T.StringType()), T.StructField("label", T.StringType())])
    long = "<article>" + "<p>One more paragraph, like the others.</p>" * 5000 + "</article>"
    odd = ["", None, "plain words only", "<article>a&amp;b &lt;p&gt; &#x41;&nbsp;&eacute;<br>c\n\t d</article>", "<![CDATA[x]]><!-- c", "<p", "<<<>>>",
           "<script>var t = '</p>';</script><style>p{}</style><title>t</title><template>x</template>", "</div></p></b>", long,
           "<article>" + "<div>" * 3000 + "deep enough" + "</div>" * 10, "<article>x<script>never closed", "\0<article>nul</article>"]
    rows = [(i, "u", h, "?", "?") for i, h in enumerate(odd)] + [(None, None, odd[3], "?", "?")] * 2
    df = spark.createDataFrame(rows, schema)
    out = extract.extract(df)
    got = {r["page_id"]: r for r in out.collect()}
    assert out.columns == ["page_id", "url", "text", "n_chars"] and out.count() == len(rows)
    assert got[0]["text"] == got[1]["text"] == got[7]["text"] == got[8]["text"] == "" and got[0]["n_chars"] == 0
    assert got[3]["text"] == got[None]["text"] == "a&b <p> A é c d" and got[3]["n_chars"] == 15
    assert got[9]["text"].count("\n\n") == 4999 and got[10]["text"] == "deep enough" and got[11]["text"] == "x"
    assert extract.extract(df.limit(0)).collect() == []


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 2**32), st.integers(1, 9))
def test_cut_costs_least(seed, n):
    rng = np.random.default_rng(seed)
    gain = rng.integers(-9, 10, n).tolist()
    edges = [(int(u), int(v), int(rng.integers(0, 8))) for u, v in itertools.combinations(range(n), 2) if rng.random() < 0.5]

    def cost(labels):
        return sum(-g for g, x in zip(gain, labels) if x) + sum(c for u, v, c in edges if labels[u] != labels[v])

    got = extract.min_cut(gain, edges)
    least = min(itertools.product([False, True], repeat=n), key=lambda x: (cost(x), sum(x)))
    assert cost(got) == cost(least) and sum(got) == sum(least)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="<>/!-[]&;=\"'apdivscrbnulto \n\0é", max_size=120))
def test_any_mark_up_is_read(text):
    extract.main_text(text)
    extract.main_text("<article><p>" + text)
