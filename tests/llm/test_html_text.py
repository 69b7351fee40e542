import html
import random
import re

import numpy as np
import pytest
from helpers import LONG

from stargauge.llm.html_text import (
    ARTICLE, DROPPED, LOOSE, blocks_of, boilerplate_starts, extract_text, host_streams, main_text, repeated_starts, unpacked, with_key,
)
from stargauge.llm.common import table

SHAPE = "page_id long, url string, html string"


def text_of(page):
    return main_text(page, np.zeros(0, np.int64), 8)[0]


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("", ""),
        ("just text", "just text"),
        ("<p>one<p>two</p>three", "one\ntwo\nthree"),
        ("<nav>menu</nav><article><h1>T &amp; U</h1><p><b>a<br><p>b\n c&nbsp;d</article><footer>f</footer>", "T & U\na\nb c d"),
        ("<article><p>x</p><aside>side</aside><div class='comment-list'>no</div><p>y</p></article>", "x\ny"),
        ("<article>a<script>var t='</p>';</script><style>p{}</style><!-- <p>c</p> -->b</article>", "ab"),
        ("<article><p title='a>b'>kept</p><form>f<p>g</p></form><p>cut &am", "kept\ncut &am"),
        ("<main>m <span class=ad>advert</span>n</main><p>loose</p>", "m n\nloose"),
        ("<div class='ad-free'><article><p>kept</p></article></div>", "kept"),
        ("<div class='content related'><article>kept</article></div>", "kept"),
        ("<article>main</article><div class='related'><article>teaser</article></div>", "main"),
        ("<div id='share'><p>all there is</p></div>", "all there is"),
        ("<article><p>text</p><article class='comment'>me too</article></article>", "text"),
        ("<article>text</article><article class='comment'>me too</article>", "text"),
        ("<div class='comments'><div>me too</div></div><p>loose</p>", "loose"),
        ("<div class='menu'><nav>n</nav></div>", ""),
        ("<article><header><h1>Head</h1></header><p>t</p></article><header>top</header>", "Head\nt"),
        ("<article><ul><li>1<li>2</ul><table><tr><td>a<td>b</tr></table></article>", "1\n2\na b"),
        ("<article>a &lt;b&gt; &#233; &eacute; 1 < 2</article>", "a <b> é é 1 < 2"),
        ("<article>open <p", "open"),
        ("<div role='navigation'>n</div><div role=main>body</div>", "body"),
    ],
)
def test_text_of_one_page(page, text):
    assert text_of(page) == text


def test_roles():
    page = "<body>loose<nav>n</nav><article>a</article></body>"
    assert blocks_of(page) == [(LOOSE, "loose"), (DROPPED, "n"), (ARTICLE, "a")]


def plain_starts(streams, pages, k):
    seen = {}
    for s, p in zip(streams, pages):
        for i in range(len(s) - k + 1):
            seen.setdefault(tuple(s[i : i + k]), set()).add(p)
    return [[i for i in range(len(s) - k + 1) if len(seen[tuple(s[i : i + k])]) > 1] for s in streams]


def test_suffix_array_finds_all_repeated_windows():
    draw = random.Random(4)
    for _ in range(30):
        streams = [np.array([draw.randrange(3) for _ in range(draw.randint(0, 40))], np.uint64) for _ in range(5)]
        pages = [1, 2, 3, 3, 4]
        got = repeated_starts(streams, pages, 4)
        assert [g.tolist() for g in got] == plain_starts(streams, pages, 4)


def test_shards_give_the_same_as_one_array(spark):
    draw = random.Random(9)
    rows = [(i, "http://h.example/x", "<p>" + " ".join(draw.choice("abc") for _ in range(draw.randint(0, 30)))) for i in range(25)]
    streams = host_streams(with_key(spark.createDataFrame(rows, SHAPE), "page_id"))

    def starts(shard_tokens):
        found = boilerplate_starts(streams, 5, shard_tokens).collect()
        return {r["key"]: sorted(r["starts"]) for r in found}

    one = starts(1_000_000)
    assert any(one.values()) and starts(60) == one
    local = {r["key"]: unpacked(r["stream"]) for r in streams.collect()}
    keys = sorted(local)
    assert [one.get(k, []) for k in keys] == plain_starts([local[k] for k in keys], keys, 5)


def test_repeated_loose_text_goes_and_unique_runs_stay(spark):
    line = "this site uses many words to say the same thing on every page"
    rows = [(i, "http://h.example/a", f"<div>{line}</div><div>{line} but page {i} tells only this</div>") for i in range(3)]
    rows += [(9, "http://other.example/", f"<div>{line}</div>"), (10, "http://h.example/b", f"<article><p>{line}</p></article>")]
    got = {r["page_id"]: r for r in extract_text(spark.createDataFrame(rows, SHAPE)).collect()}
    assert got[0]["text"].endswith("0 tells only this") and "same thing" not in got[0]["text"]
    assert got[9]["text"] == line and got[10]["text"] == line
    assert got[1]["n_boilerplate"] > 20 and got[1]["n_chars"] == len(got[1]["text"])


def test_odd_rows_and_empty_table(spark):
    rows = [
        (1, None, None), (None, "http://h/", "<p>x"), (2, "", ""), (3, "no url", "<article>" + LONG),
        (4, "http://h/", "<p>y</p>"), (4, "http://h/", "<p>y</p>"),
    ]
    pages = spark.createDataFrame(rows, SHAPE).selectExpr("*", "'extra' AS text", "'extra' AS key", "'extra' AS host")
    got = extract_text(pages).collect()
    assert len(got) == len(rows) and [r["text"] for r in got if r["page_id"] == 4] == ["y", "y"]
    assert [r["text"] for r in got if r["page_id"] in (1, 2)] == ["", ""]
    assert [r["n_chars"] for r in got if r["page_id"] == 3] == [len(LONG.strip())]
    assert extract_text(pages.limit(0)).count() == 0


def test_repeats_decide_beside_articles_and_articles_stay(spark):
    line = "subscribe to our letter and never miss any story that we write here"
    body = [" ".join(f"w{page}x{i}" for i in range(40)) for page in range(3)]
    rows = [
        (i, "http://h.example/a", f"<article><p>{body[i]}</p><p>{line}</p></article><div>{line}</div><div>{i} short loose</div>") for i in range(3)
    ]
    got = {r["page_id"]: r for r in extract_text(spark.createDataFrame(rows, SHAPE)).collect()}
    for i in range(3):
        assert got[i]["text"] == f"{body[i]}\n{line}\n{i} short loose" and got[i]["n_boilerplate"] == len(line.split())


def test_articles_equal_their_paragraphs(spark):
    pages = table(spark, "/root/testdata/sf0.01", "pages")
    got = {r["page_id"]: r["text"] for r in extract_text(pages).collect()}
    for r in pages.collect():
        article = re.search(r"<article>(.*?)</article>", r["html"] or "", re.S)[1]
        blocks = re.split(r"</?(?:h1|p)>", article)
        plain = [" ".join(html.unescape(re.sub(r"<[^>]+>", lambda m: " " if m[0] == "<br>" else "", b)).split()) for b in blocks]
        assert got[r["page_id"]] == "\n".join(b for b in plain if b)
