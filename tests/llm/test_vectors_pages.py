"""Searches and page extraction against plain versions of themselves."""

import itertools
import math

import numpy as np
import pytest

from airgrid.llm import mincut, onebit, products
from airgrid.llm import vectors as V

SCHEMA = "vec_id long, embedding array<float>, label int, score string"


def table(spark, n=400, dims=16, seed=0):
    rng = np.random.default_rng(seed)
    data = rng.normal(size=(n, dims)) * rng.lognormal(0, 0.7, (n, 1))
    data[100:200] = data[100]  # copies
    rows = [(i, [float(x) for x in v], 1, None) for i, v in enumerate(data)]
    odd = [(1000, None), (1020, [float("nan")] * dims), (1040, [float("inf")] + [0.0] * (dims - 1)), (1060, [None] * dims), (1080, [0.0] * dims), (None, [1.0] * dims)]
    return spark.createDataFrame(rows + rows[:3] + [(i, v, None, "x") for i, v in odd], SCHEMA), np.float32(data).astype(float)


def test_products_against_all_pairs(spark, work, monkeypatch):
    monkeypatch.setattr(V, "CANDIDATES", 30)
    monkeypatch.setattr(V, "QUERIES", 7)
    df, data = table(spark)
    whole = {i: np.floor(64 * v) for i, v in enumerate(data)} | {1080: np.zeros(16)}
    want = []
    for q in (i for i in whole if i % 20 == 0):
        ranked = sorted((-int(whole[q] @ v), i) for i, v in whole.items() if i != q)[:20]
        want += [(q, r, i, -s) for r, (s, i) in enumerate(ranked, 1)]
    assert sorted(map(tuple, products.top_products(df, work).collect())) == sorted(want)
    assert products.top_products(df.limit(0), work).collect() == []
    few = products.top_products(df.where("vec_id in (0, 1, 2)"), work).collect()
    assert [(r["query_id"], r["rank"]) for r in sorted(few)] == [(0, 1), (0, 2)]


def test_vectors_of_a_repeated_id_all_count(spark, work):
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (1, [0.5, 0.0]), (1, [2.0, 0.25]), (2, [0.25, 4.0]), (2, [0.25, 4.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted((r["rank"], r["vec_id"], r["score"]) for r in products.top_products(df, work, k=3).collect())
    assert got == [(1, 2, 4 * 4096), (2, 1, 2 * 4096), (3, 1, 2048)]
    got = sorted((r["rank"], r["vec_id"], round(r["score"], 4)) for r in onebit.nearest(df, work, k=3).collect())
    assert got == [(1, 1, 1.0), (2, 2, round(4 / 16.0625**0.5, 4)), (3, 1, round(2 / 4.0625**0.5, 4))]


def test_pruning_loses_nothing():
    rng = np.random.default_rng(1)
    for spread in (0.01, 1.0):
        c = rng.normal(size=(500, 8)) * rng.lognormal(0, spread, (500, 1))
        c = c[np.argsort(-np.linalg.norm(c, axis=1))]
        lengths = np.linalg.norm(c, axis=1)
        units = (c / lengths[:, None]).T
        for q in rng.normal(size=(20, 8)):
            for rank in (1, 5, 100, 400):
                bound = np.sort(c @ q)[-rank]
                alive = products.survivors(c, lengths, units, q, bound)
                assert set(np.flatnonzero(c @ q >= bound)) <= set(alive)
                assert rank > 5 or len(alive) < 500


def test_products_beyond_doubles_are_exact():
    big = np.full((2, 3), 2.0**27)
    big[1, 0] -= 1
    assert products.products(big, big)[0].tolist() == [3 * 2**54, 3 * 2**54 - 2**27]


def test_neighbours_against_all_pairs(spark, work, monkeypatch):
    monkeypatch.setattr(V, "CANDIDATES", 50)
    df, data = table(spark, 600, 32)
    unit = data / np.linalg.norm(data, axis=1, keepdims=True)
    got = onebit.nearest(df, work).collect()
    hit = 0
    for q in range(0, 600, 50):
        cos = unit @ unit[q]
        mine = sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == [1, 2, 3, 4, 5]
        assert all(r["score"] == pytest.approx(cos[r["vec_id"]], abs=1e-12) for r in mine)
        assert [(-r["score"], r["vec_id"]) for r in mine] == sorted((-r["score"], r["vec_id"]) for r in mine)
        hit += len({r["vec_id"] for r in mine} & {i for _, i in sorted((-round(c, 12), i) for i, c in enumerate(cos) if i != q)[:5]})
    assert hit / 60 >= 0.9
    copies = sorted((r["rank"], r["vec_id"]) for r in got if r["query_id"] == 150)
    assert copies == [(k, 99 + k) for k in range(1, 6)]  # ties go to the smallest ids
    assert {r["query_id"] for r in got} == set(range(0, 600, 50))
    assert onebit.nearest(df.limit(0), work).collect() == []


def test_unequal_widths_are_padded(spark, work):
    rows = [(0, [1.0, 0.0]), (1, [1.0]), (2, [0.5, 0.5, 0.5]), (3, [-1.0, 0.1])]
    got = onebit.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), work).collect()
    assert [r["vec_id"] for r in sorted(got, key=lambda r: r["rank"])] == [1, 2, 3]
    got = products.top_products(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), work).collect()
    assert [(r["vec_id"], r["score"]) for r in sorted(got, key=lambda r: r["rank"])] == [(1, 4096), (2, 2048), (3, -4096)]


def test_error_bound_holds_for_nearly_all():
    rng = np.random.default_rng(5)
    data, queries = onebit.units(rng.normal(size=(2000, 64))), onebit.units(rng.normal(size=(50, 64)))
    about, error = onebit.estimates(onebit.encode(data), 2000, 64, queries)
    assert (np.abs(about - queries @ data.T) <= error).mean() > 0.97


def brute_cut(scores, smooth):
    def cost(labels):
        return sum(abs(s) for s, x in zip(scores, labels, strict=True) if x != (s > 0)) + sum(w for (i, j), w in smooth.items() if labels[i] != labels[j])

    return min(map(cost, itertools.product((False, True), repeat=len(scores)))), cost


def test_minimum_cut_against_all_labellings():
    rng = np.random.default_rng(6)
    for _ in range(150):
        n = int(rng.integers(1, 9))
        scores = rng.normal(0, 1, n).tolist()
        smooth = {(i, j): float(rng.uniform(0, 2)) for i in range(n) for j in range(i + 1, n) if rng.random() < 0.5}
        least, cost = brute_cut(scores, smooth)
        assert math.isclose(cost(mincut.min_cut(scores, smooth)), least, abs_tol=1e-6)


PAGE = (
    "<html><head><title>T</title><script>var a='</p>';</script><style>p{}</style></head><body><header><h1>Site</h1></header>"
    "<nav><ul><li><a href='/a'>Menu one</a></li></ul></nav><div class='cookie-banner'>We use cookies. Accept them now please.</div>"
    "<div id=content><h1>Story &amp; title</h1><p><b>One long\n paragraph<br>of text, with words enough to count.<p>Short &lt;one&gt;."
    "<div class='ad'>Buy now this thing.</div><!-- x --><blockquote>Quoted text, good.</blockquote></div>"
    "<aside><p>Related story text which is long enough to be mistaken, for content surely.</p></aside>"
    "<section class=comments><article class=comment><p>I like this article, it is great and long.</p></article></section>"
    "<form><label>Name</label><input></form><footer>&copy; All rights.</footer></body></html>"
)


def test_article_without_the_rest():
    assert mincut.main_text(PAGE) == "Story & title One long paragraph of text, with words enough to count. Short <one>. Quoted text, good."


def test_elements_inside_running_text():
    text = "<p>A paragraph with words enough to count as text.</p>"
    plain = "A paragraph with words enough to count as text."
    for start in ("<video src=x>", "<button>Share", "<svg>", "<select><option>One", "<canvas>", "<audio>", "<object>", "<datalist>"):
        tag = start[1:].split(">")[0].split()[0]
        assert mincut.main_text(f"{start}<article>{text}{text}</article>") == f"{plain} {plain}"
        assert mincut.main_text(f"<article>{text}{start}{text}</article>") == f"{plain} {plain}"
        nested = f"<article>{text}<{tag}>Gone <{tag}>words</{tag}> here <p>and here</p></{tag}>{text}</article>"
        assert mincut.main_text(nested) == f"{plain} {plain}"
        assert mincut.main_text(f"<article><p>A paragraph <{tag}>Gone</{tag}>with words enough to count as text.</article>") == plain
        outer = f"<article><p>Some words that are enough to count here. <{tag}>Gone</p>{text}</{tag}></article>"
        assert mincut.main_text(outer) == f"Some words that are enough to count here. {plain}"
    formula = "<article><p>The sum of <math><mrow><mi>x</mi><mo>+</mo><mn>1</mn></mrow></math> is the number that we want here.</p></article>"
    assert mincut.main_text(formula) == "The sum of x+1 is the number that we want here."


def test_hints_can_be_outweighed():
    words = "This paragraph of the article has quite a few words, and it says what it means."
    for mark in ("<h2 id='how-to-share-data'>Title</h2>", "<h2 id='related-work'>Title</h2>", "<h2 id='search-results'>Title</h2>"):
        assert mincut.main_text(f"<article>{mark}<p>{words}</p><p>{words}</p></article>") == f"Title {words} {words}"
    for page in (
        f"<article><p>{words}</p><section id='discussion'><p>{words}</p><p>{words}</p></section></article>",
        f"<article><p>{words}</p><p class='notice'>{words}</p><p>{words}</p></article>",
        f"<article><p>{words}</p><p class='comment-on-method'>{words}</p><p>{words}</p></article>",
    ):
        assert mincut.main_text(page) == f"{words} {words} {words}"
    boxes = "".join(f"<div class='{c}'><p>Buy or share or answer this now, it is good.</p></div>" for c in ("ad", "comments", "newsletter", "cookie-banner"))
    assert mincut.main_text(f"<div class='comments'><p>{words}</p></div><article><p>{words}</p>{boxes}</article>") == words


FIRST = "The council met on Tuesday evening to talk about the new bridge, which many people in the town have been waiting for since the old one was closed."
SECOND = "After two hours of talk the plan was agreed, and work is due to begin in the spring if the money can be found before the end of the year."
STORY = f"<article><h1>The bridge</h1><p>{FIRST}</p><p>{SECOND}</p></article>"


def inside(more):
    return f"<article><h1>The bridge</h1><p>{FIRST}</p>{more}<p>{SECOND}</p></article>"


@pytest.mark.parametrize("body,kept", [
    (f"<form action='/'><div>{STORY}</div><input></form>", ""),
    (f"<div class='social-science'>{STORY}</div>", ""),
    (f"<div class='layout-sidebar-right'>{STORY}<div class='sidebar'><p>Most read today in the paper by our readers.</p></div></div>", ""),
    (inside("<ul><li><a href='/1'>First plan of the bridge</a></li><li><a href='/2'>Second plan</a></li></ul>"), "First plan of the bridge Second plan "),
    (inside("<fieldset><legend>Costs</legend><p>The bridge costs four million.</p></fieldset>"), "Costs The bridge costs four million. "),
    (inside("<div><p>Ok</p></div>"), "Ok "),
    (f"{STORY}<div class='user-feedback'><p>I think this is a very good idea, and it should have been done years ago.</p><p>No, it is far too dear for us.</p></div>", ""),
    (f"<noscript><img src=x>{STORY}", ""),
    (f"{STORY}<section class='comments'><article><p>{SECOND} {FIRST}</p></article><article><p>{SECOND} {SECOND}</p></article></section>", ""),
    (f"{STORY}<aside><div><div><p>{FIRST}</p></div></div></aside>", ""),
    (f"<aside><article class='card'><p>{SECOND}</p></article></aside>{STORY}", ""),
    (inside("<form><p>Sign up for our letter, which comes each week with all the news of the town.</p><label>Mail</label></form>"), ""),
    ("<div>" * 5000 + STORY, ""),
], ids=["form", "topic", "layout", "links", "fieldset", "short", "feedback", "noscript", "comments", "aside", "card", "inner form", "deep"])
def test_wrappers_and_neighbours_of_an_article(body, kept):
    menu = "<nav><ul><li><a href='/'>Home</a></li><li><a href='/n'>News</a></li></ul></nav>"
    page = f"<html><head><title>x</title></head><body>{menu}{body}<footer><p>Copyright 2024 The Paper. All rights reserved.</p></footer></body></html>"
    assert mincut.main_text(page) == f"The bridge {FIRST} {kept}{SECOND}"


def test_a_page_without_an_article_keeps_its_short_paragraphs():
    assert mincut.main_text(f"<div><p>{FIRST}</p><p>{SECOND}</p><p>Ok</p></div>") == f"{FIRST} {SECOND} Ok"


def test_odd_pages(spark):
    long = "<article>" + "<p>Words of a very long page.</p>" * 5000
    pages = [(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (3, "v", ""), (4, "v", "a < b"), (None, "w", "<p"), (5, "x", long), (6, "y", "<a 'b>c" * 300), (7, "z", "<article>x&#xD800;y.</article>")]
    got = mincut.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    by = {r["page_id"]: r for r in got}
    assert len(got) == len(pages) and sum(r["page_id"] == 1 for r in got) == 2
    assert (by[2]["text"], by[2]["n_chars"], by[3]["text"], by[None]["text"]) == ("", 0, "", "")
    assert by[5]["text"] == " ".join(["Words of a very long page."] * 5000) and all(r["n_chars"] == len(r["text"]) for r in got)
    assert mincut.extract(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []
