from __future__ import annotations

import html
import random
import re
from collections import defaultdict

import pyarrow as pa
import pytest

from chatlens.llm import extract
from chatlens.llm.catalog import QUERIES

PAGES = "page_id long, url string, html string"


def pages(spark, rows):
    return spark.createDataFrame(rows, PAGES)


def texts(df) -> dict:
    return {r["page_id"]: r["text"] for r in df.collect()}


@pytest.mark.parametrize(
    ("page", "expected"),
    [
        ("<article><h1>A&amp;B</h1><p>one<b>two</b>\n three <br>four<p>five &am</article>tail", "A&B onetwo three four five &am"),
        ("<nav>menu</nav><main><p>text</p><form>name</form></main><footer>foot</footer>", "text"),
        ("<header><h1>Site</h1></header><article><header><h1>Title</h1><span>by me</span></header><p>text</article>", "Title text"),
        ("<article><p>kept<div class='share-buttons'>share</div><aside>side</aside><p class=ad>buy</p><p>more</article>", "kept more"),
        ("<article>text<section id='comments'><article>reader</article></section></article>", "text"),
        ("<div id=cookieNotice>cookies</div><div class='post-content has-sidebar'><p>body</div><div>rest</div>", "body"),
        ("<script>var t='</p><article>no</article>';</script><article><p>a < b &lt;c&gt; <!-- no --> d</article>", "a < b <c> d"),
        ("<article><p title='a>b'>x</p><ul><li class=ad>no<li>yes</ul><p hidden>no</p><p style='display: none'>no</p></article>", "x yes"),
        ("<article><style>p{}</style><p>cut off <b", "cut off"),
        ("<p>one<p>two<script>never closed <p>three", "one two"),
        ("plain text", "plain text"),
        ("<article></article><p>outside</p>", "outside"),
        ("&nbsp; <p>&#xe9;&eacute;\u00a0x</p>", "éé x"),
        ("<!-- open <p>x</p>", ""),
        ("", ""),
    ],
)
def test_markup(page, expected):
    assert extract.text_of(extract.parse(page), None) == expected


def stated_article(page: str) -> str:
    """What the given pages state, cut out by their own pattern."""
    inner = re.search("<article>(.*?)</article>", page, re.S)[1]
    parts = re.split(r"</?(?:p|h\d|br|li|ul)\b[^>]*>", inner)
    parts = [" ".join(html.unescape(re.sub(r"</?\w+[^>]*>", "", x)).split()) for x in parts]
    return " ".join(x for x in parts if x)


def test_query_on_given_pages(spark, sf):
    given = {r["page_id"]: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    found = QUERIES["op13_host_suffix_array"](spark, sf)
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    rows = found.collect()
    assert len(rows) == len(given)
    for r in rows:
        assert r["text"] == stated_article(given[r["page_id"]]["html"]) and r["n_chars"] == len(r["text"])
        assert r["url"] == given[r["page_id"]]["url"]


def brute(rows: list[tuple]) -> dict:
    """Every substring of DEPTH tokens of every page against all pages of its host."""
    parsed = {p: extract.parse(h) for p, _, h in rows}
    on: dict = defaultdict(set)
    host = {p: re.match("http://([^/]*)", u)[1] for p, u, _ in rows}
    grams = lambda p: [tuple(parsed[p].stream[k : k + extract.DEPTH]) for k in range(len(parsed[p].stream) - extract.DEPTH + 1)]
    for p in parsed:
        for gram in grams(p):
            on[host[p], gram].add(p)
    return {p: extract.text_of(parsed[p], [k for k, g in enumerate(grams(p)) if len(on[host[p], g]) > 1]) for p in parsed}


def unstated(seed: int, n: int) -> list[tuple]:
    """Pages without an article: lines of their own between lines that hosts repeat, some of them on every page."""
    rng = random.Random(seed)
    common = [" ".join(f"c{rng.randint(0, 30)}" for _ in range(rng.randint(3, 14))) for _ in range(12)]
    rows = []
    for k in range(n):
        own = [" ".join(f"o{rng.randint(0, 400)}" for _ in range(rng.randint(1, 12))) for _ in range(3)]
        lines = own + [common[0]] + rng.sample(common, 3)
        rng.shuffle(lines)
        rows.append((k, f"http://h{k % 3 if k % 2 else 0}/{k}", "".join(f"<{t}>{x}</{t}>" for x in lines for t in [rng.choice(["p", "div", "li"])])))
    return rows


@pytest.mark.parametrize("partitions", [1, 7, 60])
def test_matches_brute_force(spark, partitions):
    """Also with more ranges than suffixes of a line, so that equal ones lie across several."""
    rows = unstated(partitions, 60)
    expected = brute(rows)
    whole = {p: extract.text_of(extract.parse(h), None) for p, _, h in rows}
    assert sum(expected[p] != whole[p] for p in whole) > 30 and any(expected.values())
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert texts(extract.main_text(pages(spark, rows))) == expected
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_link_lists_inside_an_article_are_left_to_the_host(spark):
    links = "<ul><li><a href=x>read more of our stories here today</a></li></ul>"
    line = "<p>the same prose of many words stands on both pages</p>"
    rows = [(k, "http://h/", f"<article>{line}{links}<p><a>link{k} no{k} one{k} else{k} has{k}</a> </p></article>") for k in range(2)]
    found = texts(extract.main_text(pages(spark, rows)))
    assert found == {k: f"the same prose of many words stands on both pages link{k} no{k} one{k} else{k} has{k}" for k in range(2)}


def test_the_array_judges_a_stated_article(spark):
    """A card that every page of the host has is no article where the page has more words of its own; an article published twice is one."""
    card = "<article><p>" + " ".join(f"subscribe{k}" for k in range(40)) + "</p></article>"
    own = {k: " ".join(f"own{k}x{j}" for j in range(60)) for k in range(4)}
    menu = "<div>home news sport weather travel culture opinion</div>"
    cards = [(k, "http://cards/", f"{menu}{card}<div>{own[k]}</div><div class=ad>advert{k}</div>") for k in range(4)]
    prose = " ".join(f"word{j}" for j in range(300))
    twice = [(10 + k, "http://twice/", f"{menu}<article><p>{prose}</p></article><div>posted on day {k}</div>") for k in range(2)]
    parts = [(20 + k, "http://parts/", f"<article><p>{prose}</p><p>{own[k]}</p></article><div>{'more of it ' * 200}{k}</div>") for k in range(2)]
    once = [(30, "http://once/", cards[0][2])]
    found = texts(extract.main_text(pages(spark, cards + twice + parts + once)))
    assert [found[k] for k in range(4)] == [own[k] for k in range(4)]
    assert found[10] == found[11] == prose and [found[20 + k] for k in range(2)] == [f"{prose} {own[k]}" for k in range(2)]
    assert found[30] == " ".join(f"subscribe{k}" for k in range(40))


def test_every_suffix_of_stated_prose_is_in_the_array(spark):
    """One word of its own anywhere makes prose an article, and what stands in another page's article is repeated in open text."""
    prose = [f"word{j}" for j in range(300)]
    page = f"<div>a menu of the site stands here</div><article><p>{' '.join(prose)}</p></article>"
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([2]), pa.array([page])], ["host", "page", "html"])
    made = [r for x in extract._suffixes(iter([batch])) for r in x.to_pylist()]
    assert sorted(k for r in made for k in r["starts"]) == [0, 1, *range(7, 7 + 300 - extract.DEPTH + 1)]

    size = 40
    card = [f"subscribe{j}" for j in range(size)]
    own = {k: " ".join(f"own{k}x{j}" for j in range(60)) for k in range(size + 1)}
    cards = {k: " ".join(card[:k] + [f"reader{k}"] * (k < size) + card[k + 1 :]) for k in range(size + 1)}
    rows = [(k, "http://cards/", f"<article><p>{cards[k]}</p></article><div>{own[k]}</div>") for k in cards]
    whole = [(100 + k, "http://open/", f"<article><p>{' '.join(prose)}</p></article>" if k else f"<p>{' '.join(prose[40:50])} here only</p>") for k in range(2)]
    found = texts(extract.main_text(pages(spark, rows + whole)))
    assert [found[k] for k in range(size)] == [cards[k] for k in range(size)] and found[size] == own[size]
    assert found[100] == "here only" and found[101] == " ".join(prose)


def test_common_passages_share_a_chosen_suffix():
    rng = random.Random(4)
    long = extract.SPARSE + extract.DEPTH - 1
    for _ in range(200):
        passage = [f"p{rng.randint(0, 9)}" for _ in range(long)]
        pair = [[f"{name}{rng.randint(0, 9)}" for _ in range(rng.randint(0, 60))] for name in "abcd"]
        one, other = (extract.chosen_suffixes(x + passage + y) for x, y in (pair[:2], pair[2:]))
        assert set(one) & set(other)
    assert len(extract.chosen_suffixes([f"t{k}" for k in range(10_000)])) < 10_000 * 3 / extract.SPARSE


def test_suffixes_go_out_in_bounded_batches():
    """Pages that state no article have a suffix for each token; a task holds a few pages' suffixes, not those of all its pages."""
    tokens = 3_000
    html = ["<p>" + " ".join(f"t{k}x{j}" for j in range(tokens)) + "</p>" for k in range(100)]
    ids = pa.array(range(100), pa.int64())
    made = list(extract._suffixes(iter([pa.RecordBatch.from_arrays([ids, ids, pa.array(html)], ["host", "page", "html"])])))
    assert max(x.num_rows for x in made) < 100_000
    rows = [r for x in made for r in x.to_pylist()]
    assert len(rows) == len({r["gram"] for r in rows}) == 100 * (tokens - extract.DEPTH + 1)
    assert all(r["host"] == r["page"] for r in rows)
    assert sorted((r["page"], *r["starts"]) for r in rows) == [(k, j) for k in range(100) for j in range(tokens - extract.DEPTH + 1)]
    assert sum(x.num_rows for x in extract._suffixes(iter([]))) == 0


def test_awkward_and_empty_tables(spark):
    line = "<div>one two three four five six seven</div>"
    rows = [
        (1, "http://h/a", line), (1, "http://h/a", line), (None, None, None), (None, None, ""), (2, None, "<p>no host</p>"),
        (3, "not an address", "<p>odd</p>"), (4, "http://H:80/b", "<i>x" + "y" * 300_000), (5, "http://u@g/", "<div><p>" * 3_000 + "deep"),
        (6, "http://g/", None), (7, "http://t/", line), (8, "HTTP://T?x", line + "<p>rest</p>"),
    ]
    df = pages(spark, rows)
    for name in ("page", "host", "text", "starts", "gram", "n"):
        df = df.selectExpr("*", f"'theirs' AS {name}")
    found = extract.main_text(df).collect()
    assert len(found) == len(rows)
    by_id = defaultdict(list)
    for r in found:
        by_id[r["page_id"]].append(r["text"])
    assert by_id[1] == ["one two three four five six seven"] * 2  # one page given twice is not repeated across pages
    assert by_id[None] == ["", ""] and by_id[2] == ["no host"] and by_id[3] == ["odd"] and by_id[6] == [""]
    assert by_id[4] == ["x" + "y" * 300_000] and by_id[5] == ["deep"]
    assert by_id[7] == [""] and by_id[8] == ["rest"]
    assert extract.main_text(pages(spark, [])).count() == 0
