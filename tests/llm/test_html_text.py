"""Main text of pages: known articles in pages of many forms, and each rule by itself."""

import html
import random

import pytest

from claimflow.llm import html_text as H

LONG = "The river was so high that the people of the town had to leave their houses and go up to the hill for a night."
MORE = "It is not known who was the first to see the water, but by the morning it was in all of the streets and on the square."


def page(body, head=""):
    return f'<!DOCTYPE html><html lang="en"><head><title>Title of it</title>{head}</head><body class="has-sidebar">{body}</body></html>'


@pytest.mark.parametrize(
    "body, want",
    [
        # unmarked containers: rules alone
        (f'<div>Home</div><ul><li><a href="/a">A</a></li><li><a href="/b">B</a></li></ul><div><p>{LONG}</p><p>Short one.</p><p>{MORE}</p></div>',
         ["Short one.", LONG, MORE]),
        # containers that never hold the article
        (f'<nav>Menu</nav><header><h1>Site</h1></header><article><h1>Head</h1><p>{LONG}</p></article><aside><p>{MORE}</p></aside><footer>&copy; us</footer>',
         ["Head", LONG]),
        (f'<main><h1>Head</h1><p>{LONG}</p><div class="cookie-notice"><p>{MORE}</p></div><section id="comments"><p>{MORE}</p></section></main>',
         ["Head", LONG]),
        (f'<article><header><h1>Head</h1></header><p>{LONG}</p><div class="ad">{MORE}</div><p>End.</p><form><label>Mail</label><p>{MORE}</p></form></article>',
         ["Head", LONG, "End."]),
        (f'<article><p>{LONG}</p></article><div class="comments"><article class="comment"><p>{MORE}</p></article></div>', [LONG]),
        (f'<article><p>{LONG}</p></article><div id="comments"><article><p>{MORE}</p></article></div>', [LONG]),
        # an article inside marked layout, or inside a form that wraps the page
        (f'<div class="page with-sidebar"><article><p>{LONG}</p></article></div>', [LONG]),
        (f'<form id="aspnetForm"><main><p>{LONG}</p></main><p>{MORE}</p></form>', [LONG]),
        # hidden text
        (f'<article><p hidden>{MORE}</p><p style="display: none">{MORE}</p><p>{LONG}</p></article>', [LONG]),
        # a list of links inside the article is a menu, a link in a paragraph is text
        (f'<article><p>{LONG}</p><ul><li><a href=/x>One</a></li><li><a href=/y>Two</a></li></ul><p><a href="/z">{MORE}</a></p><p>End.</p></article>', [LONG, MORE, "End."]),
        # an article of short blocks only, and one without listed stop words
        ("<article><h1>Head</h1><p>One.</p><p>Two.</p></article><p>Not it</p>", ["Head", "One.", "Two."]),
        (f"<article><p>{'漢字かな交じり文。' * 30}</p><p>{'xq zv ' * 40}</p></article>", ["漢字かな交じり文。" * 30, ("xq zv " * 40).strip()]),
    ],
)
def test_articles_in_pages_of_many_forms(body, want):
    got = H.main_text(page(body)).split("\n\n")
    assert sorted(got) == sorted(want)


def test_markup_is_read_as_browsers_do():
    body = (
        '<script>var t="</p><p>no";</script><style>p{}</style><!-- <p>no</p> --><!--> -->'
        '<article><p title="a > b" data-x=\'"\'>a &lt; b &amp;amp; c&nbsp;&#x41;&#66;<br>d<b>e</b>f<p>1 < 2 and 3 > 2'
        "<p class=it's>open <i>italic<p>next</i> one</article><script>open <p>no"
    )
    assert H.main_text(page(body)) == "a < b &amp; c AB def\n\n1 < 2 and 3 > 2\n\nopen italic\n\nnext one"


def test_white_space_of_a_block_is_one_space():
    assert H.main_text("<p> a\n\t b&nbsp; c d </p>") == "a b c d"


def test_empty_and_broken_pages():
    for p in (None, "", "   ", "<", "<p", "<!-- open", "<script>x", "</p>", "<p></p>", "<a href='x", "<td>"):
        assert H.main_text(p) in ("", "<")
    assert H.main_text("plain words") == "plain words"


def test_long_and_deep_pages_take_time_in_proportion():
    deep = "<div>" * 20_000 + "<b>" * 20_000 + LONG + "</div>" * 20_000
    assert H.main_text(deep) == LONG
    quotes = "<p>" + "<a href=\"x' " * 20_000
    H.main_text(quotes)
    many = "".join(f"<p>{LONG} {i}</p>" for i in range(20_000))
    assert H.main_text(many).count("\n\n") == 19_999


def brute_second_pass(blocks, decided):
    """Nearest decided neighbours by scanning outwards from each block."""
    out = []
    for i, b in enumerate(blocks):
        if decided[i] is not None:
            out.append(decided[i])
            continue
        found = {}
        for step in (-1, 1):
            j = i + step
            while 0 <= j < len(blocks):
                lists = b.kind == 2 and b.listed, blocks[j].kind == 2 and blocks[j].listed
                if blocks[j].section == b.section and lists[0] == lists[1] and decided[j] is not None:
                    found[step] = (abs(j - i), decided[j])
                    break
                j += step
        x, y = found.get(-1), found.get(1)
        if not found:
            out.append(True)
        elif x and y and x[1] != y[1]:
            out.append((x if x[0] < y[0] else y)[1] if x[0] != y[0] else b.kind == 2 or b.tag in H.HEADINGS and y[1])
        else:
            out.append((x or y)[1])
    return out


def test_undecided_blocks_follow_their_nearest_decided_neighbours():
    rng = random.Random(5)
    for _ in range(500):
        n = rng.randint(0, 12)
        blocks = [H.Block("x", rng.choice(["p", "h2"]), 0.0, rng.randint(0, 1), rng.choice([0, 2]), rng.random() < 0.5) for _ in range(n)]
        decided = [rng.choice([True, False, None, None]) for _ in range(n)]
        assert H.second_pass(blocks, decided) == brute_second_pass(blocks, decided)


def test_first_pass_rules():
    def block(text, tag="p", links=0.0, kind=0, listed=False):
        return H.Block(text, tag, links, 0, kind, listed)

    assert H.first_pass([block(LONG)]) == [True]
    assert H.first_pass([block("Short.")]) == [None]
    assert H.first_pass([block("x" * 80)]) == [None]
    assert H.first_pass([block(LONG, links=0.4)]) == [None]
    assert H.first_pass([block(LONG, links=0.9)]) == [None]
    assert H.first_pass([block("A", links=1.0, listed=True)] * 2) == [False, False]
    assert H.first_pass([block("© 2024 us")]) == [False]
    assert H.first_pass([block("© 2024 us", kind=2)]) == [None]


def test_random_articles_come_back_whole():
    rng = random.Random(11)
    words = "the of and river stone $$$ &amp; house über para was in to #tag 50% with".split()
    for _ in range(200):
        paragraphs = [" ".join(rng.choices(words, k=rng.choice([1, 3, 30, 80]))) for _ in range(rng.randint(1, 8))]
        body = "".join(
            rng.choice([f"<p>{t}</p>", f"<p>{t}", f"<p><b>{t}<br></p>", f"<div>{t}</div>", f"<blockquote>\n{t}\n</blockquote>"])
            + rng.choice(["", '<div class="ad">the ad of the day is in it</div>', "<!-- x -->"])
            for t in paragraphs
        )
        p = page(f'<nav><ul><li><a href="/x">x</a></ul></nav><article><h1>Of it</h1>{body}</article><footer>the end of it</footer>')
        assert H.main_text(p).split("\n\n") == ["Of it", *map(html.unescape, paragraphs)]


def test_table_of_pages(spark):
    rows = [
        (1, "u1", page(f"<article><p>{LONG}</p></article>"), "a", 5),
        (1, "u1", page(f"<article><p>{LONG}</p></article>"), "a", 5),
        (2, None, None, "b", None),
        (None, "u3", "", None, 1),
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars long")
    got = H.extract_text(df, ["page_id", "url", "text", "n_chars"]).select("row.page_id", "row.text", "text", "n_chars").collect()
    assert sorted(map(tuple, got), key=str) == sorted(
        [(1, "a", LONG, len(LONG)), (1, "a", LONG, len(LONG)), (2, "b", "", 0), (None, None, "", 0)], key=str
    )
    assert H.extract_text(df.limit(0), ["page_id"]).count() == 0
