import html
import re

import pytest
from brute import SF

from tidemark.llm import html_text

TEXT = "Some words of an article that goes on for a while, and says what there is to say. "


@pytest.fixture(scope="module")
def field():
    return html_text.train(html_text.labelled_pages())


def test_composed_pages_it_has_not_seen(field):
    wrong = right = 0
    for leaves, labels in html_text.labelled_pages(150, seed=99):
        got = html_text.decode(leaves, field)
        wrong += sum(a != b for a, b in zip(got, labels, strict=True))
        right += len(labels)
    assert wrong < 0.02 * right


def test_pages_of_the_table(spark, field):
    got = html_text.extract(spark.read.parquet(f"{SF}/pages.parquet"), field).collect()
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in got:
        article = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        assert r.text == "\n\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


def test_parts_that_are_not_the_article(field):
    page = (
        "<html><head><title>T</title><style>p{}</style></head><body><nav><ul><li><a href=/>Home</a></li><li><a href=/>Contact us</a></li></ul></nav>"
        f"<div class='cookie-notice'><p>We use cookies.</p></div><article><h1>A   title &amp; more</h1><p>{TEXT * 3}<b>bold</b>\n text</p>"
        f"<aside class=related><h3>Related</h3><a href=/>Other story</a></aside><p>{TEXT * 4}<p>{TEXT * 2}</article><div class=ad>Buy now</div>"
        "<form><label>Email</label><button>Subscribe</button></form><section class='comments'><h3>2 comments</h3><div class=comment><p>I like it, but not that much.</p></div></section>"
        "<script>var a = '<p>no</p>';</script><footer>&copy; 2020 All rights reserved</footer></body></html>"
    )
    body = " ".join((TEXT * 3).split())
    assert html_text.main_text(page, field) == "\n\n".join(["A title & more", f"{body} bold text".replace("say. bold", "say. bold"), (TEXT * 4).strip(), (TEXT * 2).strip()])


def test_odd_pages(spark, field):
    rows = [(1, None, None), (2, "u", ""), (None, "u", "<p"), (3, "u", "<p class='x>y"), (3, "u", "<!-- open"), (4, "u", "<article><p>" + TEXT * 5000), (5, "u", "<script>a"), (6, "u", "<div>" * 3000 + TEXT)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    got = html_text.extract(df, field).collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    by = {r.page_id: r for r in got}
    assert by[1].text == by[2].text == by[5].text == "" and by[4].text == (TEXT * 5000).strip()
    assert html_text.extract(df.where("false"), field).count() == 0


def test_long_odd_pages_take_no_more_than_their_length(field):
    """A megabyte each of what once took the square of it."""
    import time

    n = 1 << 20
    pages = ["".join(f"<div>t{i % 10}" for i in range(n // 7)), "<a " * (n // 3), "<p>" + "<a x='" * (n // 6), "<svg " * (n // 5), "<b>" * (n // 6) + "<p>t</p>" * (n // 16) + "</i>" * (n // 8)]
    for page in pages:
        start = time.process_time()
        html_text.leaves(page)
        assert time.process_time() - start < 20
    assert len(html_text.leaves(pages[0])) == n // 7 and html_text.leaves("<p>a</p> b <a c <!-- d")[1].text == "b <a c"


def test_viterbi_is_the_best_chain(field):
    import itertools

    leaves = html_text.labelled_pages(1, seed=5)[0][0][:8]
    score = [[sum(field.weights.get(f, (0, 0))[y] for f in html_text.features(leaf)) for y in (0, 1)] for leaf in leaves]
    value = lambda c: field.first[c[0]] + sum(score[i][y] for i, y in enumerate(c)) + sum(field.step[a][b] for a, b in itertools.pairwise(c))
    best = max(itertools.product((0, 1), repeat=len(leaves)), key=value)
    assert html_text.decode(leaves, field) == [bool(y) for y in best]


BODY = f"<article><h1>A title</h1><p>{TEXT * 3}</p><p>{TEXT * 4}</p></article>"
WANT = "\n\n".join(["A title", (TEXT * 3).strip(), (TEXT * 4).strip()])


@pytest.mark.parametrize(
    "page",
    [
        f"<html><head><title>T</title><meta charset=utf-8><body>{BODY}</body></html>",
        f"<html><head><title>T</title><style>p{{}}</style>{BODY}</html>",
        f"<html><head><title>T</title></head><body>{BODY}</body></html>",
    ],
)
def test_a_head_may_go_unclosed(field, page):
    assert html_text.main_text(page, field) == WANT


HALF = f"<html><head><title>T</title></head><body><article><h1>A title</h1><p>{TEXT * 3}</p>{{}}<p>{TEXT * 4}</p></article>{{}}</body></html>"


@pytest.mark.parametrize("part", ['<svg class="i"/>', "<svg/>", "<svg>", "<svg class=i><path/>", "<iframe src=x>", "<noscript><img src=x>", "<template>"])
@pytest.mark.parametrize("later", ["", "<svg><text>no</text></svg><iframe>no</iframe><noscript>no</noscript><template>no</template>"])
def test_what_nothing_closes_hides_nothing(field, part, later):
    assert html_text.main_text(HALF.format(part, later), field) == WANT


@pytest.mark.parametrize(
    "part",
    [
        "<svg><title>no</title><text>no</text></svg>", "<svg><svg><text>no</text></svg><text>no</text></svg>", "<svg><style/><title/><text>no</text></svg>", "<SVG a='x'><text>no</text></svg >",
        "<template><p>no</p><template><p>no</p></template><p>no</p></template>", "<noscript><p>no</p></noscript>", "<iframe src=x><p>no</p></iframe>", "<script>'<svg>'</script>", "<!-- <template> -->",
    ],
)
def test_what_is_closed_hides_what_is_in_it(part):
    page = HALF.format(part, "")
    assert [leaf.text for leaf in html_text.leaves(page)] == [leaf.text for leaf in html_text.leaves(HALF.format("", ""))]
