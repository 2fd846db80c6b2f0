"""Main text of web pages: a linear-chain conditional random field over the leaf blocks of the page.

A page is cut into blocks of text at block-level tags. A block is described by the tags and class names it is under and by
its own text; a chain of two states, article or not, is decoded by Viterbi. The field is trained on labelled pages: pages
that ``labelled_pages`` composes of the parts that pages have, and a bounded sample of the given pages that name their
main part by an ``article`` or ``main`` tag, whose blocks that tag labels.
"""

from __future__ import annotations

import html as entities
import random
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import slices, table, text_of

#: Pages of the table that a fit takes, about: a documented bound.
SAMPLE_PAGES = 200

# Tags of HTML by what they do.
_BLOCK_TAGS = set(
    "address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html label legend li main menu nav ol optgroup option p pre section select summary table tbody td "
    "tfoot th thead tr ul".split()
)
_VOID_TAGS = set("area base br col embed hr img input link meta source track wbr".split())
#: What is in these is no markup; without an end tag they go on to the end of the page.
_RAW = "script|style|title|textarea"
#: What is in these is not seen; without an end tag of their own they hide nothing.
_HIDDEN = ("svg", "iframe", "template", "noscript")
#: A tag of the first kind ends an open one of the second.
_CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_IN_P = _BLOCK_TAGS - {"body", "html", "button", "label", "option", "optgroup", "select"}

_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({_RAW})(?=[\s/>])[^>]*>.*?(?:</\1\s*>|\Z)|<(/?)([a-z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<[!?/a-z][^>]*>",
    re.I | re.S,
)
_MARK = re.compile(rf"<!--.*?(?:-->|\Z)|<(/?)({_RAW}|{'|'.join(_HIDDEN)})(?=[\s/>])([^>]*)>", re.I | re.S)
_HIDES = re.compile(rf"<(?:{'|'.join(_HIDDEN)})(?=[\s/>])", re.I)
_RAW_ENDS = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in _RAW.split("|")}
_NAMED = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_PART = re.compile(r"[A-Za-z]+")
_WORDS = re.compile(r"[^\W\d_]+")


#: Tags around a block that its features look at, the innermost ones: so that what a page costs grows with its length alone.
DEPTH = 64


@dataclass
class Leaf:
    path: tuple[str, ...]  # what it is under: tags, and their classes, ids and roles
    text: str
    linked: int  # code points in links


def _hidden(page: str) -> dict[int, int]:
    """Where parts that are not seen begin and end. A start tag goes with the end tag that closes it, those in between left
    out; one that nothing closes, or a self-closed svg, begins no such part."""
    spans: dict[int, int] = {}
    if not _HIDES.search(page):
        return spans
    open_at: dict[str, list[int]] = {tag: [] for tag in _HIDDEN}
    at, last = 0, page.rfind(">")  # behind it no tag ends; to look for one from each place there would take the square
    while at <= last and (mark := _MARK.search(page, at)):
        at, tag = mark.end(), (mark[2] or "").lower()
        closed = (mark[3] or "").endswith("/")
        if tag in _RAW_ENDS:
            if not mark[1] and not (closed and open_at["svg"]):
                end = _RAW_ENDS[tag].search(page, at)
                at = end.end() if end else len(page)
        elif tag and mark[1]:
            if open_at[tag]:
                spans[open_at[tag].pop()] = at
        elif tag and not (tag == "svg" and closed):
            open_at[tag].append(mark.start())
    return spans


def leaves(page: str) -> list[Leaf]:
    """The blocks of text of a page, in page order. Scripts, styles, titles and comments hold none. The tags of the head
    are passed over, as either may be left out, and what else a head holds has no text."""
    out: list[Leaf] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    opened: Counter[str] = Counter()  # the tags on the stack
    text: list[str] = []
    linked, at, last = 0, 0, page.rfind(">")

    def flush() -> None:
        nonlocal linked
        if text:
            clean = " ".join(entities.unescape("".join(text)).split())
            if clean:
                out.append(Leaf(tuple(name for _, names in stack[-DEPTH:] for name in names), clean, linked))
            text.clear()
        linked = 0

    hidden = _hidden(page)
    while at <= last and (token := _TOKEN.search(page, at)):
        if token.start() > at:
            text.append(page[at : token.start()])
            if opened["a"]:
                linked += token.start() - at
        at = max(token.end(), hidden.get(token.start(), 0))
        tag = (token[3] or "").lower()
        if not tag or tag in _HIDDEN or token.start() in hidden:
            if token[1] or tag:
                text.append(" ")
            continue
        if tag == "head":
            continue
        if tag in _BLOCK_TAGS:
            flush()
        if token[2]:
            if opened[tag]:
                _close(stack, opened, next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag))
        elif tag in _VOID_TAGS:
            if tag == "br":
                text.append(" ")
        else:
            _close_implied(stack, opened, tag)
            stack.append((tag, _names(tag, token[4])))
            opened[tag] += 1
    rest, comment, _ = page[at:].partition("<!--")  # of what needs no end only a comment is left
    text.append(rest)
    if comment and opened["a"]:
        linked += len(rest)
    flush()
    return out


def _close(stack: list[tuple[str, tuple[str, ...]]], opened: Counter[str], at: int) -> None:
    for tag, _ in stack[at:]:
        opened[tag] -= 1
    del stack[at:]


def _close_implied(stack: list[tuple[str, tuple[str, ...]]], opened: Counter[str], tag: str) -> None:
    """Close what the tag ends without saying so."""
    ends = _CLOSES.get(tag, set()) | ({"p"} if tag in _IN_P else set())
    if not any(opened[t] for t in ends):
        return
    for i in range(len(stack) - 1, -1, -1):
        if stack[i][0] in ends:
            _close(stack, opened, i)
            return
        if stack[i][0] in ("ul", "ol", "dl", "table", "div", "section", "article", "td"):
            return


def _names(tag: str, attributes: str) -> tuple[str, ...]:
    names = [tag]
    if "=" in attributes:
        for m in _NAMED.finditer(attributes):
            names += ["." + part.lower() for part in _PART.findall(m[2] or m[3] or m[4] or "")]
    return tuple(names)


_PUNCTUATION = (".", "!", "?", ":", "…", '"', "»", ")")


def features(leaf: Leaf) -> list[str]:
    """What describes a block: what it is under, and its text."""
    text, words = leaf.text, leaf.text.count(" ") + 1
    out = ["bias", *{"in " + name for name in leaf.path}]
    if leaf.path:
        out.append("tag " + next((n for n in reversed(leaf.path) if n[0] != "."), ""))
    out.append(f"words {min(words.bit_length(), 7)}")
    share = leaf.linked / max(len(text), 1)
    out.append("links " + ("none" if share < 0.05 else "some" if share < 0.5 else "most"))
    out.append("ends a sentence" if text.endswith(_PUNCTUATION) else "ends open")
    if words <= 40:
        out += ["says " + w for w in set(_WORDS.findall(text.lower())) & _TELLING]
    if "©" in text:
        out.append("copyright sign")
    return out


#: Words that short blocks outside articles use; fixed values.
_TELLING = set(
    "accept account ad ads advert advertisement agree all archive archives article articles basket browse by cart categories category "
    "checkout comment comments consent contact continue cookie cookies copyright download email faq follow followers home imprint "
    "impressum join latest leave like login logout menu more navigation newsletter next now offer older password popular posted posts "
    "preferences previous privacy promo promoted promotion read recent register related replies reply reserved respond rights rss search "
    "settings share shop sign sitemap skip sponsored submit subscribe tags terms toggle top trending tweet use username we".split()
)


@dataclass
class Field:
    weights: dict[str, tuple[float, float]]  # of each state, 1: article
    step: np.ndarray  # from state to state
    first: np.ndarray


def decode(leaves_of_page: list[Leaf], field: Field) -> list[bool]:
    """Viterbi: the likeliest chain of states."""
    get, none, back = field.weights.get, (0.0, 0.0), []
    (s00, s01), (s10, s11) = field.step.tolist()
    low, high = field.first.tolist()
    for i, leaf in enumerate(leaves_of_page):
        a = b = 0.0
        for name in features(leaf):
            x, y = get(name, none)
            a += x
            b += y
        if i:
            from_low = (low + s00 >= high + s10, low + s01 > high + s11)
            low, high = max(low + s00, high + s10), max(low + s01, high + s11)
            back.append(from_low)
        low, high = low + a, high + b
    states = [high > low]
    for from_low in reversed(back):
        states.append(not from_low[states[-1]])
    return states[::-1] if leaves_of_page else []


def train(pages: list[tuple[list[Leaf], list[bool]]], steps: int = 150, rate: float = 0.1, penalty: float = 2e-4) -> Field:
    """The field that gives the labels the highest probability, by gradients from the forward-backward recursion."""
    pages = [p for p in pages if p[0]]
    names: dict[str, int] = {}
    at = [(i, j, names.setdefault(name, len(names))) for i, (found, _) in enumerate(pages) for j, leaf in enumerate(found) for name in features(leaf)]
    page, place, name = np.array(at).T
    n, longest = len(pages), max(len(found) for found, _ in pages)
    lengths = np.array([len(found) for found, _ in pages])
    there = np.arange(longest)[None, :] < lengths[:, None]
    label = np.zeros((n, longest), int)
    for i, (_, labels) in enumerate(pages):
        label[i, : len(labels)] = labels
    cell = page * longest + place
    theta = np.zeros(2 * len(names) + 6)
    moment, spread, blocks = np.zeros_like(theta), np.zeros_like(theta), float(lengths.sum())
    target = np.eye(2)[label] * there[..., None]
    pairs = target[:, :-1, :, None] * target[:, 1:, None, :]
    for t in range(1, steps + 1):
        weights, step, first = theta[: 2 * len(names)].reshape(-1, 2), theta[-6:-2].reshape(2, 2), theta[-2:]
        score = np.stack([np.bincount(cell, weights=weights[name, y], minlength=n * longest) for y in (0, 1)], axis=1).reshape(n, longest, 2)
        forward, backward = np.zeros((n, longest, 2)), np.zeros((n, longest, 2))
        forward[:, 0] = score[:, 0] + first
        for j in range(1, longest):
            forward[:, j] = score[:, j] + np.logaddexp(forward[:, j - 1, :1] + step[0], forward[:, j - 1, 1:] + step[1])
        for j in range(longest - 2, -1, -1):
            ahead = (score[:, j + 1] + backward[:, j + 1])[:, None, :] + step[None]
            backward[:, j] = np.where(there[:, j + 1, None], np.logaddexp(ahead[..., 0], ahead[..., 1]), 0.0)
        total = np.logaddexp(forward[:, 0, 0] + backward[:, 0, 0], forward[:, 0, 1] + backward[:, 0, 1])
        chance = np.exp(forward + backward - total[:, None, None]) * there[..., None]
        both = np.exp(forward[:, :-1, :, None] + step + (score + backward)[:, 1:, None, :] - total[:, None, None, None]) * there[:, 1:, None, None]
        off = (chance - target).reshape(-1, 2)
        by_name = np.stack([np.bincount(name, weights=off[cell, y], minlength=len(names)) for y in (0, 1)], axis=1)
        gradient = np.concatenate([by_name.ravel(), (both - pairs).sum((0, 1)).ravel(), (chance - target)[:, 0].sum(0)]) / blocks + penalty * theta
        moment, spread = 0.9 * moment + 0.1 * gradient, 0.99 * spread + 0.01 * gradient**2
        theta = theta - rate * (moment / (1 - 0.9**t)) / (np.sqrt(spread / (1 - 0.99**t)) + 1e-8)
    weights = theta[: 2 * len(names)].reshape(-1, 2)
    return Field({k: (float(weights[i, 0]), float(weights[i, 1])) for k, i in names.items()}, theta[-6:-2].reshape(2, 2), theta[-2:])


# --- labelled pages --------------------------------------------------------------------------------------------------


def by_main_tag(page: str) -> tuple[list[Leaf], list[bool]]:
    """The blocks of a page, labelled by its ``article`` or ``main`` tag; no labels if it has none."""
    found = leaves(page)
    apart = {"nav", "aside", "footer", "form", "header", ".comment", ".comments", ".ad", ".ads"}
    labels = [bool({"article", "main"} & {*leaf.path}) and not apart & {*leaf.path} for leaf in found]
    return (found, labels) if any(labels) else ([], [])


def labelled_pages(count: int = 400, seed: int = 7) -> list[tuple[list[Leaf], list[bool]]]:
    """Pages composed of the parts that pages have, in varying order, markup and number. Blocks of the article begin with
    a mark that is taken off once it has told the label."""
    draw = random.Random(seed)
    mark = "⁣"
    pick, chance = draw.choice, lambda p: draw.random() < p
    telling = sorted(_TELLING)

    def prose(least: int, most: int, end: str = ".") -> str:
        words = ["".join(pick("aeiou") + pick("bcdfglmnprstv") for _ in range(draw.randint(1, 4))) for _ in range(draw.randint(least, most))]
        for i in range(len(words)):
            if chance(0.02):
                words[i] = pick(telling)
            if i % 9 == 8:
                words[i] += pick([".", ",", "?"])
        return " ".join(words).capitalize() + end

    def short() -> str:
        return " ".join(pick(telling) if chance(0.6) else prose(1, 1, "") for _ in range(draw.randint(1, 4))).capitalize()

    def element(tag: str, names: list[str], body: str) -> str:
        kind = pick(["class", "id", "class"])
        return f'<{tag} {kind}="{pick(names)}">{body}</{tag}>' if names and chance(0.85) else f"<{tag}>{body}</{tag}>"

    def menu(tags: list[str], names: list[str]) -> str:
        items = "".join(f'<li><a href="#">{short() if chance(0.5) else prose(1, 2, "")}</a></li>' for _ in range(draw.randint(2, 8)))
        return element(pick(tags), names, f"<ul>{items}</ul>")

    def named(names: list[str], body: str, tag: str | None = None) -> str:
        kind = tag or pick(["div", "section", "aside", "div"])
        return f'<{kind} {pick(["class", "id"])}="{pick(names)}">{body}</{kind}>'

    def paragraph(label: bool) -> str:
        tag = pick(["p"] * 8 + ["blockquote", "li", "pre", "h2", "h3", "td", "dd", "figcaption"])
        body = (mark if label else "") + (prose(1, 6, pick(["", "."])) if tag in ("h2", "h3") or chance(0.15) else prose(8, 120))
        if chance(0.15):
            body = body.replace(" ", ' <a href="#">', 1) + "</a>"
        return {"li": f"<ul><li>{body}</li></ul>", "td": f"<table><tr><td>{body}</td></tr></table>", "dd": f"<dl><dd>{body}</dd></dl>", "figcaption": f"<figure><figcaption>{body}</figcaption></figure>"}.get(tag, f"<{tag}>{body}</{tag}>")

    pages = []
    for _ in range(count):
        notice = lambda: named(["cookie-notice", "consent", "banner", "notice", "cookie-banner", "gdpr", "alert", "popup", "modal"], f"<p>{prose(4, 25) if chance(0.4) else short() + ' ' + prose(2, 15)}</p>" + ("<button>" + short() + "</button>" if chance(0.5) else ""), pick(["div", "div", "section", "aside"]))
        advert = lambda: named(["ad", "ads", "advert", "advertisement", "sponsored", "promo", "ad-banner"], pick(["", "<p>"]) + prose(2, 25))
        form = lambda: f"<form{pick([' class=newsletter', ' id=search', '', ' class=signup'])}><label>{short()}</label><input type=text><button>{short()}</button>{'<p>' + prose(3, 20) if chance(0.4) else ''}</form>"
        comments = lambda: named(["comments", "comment-list", "disqus", "responses", "replies", "reader-comments", "discussion"], (f"<h3>{short()}</h3>" if chance(0.6) else "") + "".join(element(pick(["div", "li", "article", "p"]), ["comment", "reply", "comment-body"], f"<p>{prose(3, 60)}</p>") for _ in range(draw.randint(1, 6))), pick(["section", "div", "ol", "aside"]))
        sidebar = lambda: element("aside", ["sidebar", "related", "widget", "rail"], f"<h3>{short()}</h3><p>{prose(4, 50)}</p>") if chance(0.5) else named(["sidebar", "related", "recommended", "widget", "trending", "rail"], f"<h4>{short()}</h4>" + menu(["div"], []) + f"<p>{prose(4, 40)}</p>", "div")
        title = f"<{pick(['h1', 'h1', 'h2'])}>{mark}{prose(3, 14, pick(['', '.', '?']))}</h1>" if chance(0.9) else ""
        story = [title, *(paragraph(True) for _ in range(draw.randint(1, 14)))]
        for extra in (advert, sidebar, form, comments, notice):
            if chance(0.15):
                story.insert(draw.randint(1, len(story)), extra())
        body = "".join(story)
        main = pick([f"<article>{body}</article>"] * 3 + [f"<main>{body}</main>", f"<main><article>{body}</article></main>", *(f'<div {k}="{c}">{body}</div>' for k, c in (("class", "content"), ("id", "main"), ("class", "post-body"), ("class", "entry-content"), ("class", "article"), ("class", "story"), ("id", "page"))), f"<div>{body}</div>", body])
        before = [menu(["nav", "nav", "div", "header"], ["menu", "nav", "navbar", "navigation", "breadcrumb", "topbar"])]
        if chance(0.6):
            before.append(element(pick(["header", "header", "div"]), ["header", "site-header", "masthead"], f"<p>{short() if chance(0.5) else prose(2, 12)}</p>"))
        after = [element(pick(["footer", "footer", "div"]), ["footer", "site-footer", "bottom"], pick(["", "<p>", "&copy; "]) + (short() if chance(0.4) else "") + " " + prose(2, 20))]
        for extra, place in ((notice, pick([before, after])), (advert, pick([before, after])), (form, pick([before, after])), (sidebar, pick([before, after])), (comments, after)):
            if chance(0.45):
                place.insert(draw.randint(0, len(place)), extra())
        found = leaves("<html><body>" + "".join(before) + main + "".join(after) + "</body></html>")
        labels = [mark in leaf.text for leaf in found]
        pages.append(([Leaf(leaf.path, leaf.text.replace(mark, ""), leaf.linked) for leaf in found], labels))
    return pages


def fit(pages: DataFrame | None = None, html_col: str = "html", sample_pages: int = SAMPLE_PAGES) -> Field:
    """Train on composed pages and on up to ``sample_pages`` of the given ones. Which ones is a matter of their hash."""
    given: list[tuple[list[Leaf], list[bool]]] = []
    if pages is not None:
        drawn = pages.select(text_of(html_col).alias("html")).withColumn("hash", F.xxhash64("html"))
        drawn = drawn.where(F.pmod("hash", F.lit(1 << 20)) < int((1 << 20) * min(1.0, 2 * sample_pages / max(pages.count(), 1))))
        given = [by_main_tag(row.html) for row in drawn.orderBy("hash", "html").limit(sample_pages).collect()]
    return train(labelled_pages() + given)


# --- extraction ------------------------------------------------------------------------------------------------------


def main_text(page: str, field: Field) -> str:
    found = leaves(page)
    return "\n\n".join(leaf.text for leaf, article in zip(found, decode(found, field), strict=True) if article)


def extract(pages: DataFrame, field: Field, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row for each row of ``pages``: page_id, url, text, n_chars.

    Null and empty pages have an empty text, and so have pages without an article. Ids and urls are given back as they
    are, null or repeated. Other columns are not read. One pass, no shuffle.
    """
    rows = pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").alias("url"), text_of(html_col).alias("html"))

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2):
            texts = [main_text(page, field) for page in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in ("page_id", "url"))
    return rows.mapInArrow(extracted, kinds + ", text string, n_chars long")


def op6_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return extract(pages, fit(pages))
