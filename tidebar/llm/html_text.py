"""HTML extraction: a linear-chain conditional random field over the leaf blocks of a page.

A page is read into leaf blocks, runs of text between block-level tags, each
with its ancestor tags, the words of their classes and ids, and features of
its text. The field scores a label (main text or not) for each block from
these and from the label before; its weights are fitted to labelled pages by
the likelihood of their labels, and Viterbi decoding picks the best sequence.

The labelled pages are made by labelled_pages() from a fixed seed: articles in
various containers, among and around menus, headers, footers, sidebars,
notices, adverts, forms and comments. Block texts of both labels run from one
word to long junk, so that the field goes by the place more than by the words.

A null or empty page gives an empty text. Unclosed tags and comments run to
the end of the page; a < that starts no tag is text. What a browser never shows is left out (scripts, styles, templates, what
stands in for frames); formulas and drawings keep their text where it stands, and xmp and plaintext, whose content is no
markup, are blocks. A header within an article counts as a header and is left out with its title. The cost is in proportion to a page, however
long or deeply nested. Of sequences that score alike that with the earlier label stands. Rows that
repeat give the same text each. No rows give none; further columns stay, but for those named
like the results, which these replace.
"""

from __future__ import annotations

import html as entities
import random
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Fixed values of HTML: elements that break text into blocks.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body button canvas caption center col colgroup dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe legend li link main menu meta nav noscript object ol optgroup option p pre search section select summary table tbody td template textarea tfoot th thead title tr ul video audio".split()
)
#: Fixed values of HTML: elements without an end tag, those whose content is no markup and never shown, and those whose is shown.
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = frozenset("script style iframe noembed noframes template".split())
PLAIN_TAGS = frozenset("xmp plaintext".split())
#: Elements of drawings that are not shown.
UNSHOWN = frozenset("title desc metadata".split())
TEXT_TAGS = frozenset("title textarea".split())
#: Elements that a start tag of the same family ends.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: A start tag of these ends an open paragraph.
ENDS_P = BLOCK_TAGS - {"button", "canvas", "object", "iframe", "noscript", "template", "video", "audio", "link", "meta", "title", "select", "option", "optgroup", "td", "th", "tr", "col", "body", "head", "html"}

_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>""")
_LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
_NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORD = re.compile(r"[a-z]+")
#: The end of a comment, after its first two hyphens: <!--> and <!---> are whole comments.
_COMMENT = re.compile(r"-{0,1}>|.*?--!?>", re.S)

RATE, EPOCHS, DECAY = 0.3, 12, 1e-4
PAGES = 320


class Block:
    __slots__ = ("text", "tags", "names", "last", "linked")

    def __init__(self, text: str, tags: frozenset, names: frozenset, last: str, linked: int):
        self.text, self.tags, self.names, self.last, self.linked = text, tags, names, last, linked


_NONE: frozenset = frozenset()


def leaf_blocks(page: str | None, known: frozenset | None = None) -> list[Block]:
    """The blocks of a page in its order, with white space made single blanks; blocks without text are left out.

    known: the ancestor tags and words that matter, all if not given. An open element shares the sets of its ancestors
    with the element around it unless it adds to them, so that depth costs no more than a list of open elements.
    """
    page = page or ""
    out: list[Block] = []
    stack: list[tuple[str, frozenset, frozenset]] = []  # tag, tags and words of it and of all around it
    opened: dict[str, int] = {}
    buffer: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        text = " ".join(entities.unescape("".join(buffer)).split())
        if text:
            last, tags, names = stack[-1] if stack else ("", _NONE, _NONE)
            out.append(Block(text, tags, names, last, linked))
        buffer.clear()
        linked = 0

    def enter(tag: str, words: str) -> None:
        _, tags, names = stack[-1] if stack else ("", _NONE, _NONE)
        if tag not in tags and (known is None or f"in={tag}" in known):
            tags = tags | {tag}
        if words:
            found = {w for x in _NAMED.findall(words) for w in _WORD.findall("".join(x).lower())}
            new = {w for w in found - names if known is None or f"name={w}" in known}
            names = names | new if new else names
        stack.append((tag, tags, names))
        opened[tag] = opened.get(tag, 0) + 1

    def close(names: set | frozenset, stop: frozenset = _NONE) -> None:
        """Close the innermost open element of these names, unless one of stop is inside it."""
        if not any(opened.get(t) for t in names):
            return
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in names:
                for t, _, _ in stack[i:]:
                    opened[t] -= 1
                del stack[i:]
                return
            if stack[i][0] in stop:
                return

    at, n = 0, len(page)
    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            lt = n
        if lt > at:
            buffer.append(page[at:lt])
            if opened.get("a"):
                linked += lt - at
        if lt == n:
            break
        if page.startswith("<!--", lt):
            m = _COMMENT.match(page, lt + 4)
            at = m.end() if m else n
            continue
        if page.startswith("<![CDATA[", lt) and (opened.get("svg") or opened.get("math")):
            end = page.find("]]>", lt)
            buffer.append(entities.escape(page[lt + 9 : end if end >= 0 else n]))
            at = end + 3 if end >= 0 else n
            continue
        follows = page[lt + 1 : lt + 2]
        if follows in ("!", "?"):
            end = page.find(">", lt)
            at = n if end < 0 else end + 1
            continue
        if not (follows.isascii() and follows.isalpha()) and not (follows == "/" and page[lt + 2 : lt + 3].isalpha()):
            buffer.append("<")
            at = lt + 1
            continue
        m = _TAG.match(page, lt) or _LOOSE.match(page, lt)
        if not m:  # the tag never ends
            break
        at, tag = m.end(), m[2].lower()
        if m[1]:
            if tag in BLOCK_TAGS:
                flush()
            close({tag})
            continue
        if tag == "br":
            buffer.append(" ")
            continue
        hidden = tag in RAW_TAGS or tag in UNSHOWN and bool(opened.get("svg"))
        if (tag in BLOCK_TAGS or tag in PLAIN_TAGS) and not (hidden and opened.get("svg")):
            flush()
        if tag in ENDS_P or tag in PLAIN_TAGS:
            close({"p"}, frozenset({"button", "td", "th", "table", "div", "article", "section", "body"}))
        if tag in ENDS:
            close(ENDS[tag], frozenset({"ul", "ol", "dl", "table", "select"}))
        if tag in VOID_TAGS or m[3].endswith("/") and tag not in BLOCK_TAGS:
            continue
        if hidden:
            end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
            at = end.end() if end else n
            continue
        if tag in PLAIN_TAGS:
            end = re.compile(r"</xmp\b[^>]*>", re.I).search(page, at) if tag == "xmp" else None
            enter("pre", m[3])
            buffer.append(entities.escape(page[at : end.start() if end else n]))
            flush()
            close({"pre"})
            at = end.end() if end else n
            continue
        enter(tag, m[3])
        if tag in TEXT_TAGS:
            end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
            buffer.append(page[at : end.start() if end else n])
            flush()
            close({tag})
            at = end.end() if end else n
    flush()
    return out


def features(blocks: list[Block]) -> list[list[str]]:
    """For each block the names of the features that it has."""
    out = []
    for i, b in enumerate(blocks):
        words = b.text.count(" ") + 1
        share = b.linked / max(1, len(b.text))
        found = {"any", *(f"in={t}" for t in b.tags), *(f"name={n}" for n in b.names), f"tag={b.last}"}
        found.add(f"words={min(words, 64).bit_length()}")
        found.add("linked=" + ("no" if not b.linked else "all" if share > 0.8 else "some"))
        found.add("ends=" + ("stop" if b.text[-1] in ".!?…" else "other"))
        if "©" in b.text:
            found.add("copyright")
        if i == 0 or i == len(blocks) - 1:
            found.add("edge")
        out.append(sorted(found))
    return out


class Field:
    """Weights of features by label (0: other, 1: main text), and of pairs of labels."""

    def __init__(self, numbers: dict[str, int], state: np.ndarray, step: np.ndarray):
        self.numbers, self.state, self.step, self.known = numbers, state, step, frozenset(numbers)

    def scores(self, rows: list[list[str]]) -> np.ndarray:
        get, state = self.numbers.get, self.state
        return np.array([state[[k for k in map(get, row) if k is not None]].sum(axis=0) for row in rows])

    def decode(self, rows: list[list[str]]) -> list[int]:
        """The best sequence of labels, by Viterbi; the earlier label on ties."""
        if not rows:
            return []
        (aa, ab), (ba, bb) = self.step.tolist()
        scores = self.scores(rows).tolist()
        x, y = scores[0]
        back = []
        for sx, sy in scores[1:]:
            fx, fy = x + aa < y + ba, x + ab < y + bb
            back.append((int(fx), int(fy)))
            x, y = (y + ba if fx else x + aa) + sx, (y + bb if fy else x + ab) + sy
        labels = [int(x < y)]
        for step in reversed(back):
            labels.append(step[labels[-1]])
        return labels[::-1]


def _log_sum(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis=axis)
    return top + np.log(np.exp(a - np.expand_dims(top, axis)).sum(axis=axis))


def fit(pages: list[tuple[list[list[str]], list[int]]]) -> Field:
    """Adaptive gradient ascent on the log likelihood of the labels given the blocks."""
    numbers: dict[str, int] = {}
    for rows, _ in pages:
        for row in rows:
            for f in row:
                numbers.setdefault(f, len(numbers))
    field = Field(numbers, np.zeros((len(numbers), 2)), np.zeros((2, 2)))
    g_state, g_step = np.full(field.state.shape, 1e-2), np.full((2, 2), 1e-2)
    coded = [([np.array([numbers[f] for f in row]) for row in rows], np.array(y)) for rows, y in pages if rows]
    for _ in range(EPOCHS):
        for rows, y in coded:
            n = len(rows)
            s = np.array([field.state[r].sum(axis=0) for r in rows])
            ahead, behind = np.zeros((n, 2)), np.zeros((n, 2))
            ahead[0] = s[0]
            for t in range(1, n):
                ahead[t] = s[t] + _log_sum(ahead[t - 1][:, None] + field.step, 0)
            for t in range(n - 2, -1, -1):
                behind[t] = _log_sum(field.step + (s[t + 1] + behind[t + 1])[None, :], 1)
            whole = _log_sum(ahead[-1], 0)
            slope = -np.exp(ahead + behind - whole)
            slope[np.arange(n), y] += 1
            pairs = np.zeros((2, 2))
            for t in range(1, n):
                pairs -= np.exp(ahead[t - 1][:, None] + field.step + (s[t] + behind[t])[None, :] - whole)
                pairs[y[t - 1], y[t]] += 1
            change = np.zeros_like(field.state)
            for r, d in zip(rows, slope):
                change[r] += d
            change -= DECAY * field.state
            g_state += change**2
            g_step += pairs**2
            field.state += RATE * change / np.sqrt(g_state)
            field.step += RATE * pairs / np.sqrt(g_step)
    return field


_MARK = "⁣"  # stands in the text of blocks of main text, in labelled pages alone


def labelled_pages(n: int = PAGES, seed: int = 11) -> list[tuple[list[Block], list[int]]]:
    """Pages of many makes with a label for each block."""
    rng = random.Random(seed)
    parts = ["".join(rng.choice("bcdfglmnprstv") + rng.choice("aeiouéü") for _ in range(rng.randint(1, 4))) for _ in range(400)]

    def text(kind: int | None = None) -> str:
        kind = rng.randrange(7) if kind is None else kind
        words = [rng.choice(parts) for _ in range((1, 3, 8, 20, 40, 90, 12)[kind])]
        if rng.random() < 0.1:
            words = [w.upper() + "!!" for w in words]
        elif rng.random() < 0.1:
            words = [w + rng.choice(("***", "%%%", " |", "###")) for w in words]
        return " ".join(words).capitalize() + rng.choice((".", ".", ".", "!", "", ","))

    def linked(k: int, tag: str = "li") -> str:
        return "".join(f'<{tag}><a href="/{rng.choice(parts)}">{text(rng.choice((0, 0, 1)))}</a></{tag}>' for _ in range(k))

    def aside() -> str:
        """Something that is not main text."""
        word = rng.choice(
            "ad ads advert advertisement banner sponsor sponsored promo cookie consent gdpr notice alert popup modal newsletter subscribe signup sidebar widget related recommended share social breadcrumb breadcrumbs menu navbar navigation comment comments reply respond disqus footer header masthead toolbar pagination login search copyright disclaimer legal".split()
        )
        sort = rng.randrange(12)
        body = rng.choice((text(), f"<p>{text()}</p><p>{text()}</p>", f"<h3>{text(1)}</h3><ul>{linked(3)}</ul>", f"<div><p>{text()}</p></div>"))
        if sort < 4:
            more = rng.choice(("", "", "-box", "-wrapper", "_inner", " block"))
            return f'<{(t := rng.choice(("div", "div", "section", "p", "ul" if "<" not in body else "div")))} {rng.choice(("class", "id"))}="{word}{more}">{body if t != "p" else text()}</{t}>'
        if sort == 4:
            return f"<nav><ul>{linked(rng.randint(2, 7))}</ul></nav>"
        if sort == 5:
            return f"<aside>{body}</aside>"
        if sort == 6:
            return f"<footer>&copy; {text()}{rng.choice(('', f'<p>{text()}</p>'))}</footer>"
        if sort == 7:
            return f"<header>{rng.choice((text(1), f'<h1>{text(1)}</h1>', f'<p>{text()}</p>'))}</header>"
        if sort == 8:
            return f"<form><label>{text(1)}</label><input><button>{text(0)}</button>{rng.choice(('', f'<p>{text()}</p>'))}<select><option>{text(0)}<option>{text(0)}</select></form>"
        if sort == 9:
            talk = "".join(f'<{t} class="comment"><b>{text(0)}</b><p>{text()}</p></{t}>' for t in ("div", "li", "article")[: rng.randint(1, 3)])
            return f'<{(t := rng.choice(("div", "section")))} id="comments">{rng.choice(("", f"<h2>{text(1)}</h2>"))}{talk}</{t}>'
        if sort == 10:
            return f'<dialog open><p>{text()}</p></dialog>{rng.choice(("", f"<noscript>{text(2)}</noscript>"))}'
        return f'<div role="{rng.choice(("navigation", "banner", "complementary", "contentinfo", "search"))}">{body}</div>'

    def main(k: int) -> str:
        blocks = []
        for _ in range(k):
            t = f"{_MARK}{text()}"
            blocks.append(
                rng.choice(
                    (
                        f"<p>{t}</p>", f"<p>{t}</p>", f"<p>{t}</p>", f"<p>{t}<p>", f"<p><b>{t}<br><p>", f"<h2>{t}</h2>", f"<ul><li>{t}</li><li>{_MARK}{text()}</li></ul>", f"<blockquote><p>{t}</p></blockquote>",
                        f"<pre>{t}</pre>", f"<table><tr><td>{t}</td><td>{_MARK}{text(0)}</td></tr></table>", f"<p>{t} <a href='/x'>{text(1)}</a> {text()}</p>", f"<div>{t}</div>", f"<figure><figcaption>{t}</figcaption></figure>", f"<section><h3>{t}</h3><p>{_MARK}{text()}</p></section>",
                    )
                )
            )
            if rng.random() < 0.12:
                blocks.append(aside())
        title = f"<h1>{_MARK}{text(rng.choice((1, 2)))}</h1>" if rng.random() < 0.8 else ""
        wrap = rng.choice(("article",) * 5 + ("main", "main><article", "article", 'div class="content"', 'div id="content"', 'div class="post entry"', 'div class="article-body"', 'section class="story"', 'article class="post"'))
        ends = "".join(f"</{x.split()[0]}>" for x in reversed(wrap.split("><")))
        return f"<{wrap}>{title}{''.join(blocks)}{ends if rng.random() < 0.95 else ''}"

    out = []
    for _ in range(n):
        before, after = "".join(aside() for _ in range(rng.randint(0, 3))), "".join(aside() for _ in range(rng.randint(0, 3)))
        inner = before + main(rng.choice((0, 1, 3, 6, 12))) + after
        inner = rng.choice((inner, inner, f'<div class="{rng.choice(("page", "wrapper", "container", "site"))}">{inner}</div>'))
        page = f"<!DOCTYPE html><html><head><title>{text(1)}</title><script>var x='<p>';</script></head><body>{inner}</body></html>"
        blocks = leaf_blocks(page)
        labels = [int(_MARK in b.text) for b in blocks]
        for b in blocks:
            b.text = b.text.replace(_MARK, "") or "x"
        out.append((blocks, labels))
    return out


@lru_cache(1)
def trained() -> Field:
    return fit([(features(blocks), labels) for blocks, labels in labelled_pages()])


def main_text(page: str | None, field: Field) -> str:
    blocks = leaf_blocks(page, field.known)
    return "\n".join(b.text for b, label in zip(blocks, field.decode(features(blocks))) if label)


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """pages with the columns text (main text, empty if none) and n_chars (its code points) in place of html."""
    shared = pages.sparkSession.sparkContext.broadcast(trained())  # of a fixed size

    @F.pandas_udf(T.StringType())
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for series in batches:
            yield pd.Series([main_text(p, shared.value) for p in series], dtype=object)

    rest = [F.col(f"`{c}`") for c in pages.columns if c not in (html, "text", "n_chars")]
    return pages.select(*rest, text(F.col(f"`{html}`")).alias("text")).withColumn("n_chars", F.char_length("text").cast("long"))
