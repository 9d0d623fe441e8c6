"""Main text of web pages: a linear-chain conditional random field over leaf blocks.

A page is cut at its block-level tags into blocks of text. Each block has features of its
ancestors' tags and names and of its own text; a chain model decides for the whole sequence
which blocks belong to the article, as neighbours tend to agree. It is trained on labelled
pages: those of the table that mark their article themselves, at most ``FIT_PAGES`` of them, in
variants that hide the mark, rename it or add other furniture, and a few composed ones.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Labelled pages to fit on, and the longest one in characters.
FIT_PAGES, FIT_CHARS = 150, 60_000
STEPS, RATE, RIDGE = 120, 0.15, 1e-3

#: A tag that isn't closed ends its search at the next "<" outside quotes, so that pages full of
#: broken tags are read in linear time.
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template|svg|iframe)\b[^<>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:\"[^\"]*\"|'[^']*'|[^'\"<>])*+)>"
    r"|<[!?/][^<>]*>",
    re.DOTALL | re.IGNORECASE,
)
NAMES = re.compile(r"""\b(?:class|id|role|itemprop)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
HIDDEN = re.compile(r"display\s*:\s*none|\bhidden\b|aria-hidden\s*=\s*[\"']?true", re.I)

BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html label "
    "legend li main menu nav ol option p pre section select summary table tbody td textarea tfoot "
    "th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: A block-level tag ends an open paragraph; these also end an open one of their kind.
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
            "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
LIMITS = frozenset("ul ol dl table select article section div body".split())

TAG_FEATURES = (
    "nav", "header", "footer", "aside", "article", "main", "section", "form", "li", "table",
    "p", "blockquote", "pre", "head", "figure", "h1", "h2", "h3", "button", "label", "a", "div",
    "select", "menu", "address", "details",
)
#: Parts of class, id and role names, by what they tell.
NAME_FEATURES = {
    "name_nav": ("nav", "menu", "breadcrumb", "pagination", "pager", "toc"),
    "name_side": ("sidebar", "side", "aside", "widget", "complementary", "rail"),
    "name_foot": ("footer", "foot", "copyright", "colophon", "contentinfo"),
    "name_head": ("header", "masthead", "banner", "topbar", "logo"),
    "name_ad": ("ad", "ads", "advert", "advertisement", "sponsor", "sponsored", "promo",
                "promotion", "adsense"),
    "name_comment": ("comment", "comments", "reply", "replies", "disqus", "respond", "discussion",
                     "reader"),
    "name_notice": ("cookie", "consent", "notice", "alert", "popup", "modal", "gdpr", "privacy",
                    "newsletter", "subscribe", "signup", "paywall", "warning", "overlay"),
    "name_share": ("share", "social", "related", "recommended", "tags", "teaser", "more"),
    "name_form": ("form", "search", "login", "contact"),
    "name_main": ("content", "article", "post", "entry", "story", "main", "body", "text",
                  "articlebody", "maincontent"),
}
TEXT_FEATURES = (
    "words_1", "words_5", "words_15", "words_40", "linked", "partly_linked", "stops", "no_stop",
    "first", "legal", "always",
)
FEATURES = (*TAG_FEATURES, *NAME_FEATURES, "hidden", *TEXT_FEATURES)
BIT = {name: 1 << k for k, name in enumerate(FEATURES)}
#: Not a feature: the block lies in what a labelled page marks as its article.
LABEL = 1 << len(FEATURES)
#: Nor this: it lies in furniture, be it inside the article.
NOT_LABEL = LABEL << 1
_OF_NAME = {word: BIT[f] for f, words in NAME_FEATURES.items() for word in words}
LEGAL = re.compile(r"©|\(c\)|all rights reserved|cookie|copyright", re.I)


def _own_bits(tag: str, attributes: str) -> int:
    bits = BIT.get(tag, 0) if tag in TAG_FEATURES else 0
    if attributes:
        for names in NAMES.findall(attributes):
            for name in re.split(r"[^a-z]+", names.lower()):
                bits |= _OF_NAME.get(name, 0)
        if HIDDEN.search(attributes):
            bits |= BIT["hidden"]
        if "data-labelled-main" in attributes:
            bits |= LABEL
        if "data-labelled-not" in attributes:
            bits |= NOT_LABEL
    return bits


class _Open:
    """The open tags of a page, and how many there are of each name."""

    def __init__(self) -> None:
        self.tags: list[tuple[str, int]] = [("", 0)]
        self.counts: Counter[str] = Counter()
        #: Of each open block-level tag, the inline tags open directly in it.
        self.inline: list[Counter[str]] = [Counter()]

    @property
    def bits(self) -> int:
        return self.tags[-1][1]

    def add(self, tag: str, bits: int) -> None:
        self.tags.append((tag, bits))
        self.counts[tag] += 1
        if tag in BLOCKS:
            self.inline.append(Counter())
        else:
            self.inline[-1][tag] += 1

    def cut(self, size: int) -> None:
        """Leaves the outer ``size`` tags open."""
        while len(self.tags) > size:
            tag, _ = self.tags.pop()
            self.counts[tag] -= 1
            if tag in BLOCKS:
                self.inline.pop()
            else:
                self.inline[-1][tag] -= 1

    def end(self, tag: str) -> None:
        """An end tag; that of an inline tag doesn't end blocks."""
        known = self.counts if tag in BLOCKS else self.inline[-1]
        if known[tag]:
            k = len(self.tags) - 1
            while self.tags[k][0] != tag:
                k -= 1
            self.cut(k)

    def before_block(self, tag: str) -> None:
        """A block-level tag ends an open paragraph, and an open one of its kind."""
        ends = {"p", *SIBLINGS.get(tag, ())}
        left = sum(self.counts[name] for name in ends)
        k, size = len(self.tags) - 1, len(self.tags)
        while left and self.tags[k][0] not in LIMITS:
            if self.tags[k][0] in ends:
                left, size = left - 1, k
            k -= 1
        self.cut(size)


def blocks(page: str) -> list[tuple[str, int]]:
    """The text of each leaf block, with references decoded and white space folded, and its bits."""
    out: list[tuple[str, int]] = []
    stack = _Open()
    held: list[str] = []
    linked = 0

    def close() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(held)).split())
        held.clear()
        if text:
            out.append((text, stack.bits | _text_bits(text, linked, not out)))
        linked = 0

    at = 0
    for m in TOKEN.finditer(page):
        piece = page[at:m.start()]
        at = m.end()
        if piece:
            held.append(piece)
            if stack.counts["a"]:
                linked += len(piece)
        tag = m[3]
        if tag is None:
            continue
        tag = tag.lower()
        block = tag in BLOCKS
        if block:
            close()
        if m[2]:
            stack.end(tag)
        elif tag in VOID:
            if tag in ("br", "hr"):
                held.append(" ")
        else:
            if block:
                stack.before_block(tag)
            stack.add(tag, stack.bits | _own_bits(tag, m[4]))
    if page[at:]:
        held.append(page[at:])
    close()
    return out


def _text_bits(text: str, linked: int, first: bool) -> int:
    n = text.count(" ") + 1
    bits = BIT["always"] | (BIT["first"] if first else 0)
    bits |= BIT["words_1" if n < 5 else "words_5" if n < 15 else "words_15" if n < 40
                else "words_40"]
    if linked:
        bits |= BIT["linked" if linked >= 0.7 * len(text) else "partly_linked"]
    bits |= BIT["stops" if text[-1] in ".!?…:;\"”»)" else "no_stop"]
    if n < 40 and LEGAL.search(text):
        bits |= BIT["legal"]
    return bits


@dataclass
class Chain:
    """Weights of the features by label, and of a label after a label."""

    weights: np.ndarray
    steps: np.ndarray

    def decode(self, bits: list[int]) -> list[bool]:
        """The most likely labels of a page's blocks (Viterbi)."""
        if not bits:
            return []
        gains = (_matrix(bits) @ self.weights).tolist()
        (s00, s01), (s10, s11) = self.steps.tolist()
        off, on = gains[0]
        back = []
        for a, b in gains[1:]:
            from_off, from_on = off + s00 >= on + s10, off + s01 >= on + s11
            back.append((0 if from_off else 1, 0 if from_on else 1))
            off, on = (
                a + (off + s00 if from_off else on + s10),
                b + (off + s01 if from_on else on + s11),
            )
        state = int(on > off)
        out = [state]
        for pair in reversed(back):
            state = pair[state]
            out.append(state)
        return [bool(x) for x in reversed(out)]


def _matrix(bits: list[int]) -> np.ndarray:
    each = np.array([b & (LABEL - 1) for b in bits], dtype=np.int64)
    return ((each[:, None] >> np.arange(len(FEATURES))) & 1).astype(np.float64)


def train(pages: list[list[int]]) -> Chain:
    """Fits a chain to the blocks' bits, which hold the labels, by the conditional likelihood."""
    pages = [p for p in pages if p]
    longest = max(map(len, pages))
    facts = np.zeros((len(pages), longest, len(FEATURES)))
    gold = np.zeros((len(pages), longest), dtype=int)
    here = np.zeros((len(pages), longest), dtype=bool)
    for k, p in enumerate(pages):
        facts[k, :len(p)] = _matrix(p)
        gold[k, :len(p)] = [b & (LABEL | NOT_LABEL) == LABEL for b in p]
        here[k, :len(p)] = True
    total = here.sum()
    pairs = here[:, 1:]
    seen = np.zeros((2, 2))
    np.add.at(seen, (gold[:, :-1][pairs], gold[:, 1:][pairs]), 1)
    one_hot = np.stack([(gold == 0) & here, (gold == 1) & here], axis=2).astype(float)
    weights, steps = np.zeros((len(FEATURES), 2)), np.zeros((2, 2))
    moments = [np.zeros_like(weights), np.zeros_like(weights), np.zeros((2, 2)), np.zeros((2, 2))]
    for step in range(1, STEPS + 1):
        gains = facts @ weights
        ahead = np.zeros((len(pages), longest, 2))
        behind = np.zeros((len(pages), longest, 2))
        ahead[:, 0] = gains[:, 0]
        for t in range(1, longest):
            moved = np.logaddexp(ahead[:, t - 1, :1] + steps[0], ahead[:, t - 1, 1:] + steps[1])
            ahead[:, t] = np.where(here[:, t, None], moved + gains[:, t], ahead[:, t - 1])
        for t in range(longest - 2, -1, -1):
            after = behind[:, t + 1] + gains[:, t + 1]
            moved = np.logaddexp(after[:, :1] + steps[:, 0], after[:, 1:] + steps[:, 1])
            behind[:, t] = np.where(here[:, t + 1, None], moved, 0)
        whole = np.logaddexp(ahead[:, -1, 0], ahead[:, -1, 1])[:, None, None]
        chance = np.exp(ahead + behind - whole) * here[:, :, None]
        joint = np.exp(
            ahead[:, :-1, :, None] + steps + (behind + gains)[:, 1:, None, :] - whole[..., None]
        )
        expected = (joint * pairs[:, :, None, None]).sum(axis=(0, 1))
        slope = np.einsum("ptf,ptl->fl", facts, one_hot - chance) / total - RIDGE * weights
        slope_steps = (seen - expected) / total - RIDGE * steps
        for k, (value, g) in enumerate(((weights, slope), (steps, slope_steps))):
            m, v = moments[2 * k], moments[2 * k + 1]
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            value += RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Chain(weights, steps)


ARTICLE = re.compile(r"<(/?)article\b", re.I)
MAIN_NAMES = ("content", "post", "entry-content", "story", "main-content", "article-body", "")
#: Furniture for labelled pages; {} stands for texts of other pages.
FURNITURE = (
    '<header class="masthead"><h2>{}</h2><p>{}</p></header>',
    '<aside class="sidebar"><h3>{}</h3><ul><li><a href="#">{}</a></li></ul><p>{}</p></aside>',
    '<div class="cookie-notice"><p>{}</p><button>{}</button></div>',
    '<form action="/s"><label>{}</label><input name="q"><button>{}</button></form>',
    '<div class="advert"><p>{}</p></div>',
    '<section class="comments"><h3>{}</h3><div class="comment"><p>{}</p></div>'
    '<div class="comment"><p>{}</p></div></section>',
    '<div id="comments"><ol><li class="reply"><p>{}</p></li><li><p>{}</p></li></ol></div>',
    '<div class="related"><h3>{}</h3><ul><li><a href="#">{}</a></li></ul></div>',
    '<div class="menu"><a href="#">{}</a> <a href="#">{}</a></div>',
    '<footer><p>{}</p></footer>', '<div class="newsletter"><p>{}</p></div>',
    '<div class="footer">{}</div>', '<aside><p>{}</p></aside>', '<nav><a href="#">{}</a></nav>',
)


def variants(pages: list[str]) -> Iterator[str]:
    """Each page that marks its article, as it is and with changed marks and other furniture."""
    texts = [t for page in pages for t, _ in blocks(page)] or ["text"]
    dice = np.random.default_rng(9)

    def furniture() -> str:
        form = FURNITURE[dice.integers(len(FURNITURE))]
        form = form.format(*(html.escape(texts[dice.integers(len(texts))]) for _ in range(6)))
        return re.sub(r"^<\w+|(?<=</div>)<div|(?<=</p>)<button", r"\g<0> data-labelled-not", form)

    for page in pages:
        name = MAIN_NAMES[dice.integers(len(MAIN_NAMES))]
        mark = f'class="{name}" data-labelled-main' if name else "data-labelled-main"
        for tag in ("article", "div"):
            yield ARTICLE.sub(
                lambda m, t=tag: f"<{m[1]}{t}" + ("" if m[1] else " data-labelled-main"), page)
        for tag in ("div", "article", "main", "section"):
            known = tag != "div"
            changed = ARTICLE.sub(
                lambda m, t=tag, k=known: f"<{m[1]}{t}" + (
                    "" if m[1] else " data-labelled-main" if k else " " + mark), page)
            start, end = changed.find(f"<{tag} "), changed.rfind(f"</{tag}>")
            if known and 0 <= start < end:
                ends = [m.end() for m in re.finditer("</p>", changed[start:end])]
                inside = start + ends[dice.integers(len(ends))] if ends else end
                end += len(tag) + 3
                changed = "".join((
                    changed[:start], furniture(), furniture(), changed[start:inside],
                    furniture(),
                    changed[inside:end], furniture(), furniture(), changed[end:],
                ))
            yield changed


def composed(n: int = 24) -> list[str]:
    """Pages of invented words, so that there is something to learn from in any table."""
    dice = np.random.default_rng(10)

    def words(low: int, high: int) -> str:
        some = ["".join(dice.choice(list("abdeilmnorstu"), dice.integers(2, 9)))
                for _ in range(dice.integers(low, high))]
        return " ".join(some)

    def furniture() -> str:
        form = FURNITURE[dice.integers(len(FURNITURE))]
        return form.format(*(words(1, 14) + "." * int(dice.integers(2)) for _ in range(6)))

    return [
        f"<html><head><title>{words(3, 9)}</title></head><body><nav><ul>"
        + "".join(f'<li><a href="#">{words(1, 3)}</a></li>' for _ in range(5))
        + f"</ul></nav>{furniture()}{furniture()}<article><h1>{words(3, 9)}</h1>"
        + "".join(f"<p>{words(1 if k % 3 else 8, 80)}.</p>" for k in range(dice.integers(1, 8)))
        + f"</article>{furniture()}<footer>&copy; {words(2, 8)}</footer></body></html>"
        for _ in range(n)
    ]


def labelled_bits(pages: list[str]) -> list[list[int]]:
    return [[bits for _, bits in blocks(page)] for page in variants([*pages, *composed()])]


def fit(pages: DataFrame, fit_pages: int = FIT_PAGES, fit_chars: int = FIT_CHARS) -> Chain:
    marked = (
        pages.filter(F.length("html") <= fit_chars)
        .filter("html rlike '(?i)<article[ >]'")
        .select(F.xxhash64("html").alias("order"), "html")
        .orderBy("order").limit(fit_pages).toArrow()
    )
    return train(labelled_bits(marked.column("html").to_pylist()))


def main_text(page: str | None, chain: Chain) -> str:
    parts = blocks(page or "")
    keep = chain.decode([bits for _, bits in parts])
    return "\n\n".join(text for (text, _), kept in zip(parts, keep, strict=True) if kept)


def extract(
    pages: DataFrame, fit_pages: int = FIT_PAGES, fit_chars: int = FIT_CHARS
) -> DataFrame:
    """page_id, url, text and n_chars (its code points) of each row of ``pages``.

    ``pages`` has page_id, url and html. Blocks of the article are joined by two line feeds; a
    null or empty page, or one without an article, has an empty text. Markup that is cut off or
    closed wrongly is read as far as it goes. Repeated rows stay; other columns are ignored; an
    empty table gives an empty result. The chain is fitted on at most ``fit_pages`` pages that mark
    their article, of at most ``fit_chars`` characters each; all pages are decoded whole.
    """
    pages = pages.select("page_id", "url", "html")
    chain = fit(pages, fit_pages, fit_chars)
    schema = pages.select("page_id", "url").schema.add("text", "string").add("n_chars", "long")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                texts = [main_text(page.as_py(), chain) for page in part.column(2)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())],
                    names=schema.names,
                )

    return pages.mapInArrow(rows, schema)
