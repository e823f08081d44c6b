"""Main text of web pages by tag-path ratios.

Every text node has a root-to-leaf tag path. Per path, text length and punctuation are summed over its nodes
and divided by their number; both ratios are smoothed along the page, fused, and paths whose fused ratio passes a threshold are content. What
a page says about itself is fused in as well: paths inside an article or main element are content, menus, forms and the like never are.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caresift.llm.tables import narrow, read

#: Standard deviations of the fused ratio over a page's nodes that a path has to reach.
THRESHOLD = 1.0
#: What being inside an article or main element adds to the fused ratio, in its standard deviations: at 2 a path inside
#: reaches a threshold of 1 however many nodes are outside, and one outside needs at most twice the ratio it would need alone.
MAIN_WEIGHT = 2.0
#: Weights of a node and its neighbours on either side.
SMOOTHING = (0.25, 0.5, 0.25)

# What HTML says of its elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TEXT = frozenset("iframe noembed noframes noscript script style template textarea title xmp".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data dfn em font i img ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 "
    "h6 header hgroup hr li main menu nav ol p pre section summary table ul dd dt".split()
)
#: Elements that end an open element of the second set when they begin.
ENDS_SAME = {
    "li": {"li"},
    "dd": {"dd", "dt"},
    "dt": {"dd", "dt"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "option": {"option"},
}
SCOPES = frozenset("article aside body div footer form header html main nav section table ul ol dl td th".split())
# Elements, roles and words in class or id that mark what is not main text.
NOT_MAIN_ELEMENTS = frozenset("nav footer aside form button select datalist dialog menu object svg canvas audio video head".split())
NOT_MAIN_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
NOT_MAIN_WORDS = frozenset(
    "ad ads adsense advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer gdpr "
    "menu modal nav navbar navigation newsletter notice popup promo related share sharing sidebar social sponsor sponsored "
    "subscribe toolbar widget".split()
)
MAIN_ELEMENTS, MAIN_ROLES = frozenset(("article", "main")), frozenset(("main", "article"))
#: Headers of the page, not those inside an article.
PAGE_ONLY = frozenset(("header", "masthead"))

_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^<>\"'])*+)>", re.DOTALL
)
#: Tags with a quote that is never closed, and one that the page breaks off in.
_LOOSE = re.compile(r"</?[A-Za-z][^<>]*(?:>|\Z)")
_ATTRIBUTE = re.compile(r"""(?:^|[\s/"'])(class|id|role|hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?(?=[\s/]|$)""", re.IGNORECASE)
_NAME_PARTS = re.compile(r"[^a-z0-9]+")
#: Elements whose class or id says nothing against what is in them, and those that a head may hold.
NEVER_BARRED = frozenset("html body main article".split())
IN_HEAD = frozenset("base basefont bgsound link meta title style script noscript template".split())
#: Bars that count for text that is never shown.
HIDDEN = 1 << 20


class _Node:
    __slots__ = ("path", "main", "barred", "text")

    def __init__(self, path: str, main: bool, barred: int, text: str):
        self.path, self.main, self.barred, self.text = path, main, barred, text


def _named(value: str, words: frozenset) -> bool:
    """Whether a name in a class or id value is one of ``words``, or begins or ends with it."""
    for name in value.split():
        parts = [p for p in _NAME_PARTS.split(name) if p]
        if parts and (parts[0] in words or parts[-1] in words):
            return True
    return False


def _marks(tag: str, attributes: str, inside_main: bool) -> tuple[bool, int]:
    """(opens main text, how much it bars it) of a start tag."""
    main, barred = tag in MAIN_ELEMENTS, tag in NOT_MAIN_ELEMENTS or (tag in PAGE_ONLY and not inside_main)
    if attributes:
        for name, *values in _ATTRIBUTE.findall(attributes):
            value, name = "".join(values).lower(), name.lower()
            if name == "role":
                main |= value in MAIN_ROLES
                barred |= value in NOT_MAIN_ROLES
            elif name == "hidden":
                return main, HIDDEN
            elif tag not in NEVER_BARRED:
                barred |= _named(value, NOT_MAIN_WORDS) or (not inside_main and _named(value, PAGE_ONLY))
    return main, int(barred)


def blocks(page: str) -> list[_Node]:
    """The text blocks of a page in order, with their tag paths; scripts, styles, comments and the head are left out."""
    out: list[_Node] = []
    stack: list[tuple[str, str, bool, int]] = [("", "", False, 0)]
    held: list[str] = []
    place = 0

    def flush() -> None:
        if held:
            text = " ".join(html.unescape("".join(held)).split())
            held.clear()
            if text:
                _, path, main, barred = stack[-1]
                out.append(_Node(path, main, barred, text))

    def close(names) -> None:
        for k in range(len(stack) - 1, 0, -1):
            if stack[k][0] in names:
                flush()
                del stack[k:]
                return
            if stack[k][0] in SCOPES:
                return

    end = len(page)
    while place < end:
        found = _TOKEN.search(page, place)
        if found is None:
            text = _LOOSE.sub(" ", page[place:])
            if stack[-1][0] == "head" and not text.isspace():
                stack.pop()
            held.append(text)
            break
        if found.start() > place:
            text = page[place : found.start()]
            if stack[-1][0] == "head" and not text.isspace():
                stack.pop()
            held.append(text)
        place = found.end()
        tag = found[2]
        if tag is None:
            continue
        tag = tag.lower()
        if found[1]:
            if tag == "br" or (tag in INLINE and tag != "a"):
                continue
            if any(s[0] == tag for s in stack):
                if tag not in INLINE:
                    flush()
                k = max(i for i, s in enumerate(stack) if s[0] == tag)
                del stack[k:]
            elif tag == "p":
                flush()
            continue
        if stack[-1][0] == "head" and tag not in IN_HEAD:
            stack.pop()
        if tag in RAW_TEXT:
            until = _raw_end(tag).search(page, place)
            place = until.end() if until else end
            held.append(" ")
            continue
        if tag in INLINE:
            if tag in ("br", "wbr", "img"):
                held.append(" " if tag == "br" else "")
            continue
        if tag in ENDS_PARAGRAPH:
            flush()
            close({"p"})
        if tag in ENDS_SAME:
            close(ENDS_SAME[tag])
        flush()
        if tag in VOID:
            continue
        main, barred = _marks(tag, found[3], stack[-1][2])
        _, path, was_main, was_barred = stack[-1]
        stack.append((tag, f"{path}/{tag}{'*' * main}", was_main or main, was_barred + barred))
    flush()
    return out


@cache
def _raw_end(tag: str) -> re.Pattern:
    return re.compile(rf"</{tag}[^>]*>", re.IGNORECASE)


def _punctuation(text: str) -> int:
    return sum(1 for c in text if not c.isalnum() and unicodedata.category(c)[0] == "P")


def fused_ratios(nodes: list[_Node]) -> np.ndarray:
    """For every node the smoothed, fused text and punctuation ratio of its path.

    Text counts as the square root of the two ratios' product, so a path needs both prose length and sentence marks.
    """
    paths: dict[str, int] = {}
    at = np.array([paths.setdefault(n.path, len(paths)) for n in nodes])
    length = np.array([len(n.text) for n in nodes], float)
    marks = np.array([_punctuation(n.text) for n in nodes], float)
    count = np.bincount(at)
    text_ratio = (np.bincount(at, length) / count)[at]
    mark_ratio = (np.bincount(at, marks) / count)[at]

    def smooth(x: np.ndarray) -> np.ndarray:
        padded = np.pad(x, 1, mode="edge")
        return sum(w * padded[k : k + len(x)] for k, w in enumerate(SMOOTHING))

    return np.sqrt(smooth(text_ratio) * smooth(mark_ratio))


def main_text(page: str | None, threshold: float = THRESHOLD) -> str:
    """The main text: its blocks in page order, one a line; empty for a null page or one without text."""
    nodes = [n for n in blocks(page or "") if n.barred < HIDDEN]
    if not nodes:
        return ""
    # a bar over all of a page says nothing; what is barred once more inside it stays out
    least = min(n.barred for n in nodes)
    nodes = [n for n in nodes if n.barred == least]
    fused = fused_ratios(nodes)
    fused += np.array([n.main for n in nodes]) * (MAIN_WEIGHT * fused.std() or 1.0)
    line = threshold * fused.std()
    passed: dict[str, list[float]] = {}
    for n, value in zip(nodes, fused.tolist()):
        passed.setdefault(n.path, []).append(value)
    chosen = {p for p, values in passed.items() if sum(values) / len(values) >= line * (1 - 1e-9)}
    return "\n".join(n.text for n in nodes if n.path in chosen)


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages`` (page_id, url, html); other columns are ignored.

    The whole html of any length is read; null or empty html gives an empty text. Repeated rows give repeated rows.
    """
    import pyarrow as pa

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(batch.column(2)[i].as_py()) for i in range(batch.num_rows)]
            columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars"])

    rows = narrow(pages, page_id="page_id", url="url", html="html").withColumn("page_id", F.col("page_id").cast("long"))
    return rows.mapInArrow(work, "page_id long, url string, text string, n_chars long")


def op7_tag_paths(spark, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return extract(read(spark, sf_dir, "pages"))
