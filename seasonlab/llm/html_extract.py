"""Main text of HTML pages by the maximum-scoring subsequence.

A page is read as a sequence of words and tags. Words score by the kind of
element around them, tags score negative, with weights fitted on labelled pages.
One linear scan finds the contiguous stretch with the largest sum; what lies in
menus, adverts, forms and the like inside that stretch is left out of the text.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seasonlab.llm.common import bound_batches, own_names
from seasonlab.llm.html_labels import LABELLED

TOKEN = re.compile(
    r"<!--(?P<comment>.*?)(?:--!?>|\Z)|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^'\">]|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<close2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<rest2>[^>]*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)",
    re.S,
)
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: Their content is not markup.
RAW = frozenset("script style textarea title noscript template iframe svg math object canvas xmp noembed noframes".split())
#: Of these, markup that is skipped as elements: they end with their parent if nothing closes them.
SKIPPED = RAW - frozenset("script style textarea title xmp".split())
#: What they hold is never main text.
ASIDE_TAGS = frozenset("nav header footer aside form menu button select dialog fieldset label datalist option head address".split())
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
#: Words of a class or id that say the same.
ASIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb breadcrumbs "
    "header masthead footer foot sidebar side aside widget comment comments reply replies discussion disqus notice notices cookie cookies consent "
    "gdpr popup modal overlay share sharing social related recommended newsletter subscribe signup login search toolbar pagination pager copyright "
    "disclaimer legal hidden skip warning alert".split()
)
#: Of the words, those that also name a layout around the whole page ("no-sidebar", "with-nav").
LAYOUT_WORDS = frozenset("banner nav navbar navigation menu header masthead footer foot sidebar side aside widget overlay search toolbar hidden".split())
#: Words that an article may use of its own parts ("legal-history", "warning"); around it they say that something is aside.
PROSE_WORDS = frozenset("alert copyright disclaimer hidden legal login notice notices promotion search skip warning".split())
#: Words that name a place, not a content: inside an article an aside word counts only if its class says nothing else.
PLACE_WORDS = frozenset(
    "area bar block bottom box card col column container content desktop inline inner item items left link links list main mobile module outer panel post "
    "right row section slot text top unit wrap wrapper".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Fewer words than this without the end of a sentence are a label rather than prose.
PROSE_BLOCK = 5
SENTENCE_END = re.compile(r"[.!?\u2026:;,\"'\u201d\u00bb)\u3002\uff01\uff1f]\s*\Z")
MAIN_TAGS = frozenset(("article", "main"))
#: Inline elements do not end a block.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q ruby rb rt rp s samp small span strike strong sub sup time tt u var wbr nobr".split()
)
#: They end an element that is skipped and that nothing closes.
BREAKS_OUT = frozenset("article main section div p h1 h2 h3 h4 h5 h6 ul ol table blockquote pre".split())
CLOSED_BY_BLOCK = frozenset(("p",))
ATTRIBUTE = re.compile(r"""\b(class|id|role|style|hidden|aria-hidden)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
SPLIT_WORDS = re.compile(r"[^a-z]+")


def _aside_words(value: str, inside_main: bool) -> frozenset[str]:
    """The words of a class or id that say aside. Inside an article only those of names that say nothing else, and none of its own parts'."""
    if not inside_main:
        return ASIDE_WORDS.intersection(SPLIT_WORDS.split(value))
    found: set[str] = set()
    for name in value.split():
        words = set(SPLIT_WORDS.split(name)) - {""}
        if words <= ASIDE_WORDS | PLACE_WORDS:
            found |= words & ASIDE_WORDS - PROSE_WORDS
    return frozenset(found)


def _aside(name: str, rest: str, inside_main: bool = False) -> str:
    """Whether an element holds something else than main text, by its name, role, class, id or being hidden.

    ``layout`` if it may as well be a wrapper of the page, ``words`` if class or id
    say what it holds, ``always`` if it is never main text; empty if it isn't aside.
    """
    if name in ASIDE_TAGS:
        return "layout" if name == "form" else "always"
    if not rest or name in ("html", "body") or name in MAIN_TAGS:
        return ""
    found = ""
    for key, value in ATTRIBUTE.findall(rest):
        key, value = key.lower(), value.strip("\"'").lower()
        if key in ("class", "id"):
            words = _aside_words(value, inside_main)
            if words:
                found = "layout" if words <= LAYOUT_WORDS and found != "words" else "words"
        elif key == "role":
            if value in ASIDE_ROLES:
                return "always"
        elif key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "style" and "display:none" in value.replace(" ", "")):
            return "always"
    return found


def _walk(page: str, wrappers: frozenset[int], sizes: list[tuple[int, str, int]]) -> Iterator[tuple[str, str, str]]:
    """Tokens of a page, where elements that begin at ``wrappers`` aren't aside; ``sizes`` gets place, kind and words of the others that may be."""
    stack: list[tuple[str, str, int, str, int]] = []  # element, the context inside it, its place, its kind of aside, words before it
    at, words = 0, 0
    context = "plain"
    closed_at: dict[str, int] = {}  # where a skipped element's name is closed next

    def part_of() -> str:
        """Whether a text is part of a link (``a``) or of a heading (``h``)."""
        names = [entry[0] for entry in stack]
        return "a" if "a" in names else "h" if HEADINGS.intersection(names) else ""

    def pop() -> str:
        name, _, place, kind, before = stack.pop()
        if kind in ("layout", "words"):
            sizes.append((place, kind, words - before))
        return name

    for m in TOKEN.finditer(page):
        if m.start() < at:  # inside a raw element
            continue
        if m.start() > at and context != "skipped":
            text = page[at : m.start()]
            words += len(text.split())
            yield context, part_of(), text
        at = m.end()
        name = m["name"] or m["name2"]
        if name is None:
            if m["comment"] is not None and context != "skipped":
                yield "comment", m["comment"], ""
            continue
        name = name.lower()
        if m["close"] or m["close2"]:
            skipped = context == "skipped"
            if any(entry[0] == name for entry in stack):
                while pop() != name:
                    pass
                context = stack[-1][1] if stack else "plain"
            if not skipped or context != "skipped":
                yield "tag", name, ""
            continue
        rest = m["rest"] or m["rest2"] or ""
        if name in RAW and name not in SKIPPED and not rest.endswith("/"):
            ended = re.compile(rf"</{re.escape(name)}\s*[^>]*>", re.I).search(page, at)
            at = ended.end() if ended else len(page)
            if context != "skipped":
                yield "tag", name, ""
            continue
        if context == "skipped" and name in BREAKS_OUT:
            outer = next(i for i, entry in enumerate(stack) if entry[1] == "skipped")
            skipped = stack[outer][0]
            if closed_at.get(skipped, -1) < at:
                ended = re.compile(rf"</{skipped}\b", re.I).search(page, at)
                closed_at[skipped] = ended.start() if ended else len(page)
            if closed_at[skipped] == len(page):
                while len(stack) > outer:
                    pop()
                context = stack[-1][1] if stack else "plain"
        if name not in VOID and not rest.endswith("/"):
            if name not in INLINE and stack and stack[-1][0] in CLOSED_BY_BLOCK and context != "skipped":
                pop()
                context = stack[-1][1] if stack else "plain"
            inside, kind = context, ""
            if context != "skipped":
                kind = _aside(name, rest, context == "main")
                if name in SKIPPED:
                    inside = "skipped"
                elif context not in ("aside", "perhaps") and kind and m.start() not in wrappers:
                    inside = "aside"
                elif name in MAIN_TAGS and context == "aside" and not any(entry[0] in MAIN_TAGS for entry in stack):
                    # a wrapper of the page around its article; an article among comments and the like is only perhaps the page's
                    around = {entry[3] for entry in stack if entry[2] not in wrappers} - {""}
                    inside = "main" if around == {"layout"} else "perhaps" if "always" not in around else "aside"
                elif context == "perhaps" and kind:
                    inside = "aside"
                elif name in MAIN_TAGS and context != "aside" and context != "perhaps":
                    inside = "main"
            if context != "skipped" and inside == "skipped":
                yield "tag", name, ""
            stack.append((name, inside, m.start(), kind, words))
            context = inside
            if inside == "skipped":
                continue
        if context != "skipped":
            yield "tag", name, ""
    if at < len(page) and context != "skipped":
        words += len(page[at:].split())
        yield context, part_of(), page[at:]
    while stack:
        pop()
    sizes.append((-1, "", words))


def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """``(kind, name, text)`` of a page in order: kind ``tag``, ``comment`` or the context of a text (aside, main, plain; name tells links and headings).

    An element that would be aside by a layout word, or as a form, is a wrapper if it
    holds more than half of the page's words; by another word, if without it nothing is left.
    """
    sizes: list[tuple[int, str, int]] = []
    found = list(_walk(page, frozenset(), sizes))
    total = sizes[-1][2]

    def said(kinds: tuple[str, ...]) -> bool:
        return any(kind in kinds and text.strip() for kind, _, text in found)

    for kinds in (("layout",), ("layout", "words")):
        if said(("main", "perhaps")) or (len(kinds) == 2 and said(("plain",))):
            break
        wrappers = frozenset(place for place, kind, words in sizes if kind in kinds and 2 * words > total)
        if wrappers:
            found = list(_walk(page, wrappers, []))
    perhaps = "aside" if said(("main",)) else "main"
    return iter([(perhaps if kind == "perhaps" else kind, name, text) for kind, name, text in found])


def _by_block(found: list[tuple[str, str, str]]) -> list[tuple[str, str, str]]:
    """Plain text told apart by its block: ``link`` if most of its words are links, ``heading``, ``label`` if it is short and no sentence, else ``plain``.

    A page without prose has its labels as such, or else its links and headings.
    """
    out, block = list(found), []

    def settle() -> None:
        texts = [out[i] for i in block]
        words = [len(text.split()) for _, _, text in texts]
        linked = sum(n for n, (_, name, _) in zip(words, texts, strict=True) if name == "a")
        whole = "".join(text for _, _, text in texts)
        kind = "plain"
        if 2 * linked > sum(words):
            kind = "link"
        elif any(name == "h" for _, name, text in texts if text.strip()):
            kind = "heading"
        elif sum(words) < PROSE_BLOCK and not SENTENCE_END.search(whole):
            kind = "label"
        for i in block:
            if out[i][0] == "plain":
                out[i] = (kind, *out[i][1:])
        block.clear()

    for i, (kind, name, _) in enumerate(found):
        if kind == "tag" and name not in INLINE:
            settle()
        elif kind not in ("tag", "comment"):
            block.append(i)
    settle()
    for kinds in (("label",), ("link", "heading")):
        if any(kind == "plain" and text.strip() for kind, _, text in out):
            break
        out = [("plain" if kind in kinds else kind, name, text) for kind, name, text in out]
    return out


def _in_context(page: str) -> list[tuple[str, str, str]]:
    """The tokens of a page; plain text of a page that has an article or main element is ``beyond`` it, that of others goes by its block."""
    found = list(tokens(page))
    if any(kind == "main" and text.strip() for kind, _, text in found):
        return [("beyond" if kind == "plain" else kind, name, text) for kind, name, text in found]
    return _by_block(found)


def fit_weights(pages: tuple[str, ...] = LABELLED) -> dict[str, float]:
    """Log-odds of each context (a word) and each tag to stand inside the marked main text, words at most 1, tags below 0.

    An unmarked page teaches nothing. Add-one smoothing; a tag that isn't in
    the labelled pages gets the weight ``tag``.
    """
    inside: Counter[str] = Counter()
    outside: Counter[str] = Counter()
    for page in pages:
        count = outside
        for kind, name, text in _in_context(page):
            if kind == "comment":
                count = inside if name == "main" else outside
            elif kind == "tag":
                count["tag:" + name] += 1
            else:
                count["word:" + kind] += len(text.split())
    weights = {"tag": -0.1}
    for key in {*inside, *outside}:
        odds = math.log((inside[key] + 1) / (outside[key] + 1))
        if key.startswith("word:"):  # an advert inside an article must not cut the article in two
            weights[key] = max(-0.05 if key == "word:aside" else -0.5, min(1.0, odds))
        else:
            weights[key] = max(-1.0, min(-0.02, odds / 10 - 0.05))
    return weights


WEIGHTS = fit_weights()


def scores(found: list[tuple[str, str, str]], weights: dict[str, float]) -> list[float]:
    """What each token adds: a tag its weight, a text that of its context for each word."""
    return [weights.get("tag:" + name, weights["tag"]) if kind == "tag" else weights.get("word:" + kind, 0.0) * len(text.split()) for kind, name, text in found]


def best_stretch(score: list[float]) -> tuple[int, int]:
    """Start and end of the stretch of largest sum by one scan, the first and shortest of equals; (0, 0) if none is above 0."""
    best, best_from, best_to = 0.0, 0, 0
    total, start = 0.0, 0
    for i, s in enumerate(score):
        total += s
        if total <= 0:
            total, start = 0.0, i + 1
        elif total > best:
            best, best_from, best_to = total, start, i + 1
    return best_from, best_to


def main_text(page: str | None, weights: dict[str, float] = WEIGHTS) -> str:
    """The text of the best-scoring stretch of a page; empty if the page is null or empty or no stretch scores above 0.

    Character references are decoded, white space inside a block becomes one
    space, blocks are joined by one space. Of stretches that score the same the
    first and shortest is taken.
    """
    if not page:
        return ""
    found = [t for t in _in_context(page) if t[0] != "comment"]
    best_from, best_to = best_stretch(scores(found, weights))
    parts: list[str] = []
    for kind, name, text in found[best_from:best_to]:
        if kind == "tag":
            if name not in INLINE:
                parts.append(" ")
        elif kind != "aside":
            parts.append(html.unescape(text))
    return " ".join("".join(parts).split())


def extract_main_text(pages: DataFrame, *, keep: list[Column], html_col: str = "html") -> DataFrame:
    """The ``keep`` columns with ``text``, for every page and the whole of its html.

    Null and empty html have an empty text; rows that repeat are extracted each; an empty table gives no
    rows. A ``keep`` column that bears the name ``text`` raises ValueError.
    """
    own_names(pages, keep, ["text"])
    bound_batches(pages.sparkSession)
    rows = pages.select(*keep, F.col(html_col).cast("string").alias("__html"))
    names = rows.columns[:-1]
    schema = rows.drop("__html").schema.add("text", "string")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page) for page in batch.column(len(names)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(names))), pa.array(texts, pa.string())], [*names, "text"])

    return rows.mapInArrow(extract, schema)
