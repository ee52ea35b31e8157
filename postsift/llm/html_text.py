"""Main text of web pages: the maximum-scoring run of tokens, words positive and tags negative.

A page is a row of tokens: words, and tags. Words in a plain block score positive, tags negative, and
words inside menus, notices, forms and the like negative too, with weights learnt from labelled
pages. One linear scan finds the contiguous run with the highest sum; its blocks are the text.
"""

import html
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postsift.llm.sampling import by_hash
from postsift.llm.text import blocks

# Elements by their part in a page.
HIDDEN = ("script", "style", "noscript", "template", "head", "title", "svg", "iframe", "object",
          "canvas", "audio", "video", "select", "textarea", "button", "annotation", "annotation-xml")
RAW = ("script", "style", "textarea", "title", "iframe", "noscript")
RAW_END = {name: re.compile(f"</{name}", re.IGNORECASE | re.ASCII) for name in RAW}
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")
INLINE = ("a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i",
          "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong",
          "sub", "sup", "time", "tt", "u", "var", "wbr", "nobr",
          "math", "mi", "mn", "mo", "ms", "mtext", "mrow", "mfrac", "msup", "msub", "msubsup", "msqrt", "mroot", "semantics")
BOILERPLATE = ("nav", "header", "footer", "aside", "form", "menu", "dialog", "fieldset")
# Of these, the ones that may also be wrapped around a whole page.
WRAPPERS = ("form", "fieldset")
CONTENT = ("article", "main")
# Elements that hold anything: what stands in them says nothing, and their tags are cheap.
NEUTRAL = ("html", "body", "div", "section", "p", "span", "ul", "ol", "li", "dl", "dt", "dd", "table", "thead", "tbody",
           "tr", "td", "th", "center", "blockquote", "pre", "figure", "figcaption", "br", "hr", "img", "h1", "h2", "h3", "h4", "h5", "h6")
# Words in a class, id or role that name a part: of the page's frame, and of its content.
FRAME_NAMES = re.compile(
    r"^(?:ads?|advert\w*|adsense|sponsor\w*|promo\w*|banner\w*|nav\w*|menu\w*|breadcrumbs?|header|masthead|foot|footer\w*|"
    r"sidebar\w*|aside|rail|widgets?|related|recommend\w*|share|sharing|social|cookies?|consent|gdpr|notice\w*|alert|"
    r"newsletter|subscri\w*|signup|login|search|form|popup|modal|overlay|comments?|commentlist|replies|reply|respond|"
    r"discussion|disqus|pagination|pager|toolbar|copyright|complementary|navigation|contentinfo)$")

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|</?[A-Za-z](?:[^>\"']|\"[^\"]*\"|'[^']*')*>|</?[A-Za-z][^>]*(?:>|\Z)|[^<]+|<", re.DOTALL)
NAME = re.compile(r"</?([A-Za-z][^\s/>]*)")
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)

# Pages that the weights are learnt from, at most.
SAMPLE = 400
# Before any page is seen: a word's weight, a tag's, and that of words in a named part of the frame.
WORD_WEIGHT, TAG_WEIGHT, FRAME_WEIGHT = 1.0, -0.02, -0.25
# A word in the frame is left out of the text; its weight is small so that a notice within the content
# does not cut off what follows it.
FRAME_SHARE = 0.03  # of its log odds, that a word weighs below a key seen outside the content
# A wrapper holds over half of a page's words, and outside it and the other parts of the frame stand fewer than
# this share of its own. A content element counts against the frame around it from this share of the page's words.
OUTSIDE_SHARE, CONTENT_SHARE = 0.1, 0.2
LINK_SHARE = 0.3  # of its log odds, that a tag costs which stands outside the content


def tag_keys(name: str, tag: str) -> list:
    """What a tag may be judged by: its name, and the words of its class, id and role."""
    keys = [name]
    for match in ATTRIBUTE.finditer(tag):
        value = match[2] or match[3] or match[4] or ""
        keys += [f".{w}" for w in re.findall(r"[a-z]+", value.lower())]
    return keys


class Element:
    """An open element: the one around it, its keys, and how many of the page's words it holds."""

    __slots__ = ("around", "keys", "depth", "words", "plain", "own", "framed", "weight")

    def __init__(self, around, keys: list):
        self.around, self.keys, self.depth = around, keys, around.depth + 1 if around else 0
        self.words = self.plain = 0  # plain: those outside all parts of the frame
        self.weight = None

    def outwards(self):
        element = self
        while element is not None:
            yield element
            element = element.around


def tokens(page: str):
    """The page as (kind, value, context): kind "text" with decoded text, "block" or "inline" for tags.

    ``context`` is the innermost element around, or None. Text in hidden elements is left out.
    """
    stack, context, hidden, open_ = [], None, 0, Counter()

    def close(depth):
        """Take the elements from ``depth`` on off the stack."""
        nonlocal context, hidden
        for name, _ in stack[depth:]:
            open_[name] -= 1
            hidden -= name in HIDDEN
        del stack[depth:]
        context = stack[-1][1] if stack else None

    position, size = 0, len(page)
    while position < size:
        match = TOKEN.match(page, position)
        if match is None:  # a tag that is never closed: the rest is no text
            return
        piece, position = match.group(), match.end()
        if piece[0] != "<" or piece == "<":
            if not hidden:
                yield "text", html.unescape(piece), context
            continue
        named = NAME.match(piece)
        if named is None:
            continue
        name = named[1].lower()
        if piece[1] == "/":
            if open_[name]:
                for depth in range(len(stack) - 1, -1, -1):
                    if stack[depth][0] == name:
                        close(depth)
                        break
                    if name in INLINE and stack[depth][0] not in INLINE:
                        break
        else:
            keys = tag_keys(name, piece)
            if name in ("p", "li", "dt", "dd", "tr", "td", "th", "option"):  # their end tag may be missing
                for depth in range(len(stack) - 1, -1, -1):
                    if stack[depth][0] == name:
                        close(depth)
                        break
                    if not open_[name] or stack[depth][0] not in INLINE and stack[depth][0] != "p":
                        break
            if name in RAW:
                end = RAW_END[name].search(page, position)
                if end is None:
                    return
                position = end.start()
            if name not in VOID and not piece.endswith("/>"):
                context = Element(context, keys)
                stack.append((name, context))
                open_[name] += 1
                hidden += name in HIDDEN
            yield "inline" if name in INLINE else "block", keys, context
            continue
        yield "inline" if name in INLINE else "block", [name], context


class Weights:
    """What a word scores in a context, and what a tag costs."""

    def __init__(self, keys: dict | None = None, tags: dict | None = None):
        self.keys = keys or {}
        self.tags = tags or {}

    def tag(self, name: str) -> float:
        return self.tags.get(name, TAG_WEIGHT)

    def own(self, element: Element) -> float | None:
        """The least weight that an element's own keys give it; None when they say nothing.

        What labelled pages say of a name goes before the name itself. ``html`` and ``body`` say nothing.
        """
        if element.keys[0] in ("html", "body"):
            return None
        named = [FRAME_WEIGHT for k in element.keys
                 if k in BOILERPLATE or (k[0] == "." and k not in self.keys and FRAME_NAMES.match(k[1:]))]
        return min(named + [w for k in element.keys if (w := self.keys.get(k, 0)) < 0], default=None)

    def place(self, texts: list) -> None:
        """Set the weight of the elements around ``texts``, pairs of an element (or None) and a word count.

        The nearest element that decides counts: a part of the frame, or a content element with
        enough of the page's words. A wrapper around the page is no part of the frame, whatever its name.
        """
        seen, total, plain = set(), 0, 0
        for context, _ in texts:
            for e in context.outwards() if context else ():
                if e in seen:
                    break
                seen.add(e)
        elements = sorted(seen, key=lambda e: e.depth)
        for e in elements:
            e.own = self.own(e)
            e.framed = e.own is not None or (e.around is not None and e.around.framed)
        for context, n in texts:
            total += n
            framed = context is not None and context.framed
            plain += 0 if framed else n
            if context is not None:
                context.words += n
                context.plain += 0 if framed else n
        for e in reversed(elements):
            if e.around is not None:
                e.around.words += e.words
                e.around.plain += e.plain

        def decides(e):
            if e.own is not None:
                strict = e.keys[0] in BOILERPLATE and e.keys[0] not in WRAPPERS
                if strict or 2 * e.words <= total or plain - e.plain >= OUTSIDE_SHARE * e.words:
                    return e.own
            return WORD_WEIGHT if e.keys[0] in CONTENT and e.words >= CONTENT_SHARE * total else None

        for e in elements:
            e.weight = decides(e)
            if e.weight is None:
                e.weight = WORD_WEIGHT if e.around is None else e.around.weight


def main_text(page: str | None, weights: Weights) -> str:
    """The text of the best run; null, empty and wordless pages have none."""
    found = list(tokens(page or ""))
    sizes = [len(value.split()) if kind == "text" else 0 for kind, value, _ in found]
    weights.place([(context, n) for (_, _, context), n in zip(found, sizes) if n])
    pieces, scores = [], []
    for (kind, value, context), n in zip(found, sizes):
        if kind == "text":
            # White space in an element without words of its own weighs nothing and stays.
            weight = WORD_WEIGHT if context is None or context.weight is None else context.weight
            pieces.append(value if weight > 0 else None)
            scores.append(weight * n)
        else:
            pieces.append(" " if kind == "block" else "")
            scores.append(weights.tag(value[0]))
    best, start, stop, run, first = 0.0, 0, 0, 0.0, 0
    for i, score in enumerate(scores):
        run += score
        if run > best:
            best, start, stop = run, first, i + 1
        if run <= 0:
            run, first = 0.0, i + 1
    return " ".join("".join(p for p in pieces[start:stop] if p is not None).split())


def learn_weights(pages: list) -> Weights:
    """Weights from labelled pages: those whose own markup names the content (article or main).

    A key's weight is the log odds of a word below it being content, against all words of the
    labelled pages; one whose words are mostly content is no part of the frame, whatever its name. A
    tag's cost grows with its odds of standing outside. The keys that name the
    content label it and are no evidence, nor are elements that hold anything.
    """
    words, tags = ({}, {}), ({}, {})
    for page in pages:
        for kind, value, context in tokens(page or ""):
            keys = {k for e in context.outwards() for k in e.keys} if context else ()
            side = not any(k in CONTENT for k in keys)
            if kind != "text":
                tags[side][value[0]] = tags[side].get(value[0], 0) + 1
            elif n := len(value.split()):
                for key in keys:
                    words[side][key] = words[side].get(key, 0) + n

    def odds(counts, key):
        return float(np.log((counts[0].get(key, 0) + 0.5) / (counts[1].get(key, 0) + 0.5)))

    known = (words[0].keys() | words[1].keys()).difference(CONTENT, NEUTRAL, INLINE)
    costly = (tags[0].keys() | tags[1].keys()).difference(CONTENT, NEUTRAL)
    keys = {k: max(FRAME_SHARE * odds(words, k), FRAME_WEIGHT) for k in known if odds(words, k) < -1}
    return Weights(keys | {k: WORD_WEIGHT for k in known if k[0] == "." and odds(words, k) > 1},
                   {k: TAG_WEIGHT + LINK_SHARE * max(odds(tags, k), -2.0) for k in costly if odds(tags, k) < -1})


def learn(pages: DataFrame, sample: int = SAMPLE) -> Weights:
    """Weights from at most ``sample`` labelled pages, taken by hash from all."""
    labelled = pages.where(F.lower("html").rlike("<(article|main)[\\s>]")).select("page_id", "html")
    rows = by_hash(labelled, sample, "page_id", "html").collect()
    return learn_weights([r.html for r in rows])


EXTRACTED = "page_id long, url string, text string, n_chars long"


def extract(pages: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Per row: page_id, url, text, n_chars.

    Character references are decoded, white space inside a block becomes one space, blocks are
    joined by one. A null, empty or wordless page has an empty text. Repeated rows stay
    repeated; other columns are ignored.
    """
    shared = pages.sparkSession.sparkContext.broadcast(learn(pages, sample))

    def run(batches):
        weights = shared.value
        for whole in batches:
            for batch in blocks(whole, "html"):
                texts = [main_text(page, weights) for page in batch.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInArrow(run, EXTRACTED)
