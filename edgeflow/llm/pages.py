"""Main text of web pages by the distribution of text over blocks of lines.

A page is read as lines: each block element of the markup starts one. What menus, headers, footers,
sidebars, notices, adverts, forms, scripts, styles and reader comments hold is left out and leaves a
gap of empty lines, unless the lines before and after belong to the element it lies in. The text lengths are summed over windows of a few lines. Between the point where
the sums surge from zero and the one where they dive back to zero lies a passage; the passages in
which a window reaches the threshold are the main text, short lines among them included; on a page with little
text it is the longest passage. An article element is a bonus only: a passage ends where it begins or ends,
and all of its lines are taken as soon as one of its passages is.

A form that encloses a page, or holds much text for its fields, is no part to leave out. Names of classes are read
by whole words: a hint alone or with words for containers and places marks an element, not one within another name;
words for reader comments mark it wherever they stand.
"""

import html
import re

import pyarrow as pa
from pyspark.sql import functions as F

from edgeflow.llm.common import mapped, slices, text_bytes

#: Lines of a window, and the sum of text that a passage must reach in one.
WINDOW, SURGE = 3, 86
#: Text for each field, outside links and labels, from which a form is text with fields in it.
FORM_TEXT = 4 * SURGE

# fixed values: elements of HTML by what they mean for a reader
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe xmp svg select annotation annotation-xml".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span"
    " strike strong sub sup time tt u var wbr img br object"
    " math semantics mrow mi mn mo ms mtext mspace mstyle mfrac msqrt mroot msub msup msubsup munder mover munderover".split()
)
CHROME = frozenset("nav footer aside header menu dialog button head".split())
CONTENT = frozenset("article main".split())
TEXTUAL = frozenset("p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd blockquote pre table tbody thead tr td th figure figcaption".split())
STRUCTURE = frozenset("article main nav header footer".split())
UNSEEN = frozenset("hidden button submit reset image".split())
#: Words for reader comments, wherever they are in a token of class, id or role.
COMMENTS = frozenset("comment comments commentlist commentbox disqus reply replies respond responses".split())
#: Words for adverts.
ADVERTS = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored adsbygoogle".split())
#: Words that mark an element whatever stands before them.
CLEAR = frozenset(
    "advert adverts advertisement advertising sponsored adsbygoogle sidebar navbar navigation breadcrumb breadcrumbs footer"
    " masthead cookie cookies newsletter pagination".split()
)
#: Words that mark an element alone, with each other, or with words of BEFORE and AFTER.
HINTS = CLEAR | ADVERTS | frozenset(
    "promo banner menu nav consent notice notices alert popup modal overlay discussion share sharing social related recommended"
    " subscribe signup login widget toolbar pager complementary contentinfo search".split()
)
#: Places and owners before a hint, containers and contents after it.
BEFORE = frozenset(
    "site page main global top bottom left right upper lower primary secondary inner outer header user reader post entry article"
    " mobile desktop sticky fixed floating google wp block".split()
)
AFTER = frozenset(
    "area areas articles bar bars block blocks body bottom box boxes button buttons card cards column container containers content"
    " contents danger dialog error feed field footer form frame group header heading holder icons info inner item items label left"
    " link links list lists message messages module news outer panel panels placeholder post posts reading region right row"
    " section sections slot stories strip success tab tabs text title tools top trail unit units warning widgets wrap"
    " wrapper zone".split()
)
#: Words that make a hint after them, and words that make a comment before them, tell of a state or layout of the page.
STATES = frozenset("has have no not non with without content layout".split())
ENDS = frozenset("open opened closed on off enabled disabled allowed".split())
#: Tokens that mark an article element itself as no part of the article.
NO_ARTICLE = frozenset("comment comments reply ad ads advert advertisement".split())

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)"""
    r"""|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+(?:"|\Z)|'[^']*+(?:'|\Z))*+)(?:>|\Z)""",
    re.DOTALL,
)
_MARKS = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_TYPE = re.compile(r"""\btype\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_WORDS = re.compile(r"[a-z]+|[A-Z]+[a-z]*")


def marks(attributes):
    """Words in the class, id and role of an element, in lower case."""
    return {w.lower() for m in _MARKS.finditer(attributes) for w in _WORDS.findall(m[2] or m[3] or m[4] or "")}


def _commented(words):
    """Whether the words of a token name reader comments, and no state of the page."""
    at = next((i for i, word in enumerate(words) if word in COMMENTS), None)
    return at is not None and words[-1] not in ENDS and STATES.isdisjoint(words[:at])


def _marked(words):
    """Whether the words of a token are a hint with words for containers and places only."""
    at = next((i for i, word in enumerate(words) if word in HINTS), None)
    if at is None or not STATES.isdisjoint(words[:at]):
        return False
    clear = next((i for i, word in enumerate(words) if word in CLEAR), None)
    start = clear if clear is not None else at
    return (clear is not None or BEFORE.issuperset(words[:at])) and all(w in AFTER or w in HINTS for w in words[start:])


def _tokens(attributes):
    """The words, in lower case, of each token of class, id and role; single letters are none."""
    for m in _MARKS.finditer(attributes):
        for token in (m[2] or m[3] or m[4] or "").split():
            words = [w.lower() for w in _WORDS.findall(token) if len(w) > 1]
            if words:
                yield words


def hinted(attributes):
    """3 if a token of class, id or role names reader comments or adverts, 2 if a clear hint marks it, 1 if another, else 0."""
    found = 0
    for words in _tokens(attributes):
        if _commented(words):
            return 3
        if _marked(words):
            found = max(found, 1 if CLEAR.isdisjoint(words) else 2, 0 if ADVERTS.isdisjoint(words) else 3)
    return found


def _no_article(attributes):
    return any(not NO_ARTICLE.isdisjoint(words) and len(words) == 1 or _commented(words) for words in _tokens(attributes))


class _Reader:
    """Lines of a page: [text, characters but spaces outside links, number of the outermost article element or 0, places].

    The places of a line are the elements it belongs to: the nearest one around paragraphs, lists and
    tables; of text right in such an element also the next one. An empty line has that of its chrome.
    """

    def __init__(self, plain=frozenset(), left_out=frozenset()):
        # offsets of elements to read in spite of their hints, and of forms to leave out
        self.plain, self.left_out = plain, left_out
        # offsets of open elements with hints; of those around articles, but comments and adverts; of those with unclear hints
        self.hints, self.around, self.unsure = [], set(), set()
        # what came before each open form; offsets of forms that are no more than their fields
        self.forms, self.filled = [], set()
        self.weight = self.fields = self.structure = 0
        self.lines, self.text, self.linked = [], [], 0
        self.open, self.names = [], {}
        self.chrome = self.content = self.links = self.inside = self.articles = self.elements = 0

    def end_line(self):
        text = " ".join("".join(self.text).split())
        if text:
            self.lines.append([text, max(0, len(text.replace(" ", "")) - self.linked), self.articles if self.inside else 0, self.places()])
        self.text, self.linked = [], 0

    def start(self, name, attributes, at):
        if name == "br":
            self.text.append(" ")
            return
        if name not in INLINE:
            self.end_line()
            # a paragraph or item ends where the next block begins
            for element in reversed(self.open):
                if element[0] not in INLINE:
                    if element[0] == "p" or element[0] == name in ("li", "dt", "dd", "tr", "td", "option"):
                        self.close(element[0])
                    break
        if name == "input" and not self.chrome:
            kind = _TYPE.search(attributes)
            self.fields += not (kind and (kind[1] or kind[2] or kind[3] or "").lower() in UNSEEN)
        if name in VOID:
            return
        found = marks(attributes) if attributes and not attributes.isspace() else ()
        article = name == "article" or "articleBody" in attributes
        chrome = name in CHROME and not (name == "header" and self.content) or "hidden" in attributes.split() or at in self.left_out
        hint = certain = False
        if not self.chrome and name in STRUCTURE:
            self.structure += 1
        if found and not chrome and name not in INLINE and name not in ("html", "body", "main") and at not in self.plain:
            hint = _no_article(attributes) if article else hinted(attributes)
            if hint == 1 and not article:
                self.unsure.add(at)
            certain = hint == 3
            hint = chrome = bool(hint)
        if article and not chrome and 0 < self.chrome == len(self.hints):
            self.around.update(at for at in self.hints if at is not None)
        article = article and not chrome and not self.chrome
        content = article or not chrome and (name in CONTENT or "main" in found and name == "div")
        if chrome and not self.chrome:
            self.end_line()
            self.gap(self.places()[:1])
        elif article and not self.inside:
            self.end_line()
            self.gap()
            self.articles += 1
        place, around = self.places()
        if name in TEXTUAL:
            around = place
        elif name not in INLINE:
            self.elements += 1
            place, around = self.elements, place
        self.open.append((name, chrome, content, article, hint, (place, around)))
        self.names[name] = self.names.get(name, 0) + 1
        self.chrome += chrome
        self.content += content
        self.inside += article
        if hint:
            self.hints.append(None if certain else at)
        self.links += name == "a"
        if name == "form":
            self.forms.append((at, self.weight, self.fields, self.structure))

    def places(self):
        return self.open[-1][-1] if self.open else (0, 0)

    def gap(self, places=()):
        self.lines += [["", 0, 0, places]] * WINDOW

    def close(self, name):
        if name not in INLINE:
            self.end_line()
        if not self.names.get(name):
            return
        while True:
            last, chrome, content, article, hint, _ = self.open.pop()
            if chrome or content:
                self.end_line()
            self.names[last] -= 1
            self.chrome -= chrome
            self.content -= content
            self.inside -= article
            if hint:
                self.hints.pop()
            if article and not self.inside:
                self.gap()
            self.links -= last == "a"
            if last == "form":
                self.end_form()
            if last == name:
                return

    def end_form(self):
        at, weight, fields, structure = self.forms.pop()
        if self.structure == structure and self.weight - weight < FORM_TEXT * max(1, self.fields - fields):
            self.filled.add(at)

    def data(self, text):
        if self.chrome:
            return
        text = html.unescape(text)
        self.text.append(text)
        if self.links:
            self.linked += len("".join(text.split()))
        elif self.forms and not self.names.get("label"):
            self.weight += len("".join(text.split()))

    def read(self, page):
        at = 0
        while found := _TOKEN.search(page, at):
            if found.start() > at:
                self.data(page[at: found.start()])
            at = found.end()
            if not found[2]:
                continue
            name = found[2].lower()
            if found[1]:
                self.close(name)
            elif name in RAW:
                self.fields += name in ("select", "textarea") and not self.chrome
                if not found[3].endswith("/"):
                    end = re.compile(rf"</{re.escape(name)}\b[^>]*>?", re.IGNORECASE).search(page, at)
                    at = end.end() if end else len(page)
            else:
                self.start(name, found[3], found.start())
        self.data(page[at:])
        self.end_line()
        while self.forms:
            self.end_form()
        return self.lines


def joined(lines):
    """The [text, weight, article] of lines, without the gaps that lie in an element both of their neighbours belong to."""
    found, gaps, last = [], [], ()
    for text, weight, article, places in lines:
        if not text:
            gaps.append(places)
            continue
        if not all(gap and gap[0] in last and gap[0] in places for gap in gaps):
            found += [["", 0, 0]] * len(gaps)
        gaps, last = [], places
        found.append([text, weight, article])
    return found


def passages(weights, window=WINDOW, surge=SURGE):
    """(start, end) of the passages between surge and dive points whose window sums reach `surge`; else of the heaviest one."""
    sums, total = [], 0
    for i, weight in enumerate(weights):
        total += weight - (weights[i - window] if i >= window else 0)
        sums.append(total)  # of the window that ends here
    found, start = [], None
    for i, weight in enumerate([*weights, 0]):
        dry = i == len(weights) or sums[i] == 0
        if start is None and not dry:
            start = i
        elif start is not None and dry:
            found.append((start, i))
            start = None
    high = [(start, end) for start, end in found if max(sums[start:end]) >= surge]
    return high or sorted(found, key=lambda p: sum(weights[p[0]: p[1]]))[-1:]


def main_text(page):
    """Blocks of the main text of a page, in page order, joined by two line ends; empty if there is none.

    Forms that are no more than their fields are left out. Elements with hints around article elements are read as
    well where these hold most of the text, and those with unclear hints on a page with no text beside them.
    """
    reader, forms = _Reader(), frozenset()
    lines = reader.read(page)
    if reader.filled:
        forms = frozenset(reader.filled)
        reader = _Reader(left_out=forms)
        lines = reader.read(page)
    text, surges = _chosen(lines)
    if reader.around:
        whole, _ = _chosen(_Reader(frozenset(reader.around), forms).read(page))
        if not surges or len(whole) > 2 * len(text):
            text = whole
    if not text and reader.unsure:
        text, _ = _chosen(_Reader(frozenset(reader.unsure | reader.around), forms).read(page))
    return text


def _chosen(lines):
    """The main text of the lines of a page, and whether a window of it reaches SURGE."""
    lines = joined(lines)
    weights = [weight for _, weight, _ in lines]
    chosen = set()
    for start, end in passages(weights):
        # to the last line before the dive that has weight, those without among them
        chosen.update(range(start, max(i for i in range(start, end) if weights[i]) + 1))
    surges = any(sum(weights[i: i + WINDOW]) >= SURGE for i in chosen)
    if not surges and any(article for *_, article in lines):
        # little text: that of the article elements
        chosen, articles = set(), {article for *_, article in lines} - {0}
    else:
        articles = {lines[i][2] for i in chosen} - {0}
    return "\n\n".join(
        text for i, (text, _, article) in enumerate(lines) if text and (i in chosen or article in articles)
    ), surges


def extract(pages, id="page_id", url="url", html="html"):
    """(page_id, url, text, n_chars) of every row of `pages`, from the whole html; null counts as empty.

    `n_chars` is the number of code points. Other columns are not read, whatever their names.
    """

    def run(batches):
        for batch in slices(batches, "html"):
            texts = [main_text(t.as_buffer().to_pybytes().decode("utf-8", "replace")) for t in batch.column("html")]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"), batch.column("url"),
                    pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars"],
            )

    kinds = [pages.schema[c].dataType.simpleString() for c in (id, url)]
    columns = [F.col(id).alias("page_id"), F.col(url).alias("url"), text_bytes(F.col(html)).alias("html")]
    return mapped(pages.select(columns), run, f"page_id {kinds[0]}, url {kinds[1]}, text string, n_chars bigint")
