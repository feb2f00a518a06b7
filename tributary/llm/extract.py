"""Main text of web pages: a conditional random field over the leaf blocks of the tree.

A page is read into its leaf blocks, the runs of text between block-level tags, each with its open elements and
their classes and ids. Features of the ancestors, of the text and of its neighbours go to a linear-chain conditional
random field, trained on labelled pages that are made up here (``made_pages``), and its Viterbi path says which
blocks are the article. A page with a long block outside all menus, forms and the like has an article: where the
likeliest path has none, the likeliest of those that have one is taken. Character references are decoded, white space
inside a block becomes one space, and the article's blocks are joined in page order by one space.

Only ``script``, ``style``, ``textarea``, ``title`` and their like hold raw text; unclosed, they reach to the page's end, as
in browsers. ``svg``, ``select`` and ``template`` are left out where they are closed; unclosed, only their tag is.

Nulls: a null page counts as empty and has an empty text. Repeated rows are treated alike. An empty table gives
an empty table. Ties between paths go to the one with less text. Pages of any length are read whole, in time linear
in the page; one page and its blocks lie in a worker's memory. Other columns pass; ``text`` and ``n_chars`` replace
any of the same name.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from tributary.llm.crf import Model, train
from tributary.llm.made_pages import pages as made_pages

#: Labelled pages for training; a fixed number, the same for any input.
TRAINING_PAGES = 900
#: Blocks of a training page at most; longer ones teach nothing else.
TRAINING_BLOCKS = 70
#: Words of a block that make a page one with an article, if no menu, form or the like is around it.
LONG = 25

#: Elements within a line; all others end a block.
INLINE = frozenset(
    "a abbr acronym audio b bdi bdo big canvas cite code data del dfn em font i img ins kbd label map mark meter nobr noscript object output param picture progress"
    " q rb rp rt rtc ruby s samp small source span strike strong sub sup time track tt u var video wbr input".split()
) | frozenset(
    "math mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle merror mpadded mphantom menclose msub msup msubsup munder mover munderover mmultiscripts mprescripts mtable mtr mlabeledtr mtd maction semantics annotation annotation-xml".split()
)
#: Elements whose content is raw text, and none of the page's.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
#: Elements with tags inside that are none of the page's text either.
TREES = frozenset("template svg select".split())
#: Tags that cannot stand in an ``svg``: they end it, closed or not.
BREAKS_SVG = "article|aside|blockquote|body|center|dd|div|dl|dt|footer|form|h[1-6]|header|hr|li|main|nav|ol|p|pre|section|table|ul"
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their text is a form's.
CHOICES = frozenset(("option", "optgroup"))
#: What an opening tag closes, if it is the innermost open block.
CLOSES = {x: ("p",) for x in "address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split()} | {
    "li": ("p", "li"),
    "dt": ("p", "dt", "dd"),
    "dd": ("p", "dt", "dd"),
    "tr": ("td", "th", "tr"),
    "td": ("td", "th"),
    "th": ("td", "th"),
    "option": ("option",),
}
#: Blocks whose own element is one of these belong to the box around it.
LEAVES = frozenset("p li h1 h2 h3 h4 h5 h6 pre blockquote dt dd td th tr figcaption caption".split())

TAG = re.compile(r"<!--(?:-?>|(?:[^-]|-(?!-!?>))*+(?:--!?>|\Z))|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|<[!?/][^>]*+>")
NAMED = re.compile(r"""(?:^|[\s"'])(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
HIDDEN = re.compile(r"""(?:^|[\s"'])(?:hidden(?=[\s=/]|\Z)|style\s*=\s*["']?[^"'>]*display\s*:\s*none)""", re.IGNORECASE)
PART = re.compile(r"[a-z0-9]+|[A-Z][a-z0-9]*")
SPACE = re.compile(r"\s+")

#: Words in names of classes and ids, by what they stand for.
HINTS = {
    "main": "article content post entry story main text prose blog news body".split(),
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs crumbs toc tabs pagination pager skip topnav subnav".split(),
    "side": "side sidebar aside related widget widgets trending recommended recommendations popular teaser teasers rail".split(),
    "ad": "ad ads advert adverts advertisement adsense sponsor sponsored promo promoted banner commercial affiliate".split(),
    "notice": "cookie cookies notice consent alert alerts gdpr disclaimer warning popup modal overlay toast privacy".split(),
    "form": "form newsletter subscribe subscription login signin signup search register".split(),
    "comment": "comment comments reply replies discussion respond responses reviews feedback disqus".split(),
    "foot": "foot footer copyright legal colophon bottom imprint".split(),
    "head": "header masthead topbar logo brand branding".split(),
    "share": "share sharing social tags author byline meta avatar".split(),
}
WORDS = {word: kind for kind, words in HINTS.items() for word in words}
#: Words that say that a name speaks of something beside the element.
BESIDE = frozenset("has with without no not hide show is".split())
#: What short blocks around articles say, in the languages at hand.
CUES = {
    "rights": r"©|copyright|rights reserved|rechte vorbehalten|droits réservés|derechos reservados|imprint|impressum|terms of|mentions légales|aviso legal",
    "cookies": r"\bcookies?\b|privacy|datenschutz|consent|einwilligung|confidentialité|privacidad",
    "share": r"\bshare\b|\bteilen\b|partage[rz]|compart[ei]|\btweet\b|follow us|folge uns|suivez|síguenos|print this|e-?mail this",
    "account": r"newsletter|subscri|abonn|suscri|sign (?:up|in)|log ?in|anmelde|connexion|regist|password|passwor[dt]|mot de passe|contraseña|e-?mail address",
    "comments": r"\bcomments?\b|kommentar|commentaire|comentario|\breply\b|antworten|répondre|responder|\bschrieb\b|a écrit|\bsays:|\bwrote:",
    "advert": r"advert|sponsor|anzeige|werbung|publicité|publicidad|promot|buy now|jetzt kaufen|\d ?% off|acheter|comprar ahora",
    "more": r"read (?:more|next|also)|related|most read|more (?:stories|from|on)|weiterlesen|mehr zum thema|meistgelesen|lire (?:aussi|la suite)|à lire|leer más|también|you may also|recommended",
    "places": r"\A(?:home|menu|contact|about(?: us)?|search|startseite|kontakt|über uns|suche|accueil|rechercher|inicio|contacto|buscar|skip to .*|zum inhalt.*)\Z",
}
CUES = {kind: re.compile(pattern, re.IGNORECASE) for kind, pattern in CUES.items()}


class Element:
    """An open element: its parent, all tags and hints from the root down to it, and sums over its blocks."""

    __slots__ = ("name", "parent", "own", "tags", "hints", "nearest", "words", "size", "linked", "free", "score", "core", "seen", "holders")

    def __init__(self, name: str, parent: Element | None, hints: frozenset[str] = frozenset()):
        self.name, self.parent = name, parent
        self.tags = parent.tags | {name} if parent else frozenset()
        self.hints = parent.hints | hints if parent else frozenset()
        self.nearest = hints or (parent.nearest if parent else frozenset())
        self.own = hints
        self.clear()

    def clear(self) -> None:
        self.words = self.size = self.linked = self.free = 0
        self.score = 0.0
        self.core = self.seen = False
        self.holders: tuple[str, str] = ("none", "none")


@dataclass
class Block:
    text: str
    element: Element
    linked: int

    @property
    def parent(self) -> str:
        return self.element.name

    @property
    def tags(self) -> frozenset[str]:
        return self.element.tags

    @property
    def hints(self) -> frozenset[str]:
        return self.element.hints


def hint_of(word: str) -> str | None:
    """The kind that a word, or a run-together name that begins or ends with a long one, stands for."""
    if word in WORDS:
        return WORDS[word]
    for n in range(len(word) - 1, 4, -1):
        if kind := WORDS.get(word[:n]) or WORDS.get(word[-n:]):
            return kind
    return None


@lru_cache(maxsize=4096)
def hints_of(names: str) -> frozenset[str]:
    out = set()
    for name in names.split()[:32]:
        words = [x.lower() for x in PART.findall(name[:80])]
        for i, word in enumerate(words):
            if kind := None if i and words[i - 1] in BESIDE else hint_of(word):
                out.add(kind)
    return frozenset(out)


def element_hints(attributes: str) -> frozenset[str]:
    if not attributes:
        return frozenset()
    names = " ".join(a or b or c for a, b, c in NAMED.findall(attributes))
    hints = hints_of(names) if names else frozenset()
    return hints | {"hidden"} if HIDDEN.search(attributes) else hints


@lru_cache(maxsize=16)
def nesting(name: str) -> re.Pattern[str]:
    inner = f"|foreignobject|{BREAKS_SVG}" if name == "svg" else ""
    return re.compile(rf"<(/?)({name}{inner})(?=[\s/>])[^>]*>", re.IGNORECASE)


def ends_of(name: str, page: str, at: int, end: int) -> tuple[dict[int, int], int]:
    """Where the tree element that opens right before ``at`` ends, and those inside: place after the opening tag -> place after the closing one.

    Elements that nothing closes, or that a tag ends which cannot stand inside, are not in it. Comes with the place up
    to which all such elements are known.
    """
    out: dict[int, int] = {}
    open_, foreign = [at], 0
    for m in nesting(name).finditer(page, at, end):
        found = m[2].lower()
        if found == "foreignobject":
            foreign = max(0, foreign + (-1 if m[1] else 0 if m[0].endswith("/>") else 1))
        elif found != name:
            if not foreign:
                return out, m.start()
        elif m[1]:
            out[open_.pop()] = m.end()
            if not open_:
                return out, m.end()
        elif name == "select":  # one does not stand in another
            open_ = [m.end()]
        elif not m[0].endswith("/>"):
            open_.append(m.end())
    return out, end


def blocks(page: str) -> list[Block]:
    """The leaf blocks with text, in page order; in time linear in the page."""
    out: list[Block] = []
    stack = [Element("", None)]
    depth: Counter[str] = Counter()
    parts: list[str] = []
    linked = 0
    link_at: int | None = None  # blocks open where the open link began
    at, end = 0, page.rfind(">") + 1  # no tag ends beyond
    ends: dict[str, dict[int, int]] = {x: {} for x in TREES}
    judged: dict[str, int] = dict.fromkeys(TREES, 0)  # up to where ``ends`` is known

    def flush() -> None:
        nonlocal linked
        if parts:
            text = SPACE.sub(" ", "".join(parts)).strip()
            if text and stack[-1].name not in CHOICES:
                out.append(Block(text, stack[-1], linked))
            parts.clear()
        linked = 0

    def add(raw: str) -> None:
        nonlocal linked
        if raw:
            text = unescape(raw) if "&" in raw else raw
            parts.append(text)
            if link_at is not None:
                linked += len(text)

    def close(keep: int) -> None:
        nonlocal link_at
        while len(stack) > keep:
            depth[stack.pop().name] -= 1
        if link_at is not None and link_at > keep:
            link_at = None

    while at < end:
        m = TAG.search(page, at, end)
        if m is None:
            add(page[at:end])
            at = end
            break
        add(page[at : m.start()])
        at = m.end()
        if m[0].startswith("<!--") and not m[0].endswith(("-->", "--!>")):
            at = len(page)
        slash, name, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not name:
            continue
        name = name.lower()
        if name == "br":
            parts.append(" ")
        elif name == "a":
            link_at = None if slash else len(stack)
        elif name in INLINE:
            continue
        elif slash:
            flush()
            if depth[name] > 0:
                keep = len(stack) - 1
                while stack[keep].name != name:
                    keep -= 1
                close(keep)
        elif name in RAW:
            if not attributes.rstrip().endswith("/"):
                ended = re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.IGNORECASE).search(page, at, end)
                at = ended.end() if ended else len(page)
        elif name in TREES:
            if not attributes.rstrip().endswith("/"):
                if at > judged[name]:
                    found, judged[name] = ends_of(name, page, at, end)
                    ends[name].update(found)
                at = ends[name].get(at, at)
        else:
            flush()
            if stack[-1].name in CHOICES and name not in CHOICES:
                while stack[-1].name in CHOICES:
                    close(len(stack) - 1)
            for closed in CLOSES.get(name, ()):
                if stack[-1].name == closed:
                    close(len(stack) - 1)
            if name in VOID or attributes.endswith("/"):
                continue
            depth[name] += 1
            stack.append(Element(name, stack[-1], frozenset() if name in ("html", "body") else element_hints(attributes)))
    add(page[at:].partition("<!--")[0])
    flush()
    return out


def bucket(x: float, edges: tuple[float, ...]) -> int:
    return sum(x >= e for e in edges)


#: Around these stands no article; nor around an element of such a name.
OUTSIDE = frozenset("nav aside footer form button select label menu dialog".split())
SIDES = frozenset(HINTS) - {"main", "head"} | {"hidden"}


def outside(b: Block) -> bool:
    return not OUTSIDE.isdisjoint(b.element.tags) or not SIDES.isdisjoint(b.element.hints)


def core_of(page: list[Block], words: list[int], dense: list[bool]) -> tuple[list[Element], float]:
    """Marks the element that holds the bulk of the running text, and all inside it; says how much of it that is.

    An element counts its own running text in full, and 0.6 of what its children count.
    """
    elements: list[Element] = []
    for b in page:
        chain, e = [], b.element
        while e is not None and not e.seen:
            e.seen = True
            chain.append(e)
            e = e.parent
        elements += reversed(chain)  # parents before children
    total = 0
    for b, n, solid in zip(page, words, dense, strict=True):
        box = b.element.parent if b.element.name in LEAVES and b.element.parent else b.element
        box.words += n
        box.size += len(b.text)
        box.linked += b.linked
        if solid:
            box.score += n
            total += n
    inside: dict[Element, float] = {e: e.score for e in elements}
    for e in reversed(elements):
        if e.parent is not None:
            e.parent.score += 0.6 * e.score
            inside[e.parent] += inside[e]
    if not total:
        return elements, 0.0
    best = max(elements, key=lambda e: e.score)
    for e in elements:
        e.core = e is best or (e.parent is not None and e.parent.core)
    return elements, inside[best] / total


def hold(elements: list[Element]) -> None:
    """Says of each element whether it lies in the one that is called the article, by its tag or by its name.

    Of several, it is the one with most words that are nobody else's, or the inner ones that have most of these.
    """
    for e in reversed(elements):
        if e.parent is not None:
            e.parent.free += e.free
    found = []
    for called in (lambda e: e.name in ("article", "main"), lambda e: "main" in e.own):
        those = [e for e in elements if e.free and called(e)]
        most = max((e.free for e in those), default=0)
        chosen: set[Element] = set()
        above: set[Element] = set()  # what has a chosen one inside
        for e in reversed(those):
            if e.free >= 0.6 * most and e not in above:
                chosen.add(e)
                up = e.parent
                while up is not None and up not in above:
                    above.add(up)
                    up = up.parent
        found.append(chosen)
    for e in elements:
        up = e.parent.holders if e.parent else ("none", "none")
        e.holders = tuple("in" if e in chosen or x == "in" else "out" if chosen else "none" for chosen, x in zip(found, up, strict=True))


def features(page: list[Block]) -> list[list[str]]:
    words = [b.text.count(" ") + 1 for b in page]
    links = [b.linked / len(b.text) for b in page]
    free = [x < 0.3 and not outside(b) for b, x in zip(page, links, strict=True)]
    least = next((k for k in (10, 4, 1) if any(f and n >= k for f, n in zip(free, words, strict=True))), 1)  # a page of scraps has a core too
    dense = [f and n >= least for f, n in zip(free, words, strict=True)]
    elements, share = core_of(page, words, dense)
    for b, f, n in zip(page, free, words, strict=True):
        b.element.free += n * f
    hold(elements)
    core_share = f"core-share:{bucket(share, (0.3, 0.6, 0.9))}"
    some = any(dense)
    out, size = [], len(page)
    for i, b in enumerate(page):
        e, n, text = b.element, words[i], b.text
        own = {f"in:{x}" for x in e.tags} | {f"hint:{x}" for x in e.hints} | {f"near:{x}" for x in e.nearest} | {f"parent:{e.name}"}
        kind = bucket(n, (3, 6, 12, 25, 60))
        own.add(f"words:{kind}")
        link = bucket(links[i], (0.01, 0.3, 0.7))
        own.add(f"linked:{link}")
        own.add(f"stops:{bucket(sum(map(text.count, '.!?')) / n, (0.01, 0.04, 0.1))}")
        own.add("ends" if text[-1] in ".!?:\"'”»" else "open")
        if n < LONG:
            own.update(f"cue:{k}" for k, p in CUES.items() if p.search(text))
        tag, name = e.holders
        own.update((f"tag-holder:{tag}", f"name-holder:{name}", f"holders:{tag}-{name}"))
        box = e.parent if e.name in LEAVES and e.parent else e
        own.add(f"box-words:{bucket(box.words, (10, 40, 150))}")
        own.add(f"box-linked:{bucket(box.linked / max(1, box.size), (0.05, 0.3, 0.6))}")
        if some:
            place = "core" if e.core else "out"
            own.update((f"place:{place}", f"{place}-{core_share}", f"{place}-words:{kind}", f"{place}-linked:{link}", f"{place}-scale:{least}"))
        for way, j in (("before", i - 1), ("after", i + 1)):
            if 0 <= j < size:
                other = page[j].element
                near = other is e or other.parent is e.parent and other.name == e.name
                own.update((f"{way}-words:{bucket(words[j], (3, 12, 25))}", f"{way}-linked:{bucket(links[j], (0.3,))}", f"{way}-like:{near}"))
            else:
                own.add(f"{way}-none")
        out.append(sorted(own))
    for e in elements:
        e.clear()
    return out


@lru_cache(maxsize=1)
def trained(n: int = TRAINING_PAGES) -> Model:
    """The model; some seconds, once per driver."""
    sequences, labels = [], []
    for page, known in made_pages(n):
        found = blocks(page)
        ls = [known.get(b.text) for b in found]
        if found and len(found) <= TRAINING_BLOCKS and None not in ls:
            sequences.append(features(found))
            labels.append(ls)
    return train(sequences, labels)


def article(model: Model, found: list[Block]) -> list[Block]:
    """The blocks of the article."""
    sequence = features(found)
    labels = model.decode(sequence)
    if not any(labels) and any(b.text.count(" ") + 1 >= LONG and b.linked < 0.3 * len(b.text) and not outside(b) for b in found):
        labels = model.decode(sequence, some=1)
    return [b for b, label in zip(found, labels, strict=True) if label]


def main_text(model: Model, page: str | None) -> str:
    return " ".join(b.text for b in article(model, blocks(page or "")))


def extract(df: DataFrame, *, html: str = "html", model: Model | None = None) -> DataFrame:
    """Adds ``text STRING`` and ``n_chars BIGINT`` (code points); the page itself is left behind."""
    sent = df.sparkSession.sparkContext.broadcast(model or trained())  # some hundred weights, whatever the input
    kept = [x for x in df.columns if x not in (html, "text", "n_chars")]
    rows = df.select(*kept, html)
    schema = rows.select(*kept).schema.add("text", "string").add("n_chars", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(sent.value, x.as_py()) for x in batch.column(len(kept))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], schema.fieldNames())

    return rows.mapInArrow(run, schema)
