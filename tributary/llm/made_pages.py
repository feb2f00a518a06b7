"""Labelled web pages made up for training: article blocks among menus, adverts, notices, forms and comments.

Words are random syllables, so that a model can learn nothing from them; what it learns is where in the tree a block
stands, the shape of its text and of what is around it, and how much to believe names and the usual phrases. Half of
the pages have no telling names, half no telling tags; articles stand in any element, whole or in sections.
"""

from __future__ import annotations

import random

SYLLABLES = "ba ce di fo gu ha je ki lo mu na pe ri so tu va we xi yo zu tion ment ung keit ción eau".split()
MAIN = ("article", "content", "post-body", "entry-content", "story", "main-text", "articleBody", "post has-sidebar", "content with-nav", "single_post no-ads", "story is-commented")
PLAIN = ("c1", "wrap", "box", "row", "col-8", "css-1x9ab", "inner", "grid", "x7", "block", "l-2", "unit", "z")
NAMES = {
    "menu": ("nav", "menu", "navbar", "breadcrumb", "toc-links", "topnav"),
    "side": ("sidebar", "aside", "related", "widget", "trending", "recommended"),
    "ad": ("ad", "ads", "advert", "sponsor", "promo", "banner-ad"),
    "notice": ("cookie", "notice", "consent", "alert", "gdpr-banner", "disclaimer"),
    "form": ("form", "newsletter", "subscribe", "login", "search-box", "signup"),
    "comment": ("comments", "comment-list", "reply", "discussion", "respond", "user-comments"),
    "foot": ("footer", "foot", "copyright", "legal", "siteFooter", "bottom"),
    "head": ("header", "masthead", "topbar", "site-header", "logo", "branding"),
    "share": ("share", "social", "tags", "author-box", "byline", "meta"),
}
TAGS = {"menu": "nav", "side": "aside", "foot": "footer", "head": "header", "form": "form", "notice": "dialog"}
PHRASES = {
    "menu": ("Home", "Contact", "About us", "Startseite", "Kontakt", "Accueil", "Inicio", "Search", "Menu", "Skip to content"),
    "side": ("Related stories", "Most read", "You may also like", "Mehr zum Thema", "À lire aussi", "Leer más", "Read more"),
    "ad": ("Advertisement", "Sponsored", "Anzeige", "Publicité", "Publicidad", "Buy now", "20% off today"),
    "notice": ("We use cookies.", "This site uses cookies to improve your visit.", "Privacy settings", "Wir verwenden Cookies.", "Nous utilisons des cookies.", "Utilizamos cookies."),
    "form": ("Subscribe to our newsletter", "Sign in", "Log in", "Register", "Your e-mail address", "Newsletter abonnieren", "Connexion", "Regístrate", "Password"),
    "comment": ("Comments", "3 comments", "Reply", "Leave a comment", "Kommentare", "Antworten", "Commentaires", "Responder"),
    "foot": ("© 2021", "All rights reserved", "Copyright", "Alle Rechte vorbehalten", "Tous droits réservés", "Terms of use", "Impressum"),
    "head": ("Menu", "Search", "Log in", "Subscribe", "Home"),
    "share": ("Share this", "Share", "Follow us", "Teilen", "Partager", "Compartir", "Print this"),
}


class Page:
    def __init__(self, seed: int):
        self.rng = random.Random(seed)
        self.out: list[str] = []
        self.labels: dict[str, int] = {}
        self.named = self.rng.random() < 0.5
        self.tagged = self.rng.random() < 0.5
        self.telling = self.rng.random() < 0.75  # the article's own element says what it is

    def words(self, low: int, high: int) -> str:
        pick = self.rng.choice
        return " ".join("".join(pick(SYLLABLES) for _ in range(self.rng.randint(1, 4))) for _ in range(self.rng.randint(low, high)))

    def sentences(self, low: int, high: int) -> str:
        junk = self.rng.random() < 0.1
        mark = self.rng.choice(["###", "$$$", "&amp;&amp;", "%%%", " |", "!!"])
        out = []
        for _ in range(self.rng.randint(low, high)):
            s = self.words(1, 22).capitalize()
            out.append(" ".join(w + mark for w in s.split()) if junk else s + self.rng.choice(".....!?"))
        return " ".join(out)

    def put(self, label: int, before: str, text: str, after: str) -> None:
        self.labels[" ".join(text.replace("&amp;", "&").split())] = label
        self.out.append(before + text + after)

    def open(self, tag: str, name: str | None = None) -> str:
        if name is None:
            name = self.rng.choice(PLAIN) if self.rng.random() < 0.5 else None
        return f"<{tag}>" if name is None else f'<{tag} {self.rng.choice(["class", "class", "id"])}="{name}">'

    def phrase(self, kind: str) -> str:
        """One of the usual phrases, alone or with words around it."""
        rng = self.rng
        text = rng.choice(PHRASES[kind])
        return rng.choice((text, text, f"{text} {self.words(1, 5)}", f"{text} {self.words(1, 6)}.", f"{self.words(1, 4)} {text}", f"{text}. {rng.choice(PHRASES[kind])}."))

    def links(self, low: int, high: int, kind: str) -> None:
        flat = self.rng.random() < 0.25
        self.out.append("<div>" if flat else "<ul>")
        for _ in range(self.rng.randint(low, high)):
            text = self.rng.choice(PHRASES[kind]) if self.rng.random() < 0.2 else self.words(1, self.rng.choice([3, 4, 9]))
            before, after = ("<div>", "</div>") if flat else ("<li>", self.rng.choice(["</li>", ""]))
            self.put(0, f'{before}<a href="/x">', text, f"</a>{after}")
        self.out.append("</div>" if flat else "</ul>")

    def around(self, kind: str, inside: bool = False) -> None:
        """A part beside the article, or within it; there it has a name, as without one nothing would tell it apart."""
        rng = self.rng
        tag = TAGS[kind] if kind in TAGS and self.tagged else rng.choice(("div", "div", "section", "td" if kind in ("menu", "side") else "div"))
        name = rng.choice(NAMES[kind]) if inside or (self.named and rng.random() < 0.85) else None
        self.out.append(self.open(tag, name) if rng.random() > 0.04 else f'<{tag} style="display:none">')
        if kind in ("menu", "head") or (kind == "side" and rng.random() < 0.6):
            if kind == "side" and rng.random() < 0.5:
                self.put(0, "<h3>", self.phrase(kind), "</h3>")
            if kind == "head" and rng.random() < 0.5:
                self.put(0, "<div>", self.words(1, 4), "</div>")
            self.links(2, 10, kind)
        elif kind == "comment":
            if rng.random() < 0.5:
                self.put(0, "<h3>", self.phrase(kind), "</h3>")
            for _ in range(rng.randint(1, 8)):
                box = rng.choice(["<div>", "<li>", '<div class="c">', "<article>" if self.tagged and self.telling else "<div>"])
                self.out.append(box)
                if rng.random() < 0.7:
                    self.put(0, rng.choice(["<p><b>", "<div>", "<p><span>"]), f"{self.words(1, 2)} {rng.choice(['says:', 'wrote:', 'schrieb am 3. Mai:', 'a écrit', '2 days ago', ''])}", "</div>")
                self.put(0, "<p>", self.sentences(1, 4), "</p>")
                if rng.random() < 0.4:
                    self.put(0, "<div><a>", rng.choice(["Reply", "Antworten", "Répondre", "Responder"]), "</a></div>")
                self.out.append(f"</{box[1:].split()[0].rstrip('>')}>")
        elif kind == "foot":
            self.put(0, rng.choice(["", "<p>"]), rng.choice((self.phrase(kind), f"{self.phrase(kind)} {self.words(0, 12)}")), "")
            if rng.random() < 0.4:
                self.links(2, 5, kind)
        elif kind == "form":
            self.put(0, "<label>", self.phrase(kind), "</label><input name=q>")
            self.put(0, "<p>", self.words(2, 8), "</p>")
            self.put(0, "<div><button>", self.phrase(kind), "</button></div>")
            if rng.random() < 0.3:
                self.out.append("<select><option>one<option>two</select>")
        elif kind == "share":
            self.put(0, "<p>", self.phrase(kind), "</p>")
            if rng.random() < 0.5:
                self.links(2, 4, kind)
        else:
            if rng.random() < 0.6:
                self.put(0, rng.choice(["<p>", "<div>", "<h4>"]), self.phrase(kind), "</p>")
            for _ in range(rng.randint(1, 3)):
                self.put(0, *rng.choice([("<p>", self.sentences(1, 2), "</p>"), ("<h3>", self.words(1, 5), "</h3>"), ("<div>", self.sentences(1, 2), "</div>"), ("<p>", self.words(2, 9), "")]))
            if rng.random() < 0.3:
                self.put(0, "<p><a>", self.words(1, 4), "</a></p>")
        self.out.append(f"</{tag}>")

    def part(self, style: str) -> None:
        """Some blocks of the article."""
        rng = self.rng
        if style == "breaks":  # lines between breaks, all one block
            self.put(1, "<font size=2>", " <br><br> ".join(self.sentences(1, 6) for _ in range(rng.randint(1, 5))).replace(" <br><br> ", " "), "</font>")
            return
        for _ in range(rng.choice([1, 2, 3, 5, 8, 12])):
            kind = rng.random()
            if kind < 0.08:
                self.put(1, "<p><b>", self.sentences(1, 3), rng.choice(["<br>", "</b></p>"]))
            elif kind < 0.16:
                self.put(1, rng.choice(["<h2>", "<h3>"]), self.words(1, 8), "</h2>")
            elif kind < 0.22:
                self.out.append(rng.choice(["<ul>", "<ol>"]))
                for _ in range(rng.randint(2, 5)):
                    self.put(1, "<li>", self.sentences(1, 1) if rng.random() < 0.7 else self.words(1, 6), "</li>")
                self.out.append("</ul>")
            elif kind < 0.26:
                self.put(1, "<blockquote>", self.sentences(1, 3), "</blockquote>")
            elif kind < 0.30:
                self.put(1, "<pre>", self.words(3, 40), "</pre>")
            elif kind < 0.34:
                self.out.append("<table>")
                for _ in range(rng.randint(2, 4)):
                    self.out.append("<tr>")
                    for _ in range(2):
                        self.put(1, rng.choice(["<td>", "<th>"]), self.words(1, 3), "</td>")
                self.out.append("</table>")
            elif kind < 0.37:
                self.put(1, "<figure><img src=a><figcaption>", self.words(3, 14), "</figcaption></figure>")
            elif kind < 0.40:
                self.put(1, "<dl><dt>", self.words(1, 4), "")
                self.put(1, "<dd>", self.sentences(1, 2), "</dl>")
            elif kind < 0.42:
                self.put(1, "<p>", f"{self.sentences(1, 2)} {self.phrase(rng.choice(list(PHRASES)))} {self.words(1, 4)}.", "</p>")
            elif kind < 0.52:
                self.put(1, "<p>", self.words(1, 9) + rng.choice([".", "", "!"]), "</p>")
            elif style == "divs":
                self.put(1, "<div>", self.sentences(1, rng.choice([1, 3, 9])), "</div>")
            elif kind < 0.60:
                a, b = self.sentences(1, 2), self.words(1, 4)
                self.labels[f"{a} {b} x."] = 1
                self.out.append(f"<p>{a} <a href=y>{b}</a> x.</p>")
            else:
                self.put(1, "<p>", self.sentences(1, rng.choice([1, 3, 9])), rng.choice(["</p>", "</p>", ""]))
            if rng.random() < 0.03:  # on its own among the paragraphs
                self.put(0, rng.choice(["<p>", "<div>"]), rng.choice(PHRASES[rng.choice(["share", "ad", "form", "side"])]), "</p>")
            if rng.random() < 0.08:
                self.around(rng.choice(["ad", "share", "notice", "form", "side"]), inside=True)

    def article(self) -> None:
        rng = self.rng
        tag = ""
        if rng.random() > 0.07 or self.telling:
            tag = rng.choice(["article", "article", "main"]) if self.tagged and self.telling else rng.choice(["div", "div", "section", "td", "center"])
        name = rng.choice(MAIN) if tag and self.named and self.telling else None
        deep = rng.randint(0, 2)
        if tag:
            self.out.append(("<table><tr>" if tag == "td" else "") + self.open(tag, name) + "".join(self.open("div") for _ in range(deep)))
        head = rng.random()
        if head < 0.7:
            self.put(1, "<h1>", self.words(1, 12), "</h1>")
        elif head < 0.8 and self.tagged:
            self.put(1, "<header><h1>", self.words(1, 12), "</h1></header>")
        if rng.random() < 0.15:
            self.around("share")
        style = rng.choice(["", "", "", "", "divs", "breaks"])
        if self.telling and (self.named or self.tagged) and rng.random() < 0.12:  # hardly anything in it
            for _ in range(rng.randint(1, 2)):
                self.put(1, "<p>", self.words(1, 5) + rng.choice([".", ""]), "</p>")
        elif rng.random() < 0.2:
            for _ in range(rng.randint(2, 4)):
                box = "section" if rng.random() < 0.6 else "div"
                self.out.append(self.open(box))
                if rng.random() < 0.6:
                    self.put(1, "<h2>", self.words(1, 8), "</h2>")
                self.part(style)
                self.out.append(f"</{box}>")
        else:
            self.part(style)
        if rng.random() < 0.1:
            self.around("comment")
        if tag:
            self.out.append("</div>" * deep + f"</{tag}>" + ("</tr></table>" if tag == "td" else ""))

    def html(self) -> str:
        rng = self.rng
        self.out.append("<!DOCTYPE html><html><head><title>t</title><style>p{}</style></head><body>")
        bare = rng.random() < 0.12
        if bare and rng.random() < 0.25:  # text and nothing else
            self.put(1, "", self.sentences(1, 3), "")
            return "".join(self.out)
        for kind in ("head", "menu", "notice", "ad", "form"):
            if rng.random() < 0.5 and not bare:
                self.around(kind)
        if rng.random() < 0.2 and not bare:
            self.around("side")
        wrap = rng.randint(0, 2)
        self.out += [self.open("div", rng.choice(["page", "container", "wrapper", None])) for _ in range(wrap)]
        self.article()
        for kind in ("share", "comment", "side", "ad", "form"):
            if rng.random() < 0.35 and not bare:
                self.around(kind)
        self.out.append("</div>" * wrap)
        for kind in ("notice", "foot"):
            if rng.random() < 0.6 and not bare:
                self.around(kind)
        self.out.append("</body></html>")
        return "".join(self.out)


def pages(n: int, seed: int = 0) -> list[tuple[str, dict[str, int]]]:
    """Pages with the label of each block's text: 1 in the article, 0 around it."""
    out = []
    for i in range(n):
        page = Page(seed * 1_000_003 + i)
        out.append((page.html(), page.labels))
    return out
