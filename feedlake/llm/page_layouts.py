"""Pages in many layouts around given texts, with the truth about each block, to learn from.

Crawled pages tell by their own markup at best which blocks are the article; to be right on sites
built in other ways, the labeller also learns from the texts of crawled pages laid out anew: other
elements and names for the article, and menus, headers, footers, sidebars, notices, adverts, forms
and comments of all kinds around it and inside it.
"""

from __future__ import annotations

import html
import random
from collections.abc import Sequence

from feedlake.llm.html_blocks import Block

# Names that sites give to the parts of a page.
ARTICLE = "content post entry-content article article-body story post-body entry text main-content page-content articleBody post-content".split()
PARTS = {
    "nav": "nav menu navbar topnav breadcrumb breadcrumbs navigation site-nav main-menu tabs pagination pager".split(),
    "header": "header site-header masthead banner topbar branding page-header logo".split(),
    "footer": "footer site-footer foot bottom copyright legal colophon imprint credits".split(),
    "aside": "sidebar side widget related recommended trending popular more-stories rail secondary".split(),
    "notice": "cookie cookies cookie-notice consent notice notification alert gdpr popup modal overlay message warning banner-notice".split(),
    "ad": "ad ads advert advertisement sponsored promo sponsor ad-slot adsense promotion teaser".split(),
    "form": "form search login signup subscribe newsletter contact search-form".split(),
    "comments": "comments comment-list responses discussion replies commentlist disqus comment-section user-comments".split(),
    "share": "share social sharing tags meta byline toolbar follow".split(),
}
ELEMENTS = {"nav": "nav", "header": "header", "footer": "footer", "aside": "aside", "form": "form"}
WRAPPERS = "container wrapper row col page site inner clearfix block section layout box grid root app outer".split()
PHRASES = {
    "nav": "Home|About us|Contact|News|Sports|Login|Sitemap|Accueil|Startseite|Inicio|Archive|Next|Previous|Products|Blog|Help",
    "header": "Welcome|The daily site|Your source for everything|Skip to content|Menu|Search",
    "footer": "© 2024 All rights reserved|Privacy policy|Terms of use|Imprint|Powered by|Contact us|Mentions légales|Impressum|Datenschutz|Aviso legal",
    "aside": "Related articles|Most read|Read also|You may also like|Popular now|À lire aussi|Mehr zum Thema|Te puede interesar",
    "notice": "We use cookies to improve this site.|Accept all cookies|This site uses cookies.|Please enable JavaScript.|Nous utilisons des cookies.|Wir verwenden Cookies.|Usamos cookies.",
    "ad": "Advertisement|Sponsored|Buy now and save|Limited offer|Click here|Publicité|Anzeige|Publicidad",
    "form": "Search|Subscribe to our newsletter|Your email|Password|Send|Submit|Sign up|Name|Leave a reply|Remember me",
    "comments": "Comments|3 comments|Reply|Leave a comment|Log in to reply|Commentaires|Kommentare|Comentarios|says:",
    "share": "Share|Tweet|Print this page|By admin|Posted on May 4|Tags: news|Facebook|Teilen|Partager",
}


class Layout:
    """One page: markup is collected, and each text with whether it is of the article."""

    def __init__(self, r: random.Random, texts: Sequence[str]):
        self.r, self.texts = r, texts
        self.markup: list[str] = []
        self.truth: list[tuple[str, bool]] = []

    def prose(self) -> str:
        return self.r.choice(self.texts)

    def few(self) -> str:
        words = self.prose().split()
        start = self.r.randrange(len(words))
        return " ".join(words[start : start + self.r.randint(1, 4)])

    def text(self, value: str, mine: bool, wrap: str | None = None) -> None:
        value = " ".join(value.split())
        if not value:
            return
        inner = html.escape(value, quote=False)
        if wrap is None and self.r.random() < 0.1:
            words = inner.split(" ")
            k = self.r.randrange(len(words))
            words[k] = self.r.choice(("<b>{}</b>", "<em>{}</em>", "<a href='/x'>{}</a>", "<span class='x'>{}</span>")).format(words[k])
            inner = " ".join(words)
        self.markup.append(f"<{wrap} href='#'>{inner}</{wrap}>" if wrap else inner)
        self.truth.append((value, mine))

    def open(self, tag: str, *names: str) -> str:
        attr = self.r.choice(("class", "class", "class", "id"))
        extra = [self.r.choice(WRAPPERS)] if self.r.random() < 0.15 else []
        names = (*extra, *names) if attr == "class" else names[:1]
        self.markup.append(f'<{tag} {attr}="{" ".join(names)}">' if names else f"<{tag}>")
        return f"</{tag}>"

    def close(self, end: str) -> None:
        self.markup.append(end)

    def element(self, tag: str, value: str, mine: bool, wrap: str | None = None) -> None:
        self.markup.append(f"<{tag}>")
        self.text(value, mine, wrap)
        # Ends that may be left out sometimes are.
        if tag not in ("p", "li", "td", "dd") or self.r.random() < 0.9:
            self.markup.append(f"</{tag}>")

    def part(self, kind: str) -> None:
        r = self.r
        tag = ELEMENTS.get(kind, "section")
        named = tag == "section" or r.random() < 0.6
        tag = r.choice((tag, "div")) if named else tag
        if tag == "div" or tag == "section" or r.random() < 0.3:
            end = self.open(tag, r.choice(PARTS[kind]))
        else:
            end = self.open(tag)
        if kind == "nav" or (kind in ("footer", "header", "aside", "share") and r.random() < 0.4):
            if kind == "aside":
                self.element(r.choice(("h2", "h3", "h4")), r.choice(PHRASES[kind].split("|")), False)
            listed = r.random() < 0.7
            self.markup.append("<ul>" if listed else "")
            for _ in range(r.randint(2, 9)):
                value = r.choice(PHRASES[kind].split("|")) if r.random() < 0.4 else self.few()
                self.element("li" if listed else r.choice(("div", "p")), value, False, "a" if r.random() < 0.9 else None)
            self.markup.append("</ul>" if listed else "")
        elif kind == "comments":
            self.element(r.choice(("h2", "h3", "p")), r.choice(PHRASES[kind].split("|")), False)
            for _ in range(r.randint(1, 5)):
                inner = self.open(r.choice(("div", "li", "article", "section")), r.choice(("comment", "comment-body", "reply", "response")))
                if r.random() < 0.6:
                    self.element(r.choice(("p", "div", "h4")), self.few(), False)
                for _ in range(r.randint(1, 2)):
                    self.element("p", self.prose(), False)
                self.close(inner)
        elif kind == "form":
            for _ in range(r.randint(1, 4)):
                self.element(r.choice(("p", "div", "fieldset", "legend", "option", "textarea")), r.choice(PHRASES[kind].split("|")), False)
        elif r.random() < 0.25:
            self.text(self.prose() if r.random() < 0.6 else r.choice(PHRASES[kind].split("|")), False)
        else:
            for _ in range(r.randint(1, 3)):
                kindly = r.random() < 0.5
                self.element(r.choice(("p", "div", "h3", "h4") if kind != "header" else ("h1", "div", "p")), r.choice(PHRASES[kind].split("|")) if kindly else self.prose() if r.random() < 0.7 else self.few(), False)
        self.close(end)

    def article(self, paragraphs: Sequence[str]) -> None:
        r = self.r
        kind = r.random()
        if kind < 0.35:
            ends = [self.open("article", *([r.choice(ARTICLE)] if r.random() < 0.4 else []))]
        elif kind < 0.5:
            ends = [self.open("main", *([r.choice(ARTICLE)] if r.random() < 0.3 else []))]
            if r.random() < 0.5:
                ends.append(self.open(r.choice(("article", "div", "section"))))
        elif kind < 0.93:
            ends = [self.open(r.choice(("div", "div", "section", "td")), r.choice(ARTICLE))]
            if ends[0] == "</td>":
                self.markup.insert(-1, "<table><tr>")
                ends.insert(0, "</tr></table>")
        else:
            ends = [self.open("div")]
        inside = [k for k in ("ad", "share", "aside", "form", "notice", "comments") if r.random() < 0.08]
        self.element(r.choice(("h1", "h1", "h1", "h2")), paragraphs[0][:60] if r.random() < 0.6 else self.few(), True)
        for i, value in enumerate(paragraphs):
            draw = r.random()
            if draw < 0.82:
                self.element("p", value, True)
            elif draw < 0.87:
                self.element(r.choice(("h2", "h3")), self.few(), True)
                self.element("p", value, True)
            elif draw < 0.91:
                self.markup.append("<ul>")
                for _ in range(r.randint(1, 4)):
                    self.element("li", self.few() if r.random() < 0.5 else self.prose(), True)
                self.markup.append("</ul>")
            elif draw < 0.94:
                self.element("blockquote", value, True)
            elif draw < 0.96:
                self.element("pre", value, True)
            elif draw < 0.98:
                self.element("p", self.few(), True)
            else:
                self.element("div", value, True)
            if inside and (r.random() < 0.5 or i + 1 == len(paragraphs)):
                self.part(inside.pop())
        for kind in inside:
            self.part(kind)
        for end in reversed(ends):
            self.close(end)

    def page(self) -> str:
        r = self.r
        paragraphs = [self.prose() for _ in range(min(r.randint(1, 12), r.randint(1, 25)))]
        self.markup.append("<!DOCTYPE html><html><head>")
        if r.random() < 0.8:
            self.element("title", paragraphs[0][:60] if r.random() < 0.6 else self.few(), False)
        self.markup.append("<style>p{margin:0}</style></head><body>")
        ends = [self.open("div", r.choice(WRAPPERS)) for _ in range(r.randint(0, 2))]
        before = [k for k, share in (("notice", 0.25), ("header", 0.5), ("nav", 0.75), ("form", 0.2), ("ad", 0.5), ("aside", 0.15)) if r.random() < share]
        after = [k for k, share in (("share", 0.2), ("aside", 0.4), ("comments", 0.4), ("form", 0.2), ("ad", 0.25), ("nav", 0.15), ("footer", 0.75), ("notice", 0.15)) if r.random() < share]
        if r.random() < 0.3:
            r.shuffle(before)
        for kind in before:
            self.part(kind)
        self.article(paragraphs)
        for kind in after:
            self.part(kind)
        for end in reversed(ends):
            self.close(end)
        if r.random() < 0.9:
            self.markup.append("</body></html>")
        return "".join(self.markup)


#: Elements that mark the article, and what is never part of it, in a page's own markup.
_MARKED = {"article", "main"}
_APART = {"nav", "aside", "footer", "header", "form"} | {"." + w for names in PARTS.values() for n in names for w in n.split("-")} - {".text", ".main", ".page", ".content", ".post"}


def by_markup(page: Sequence[Block]) -> list[bool] | None:
    """What the markup says about each block; None if it marks no article."""
    if not any(_MARKED & set(b.path) for b in page):
        return None
    return [bool(_MARKED & set(b.path)) and not _APART & set(b.path) for b in page]


def invented(r: random.Random, words: int) -> str:
    """A text of made-up words, for tables whose pages mark no article."""
    word = lambda: "".join(r.choice("aeiou" if i % 2 else "bdglmnrst") for i in range(r.randint(2, 8)))
    return " ".join(word() for _ in range(words)).capitalize() + "."


def training_pages(crawled: Sequence[Sequence[Block]], count: int, seed: int = 7) -> tuple[list[str], list[list[tuple[str, bool]]]]:
    """``count`` pages laid out around the article texts of crawled ones, with their truth."""
    r = random.Random(seed)
    texts = []
    for page in crawled:
        labels = by_markup(page) or [b.linked < 0.5 and b.text.count(" ") > 10 for b in page]
        texts += [b.text for b, mine in zip(page, labels, strict=True) if mine and len(b.text) < 2_000]
    # Half of the texts are cut short: articles hold short paragraphs, too.
    texts = [t if r.random() < 0.6 else " ".join(t.split()[: r.randint(1, 30)]) for t in texts]
    texts += [invented(r, min(r.randint(2, 80), r.randint(2, 160))) for _ in range(max(50, len(texts) // 4))]
    pages, truths = [], []
    for _ in range(count):
        layout = Layout(r, texts)
        pages.append(layout.page())
        truths.append(layout.truth)
    return pages, truths
