"""Made web pages with known block labels, to train the block labeller on.

Each page is laid out by chance: where the article stands and in what markup,
and which menus, headers, notices, adverts, sidebars, forms, comments and
footers surround or interrupt it. Its words are invented, apart from a list of
words that such surroundings use.
"""

from __future__ import annotations

import html
import random
from collections.abc import Iterator

import numpy as np

from paylens.llm.html_blocks import Page, read_page

# Words of page furniture, and names that page authors give to parts of a page.
FURNITURE = (
    "home menu search login register subscribe newsletter share follow contact about privacy policy terms cookies accept copyright rights "
    "reserved comments reply comment advertisement sponsored ad related more read next previous archive tags categories sitemap help shop "
    "startseite anmelden impressum datenschutz kommentare werbung mehr accueil connexion contact commentaires mentions publicité inicio "
    "buscar contacto comentarios publicidad privacidad aviso"
).split()
ARTICLE_NAMES = ("content", "post", "entry", "entry-content", "article", "article-body", "story", "story-body", "main", "main-content", "text", "post-content", "body-copy", "page-content")
NEUTRAL_NAMES = ("wrapper", "container", "row", "col", "inner", "box", "page", "site", "block", "clearfix", "layout", "grid", "left", "right", "wide")
PART_NAMES = {
    "menu": ("nav", "menu", "navbar", "navigation", "breadcrumb", "breadcrumbs", "topnav", "toc", "pagination", "pager", "tabs", "skip-link"),
    "header": ("header", "masthead", "site-header", "top", "branding", "logo", "topbar"),
    "footer": ("footer", "site-footer", "bottom", "copyright", "colophon", "legal"),
    "side": ("sidebar", "side", "widget", "related", "recommended", "popular", "trending", "aside", "rail", "teaser", "latest"),
    "ad": ("ad", "ads", "advert", "advertisement", "banner", "sponsor", "sponsored", "promo", "promotion", "adsense"),
    "notice": ("notice", "cookie", "cookie-notice", "consent", "alert", "gdpr", "modal", "popup", "overlay", "disclaimer", "message", "paywall"),
    "form": ("form", "search", "search-form", "subscribe", "newsletter", "signup", "login", "contact-form"),
    "comments": ("comments", "comment", "comment-list", "discussion", "responses", "replies", "disqus", "reader-comments"),
    "share": ("share", "social", "social-links", "share-buttons", "tools", "toolbar"),
}
SYLLABLES = "th er on an re he in ed nd ha at en es of or nt ti to it st io le is ou ar as de rt ve sch ung eau ción ñe ü é la ver ge ch lich ein pro con mi ta ka lo ne".split()


class _Maker:
    def __init__(self, rnd: random.Random):
        self.rnd = rnd
        self.labels: list[int] = []
        self.syllables = rnd.sample(SYLLABLES, 14)

    def chance(self, p: float) -> bool:
        return self.rnd.random() < p

    def word(self) -> str:
        return "".join(self.rnd.choices(self.syllables, k=self.rnd.choice((1, 1, 2, 2, 3))))

    def words(self, n: int) -> str:
        return " ".join(self.word() for _ in range(n))

    def sentence(self) -> str:
        words = [self.word() + ("," if self.chance(0.06) else "") for _ in range(self.rnd.choice((1, 2, 3, 6, 9, 14, 22)))]
        return " ".join(words).rstrip(",").capitalize() + self.rnd.choice((".", ".", ".", ".", "!", "?"))

    def prose(self, most: int = 6) -> str:
        text = " ".join(self.sentence() for _ in range(self.rnd.randint(1, most)))
        return text.replace(" ", " | ") if self.chance(0.03) else text

    def furniture(self, n: int) -> str:
        return " ".join(self.rnd.choice(FURNITURE) if self.chance(0.6) else self.word() for _ in range(n)).capitalize()

    def leaf(self, label: int, text: str) -> str:
        """The text as markup; it makes one block with this label."""
        self.labels.append(label)
        text = html.escape(text, quote=False)
        if self.chance(0.2):
            text = text.replace(" ", "\n", 1).replace("é", "&eacute;").replace("ü", "&#252;")
        return text

    def inline(self, markup: str) -> str:
        pieces = markup.split(" ")
        if len(pieces) > 4 and self.chance(0.35):
            a = self.rnd.randrange(len(pieces) - 2)
            b = self.rnd.randint(a + 1, min(len(pieces), a + 5))
            tag, attributes = self.rnd.choice((("b", ""), ("i", ""), ("em", ""), ("strong", ""), ("span", ' class="x"'), ("a", ' href="/x?a=1"'), ("code", "")))
            pieces[a:b] = [f"<{tag}{attributes}>" + " ".join(pieces[a:b]) + (f"</{tag}>" if self.chance(0.9) or tag == "a" else "")]
        if self.chance(0.06):
            pieces.insert(self.rnd.randrange(len(pieces) + 1), "<br>")
        return " ".join(pieces)

    def named(self, names: tuple[str, ...], p: float = 0.9) -> str:
        if not self.chance(p):
            return ""
        name = self.rnd.choice(names)
        if self.chance(0.25):
            name = f"{self.rnd.choice(('site', 'page', 'js', 'c', 'block', 'l'))}-{name}"
        if self.chance(0.2):
            name = f"{name}-{self.rnd.choice(('box', 'wrap', 'area', 'inner', '1', 'list', 'section'))}"
        key = self.rnd.choice(("class", "class", "class", "id"))
        quote = self.rnd.choice(('"', '"', '"', "'"))
        return f" {key}={quote}{name}{quote}"

    def wrapped(self, tag: str, attributes: str, inside: str, p_end: float = 0.98) -> str:
        return f"<{tag}{attributes}>{inside}" + (f"</{tag}>" if self.chance(p_end) else "")

    def links(self, label: int, n: int, words: int = 2) -> str:
        style = self.rnd.choice(("ul", "ul", "ol", "div", "plain"))
        items = [f'<a href="/{i}">{self.leaf(label, self.furniture(self.rnd.randint(1, words)))}</a>' for i in range(n)]
        if style in ("ul", "ol"):
            return f"<{style}>" + "".join(self.wrapped("li", "", i, 0.9) for i in items) + f"</{style}>"
        if style == "div":
            return "".join(f"<div>{i}</div>" for i in items)
        del self.labels[len(self.labels) - n + 1:]
        return " | ".join(items)

    # parts around the article

    def menu(self) -> str:
        inside = self.links(0, self.rnd.randint(2, 12), self.rnd.choice((1, 2, 3)))
        return f"<nav{self.named(PART_NAMES['menu'], 0.4)}>{inside}</nav>" if self.chance(0.6) else f"<div{self.named(PART_NAMES['menu'])}>{inside}</div>"

    def header(self) -> str:
        tag = self.rnd.choice(("header", "header", "div"))
        inside = self.wrapped(self.rnd.choice(("div", "h1", "p", "h2")), self.named(PART_NAMES["header"], 0.5), self.leaf(0, self.words(self.rnd.randint(1, 4))))
        if self.chance(0.5):
            inside += f"<p>{self.leaf(0, self.rnd.choice((self.furniture(4), self.prose(1))))}</p>"
        if self.chance(0.4):
            inside += self.menu()
        return f"<{tag}{self.named(PART_NAMES['header'], 0.4 if tag == 'header' else 1)}>{inside}</{tag}>"

    def footer(self) -> str:
        tag = self.rnd.choice(("footer", "footer", "div"))
        attributes = self.named(PART_NAMES["footer"], 0.3 if tag == "footer" else 1)
        choice = self.rnd.randint(0, 3)
        if choice == 0:
            inside = self.leaf(0, f"© {self.word()}.example · {self.prose(3)}")
        elif choice == 1:
            inside = f"<p>{self.leaf(0, self.furniture(self.rnd.randint(3, 12)))}</p>" + self.links(0, self.rnd.randint(2, 8))
        elif choice == 2:
            inside = "".join(f"<div><h4>{self.leaf(0, self.furniture(1))}</h4><p>{self.leaf(0, self.prose(2))}</p></div>" for _ in range(self.rnd.randint(1, 3)))
        else:
            inside = f"<p>{self.leaf(0, f'© 20{self.rnd.randint(10, 26)} {self.word()}. {self.furniture(5)}')}</p>"
        return self.wrapped(tag, attributes, inside, 0.8)

    def aside(self) -> str:
        tag = self.rnd.choice(("aside", "aside", "div", "section"))
        attributes = self.named(PART_NAMES["side"], 0.4 if tag == "aside" else 1)
        inside = ""
        for _ in range(self.rnd.randint(1, 4)):
            heading = f"<h3>{self.leaf(0, self.rnd.choice((self.furniture(2), self.words(3))))}</h3>" if self.chance(0.7) else ""
            body = self.links(0, self.rnd.randint(2, 7), 6) if self.chance(0.5) else f"<p>{self.inline(self.leaf(0, self.prose(4)))}</p>"
            inside += self.wrapped("div", self.named(PART_NAMES["side"], 0.5), heading + body, 1) if self.chance(0.5) else heading + body
        return f"<{tag}{attributes}>{inside}</{tag}>"

    def advert(self) -> str:
        tag = self.rnd.choice(("div", "div", "div", "section", "aside", "p"))
        text = self.leaf(0, self.rnd.choice((self.prose(3), self.prose(1), self.furniture(6))))
        if tag != "p" and self.chance(0.3):
            text = f"<p>{text}</p>"
        if self.chance(0.3):
            text = f'<a href="//x">{text}</a>'
        return f"<{tag}{self.named(PART_NAMES['ad'], 1)}>{text}</{tag}>"

    def notice(self) -> str:
        tag = self.rnd.choice(("div", "div", "section", "dialog", "aside"))
        inside = f"<p>{self.leaf(0, self.rnd.choice((self.prose(3), self.furniture(14))))}</p>"
        if self.chance(0.2):
            inside = inside[3:-4]
        elif self.chance(0.6):
            inside += f"<button>{self.leaf(0, self.furniture(1))}</button>"
        role = ' role="alert"' if self.chance(0.2) else ""
        return f"<{tag}{self.named(PART_NAMES['notice'], 0.6 if tag == 'dialog' else 1)}{role}>{inside}</{tag}>"

    def form(self) -> str:
        fields = ""
        if self.chance(0.5):
            fields += f"<h3>{self.leaf(0, self.furniture(3))}</h3>"
        if self.chance(0.5):
            fields += f"<p>{self.leaf(0, self.prose(2))}</p>"
        for _ in range(self.rnd.randint(1, 3)):
            fields += f'<div><label>{self.leaf(0, self.furniture(1))}</label><input type="text" value="x"></div>'
        if self.chance(0.4):
            fields += "<select><option>a<option>b</select><textarea>old</textarea>"
        if self.chance(0.7):
            fields += f"<button>{self.leaf(0, self.furniture(1))}</button>"
        made = f'<form action="/s"{self.named(PART_NAMES["form"], 0.4)}>{fields}</form>'
        return made if self.chance(0.6) else f"<div{self.named(PART_NAMES['form'], 1)}>{made}</div>"

    def share(self) -> str:
        return f"<div{self.named(PART_NAMES['share'], 1)}>{self.links(0, self.rnd.randint(2, 5), 1)}</div>"

    def comments(self) -> str:
        tag = self.rnd.choice(("section", "div", "div", "ol", "ul"))
        heading = f"<h3>{self.leaf(0, self.rnd.choice(('Comments', '3 comments', 'Kommentare', self.furniture(2))))}</h3>" if self.chance(0.7) else ""
        inside = ""
        item = "li" if tag in ("ol", "ul") else self.rnd.choice(("div", "article", "div"))
        for _ in range(self.rnd.randint(1, 6)):
            who = f"<{self.rnd.choice(('b', 'cite', 'span'))}>" if self.chance(0.0) else ""
            by = f"<div{self.named(('author', 'meta', 'comment-author', 'by'), 0.8)}>{who}{self.leaf(0, self.words(2))}</div>" if self.chance(0.7) else ""
            inside += f"<{item}{self.named(PART_NAMES['comments'] if item != 'li' else ('comment',), 0.85)}>{by}<p>{self.inline(self.leaf(0, self.prose(4)))}</p></{item}>"
        return f"<{'div' if tag in ('ol', 'ul') else tag}{self.named(PART_NAMES['comments'], 1)}>{heading}" + (
            f"<{tag}>{inside}</{tag}>" if tag in ("ol", "ul") else inside) + f"</{'div' if tag in ('ol', 'ul') else tag}>"

    # the article

    def paragraph(self) -> str:
        text = self.inline(self.leaf(1, self.rnd.choice((self.prose(8), self.prose(3), self.prose(40) if self.chance(0.2) else self.prose(5), self.sentence(), self.words(self.rnd.randint(1, 3)) + "."))))
        style = self.rnd.random()
        if style < 0.70:
            return f"<p{self.named(('lead', 'intro', 'p1', 'x'), 0.08)}>{text}" + ("</p>" if self.chance(0.85) else "")
        if style < 0.80:
            return f"<p><b>{text}<br>"
        return f"<div{self.named(('para', 'text', 'block'), 0.3)}>{text}</div>" if style < 0.88 else f"<p>{text}</p>"

    def article_part(self) -> str:
        kind = self.rnd.random()
        if kind < 0.72:
            return self.paragraph()
        if kind < 0.80:
            return f"<{(h := self.rnd.choice(('h2', 'h3', 'h4')))}>{self.leaf(1, self.words(self.rnd.randint(1, 6)).capitalize())}</{h}>"
        if kind < 0.85:
            tag = self.rnd.choice(("ul", "ol"))
            return f"<{tag}>" + "".join(self.wrapped("li", "", self.inline(self.leaf(1, self.rnd.choice((self.words(3), self.prose(2))))), 0.7) for _ in range(self.rnd.randint(2, 5))) + f"</{tag}>"
        if kind < 0.89:
            return f"<blockquote><p>{self.leaf(1, self.prose(3))}</p></blockquote>"
        if kind < 0.92:
            return f"<pre>{self.leaf(1, self.words(6))}</pre>"
        if kind < 0.95:
            rows = "".join("<tr>" + "".join(f"<td>{self.leaf(1, self.words(self.rnd.randint(1, 3)))}</td>" for _ in range(2)) + "</tr>" for _ in range(self.rnd.randint(1, 3)))
            return f"<table>{rows}</table>"
        return f'<figure><img src="x.png" alt="{self.word()}"><figcaption>{self.leaf(1, self.prose(1))}</figcaption></figure>'

    def article(self) -> str:
        inside = ""
        title = self.rnd.choice((self.words(self.rnd.randint(2, 9)).capitalize(), self.prose(2)[:60], self.sentence()))
        if self.chance(0.8) and title.strip():
            heading = f"<h1>{self.leaf(1, ' '.join(title.split()))}</h1>"
            inside += f"<header>{heading}</header>" if self.chance(0.12) else heading
        for _ in range(self.rnd.choice((1, 1, 2, 3, 4, 5, 6, 8, 10, 12, 16, 45))):
            inside += self.article_part()
            if self.chance(0.05):
                inside += self.rnd.choice((self.advert, self.aside, self.form, self.share, self.notice))()
        if self.chance(0.12):
            inside += self.rnd.choice((self.share, self.comments, self.aside))()
        kind = self.rnd.random()
        if kind < 0.40:
            made = self.wrapped("article", self.named(ARTICLE_NAMES, 0.3), inside)
            return f"<main>{made}</main>" if self.chance(0.4) else made
        if kind < 0.55:
            return self.wrapped("main", self.named(ARTICLE_NAMES, 0.3), inside)
        if kind < 0.85:
            return self.wrapped(self.rnd.choice(("div", "div", "section")), self.named(ARTICLE_NAMES, 1), inside)
        if kind < 0.90:
            return f"<table><tr><td{self.named(ARTICLE_NAMES, 0.5)}>{inside}</td></tr></table>"
        return self.wrapped("div", self.named(NEUTRAL_NAMES, 0.5), inside) if kind < 0.95 else inside

    def page(self) -> str:
        before = [self.header, self.menu, self.advert, self.notice, self.form, self.aside, self.share]
        after = [self.comments, self.aside, self.advert, self.menu, self.form, self.notice, self.share]
        body = "".join(make() for make in before if self.chance(0.33))
        if self.chance(0.97):
            body += self.article()
        body += "".join(make() for make in after if self.chance(0.28))
        if self.chance(0.8):
            body += self.footer()
        for _ in range(self.rnd.choice((0, 0, 1, 2))):
            body = f"<div{self.named(NEUTRAL_NAMES, 0.8)}>{body}</div>"
        if self.chance(0.5):
            body = body.replace("</p>", "</p><!-- ad --><script>var a = '<p>x</p>';</script>\n", 2)
        head = f'<!DOCTYPE html><html lang="en"><head><meta charset="utf-8"><title>{self.words(4)}</title><style>p{{margin:0}}</style></head>'
        return (head if self.chance(0.9) else "") + f"<body>{body}" + ("</body></html>" if self.chance(0.8) else "")


def training_pages(n: int, seed: int = 0) -> Iterator[tuple[Page, np.ndarray]]:
    """``n`` made pages as read, with their blocks' labels (1: main text)."""
    rnd = random.Random(seed)
    made = 0
    while made < n:
        maker = _Maker(rnd)
        page = read_page(maker.page())
        if len(page.texts) != len(maker.labels):
            continue  # an inline element left open or an empty leaf merged blocks
        made += 1
        yield page, np.array(maker.labels, np.float32)
