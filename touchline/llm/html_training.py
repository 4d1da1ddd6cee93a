"""Labelled pages for the extraction model, generated from a set of layouts.

Each page is a list of pieces (html, is main text), rendered in one of several layouts, parsed by
the operator's own parser and labelled block by block. Words are random syllables, so the model
learns layout, not vocabulary; the names of tags and classes vary from page to page.
"""

from __future__ import annotations

import random

from touchline.llm.html_extract import Block, parse

_SYLLABLES = "ka lo mi ren tas vo ur el den por sha ti gra no ble que ment ung".split()
#: Class and id names that pages use for each part.
_NAMES = {
    "nav": "nav navbar menu main-menu navigation topnav breadcrumb breadcrumbs site-nav toc pagination pager skip-link".split(),
    "header": "header site-header masthead banner top-bar logo branding page-header".split(),
    "footer": "footer site-footer bottom colophon copyright legal page-footer".split(),
    "side": "sidebar side aside widget related related-posts recommended popular trending tags rail secondary newsletter share social author-box".split(),
    "ad": "ad ads advert advertisement sponsored promo banner-ad ad-slot sponsor adsense promotion".split(),
    "notice": "notice cookie cookie-banner consent gdpr alert popup modal overlay paywall cookie-notice".split(),
    "comments": "comments comment-list comment discussion replies reader-comments responses disqus comment-section".split(),
    "form": "form search-form login subscribe contact-form signup search newsletter-form".split(),
    "main": "content article post entry article-body post-content entry-content main story main-content text body-text prose".split(),
}


class _Writer:
    def __init__(self, seed: int):
        self.r = random.Random(seed)

    def word(self) -> str:
        return "".join(self.r.choice(_SYLLABLES) for _ in range(self.r.randint(1, 3)))

    def words(self, low: int, high: int) -> str:
        return " ".join(self.word() for _ in range(self.r.randint(low, high)))

    def sentence(self, low: int = 3, high: int = 18) -> str:
        text = self.words(low, high).capitalize() + self.r.choice(("." * 6) + "!?")
        return text.replace(" ", self.r.choice([" "] * 8 + [" &amp; ", "&nbsp;", " %%% "]), 1)

    def prose(self) -> str:
        return " ".join(self.sentence() for _ in range(self.r.choice((1, 1, 2, 3, 5, 9))))

    def name(self, part: str) -> str:
        return self.r.choice(_NAMES[part])

    def attribute(self, part: str) -> str:
        return f'{self.r.choice(("class", "class", "id"))}="{self.name(part)}"'

    def links(self, low: int = 2, high: int = 8) -> str:
        items = [f'<a href="/{self.word()}">{self.words(1, 3)}</a>' for _ in range(self.r.randint(low, high))]
        kind = self.r.randint(0, 2)
        if kind == 0:
            return "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>"
        return (" | " if kind == 1 else " ").join(items) if kind == 1 else "<div>" + "</div><div>".join(items) + "</div>"

    # Parts of a page that are not main text.

    def nav(self) -> str:
        return self.r.choice((f"<nav>{self.links()}</nav>", f"<nav {self.attribute('nav')}>{self.links()}</nav>", f"<div {self.attribute('nav')}>{self.links()}</div>"))

    def header(self) -> str:
        inner = self.r.choice((f'<a href="/">{self.words(1, 3)}</a>', f"<h1>{self.words(1, 3)}</h1>", f"<p>{self.sentence(2, 6)}</p>", f"<span>{self.words(1, 4)}</span>"))
        return self.r.choice((f"<header>{inner}{self.r.choice(('', self.nav()))}</header>", f"<div {self.attribute('header')}>{inner}</div>"))

    def footer(self) -> str:
        sign, year, dot = self.r.choice(("&copy;", "©", "(c)", "&#169;")), self.r.choice(("", f" {self.r.randint(1999, 2030)}")), self.r.choice((" | ", " - ", " &bull; ", ". ", "<br>"))
        notice = f"{sign}{year} {self.words(1, 3)}"
        inner = self.r.choice((notice + dot + self.sentence(), f"<p>{notice}</p><p>{self.sentence()}</p>", f"<small>{self.sentence(2, 5)} {notice}</small>", self.links(), f"<p>{self.prose()}</p>"))
        return self.r.choice((f"<footer>{inner}</footer>", f"<footer {self.attribute('footer')}>{inner}</footer>", f"<div {self.attribute('footer')}>{inner}</div>"))

    def boxed(self, part: str) -> str:
        inner = self.r.choice((self.prose(), f"<p>{self.prose()}</p>", f"<h3>{self.words(1, 4)}</h3>{self.links()}", f"<h2>{self.words(1, 3)}</h2><p>{self.prose()}</p>"))
        tag = self.r.choice(("div", "div", "section", "aside")) if part != "side" else self.r.choice(("aside", "aside", "div"))
        bare = tag == "aside" and self.r.random() < 0.5
        return f"<{tag}>{inner}</{tag}>" if bare else f"<{tag} {self.attribute(part)}>{inner}</{tag}>"

    def form(self) -> str:
        inner = f"<label>{self.words(1, 2)}</label><input name=q><p>{self.sentence(2, 8)}</p><button>{self.words(1, 2)}</button>"
        return self.r.choice((f"<form>{inner}</form>", f"<form {self.attribute('form')}>{inner}</form>", f"<div {self.attribute('form')}><form>{inner}</form></div>"))

    def comments(self) -> str:
        each = "".join(f'<div class="comment"><b>{self.word()}</b><p>{self.prose()}</p></div>' if self.r.random() < 0.5 else f"<li><p>{self.prose()}</p></li>" for _ in range(self.r.randint(1, 4)))
        return self.r.choice((f"<section {self.attribute('comments')}><h2>{self.words(1, 2)}</h2>{each}</section>", f"<div {self.attribute('comments')}>{each}</div>", f"<ol {self.attribute('comments')}>{each}</ol>"))

    def script(self) -> str:
        quoted = self.r.choice(("</div>", "<b>x</b>", "</p>", "<li>", self.words(1, 4)))
        code = self.r.choice(("{w}.push('{q}')", "if ({w} < 2) {{ {w}2 = '{q}'; }}", "const {w} = '{q}';", "document.write('{q}'); // {w}"))
        return f"<script{self.r.choice(('', ' async', ' type=module'))}>{code.format(w=self.word(), q=quoted)}</script>"

    def style(self) -> str:
        rules = " ".join(f".{self.word()} {{ {self.r.choice(('color: red', 'float: left', 'display: flex', 'padding: 4px 2px'))} }}" for _ in range(self.r.randint(1, 3)))
        return f"<style>{rules}</style>"

    def junk(self) -> str:
        kind = self.r.randint(0, 6)
        if kind == 0:
            return f"<!-- {self.words(1, 5)} -->"
        if kind == 1:
            return self.r.choice((self.script, self.style))()
        return [self.boxed("ad"), self.boxed("ad"), self.boxed("notice"), self.form(), self.boxed("side")][kind - 2]

    # Main text.

    def unclosed(self, text: str) -> str:
        """Inline tags that are never closed, breaks among the words."""
        tag = self.r.choice(("i", "b", "em", "span", "strong", "u"))
        words = text.split(" ")
        for piece in (f"<{tag}>", self.r.choice(("<br>", "<br/>", "<wbr>", ""))):
            words.insert(self.r.choice([i for i, w in enumerate(words) if "<" not in w and ">" not in w]), piece)
        return " ".join(words)

    def body(self) -> list[str]:
        out = [f"<h1>{self.words(3, 9)}</h1>"] if self.r.random() < 0.8 else []
        for _ in range(self.r.choice((1, 2, 3, 5, 8, 12))):
            k = self.r.randint(0, 15)
            if k < 9:
                p = self.prose()
                if self.r.random() < 0.25:
                    p = p.replace(" ", f' <a href="/{self.word()}">{self.word()}</a> ', 1)
                out.append(self.r.choice((f"<p>{p}</p>", f"<p>{p}</p>", f"<p>{p}", f"<p>{self.unclosed(p)}", f"<p><em>{p}</em></p>", f"<p>{p}</p>\n")))
            elif k == 9:
                out.append(f"<h2>{self.words(1, 6)}</h2>")
            elif k == 10:
                out.append("<ul>" + "".join(f"<li>{self.sentence()}</li>" for _ in range(self.r.randint(1, 5))) + "</ul>")
            elif k == 11:
                out.append(f"<blockquote><p>{self.prose()}</p></blockquote>")
            elif k == 12:
                out.append(f"<pre>{self.words(2, 8)}\n  {self.words(1, 5)}</pre>")
            elif k == 13:
                out.append("<table>" + "".join(f"<tr><td>{self.words(1, 3)}</td><td>{self.words(1, 3)}</td></tr>" for _ in range(self.r.randint(1, 3))) + "</table>")
            elif k == 14:
                out.append(f"<figure><img src=x><figcaption>{self.sentence()}</figcaption></figure>")
            else:
                out.append(f"<div><p>{self.prose()}</p></div>")
        return out

    def page(self) -> str:
        """Main text sits between form feeds, which the labeller looks for in the text order."""
        main, pieces = self.body(), []
        for m in main:
            pieces.append(f"\x00{m}\x01")
            if self.r.random() < 0.08:
                pieces.append(self.junk())
        inner = "".join(pieces)
        tag = self.r.choice(("article", "article", "main", "div", "section", "td"))
        bare = tag in ("article", "main") and self.r.random() < 0.6
        inner = f"<{tag}>{inner}</{tag}>" if bare else f"<{tag} {self.attribute('main')}>{inner}</{tag}>"
        if tag == "td":
            inner = f"<table><tr>{inner}</tr></table>"
        if self.r.random() < 0.3:
            inner = self.r.choice((f"<main>{inner}</main>", f"<div {self.attribute('main')}>{inner}</div>", f'<div class="container">{inner}</div>'))
        before = [x() for x in (self.header, self.nav, self.junk, self.junk) if self.r.random() < 0.55]
        after = [x() for x in (lambda: self.boxed("side"), self.comments, self.junk, self.footer) if self.r.random() < 0.55]
        self.r.shuffle(before)
        end = self.r.choice(("</body></html>", "</body></html>", ""))
        return f"<!DOCTYPE html><html><head><title>{self.words(2, 5)}</title>{self.r.choice((self.style, self.script, str))()}</head><body>{''.join(before)}{inner}{''.join(after)}{end}"


def labelled_pages(n: int = 400, seed: int = 11) -> list[tuple[list[Block], list[int]]]:
    """``n`` pages as (blocks, labels); label 1 is main text."""
    out = []
    for i in range(n):
        blocks = parse(_Writer(seed * 100_003 + i).page())
        labels, inside = [], False
        for b in blocks:
            # A marker sticks to the text next to it; blocks between the two are inside.
            inside = inside or "\x00" in b.text
            last = b.text.rfind("\x01") > b.text.rfind("\x00")
            bare = b.text.replace("\x00", "").replace("\x01", "").strip()
            if bare:
                labels.append((b, bare, int(inside and not b.text.startswith("\x01"))))
            if last:
                inside = False
        kept = []
        for b, bare, y in labels:
            b.text = bare
            kept.append((b, y))
        out.append(([b for b, _ in kept], [y for _, y in kept]))
    return out
