"""Generated page layouts with marked article blocks, to train the block labeller."""

from __future__ import annotations

import numpy as np

#: Private-use characters that mark the text of article blocks and of all others.
ARTICLE_MARK, OTHER_MARK = "", ""
LAYOUT_MARKS = {0xE000: None, 0xE001: None}

#: Syllables of invented words, and usual phrases of page furniture.
_SYLLABLES = "ba co de fi gu ha in lo ma ne or pa qui re si ta un ver wo zen the er an tion ment lich os".split()
_SMALL = "the of and a to in is der die und in den la le de et en el y que los con for with on by".split()
_MENU = "Home|About|Contact|News|Products|Login|Register|Blog|Shop|Start|Kontakt|Accueil|Inicio|Help|FAQ|Archive".split("|")
_FOOT = "All rights reserved|Privacy policy|Terms of use|Imprint|Impressum|Copyright 2024|Powered by|Sitemap|© 2023".split("|")
_NOTICE = (
    "We use cookies to improve your experience|By continuing you accept our cookie policy|Accept all|"
    "Please enable JavaScript|Your browser is out of date|Subscribe to our newsletter|This site requires consent"
).split("|")
_SHARE = "Share on Facebook|Tweet|Share|Print|Email this|Like|Follow us|Pin it".split("|")
_FORM = "Search|Submit|Your name|Email|Password|Sign up|Log in|Send|Message|Leave a reply|Post comment".split("|")
_COMMENT = "Reply|says:|Great post|Thanks for sharing|2 days ago|Report|Permalink|likes this".split("|")
_RELATED = "Related articles|You may also like|Read more|Most popular|Recent posts|Trending|Next|Previous|Tags".split("|")

_CONTENT = "content post entry entry-content article article-body story text main main-content body-text post-body page".split()
_AD = "ad ads advert advertisement sponsored banner promo ad-slot adbox sponsor".split()
_SIDE = "sidebar side aside widget widget-area right-col left-col rail secondary".split()
_NOTE = "cookie cookie-banner notice consent gdpr alert popup modal message overlay notification".split()
_COMM = "comments comment-list comment discussion replies disqus responses respond user-comments".split()
_NAV = "nav menu navbar navigation topnav main-menu breadcrumb breadcrumbs pagination pager links".split()
_HEAD = "header masthead site-header top topbar branding logo".split()
_FOOTS = "footer site-footer bottom copyright colophon legal".split()
_REL = "related related-posts more recommended popular trending see-also teaser tags meta".split()
_SOC = "share social sharing social-links toolbar share-buttons".split()


class _Layout:
    def __init__(self, rng: np.random.Generator):
        self.rng = rng

    def one(self, items):
        return items[int(self.rng.integers(len(items)))]

    def chance(self, p: float) -> bool:
        return bool(self.rng.random() < p)

    def word(self) -> str:
        if self.chance(0.35):
            return self.one(_SMALL)
        return "".join(self.one(_SYLLABLES) for _ in range(int(self.rng.integers(1, 4))))

    def phrase(self, low: int, high: int) -> str:
        return " ".join(self.word() for _ in range(int(self.rng.integers(low, high + 1)))).capitalize()

    def prose(self, sentences: int) -> str:
        out = []
        for _ in range(sentences):
            text = self.phrase(1, 18)
            out.append(text.replace(" ", ", ", 1) + "." if self.chance(0.3) else text + self.one(["."] * 8 + ["?", "!"]))
        text = " ".join(out)
        kind = self.rng.random()
        if kind < 0.03:
            return " ".join([self.word()] * int(self.rng.integers(3, 60)))
        if kind < 0.06:
            return text.replace(" ", self.one([" | ", "!! ", "%%% ", "*** ", "### "]))
        return text.upper() if kind < 0.08 else text

    def mixed(self, phrases: list[str], low: int = 1, high: int = 4) -> str:
        return self.one(phrases) if self.chance(0.5) else self.phrase(low, high)

    def named(self, tag: str, names: list[str], inner: str, plain: float = 0.1) -> str:
        if self.chance(plain):
            return f"<{tag}>{inner}</{tag}>"
        name = self.one(names)
        if self.chance(0.2):
            name += " " + self.one(["clearfix", "row", "col-md-8", "container", "wrap", "box", "js-x", "mt-2"])
        kind = "id" if self.chance(0.25) else "class"
        return f'<{tag} {kind}="{name}">{inner}</{tag}>'

    def link(self, text: str) -> str:
        return f'<a href="/{self.word()}">{text}</a>'

    # Page furniture: every text starts with the mark of other blocks.

    def menu(self) -> str:
        items = [self.link(OTHER_MARK + self.mixed(_MENU, 1, 2)) for _ in range(int(self.rng.integers(2, 9)))]
        body = "<ul>" + "".join(f"<li>{i}</li>" for i in items) + "</ul>" if self.chance(0.7) else " ".join(items)
        return self.named("nav", _NAV, body, 0.6) if self.chance(0.6) else self.named("div", _NAV, body, 0.0)

    def header(self) -> str:
        body = self.one(["<h1>{}</h1>", "<div>{}</div>", "<span>{}</span>", "<p>{}</p>", "<h2>{}</h2>"]).format(
            OTHER_MARK + self.phrase(1, 5)
        )
        if self.chance(0.5):
            body += self.menu()
        if self.chance(0.3):
            body += f"<p>{OTHER_MARK}{self.phrase(2, 9)}</p>"
        if self.chance(0.2):
            body += self.form()
        return self.named("header", _HEAD, body, 0.5) if self.chance(0.6) else self.named("div", _HEAD, body, 0.0)

    def footer(self) -> str:
        body = ""
        for _ in range(int(self.rng.integers(1, 4))):
            text = OTHER_MARK + self.one(["", "&copy; ", "&middot; "]) + self.mixed(_FOOT, 1, 10)
            body += self.one(["<p>{}</p>", "<div>{}</div>", "<li>{}</li>", "{} ", "<small>{}</small>"]).format(
                self.link(text) if self.chance(0.4) else text
            )
        if self.chance(0.2):
            body += f"<p>{OTHER_MARK}{self.prose(2)}</p>"
        return self.named("footer", _FOOTS, body, 0.6) if self.chance(0.7) else self.named("div", _FOOTS, body, 0.0)

    def advert(self) -> str:
        text = OTHER_MARK + (self.prose(int(self.rng.integers(1, 3))) if self.chance(0.6) else self.phrase(1, 8))
        inner = self.one(["{}", "<p>{}</p>", "<span>{}</span>", "<div>{}</div>", "<h3>{}</h3>"]).format(text)
        if self.chance(0.4):
            inner = self.link(inner)
        return self.named(self.one(["div", "div", "div", "aside", "section"]), _AD, inner, 0.0)

    def notice(self) -> str:
        inner = f"<p>{OTHER_MARK}{self.mixed(_NOTICE, 4, 16)}</p>"
        if self.chance(0.5):
            inner += f"<button>{OTHER_MARK}{self.mixed(_NOTICE, 1, 2)}</button>"
        if self.chance(0.2):
            inner = f"{OTHER_MARK}{self.prose(1)}"
        return self.named(self.one(["div", "div", "section", "aside", "dialog"]), _NOTE, inner, 0.0)

    def form(self) -> str:
        inner = ""
        for _ in range(int(self.rng.integers(1, 5))):
            inner += f"<label>{OTHER_MARK}{self.mixed(_FORM, 1, 3)}</label><input name=x>"
        if self.chance(0.5):
            inner += f"<p>{OTHER_MARK}{self.phrase(2, 12)}</p>"
        inner += f"<button>{OTHER_MARK}{self.mixed(_FORM, 1, 2)}</button>"
        return self.named("form", ["search", "login", "form", "newsletter", "signup"], inner, 0.5)

    def related(self) -> str:
        inner = self.one(["<h3>{}</h3>", "<h4>{}</h4>", "<p>{}</p>", "<h2>{}</h2>"]).format(OTHER_MARK + self.mixed(_RELATED, 1, 4))
        items = [self.link(OTHER_MARK + self.phrase(2, 9)) for _ in range(int(self.rng.integers(2, 6)))]
        inner += "<ul>" + "".join(f"<li>{i}</li>" for i in items) + "</ul>"
        return self.named(self.one(["div", "section", "aside", "nav"]), _REL, inner, 0.0)

    def sidebar(self) -> str:
        inner = ""
        for _ in range(int(self.rng.integers(1, 4))):
            if self.chance(0.4):
                inner += f"<h3>{OTHER_MARK}{self.phrase(1, 4)}</h3><p>{OTHER_MARK}{self.prose(int(self.rng.integers(1, 3)))}</p>"
            else:
                inner += self.one([self.related, self.advert, self.form, self.menu])()
        return self.named("aside", _SIDE, inner, 0.5) if self.chance(0.6) else self.named("div", _SIDE, inner, 0.0)

    def share(self) -> str:
        inner = "".join(self.link(OTHER_MARK + self.mixed(_SHARE, 1, 2)) + " " for _ in range(int(self.rng.integers(1, 5))))
        return self.named(self.one(["div", "ul", "p", "section"]), _SOC, inner, 0.0)

    def comments(self) -> str:
        inner = f"<h3>{OTHER_MARK}{self.mixed(_COMMENT, 1, 3)}</h3>" if self.chance(0.7) else ""
        tag = self.one(["li", "div", "article", "div"])
        for _ in range(int(self.rng.integers(1, 6))):
            one = f"<span>{OTHER_MARK}{self.phrase(1, 2)}</span>" if self.chance(0.6) else ""
            one += f"<p>{OTHER_MARK}{self.prose(int(self.rng.integers(1, 5)))}</p>"
            if self.chance(0.4):
                one += f"<div>{self.link(OTHER_MARK + self.mixed(_COMMENT, 1, 2))}</div>"
            inner += self.named(tag, _COMM, one, 0.4)
        if self.chance(0.3):
            inner += self.form()
        return self.named(self.one(["section", "div", "ol", "ul", "aside"]), _COMM, inner, 0.0)

    # The article: every text starts with its mark.

    def inline(self, text: str) -> str:
        words = text.split(" ")
        if len(words) > 4 and self.chance(0.3):
            k = int(self.rng.integers(1, len(words) - 1))
            tag = self.one(["b", "i", "em", "strong", "span", "code"])
            words[k] = self.link(words[k]) if self.chance(0.4) else f"<{tag}>{words[k]}</{tag}>"
        return " ".join(words)

    def paragraph(self) -> str:
        text = ARTICLE_MARK + self.inline(self.prose(int(self.rng.integers(1, 7))))
        if self.chance(0.2):
            short = self.phrase(1, 3)
            text = ARTICLE_MARK + self.one([short, short.lower(), short + ".", short.lower() + ","])
        kind = self.rng.random()
        if kind < 0.75:
            return f"<p>{text}</p>"
        if kind < 0.83:
            return f"<p><b>{text}<br>" if self.chance(0.5) else f"<p>{text}"
        if kind < 0.9:
            return f"<div>{text}</div>"
        if kind < 0.95:
            return f"<blockquote><p>{text}</p></blockquote>"
        return text + "<br><br>"

    def item(self) -> str:
        kind = self.rng.random()
        if kind < 0.72:
            return self.paragraph()
        if kind < 0.8:
            return self.one(["<h2>{}</h2>", "<h3>{}</h3>"]).format(ARTICLE_MARK + self.phrase(1, 8))
        if kind < 0.87:
            items = "".join(f"<li>{ARTICLE_MARK}{self.inline(self.phrase(1, 14))}</li>" for _ in range(int(self.rng.integers(2, 6))))
            return self.one(["<ul>{}</ul>", "<ol>{}</ol>"]).format(items)
        if kind < 0.91:
            rows = "".join(f"<tr><td>{ARTICLE_MARK}{self.phrase(1, 3)}</td><td>{ARTICLE_MARK}{self.phrase(1, 4)}</td></tr>" for _ in range(3))
            return f"<table>{rows}</table>"
        if kind < 0.94:
            return f"<figure><img src=x><figcaption>{ARTICLE_MARK}{self.phrase(2, 10)}</figcaption></figure>"
        if kind < 0.97:
            return f"<pre>{ARTICLE_MARK}{self.phrase(3, 12)}</pre>"
        return self.paragraph() + self.paragraph()

    def article(self) -> str:
        parts = []
        if self.chance(0.8):
            parts.append(self.one(["<h1>{}</h1>"] * 4 + ["<h2>{}</h2>", '<h1 class="title">{}</h1>']).format(ARTICLE_MARK + self.phrase(1, 10)))
        parts += [self.item() for _ in range(int(self.rng.integers(1, 14)))]
        if self.chance(0.06):
            same = f"<p>{ARTICLE_MARK}{self.phrase(1, 4)}.</p>"
            parts += [same] * int(self.rng.integers(3, 40))
        inside = [self.advert, self.related, self.share, self.notice, self.form]
        for _ in range(int(self.rng.integers(0, 3)) if self.chance(0.5) else 0):
            parts.insert(int(self.rng.integers(1, len(parts) + 1)), self.one(inside)())
        if self.chance(0.15):
            parts.append(self.comments())
        body = "".join(parts)
        kind = self.rng.random()
        odd = [f"c-{self.word()}", f"x{int(self.rng.integers(99))}", self.word()]
        if kind < 0.5:
            body = self.named("article", _CONTENT, body, 0.7)
        elif kind < 0.62:
            body = self.named("main", _CONTENT, body, 0.7)
        elif kind < 0.8:
            body = self.named("div", _CONTENT, body, 0.0)
        elif kind < 0.9:
            body = self.named(self.one(["div", "section"]), odd, body, 0.2)
        for _ in range(int(self.rng.integers(0, 3)) if self.chance(0.5) else 0):
            body = self.named(self.one(["div", "main", "section"]), [*_CONTENT[:3], "container", "wrapper", "page", "row", *odd], body, 0.1)
        return body

    def page(self) -> str:
        before = [self.header, self.menu, self.advert, self.notice, self.sidebar, self.form, self.share]
        after = [self.comments, self.sidebar, self.related, self.advert, self.share, self.notice, self.form, self.menu]
        parts = [f() for f in before if self.chance(0.35)]
        parts.append(self.article())
        parts += [f() for f in after if self.chance(0.3)]
        if self.chance(0.8):
            parts.append(self.footer())
        body = "".join(parts)
        if self.chance(0.2):
            body = self.named("div", ["container", "wrapper", "page", "site", "app", "root"], body, 0.0)
        return f"<!DOCTYPE html><html><head><title>x</title></head><body>{body}</body></html>"


def layout(rng: np.random.Generator) -> str:
    """One page of random layout."""
    return _Layout(rng).page()
