"""Labelled web pages for training: layouts of invented text, marked with data-content.

``data-content="1"`` marks an element with the main text, ``"0"`` one without;
what is inside inherits the mark. Layouts differ in their elements, class names,
order and care (unclosed tags), so the extractor cannot lean on one of them.
"""

from __future__ import annotations

import random

#: Class and id words by the kind of element they are seen on.
WORDS = {
    "content": "content main article post entry story body text page single document blog news hentry prose detail",
    "menu": "nav menu navbar navigation breadcrumb breadcrumbs links tabs toc topbar toolbar pager pagination",
    "header": "header head masthead logo branding top site hero title bar",
    "footer": "footer foot bottom copyright colophon legal credits site info",
    "sidebar": "sidebar aside side rail widget related recommended popular trending more archive tags teaser",
    "notice": "notice cookie cookies consent gdpr alert banner message popup modal newsletter subscribe paywall privacy warning",
    "advert": "ad ads advert advertisement sponsor sponsored promo promotion banner dfp adsense adslot partner",
    "form": "form search login signup contact subscribe field input",
    "comments": "comment comments commentlist respond replies discussion disqus thread reply reviews",
    "share": "share social sharing follow buttons icons like tweet",
}
WORDS = {k: v.split() for k, v in WORDS.items()}
#: Elements with a meaning of their own, and the plain ones used instead.
TAGS = {"menu": ["nav", "nav", "div", "ul", "menu"], "header": ["header", "header", "div"], "footer": ["footer", "footer", "div"],
        "sidebar": ["aside", "aside", "div", "section"], "notice": ["div", "aside", "section", "p", "dialog"],
        "advert": ["div", "div", "aside", "section", "p"], "form": ["form"], "comments": ["section", "div", "ol"],
        "share": ["div", "ul", "p"]}
SMALL = ["li", "ro", "ta", "men", "schu", "the", "é", "vo", "on", "ku", "ir", "das", "que", "ol", "por", "ing", "ß", "na", "st", "ä"]


class Layout:
    def __init__(self, seed: int):
        self.r = random.Random(seed)
        self.care = self.r.random() < .6
        self.noise = self.r.choice(["", "", "", "###", "%%%", "&amp;&amp;"])
        self.short = self.r.random() < .25
        self.odd = self.r.choice([0, 0, .1, .5, 1])
        self.classes = self.r.random() < .85

    def word(self):
        return "".join(self.r.choice(SMALL) for _ in range(self.r.choice([1, 1, 2, 2, 3, 4])))

    def sentence(self, low=2, high=24):
        words = [self.word() + ("," if self.r.random() < .08 else "") for _ in range(self.r.randint(low, high))]
        return " ".join(w + self.noise for w in words).capitalize() + self.r.choice([".", ".", ".", "?", "!", ""])

    def prose(self, low=1, high=6):
        x = self.r.random()
        if x < self.odd:        # lists of words, tables in signs, one word again and again
            words = [self.word() for _ in range(self.r.randint(1, 40))]
            return self.r.choice([" ", " | ", ", ", " 12 "]).join(w for w in words for _ in range(self.r.choice([1, 1, 5])))
        return " ".join(self.sentence() for _ in range(self.r.randint(low, high)))

    def link(self, low=1, high=4):
        return f'<a href="/{self.word()}">{" ".join(self.word() for _ in range(self.r.randint(low, high)))}</a>'

    def end(self, tag):
        return f"</{tag}>" if self.care or self.r.random() < .7 else ""

    def attrs(self, kind):
        if not self.classes and self.r.random() < .8:
            return ""
        out = ""
        if self.r.random() < .85:
            names = [self.r.choice(WORDS[kind]) for _ in range(self.r.choice([1, 1, 2]))]
            if self.r.random() < .3:
                names = [self.r.choice(["-", "_"]).join([names[0], self.r.choice(["box", "wrap", "area", "1", "item", self.word()])])]
            out += f' class="{" ".join(names)}"'
        if self.r.random() < .25:
            out += f' id="{self.r.choice(WORDS[kind])}"'
        return out

    def block(self, kind, inner):
        tag = self.r.choice(TAGS[kind])
        attrs = self.attrs(kind)
        if not attrs and tag in ("div", "p", "section"):      # something must tell it apart
            attrs = f' class="{self.r.choice(WORDS[kind])}"' if kind not in ("menu", "footer", "sidebar") else ""
        return f'<{tag}{attrs} data-content="0">{inner}</{tag}>'

    def links(self, n):
        if self.r.random() < .7:
            return "<ul>" + "".join(f"<li>{self.link()}{self.end('li')}" for _ in range(n)) + "</ul>"
        return " | ".join(self.link() for _ in range(n))

    def aside(self, kind):
        r = self.r
        inner = {"menu": lambda: self.links(r.randint(3, 12)),
                 "header": lambda: f"<{r.choice(['h1', 'div', 'p', 'span'])}>{self.sentence(1, 4)}" + (self.links(r.randint(2, 6)) if r.random() < .5 else ""),
                 "footer": lambda: r.choice(["&copy; ", "© 2020 ", ""]) + self.sentence(2, 9) + (self.links(r.randint(2, 6)) if r.random() < .4 else ""),
                 "sidebar": lambda: f"<h3>{self.sentence(1, 3)}</h3>" + r.choice([self.links(r.randint(2, 8)), f"<p>{self.prose(1, 3)}</p>", f"<div>{self.link(2, 6)}<p>{self.sentence()}</p></div>" * 2]),
                 "notice": lambda: r.choice([self.prose(1, 3), f"<p>{self.prose(1, 4)}</p>", f"<h4>{self.sentence(1, 4)}</h4><p>{self.prose(1, 2)} {self.link()}</p>"]),
                 "advert": lambda: r.choice([self.prose(1, 4), f"<p>{self.prose(1, 3)}</p>", self.link(2, 8), f"<h4>{self.sentence(1, 4)}</h4>{self.prose(1, 2)}"]),
                 "form": lambda: f"<label>{self.word()}</label><input><p>{self.sentence(1, 8)}</p><button>{self.word()}</button>",
                 "comments": lambda: f"<h3>{self.sentence(1, 3)}</h3>" + "".join(
                     f'<{t}{self.attrs("comments")}><b>{self.word()}</b> {r.choice(["<p>", "<div>", ""])}{self.prose(1, 4)}</{t}>'
                     for t in [r.choice(["li", "div", "article"])] for _ in range(r.randint(1, 5))),
                 "share": lambda: self.links(r.randint(2, 5))}[kind]()
        return self.block(kind, inner)

    def paragraph(self):
        r, x = self.r, self.r.random()
        if x < .7:
            text = self.sentence(1, 4) if self.short else self.prose(1, r.choice([1, 3, 8]))
            if r.random() < .2:
                text += f" {self.link()} {self.sentence()}"
            return f"<p><b>{text}<br>" if r.random() < .12 else f"<p>{text}{self.end('p')}"
        if x < .78:
            return f"<h{(k := r.randint(2, 4))}>{self.sentence(1, 7)}</h{k}>"
        if x < .86:
            return "<ul>" + "".join(f"<li>{self.link() if r.random() < .3 else ''} {self.sentence()}{self.end('li')}" for _ in range(r.randint(2, 6))) + "</ul>"
        if x < .9:
            return f"<blockquote><p>{self.prose()}</p></blockquote>"
        if x < .93:
            return f"<figure><img src='x'><figcaption>{self.sentence()}</figcaption></figure>"
        if x < .96:
            return "<table>" + "".join(f"<tr><td>{self.word()}<td>{self.sentence(1, 5)}</tr>" for _ in range(r.randint(2, 4))) + "</table>"
        return r.choice([f"<pre>{self.prose()}</pre>", f"<div>{self.prose()}</div>", self.prose() + "<br><br>"])

    def html(self) -> str:
        r = self.r
        parts = [f"<h1>{self.sentence(2, 9)}</h1>"] if r.random() < .8 else []
        for _ in range(r.choice([0, 1, 1, 2, 4, 8, 14])):
            parts += [self.paragraph()] * r.choice([1, 1, 1, 1, 1, 1, 2, 12 if self.short else 1])
            if r.random() < .1:
                parts.append(self.aside(r.choice(["advert", "advert", "share", "notice", "sidebar", "form"])))
        if r.random() < .15:
            parts.append(self.aside(r.choice(["comments", "share", "sidebar"])))
        bare = r.choice(["html", "body"]) if r.random() < .15 else ""      # no element around the main text
        tag = r.choice(["article", "article", "article", "main", "div", "section", "td"])
        attrs = self.attrs("content")
        if not attrs and tag in ("div", "section", "td"):
            attrs = f' class="{r.choice(WORDS["content"])}"'
        main = f'<{tag}{attrs} data-content="1">{"".join(parts)}</{tag}>'
        if tag == "td":
            menu = f'<td{self.attrs("menu")} data-content="0">{self.links(r.randint(2, 8))}{self.end("td")}' if r.random() < .6 else ""
            main = f"<table><tr>{menu}{main}</tr></table>"
        if bare:
            main = "".join(parts) or self.prose()
        for _ in range(0 if bare else r.choice([0, 0, 1, 2])):
            main = f'<{r.choice(["div", "main", "section"])}{self.attrs("content")}>{main}</div>'
        before = [self.aside(k) for k in ("header", "menu", "notice", "advert", "sidebar") if r.random() < .45]
        after = [self.aside(k) for k in ("sidebar", "comments", "advert", "form", "notice", "footer") if r.random() < .4]
        r.shuffle(before)
        body = "".join(before) + main + "".join(after)
        head = f"<head><title>{self.sentence(2, 6)}</title><style>p{{}}</style></head>" if r.random() < .8 else ""
        mark = {bare: ' data-content="1"'}
        if bare == "html" and r.random() < .5:
            return f"<html{mark[bare]}>{body}"
        return f"<!DOCTYPE html><html{mark.get('html', '')}>{head}<body{mark.get('body', '')}>{body}" + ("</body></html>" if self.care else "")


def labelled_pages(n: int, seed: int = 0) -> list[str]:
    return [Layout(seed * 1_000_003 + k).html() for k in range(n)]
