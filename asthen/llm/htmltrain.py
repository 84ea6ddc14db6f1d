"""Labelled pages to train the extraction model on: layouts of many kinds, each block marked.

Main text stands below an element with the attribute data-main="1"; data-main="0" below it
takes a part out again. Words are made up, so the model can't learn a vocabulary.
"""

from __future__ import annotations

import random

# Names that sites give to their parts, by what the part is (fixed values).
PARTS = {
    "menu": "nav menu navbar navigation navigate topnav mainmenu submenu breadcrumb breadcrumbs "
    "tabs pagination pager toc skip links sitemap dropdown hamburger",
    "head": "header head masthead topbar top banner branding logo site title tagline hero toolbar",
    "foot": "footer foot bottom copyright legal colophon imprint credits contentinfo terms",
    "side": "sidebar side aside rail widget widgets related recommended recommendations popular "
    "trending more secondary complementary tags archive archives recent teaser teasers bio author",
    "note": "notice cookie cookies consent gdpr banner alert message popup modal overlay warning "
    "privacy toast dialog announcement disclaimer paywall subscribe",
    "ad": "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion "
    "promoted dfp adsense adslot commercial affiliate deal partner",
    "form": "form search login signup newsletter contact register subscribe subscription input "
    "query field",
    "comment": "comment comments reply replies respond discussion disqus thread reader readers "
    "feedback responses reaction reactions",
    "share": "share sharing social buttons follow print tools actions rating vote meta byline",
}
MAIN = "content article post entry body main text story page maincontent primary prose markdown "
MAIN += "articlebody entrycontent postcontent blogpost newsbody region column inner"

_SYLLABLES = "an ber che da en fo ga her in jo ka lo men na ou pre qui re sch ta un ver wo xa za é ü"


class _Page:
    def __init__(self, seed: int) -> None:
        self.rng = random.Random(seed)
        self.syllables = _SYLLABLES.split()

    def pick(self, *options):
        return self.rng.choice(options)

    def odds(self, p: float) -> bool:
        return self.rng.random() < p

    def word(self) -> str:
        return "".join(self.rng.choices(self.syllables, k=self.rng.randint(1, 4)))

    def words(self, lo: int, hi: int) -> str:
        return " ".join(self.word() for _ in range(self.rng.randint(lo, hi)))

    def sentence(self) -> str:
        return self.words(1, 18).capitalize() + self.pick(".", ".", ".", ".", "?", "!", ",")

    def prose(self, most: int = 7) -> str:
        text = " ".join(self.sentence() for _ in range(self.rng.randint(1, most)))
        if self.odds(0.2):
            text += f' <{self.pick("b", "i", "em", "span", "code")}>{self.words(1, 5)}</span> '
        if self.odds(0.15):
            text += f' <a href="/{self.word()}">{self.words(1, 4)}</a> ' + self.sentence()
        return text

    def names(self, pool: str) -> str:
        """Attributes that name a part, or none."""
        names = self.rng.choices(pool.split(), k=self.rng.randint(1, 2))
        if self.odds(0.3):
            names[0] = self.pick("site", "page", "main", "top", "box", "block") + "-" + names[0]
        if self.odds(0.3):
            names[-1] += self.pick("-wrap", "-list", "-box", "-inner", "-item", "_1", "-area")
        kind = self.pick("class", "class", "class", "id")
        return f' {kind}="{" ".join(names)}"'

    def links(self) -> str:
        items = [
            f'<li><a href="/{self.word()}">{self.words(1, 3)}</a></li>'
            for _ in range(self.rng.randint(1, 8))
        ]
        if self.odds(0.2):
            return " | ".join(x[4:-5] for x in items)
        return "<ul>" + "".join(items) + "</ul>"

    def lines(self, most: int = 3) -> str:
        """Running text in a part that isn't main: told from main text by its place only."""
        tag = self.pick("p", "p", "div", "span", "")
        out = []
        for _ in range(self.rng.randint(1, most)):
            text = self.prose(self.pick(1, 2, 5))
            out.append(f"<{tag}>{text}</{tag}>" if tag else text)
        return "".join(out)

    def part(self, kind: str) -> str:
        rng = self.rng
        names = self.names(PARTS[kind])
        plain = self.odds(0.35)  # the tag alone tells
        if kind == "menu":
            tag = "nav" if plain else self.pick("nav", "div", "ul", "section")
            body = self.links()
        elif kind == "head":
            tag = "header" if plain else self.pick("header", "div", "section")
            body = f"<{(h := self.pick('h1', 'h2', 'p', 'div'))}>{self.words(1, 6)}</{h}>"
            body += self.links() if self.odds(0.5) else self.lines(1)
        elif kind == "foot":
            tag = "footer" if plain else self.pick("footer", "div", "section")
            body = f"&copy; {self.word()}.example &middot; {self.prose(2)}"
            body = body if self.odds(0.6) else self.lines() + self.links()
        elif kind == "side":
            tag = "aside" if plain else self.pick("aside", "div", "section")
            body = f"<h3>{self.words(1, 4)}</h3>" * self.odds(0.6)
            body += self.links() if self.odds(0.4) else self.lines()
        elif kind == "form":
            tag = "form" if plain else self.pick("form", "form", "div")
            body = f"<label>{self.words(1, 3)}</label><input name=q><button>{self.words(1, 2)}</button>"
            body = self.lines(1) * self.odds(0.5) + body
            body += f"<select><option>{self.word()}</option></select>" * self.odds(0.2)
        elif kind == "comment":
            tag, plain = self.pick("div", "section", "ul", "ol"), False
            body = f"<h3>{self.words(1, 3)}</h3>" * self.odds(0.6)
            for _ in range(rng.randint(1, 4)):
                inner = self.names(PARTS["comment"]) if self.odds(0.6) else ""
                item = self.pick("div", "li", "article", "p")
                body += f"<{item}{inner}>{self.lines(2) if item != 'p' else self.prose(3)}</{item}>"
        elif kind == "share":
            tag, plain = self.pick("div", "ul", "section", "p"), False
            body = self.links() if tag != "p" else self.words(1, 6)
        else:  # notices and adverts
            tag, plain = self.pick("div", "div", "section", "aside", "p"), False
            body = self.prose(3) if tag == "p" or self.odds(0.6) else self.lines(2)
        role = {"menu": "navigation", "head": "banner", "foot": "contentinfo", "side": "complementary",
                "form": "search", "note": "alert"}.get(kind)
        if plain:
            names = ""
        elif role and self.odds(0.15):
            names = f' role="{role}"'
        hidden = ' style="display:none"' * self.odds(0.03)
        return f'<{tag}{names}{hidden} data-main="0">{body}</{tag}>'

    def block(self) -> str:
        """A block of main text."""
        kind = self.rng.random()
        if kind < 0.66:
            end = self.pick("</p>", "</p>", "</p>", "<br>", "")
            return f"<p>{'<b>' * self.odds(0.1)}{self.prose(self.pick(1, 3, 9))}{end}"
        if kind < 0.78:
            h = self.pick("h1", "h2", "h2", "h3", "h4")
            return f"<{h}>{self.words(1, 9)}</{h}>"
        if kind < 0.86:
            tag = self.pick("ul", "ol")
            items = "".join(f"<li>{self.prose(2)}</li>" for _ in range(self.rng.randint(1, 4)))
            return f"<{tag}>{items}</{tag}>"
        if kind < 0.90:
            return f"<blockquote><p>{self.prose()}</p></blockquote>"
        if kind < 0.93:
            return f"<figure><img src=x><figcaption>{self.prose(1)}</figcaption></figure>"
        if kind < 0.95:
            cells = "".join(f"<td>{self.words(1, 4)}</td>" for _ in range(3))
            return f"<table><tr>{cells}</tr></table>"
        if kind < 0.97:
            return f"<pre>{self.words(2, 12)}</pre>"
        return f"<div>{self.prose()}</div>"

    def article(self) -> str:
        title = f"<h1>{self.words(1, 12)}</h1>" * self.odds(0.8)
        blocks = [self.block() for _ in range(self.rng.randint(1, 9))]
        for _ in range(self.pick(0, 0, 1, 1, 2)):  # parts that stand inside the article
            kind = self.pick("ad", "side", "side", "share", "form", "comment", "note", "menu")
            blocks.insert(self.rng.randint(0, len(blocks)), self.part(kind))
        body = title + "".join(blocks)
        names = self.names(MAIN) if self.odds(0.6) else ""
        how = self.rng.random()
        if how < 0.55:
            return f'<article{names} data-main="1">{body}</article>'
        if how < 0.75:
            return f'<main{names} data-main="1">{body}</main>'
        names = self.names(MAIN)
        tag = self.pick("div", "div", "section", "td")
        return f'<{tag}{names} data-main="1">{body}</{tag}>'

    def plain(self, kind: str) -> str:
        """A part that neither a telling element nor a name marks: only its text does."""
        link = lambda: f'<a href="/{self.word()}">{self.words(1, 3)}</a>'
        many = range(self.rng.randint(2, 8))
        if kind == "menu":
            gap = self.pick(" ", " | ", " &middot; ", "<br>", "</p><p>", "</div><div>", "</td><td>")
            return gap.join(link() for _ in many)
        if kind == "head":
            return self.pick(f"<b>{self.words(1, 3)}</b>", self.words(1, 4), f"<img src=x> {self.words(1, 3)}")
        if kind == "foot":
            mark = self.pick("&copy;", "©", "Copyright", "Copyright &copy;", "(c)", "&copy;")
            owner = f"{mark} {self.pick('2019', '2024', '')} {self.words(1, 4)}"
            return owner + self.pick("", ".", " | " + link(), ". All rights reserved.", " &middot; " + self.sentence())
        return "<br>".join(f'{link()} {self.pick("", "(" + str(self.rng.randint(1, 99)) + ")")}' for _ in many)

    def plain_page(self) -> str:
        """A layout of bare cells or boxes around the text."""
        cell = self.pick("td", "td", "div", "div", "p")
        before = [self.plain(k) for k in ("head", "menu") if self.odds(0.7)]
        after = [self.plain(k) for k in ("links", "menu", "foot") if self.odds(0.6)]
        title = f"<{(h := self.pick('h1', 'h2', 'h3'))}>{self.words(2, 10)}</{h}>" * self.odds(0.8)
        tag = "div" if cell == "p" else cell
        blocks = [f"<p>{self.prose(self.pick(2, 4, 8))}</p>" for _ in range(self.rng.randint(1, 8))]
        if self.odds(0.3):
            blocks = [self.prose(6) + "<br><br>" + self.prose(6)]
        boxes = [f'<{cell} data-main="0">{b}</{cell}>' for b in before]
        boxes += [f'<{tag} data-main="1">{title}{"".join(blocks)}</{tag}>']
        boxes += [f'<{cell} data-main="0">{b}</{cell}>' for b in after]
        if cell == "td":
            row = "</tr><tr>" if self.odds(0.5) else ""
            body = f"<table><tr>{row.join(boxes)}</tr></table>"
        else:
            body = "".join(boxes)
            body = f"<div>{body}</div>" if self.odds(0.5) else body
        return f"<html><head><title>{self.words(2, 6)}</title></head><body>{body}</body></html>"

    def page(self) -> str:
        if self.odds(0.18):
            return self.plain_page()
        before = [self.part(k) for k in ("head", "menu", "note", "ad", "form", "side") if self.odds(0.4)]
        after = [
            self.part(k)
            for k in ("share", "comment", "side", "ad", "menu", "form", "foot", "note")
            if self.odds(0.35) or k == "foot" and self.odds(0.5)
        ]
        if self.odds(0.1):
            before = after = []  # only an article
        self.rng.shuffle(before)
        middle = self.article()
        if self.odds(0.4):  # a frame around the article and what follows it
            split = self.rng.randint(0, len(after))
            middle = f'<{(t := self.pick("div", "main", "section"))} class="{self.pick("wrapper", "container", "row", "layout")}">' + middle + "".join(after[:split]) + f"</{t}>"
            after = after[split:]
        end = self.pick("</body></html>", "</body></html>", "")
        return (
            f"<!DOCTYPE html><html><head><title>{self.words(2, 8)}</title></head><body>"
            + "".join(before) + middle + "".join(after) + end
        )


def labelled_pages(n: int = 400, seed: int = 1) -> list[str]:
    """`n` labelled pages, the same for the same seed."""
    return [_Page(seed * 1_000_003 + i).page() for i in range(n)]
