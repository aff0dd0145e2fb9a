"""Invented pages with known labels, from which the block labeller is trained."""

from __future__ import annotations

import random

# Names that sites give to parts of a page, by what the part is.
PARTS = {
    "nav": "nav navbar menu navigation breadcrumb breadcrumbs topnav links pagination pager tabs",
    "header": "header masthead banner topbar branding site-header logo hero-bar",
    "footer": "footer site-footer copyright colophon legal bottom foot",
    "aside": "sidebar aside related recommended widget popular trending more-stories rail complementary tags social share",
    "notice": "notice cookie consent gdpr alert popup modal banner-notice newsletter-notice message disclaimer hidden",
    "ad": "ad ads advert advertisement sponsored promo promotion sponsor adbox ad-slot dfp",
    "form": "form search login signup subscribe newsletter contact-form searchbox",
    "comments": "comments comment reply replies discussion disqus respond commentlist user-comment reader-comments",
}
CONTENT = "content article post entry story main body text post-content entry-content article-body storybody page main-content"
NEUTRAL = "container wrapper row col inner block box section grid left right wide clearfix module item group"
NOISE_WORDS = {
    "nav": "home about contact news sports next previous page more archive login all",
    "header": "welcome site search menu your daily",
    "footer": "copyright © rights reserved privacy terms imprint · all",
    "aside": "related popular read more share follow trending latest tags",
    "notice": "cookies we use accept consent site privacy continue notice browser please",
    "ad": "buy now offer sale advertisement sponsored free only save deal",
    "form": "name email search submit subscribe password your send",
    "comments": "reply says comment posted ago like great thanks user said report",
}
SYLLABLES = (
    "th er on an re he in ed nd ha at en es of or nt ea ti to it st io le is ou ar as de rt ve ung sch keit ein ver ge "
    "ción mente ado que los las ñ eau tion ment ent les é è ka ri mo ну ст по 人 の 語 ва"
).split()
# Some of the most frequent words of four languages.
FREQUENT = (
    "the of and to in is was for that with on as by at from it are this which not "
    "der die und das ist nicht mit von ein auf le la les des est une dans que pour el los las por con una del"
).split()


class PageMaker:
    """Pages from a seeded generator: markup and a label (1: main text) for each block that parsing gives."""

    def __init__(self, seed: int) -> None:
        self.r = random.Random(seed)

    def word(self) -> str:
        if self.r.random() < 0.25:
            return self.r.choice(FREQUENT)
        return "".join(self.r.choice(SYLLABLES) for _ in range(self.r.randint(1, 4)))

    def words(self, low: int, high: int) -> str:
        if self.r.random() < 0.06:  # one word again and again
            return " ".join([self.word()] * self.r.randint(low, high))
        out = [self.word() for _ in range(self.r.randint(low, high))]
        if self.r.random() < 0.06:
            mark = self.r.choice(("!!", "***", " |", "%%%"))
            return " ".join(w.upper() + mark for w in out)
        out[0] = out[0].capitalize()
        for k in range(len(out)):
            if self.r.random() < 0.12:
                out[k] += self.r.choice(",.;:!?")
        return " ".join(out) + self.r.choice((".", ".", ".", "", "!", "?"))

    def made_up(self) -> str:
        return "".join(self.r.choice("abcdefghijklmnoprstuvwxyz") for _ in range(self.r.randint(2, 9)))

    def attributes(self, names: str) -> str:
        name = self.r.choice(names.split())
        if self.r.random() < 0.3:  # names that tell nothing, as most sites have
            name = f"{name} {self.made_up()}"
        if self.r.random() < 0.3:
            name += self.r.choice((" ", "-", "_")) + self.r.choice(NEUTRAL.split())
        elif names != CONTENT and self.r.random() < 0.15:
            name += self.r.choice(("-", "_")) + self.r.choice(("banner", "bar", "area", "list"))
        how = self.r.random()
        if how < 0.6:
            return f' class="{name}"'
        return f' id="{name}"' if how < 0.9 else f" class='{name}' id=x{self.r.randint(1, 99)}"

    def inline(self, text: str) -> str:
        how = self.r.random()
        if how < 0.12:
            return f"<b>{text}</b>"
        if how < 0.2:
            return f"<b>{text}<br>"  # left open
        if how < 0.35:
            at = text.find(" ")
            return f'{text[:at]}<a href="/x">{text[at:]}</a> {self.words(3, 12)}' if at > 0 else text
        return text

    def noise(self, kind: str) -> list[str]:
        """Markup of the inside of a part, as list of leaf elements."""
        r, own = self.r, NOISE_WORDS[kind].split()

        def text(low: int, high: int) -> str:
            if r.random() < 0.5:  # what looks like main text
                return r.choice(("", "", "© ", "· ")) + self.words(low, high)
            out = [r.choice(own) if r.random() < 0.35 else self.word() for _ in range(r.randint(low, high))]
            return " ".join(out) + r.choice(("", "", ".", ":"))

        if kind == "nav":
            return ["<ul>"] + [f'<li><a href="/{k}">{text(1, 2)}</a></li>' for k in range(r.randint(2, 9))] + ["</ul>"]
        if kind == "comments":
            out = []
            if r.random() < 0.35:
                return [f"<p>{text(3, 40)}</p>" for _ in range(r.randint(1, 3))]
            for _ in range(r.randint(1, 6)):
                out += [f"<div{self.attributes('comment user reply item')}>", f"<b>{text(1, 2)}</b>", f"<p>{text(3, 40)}</p>", "</div>"]
            return out
        if kind == "form":
            return [f"<label>{text(1, 3)}</label><input name=q>", f"<p>{text(2, 8)}</p>"]
        if kind == "aside" and r.random() < 0.6:
            items = [f'<li><a href="/s{k}">{text(2, 9)}</a></li>' for k in range(r.randint(1, 7))]
            return [f"<h3>{text(1, 3)}</h3>", "<ul>", *items, "</ul>"]
        tag = r.choice(("p", "div", "span", "small"))
        if kind == "header" and r.random() < 0.3:  # the site's name
            return [f"<h1>{text(1, 4)}</h1>"] + [f"<p>{text(2, 9)}</p>"] * r.randint(0, 1)
        if r.random() < 0.4:
            return [text(2, 25)]
        return [f"<{tag}>{text(2, 25)}</{tag}>" for _ in range(r.randint(1, 3))]

    def part(self, kind: str) -> str:
        r = self.r
        semantic = {"nav": "nav", "header": "header", "footer": "footer", "aside": "aside", "form": "form"}.get(kind)
        if kind == "nav" and r.random() < 0.3:  # a bare list of links
            return "".join(self.noise(kind))
        tag = semantic if semantic and r.random() < 0.6 else r.choice(("div", "div", "section"))
        plain = tag == semantic and r.random() < 0.6
        attributes = "" if plain else self.attributes(PARTS[kind])
        return f"<{tag}{attributes}>" + "".join(self.noise(kind)) + f"</{tag}>"

    def article(self) -> str:
        r = self.r
        out = [f"<{h}>{self.words(2, 12)}</{h}>" for h in ("h1", "h2")[: r.randint(0, 1) + (r.random() < 0.3)]]
        for _ in range(r.choice((1, 2, 2, 3, 4, 6, 9, 14, 20, 30))):
            how, text = r.random(), self.words(*r.choice(((1, 4), (3, 15), (15, 60), (40, 120))))
            if how < 0.72:
                out.append(f"<p>{self.inline(text)}" + ("</p>" if r.random() < 0.85 else ""))
            elif how < 0.78:
                out.append(f"<h{r.randint(2, 4)}>{self.words(1, 7)}</h{2}>")
            elif how < 0.84:
                out.append("<ul>" + "".join(f"<li>{self.words(2, 20)}</li>" for _ in range(r.randint(1, 6))) + "</ul>")
            elif how < 0.88:
                out.append(f"<blockquote><p>{text}</p></blockquote>")
            elif how < 0.92:
                out.append(f"<table><tr><td>{self.words(1, 4)}</td><td>{self.words(1, 4)}</td></tr></table>")
            elif how < 0.95:
                out.append(f"<pre>{text}</pre>")
            else:
                out.append(f"<div>{text}</div>")
        return "".join(out)

    def page(self) -> str:
        """Markup in which main text stands between the marks \\x01 and \\x02."""
        r = self.r
        inner = self.article()
        pieces = [f"\x01{inner}\x02"]
        while r.random() < 0.3:  # a part inside the article's element, before, after or amid
            pieces.insert(r.randint(0, len(pieces)), self.part(r.choice(("ad", "aside", "notice", "comments", "form"))))
            if r.random() < 0.5:
                pieces.append(f"\x01<p>{self.words(8, 50)}</p>\x02")
        tag = r.choice(("article", "article", "main", "div", "div", "section"))
        attributes = "" if tag in ("article", "main") and r.random() < 0.5 else self.attributes(CONTENT)
        if r.random() < 0.15:  # a name that nobody knows
            attributes = f' class="{self.made_up()}"'
        body = [f"<{tag}{attributes}>{''.join(pieces)}</{tag}>"]
        if r.random() < 0.3:  # nothing around the article
            body = ["".join(pieces)]
        elif r.random() < 0.4:
            body = [f"<div{self.attributes(NEUTRAL)}>{body[0]}</div>"]
        many = r.choice((1, 1, 1, 0.4, 0))  # some pages hold little but an article
        before = [k for k in ("header", "nav", "notice", "ad", "form", "aside") if r.random() < 0.45 * many]
        after = [k for k in ("comments", "aside", "ad", "form", "nav", "notice") if r.random() < 0.3 * many]
        after += ["footer"] if r.random() < 0.8 * many else []
        parts = [self.part(k) for k in before] + body + [self.part(k) for k in after]
        if r.random() < 0.3:
            parts = [f"<div{self.attributes(NEUTRAL)}>", *parts, "</div>"]
        if r.random() < 0.06:  # some systems put the whole page into a form
            parts = [f"<form{self.attributes(NEUTRAL)}>", *parts, "</form>"]
        for _ in range(r.choice((0, 0, 0, 1, 2))):
            parts = [f'<div {r.choice(("id", "class"))}="{self.made_up()}">', *parts, "</div>"]
        if r.random() < 0.15:
            return "".join(["<body>", *parts])
        return f"<!DOCTYPE html><html><head><title>x</title></head><body>{''.join(parts)}</body></html>"
