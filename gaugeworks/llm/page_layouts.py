"""Pages composed for training: layouts in which it is known what is the article.

Tags, nesting, attribute words, lengths and order vary at random; many pages use plain containers,
attributes that say nothing, or markup with errors, so that a model has to use structure as well.
"""

from __future__ import annotations

import random

OUTER, CONTENT, BOILERPLATE = 0, 1, 2
CONTENT_WORDS = (
    "article content main post entry body story text page-body article-body post-content blog-post"
    " maincontent news-text prose document single hentry".split()
)
#: Attribute words by what is not the article, and tags that may be used for it.
KINDS = {
    "menu": ("nav menu navbar navigation main-nav topnav breadcrumb breadcrumbs pagination toc tabs", "nav div ul header"),
    "header": ("header masthead topbar banner site-header logo branding top page-header", "header div"),
    "footer": ("footer site-footer bottom copyright legal colophon page-footer", "footer div"),
    "sidebar": ("sidebar side aside widget widget-area rail secondary right-column left", "aside div section"),
    "notice": ("cookie cookie-notice consent notice gdpr popup modal alert message warning privacy overlay", "div section aside p"),
    "advert": ("ad ads advert advertisement sponsor sponsored promo banner-ad adslot commercial teaser", "div aside section p ins"),
    "form": ("form search login newsletter subscribe signup contact search-form", "form div"),
    "comments": ("comments comment comment-list respond reply discussion disqus reader-comments responses thread", "div section ol ul"),
    "related": ("related recommended more popular trending also-like links share social tags", "div section aside ul"),
}
SYLLABLES = "an be con da er fi go hu in jo ka li mo ne or pa qu re sa ti un ve wo xi ya ze".split()


class Composer:
    def __init__(self, seed: int):
        self.r = random.Random(seed)
        self.out: list[str] = []
        self.labels: list[tuple[str, int]] = []  # of every text, in page order
        self.plain = self.r.random() < 0.3  # attributes that say nothing
        self.semantic = self.r.random() < 0.5
        self.inside = False  # the article
        self.bare = self.r.random() < 0.15  # nothing around the article

    def words(self, low: int, high: int) -> str:
        r = self.r
        count = r.randint(low, high)
        words = ["".join(r.choices(SYLLABLES, k=r.randint(1, 4))) for _ in range(count)]
        for i in range(count):
            if r.random() < 0.12 and i:
                words[i - 1] += r.choice([".", ".", ",", ",", "!", ";"])
                words[i] = words[i].capitalize()
        return words[0].capitalize() + " " + " ".join(words[1:]) + r.choice([".", ".", ".", ""])

    def attributes(self, words: list[str]) -> str:
        r = self.r
        if self.plain:
            word = "".join(r.choices("bcdfghjkvwxz", k=r.randint(2, 5)))
            return r.choice(["", f' class="{word}"', f' class="{word}{r.randint(1, 99)}"'])
        if r.random() < 0.12 and not self.inside:
            return ""
        return f' {r.choice(["class", "class", "id"])}="{r.choice(words)}{r.choice(["", "", " box", "-1", " wrap"])}"'

    def text(self, words: str, label: int, tag: str = "p", attributes: str = "") -> None:
        r = self.r
        shown = words
        if label == CONTENT and r.random() < 0.25:
            at = words.find(" ")
            shown = f"<{r.choice(['b', 'em', 'i', 'a href=/x', 'span'])}>{words[:at]}</b></a>{words[at:]}"
        if r.random() < 0.1:
            shown += "<br>"
        end = "" if r.random() < 0.08 and tag in ("p", "li") else f"</{tag}>"
        self.out.append(f"<{tag}{attributes}>{shown}{end}")
        self.labels.append((" ".join(words.split()), label))

    def links(self, count: int, tag: str = "li") -> None:
        if tag == "span":  # in a row, one block
            texts = [self.words(1, 4) for _ in range(count)]
            self.out.append("<p>" + " ".join(f'<span><a href="#">{t}</a></span>' for t in texts) + "</p>")
            self.labels.append((" ".join(" ".join(texts).split()), BOILERPLATE))
            return
        for _ in range(count):
            words = self.words(1, 4)
            self.out.append(f'<{tag}><a href="/{words[:3]}">{words}</a></{tag}>')
            self.labels.append((" ".join(words.split()), BOILERPLATE))

    def link_row(self, tag: str, attributes: str) -> None:
        """A block of links behind a word or two."""
        r = self.r
        texts = [self.words(1, 5) for _ in range(r.randint(1, 4))]
        before = self.words(1, 2) + r.choice([":", ""])
        self.out.append(f"<{tag}{attributes}>{before} " + " ".join(f"<a href=/y>{t}</a>" for t in texts) + f"</{tag}>")
        self.labels.append((" ".join(" ".join([before, *texts]).split()), BOILERPLATE))

    def boilerplate(self, kind: str) -> None:
        r = self.r
        words, tags = KINDS[kind]
        tags = tags.split()
        tag = tags[0] if self.semantic else r.choice(tags)
        if self.inside and kind in ("related", "advert", "notice") and r.random() < 0.35:
            tag = "aside"  # says enough by itself
        attributes = self.attributes(words.split())
        if tag in ("nav", "header", "footer", "aside", "form") and r.random() < 0.5:
            attributes = attributes if self.inside and tag != "aside" else ""
        if kind == "related" and r.random() < 0.3:
            self.link_row(tag if tag != "ul" else "div", attributes)
            return
        if kind in ("advert", "notice") and (tag == "p" or r.random() < 0.4):
            self.text(self.words(3, 40), BOILERPLATE, "div" if tag == "ins" else tag, attributes)
            return
        self.out.append(f"<{tag}{attributes}>")
        if kind == "menu":
            inner = "" if tag == "ul" else r.choice(["<ul>", "<ol>", ""])
            self.out.append(inner)
            self.links(r.randint(3, 10), "li" if inner or tag == "ul" else r.choice(["div", "span", "p"]))
            self.out.append(inner.replace("<", "</"))
        elif kind == "form":
            for _ in range(r.randint(1, 4)):
                self.text(self.words(1, 8), BOILERPLATE, r.choice(["p", "div"]))
                self.out.append(f'<input name="{r.choice(SYLLABLES)}">')
        elif kind == "comments":
            if r.random() < 0.6:
                self.text(self.words(1, 3), BOILERPLATE, r.choice(["h2", "h3"]))
            for _ in range(r.randint(1, 8)):
                inner = "li" if tag in ("ul", "ol") else r.choice(["div", "article", "p"])
                own = self.attributes(["comment", "reply", "comment-body", "comment-text"])
                if inner == "p":
                    self.text(self.words(3, 60), BOILERPLATE, "p", own)
                else:
                    self.out.append(f"<{inner}{own}>")
                    if r.random() < 0.6:
                        self.text(self.words(1, 3), BOILERPLATE, r.choice(["div", "h4", "p"]))
                    for _ in range(r.randint(1, 3)):
                        self.text(self.words(4, 60), BOILERPLATE)
                    self.out.append(f"</{inner}>")
        elif kind in ("related", "sidebar"):
            if r.random() < 0.7:
                self.text(self.words(1, 4), BOILERPLATE, r.choice(["h2", "h3", "h4", "p"]))
            if r.random() < 0.7:
                self.out.append("<ul>" if tag != "ul" else "")
                self.links(r.randint(2, 8))
                self.out.append("</ul>" if tag != "ul" else "")
            if kind == "sidebar" and r.random() < 0.5:
                self.text(self.words(5, 50), BOILERPLATE)
        else:
            for _ in range(r.randint(1, 3)):
                self.text(self.words(2, 18), BOILERPLATE, r.choice(["p", "div", "p", "h2"]))
            if r.random() < 0.4:
                self.links(r.randint(1, 4), "span")
        self.out.append(f"</{tag}>")

    def article(self) -> None:
        r = self.r
        tag = r.choice(["article", "main"]) if self.semantic else r.choice(["div", "div", "section", "td"])
        attributes = "" if self.semantic and r.random() < 0.6 else self.attributes(CONTENT_WORDS)
        if tag == "td":
            self.out.append("<table><tr>")
        self.out.append(f"<{tag}{attributes}>")
        wrapped = r.random() < 0.25
        if wrapped:
            self.out.append(f"<div{self.attributes(CONTENT_WORDS)}>")
        if r.random() < 0.75:
            self.text(self.words(2, 12), CONTENT, r.choice(["h1", "h1", "h1", "h2"]))
        count = r.choice([1, 2, 3, 5, 8, 12, 20])
        if r.random() < 0.12:  # hardly any text at all
            count = r.randint(1, 2)
            for _ in range(count):
                self.text(self.words(1, 6), CONTENT)
            count = 0
        for i in range(count):
            x = r.random()
            if x < 0.72:
                self.text(self.words(r.choice([1, 3, 10, 20]), r.choice([20, 60, 120, 200])), CONTENT)
            elif x < 0.80:
                self.text(self.words(1, 8), CONTENT, r.choice(["h2", "h3"]))
            elif x < 0.88:
                list_ = r.choice(["ul", "ol"])
                self.out.append(f"<{list_}>")
                linked = r.random() < 0.5  # sources, downloads
                for _ in range(r.randint(1, 6)):
                    if linked:
                        words = self.words(1, 9)
                        self.out.append(f"<li><a href=/d>{words}</a></li>")
                        self.labels.append((" ".join(words.split()), CONTENT))
                    else:
                        self.text(self.words(2, 25), CONTENT, "li")
                self.out.append(f"</{list_}>")
            elif x < 0.92:
                self.text(self.words(5, 50), CONTENT, r.choice(["blockquote", "pre", "div"]))
            elif x < 0.94:
                self.out.append("<table>")
                for _ in range(r.randint(1, 4)):
                    self.out.append("<tr>")
                    for _ in range(2):
                        self.text(self.words(1, 6), CONTENT, "td")
                    self.out.append("</tr>")
                self.out.append("</table>")
            if i < count - 1 and r.random() < (0.25 if self.bare else 0.06):
                # Nothing but its attributes tells an advert among paragraphs from one of them.
                plain, self.plain, self.inside = self.plain, False, True
                self.boilerplate(r.choice(["advert", "related", "form", "notice"]))
                self.plain, self.inside = plain, False
        if wrapped:
            self.out.append("</div>")
        if r.random() < 0.2:
            self.boilerplate(r.choice(["related", "comments"]))
        self.out.append(f"</{tag}>" + ("</tr></table>" if tag == "td" else ""))

    def page(self) -> tuple[str, list[tuple[str, int]]]:
        """A page and the texts of its blocks in page order, each with its label."""
        r = self.r
        if r.random() < 0.04:
            return self.unmarked()
        self.out.append('<!DOCTYPE html><html lang="x"><head><title>T</title><style>p{}</style></head><body>')
        wrapped = r.random() < 0.4
        if wrapped:
            self.out.append(f"<div{self.attributes(['wrapper', 'container', 'page', 'site', 'layout'])}>")
        if self.bare:
            self.article()
        else:
            self.furnished()
        self.out.append(("</div>" if wrapped else "") + "</body></html>")
        return "".join(self.out), self.labels

    def furnished(self) -> None:
        """The article with what stands around it."""
        r = self.r
        for kind in r.sample(["notice", "header", "menu", "advert", "form"], r.randint(0, 4)):
            self.boilerplate(kind)
        if r.random() < 0.25:
            self.boilerplate("sidebar")
        self.article()
        for kind in r.sample(["comments", "related", "sidebar", "advert", "form", "notice"], r.randint(0, 4)):
            self.boilerplate(kind)
        if r.random() < 0.8:
            self.boilerplate("footer")

    def unmarked(self) -> tuple[str, list[tuple[str, int]]]:
        """A page of text alone, or of paragraphs and nothing else."""
        r = self.r
        if r.random() < 0.5:
            words = self.words(3, 200)
            return words, [(" ".join(words.split()), CONTENT)]
        for _ in range(r.randint(1, 6)):
            self.text(self.words(5, 80), CONTENT)
        return "".join(self.out), self.labels
