"""Made-up pages in many layouts, whose main text is known, to train the block labeller on."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np

#: Ways to mark up each kind of part: element, then class or id words, of which some are drawn.
_KINDS = {
    "nav": [("nav", "nav menu navbar main-nav primary-menu site-navigation"), ("ul", "menu nav links topmenu"),
            ("div", "nav menu navigation navbar breadcrumb breadcrumbs menu-bar toolbar skip-links pagination pager tabs"),
            ("ol", "breadcrumb breadcrumbs trail"), ("div", "toc table-of-contents contents-list")],
    "header": [("header", "header site-header top masthead"), ("div", "header masthead topbar banner brand logo site-title tagline page-header")],
    "footer": [("footer", "footer site-footer bottom"), ("div", "footer copyright legal colophon imprint bottom-bar credits")],
    "aside": [("aside", "sidebar widget related aside"), ("div", "sidebar widget related recommended teaser trending popular side rail "
              "more-stories see-also tags-cloud recent-posts blogroll author-box bio"), ("section", "related sidebar recommended")],
    "notice": [("div", "notice cookie cookies consent gdpr alert warning banner popup modal overlay privacy-notice paywall announcement disclaimer toast"),
               ("section", "notice cookie-banner announcement"), ("p", "notice alert"), ("dialog", "consent popup")],
    "ad": [("div", "ad ads advert advertisement sponsor sponsored promo promotion banner-ad adsense affiliate commercial partner"),
           ("section", "ad promo sponsored"), ("aside", "ad advert"), ("ins", "adsbygoogle"), ("p", "ad advert sponsored")],
    "form": [("form", "form search login newsletter subscribe signup contact comment-form"), ("div", "newsletter subscribe signup login search-box form-group"),
             ("fieldset", "form")],
    "comments": [("section", "comments discussion responses"), ("div", "comments comment-list reader-comments comment reply replies discussion disqus "
                 "comment-thread feedback user-comments responses reviews"), ("ol", "commentlist comments comment-list"), ("ul", "comments comment-list")],
    "share": [("div", "share social sharing social-links follow share-buttons like-buttons"), ("ul", "share social follow")],
}
_MAIN = [("article", "article post entry story hentry"), ("main", "main content"), ("div", "content article post entry story post-body "
         "article-body entry-content main-content post-content text body-text story-body page-content"), ("section", "article content story main"),
         ("div", ""), ("article", ""), ("main", "")]
_SAY = {
    "nav": "Home|About|Contact|News|Next|Previous|Sitemap|Sections|Skip to content|Menu|Archive".split("|"),
    "header": "Welcome|Official site|Daily news|Sign in".split("|"),
    "footer": "© 2024 All rights reserved|&copy; 2023|Privacy policy|Terms of use|Imprint|Contact us|Powered by".split("|"),
    "aside": "Related articles|Most read|Popular posts|You may also like|Recent posts|Tags|Read more|About the author".split("|"),
    "notice": "We use cookies|Accept all|This site uses cookies to improve your experience|Notice|Please enable JavaScript|Subscribe to read".split("|"),
    "ad": "Advertisement|Sponsored|Buy now|Special offer|Shop now|Ad".split("|"),
    "form": "Your email|Subscribe|Sign up|Log in|Search|Name|Password|Send|Submit".split("|"),
    "comments": "Comments|Leave a comment|Reply|3 comments|Posted by|says:|Report|Join the discussion".split("|"),
    "share": "Share|Tweet|Follow us|Like|Print|Email this".split("|"),
}


class _Maker:
    def __init__(self, words: list[str], seed: int):
        self.rng = np.random.default_rng(seed)
        self.words = [w for w in words if "<" not in w and "&" not in w and ">" not in w] or ["text", "word", "line"]
        self.main: set[str] = set()
        self.serial = 0

    def pick(self, items):
        return items[int(self.rng.integers(len(items)))]

    def chance(self, p: float) -> bool:
        return bool(self.rng.random() < p)

    def some(self, low: int, high: int) -> str:
        return " ".join(self.pick(self.words) for _ in range(int(self.rng.integers(low, high + 1))))

    def sentence(self, low: int, high: int) -> str:
        """Words that occur nowhere else on the page, as a number is among them."""
        self.serial += 1
        return f"{self.some(low, high)} {self.serial}x{self.pick(['', '.', '.', '.'])}"

    def element(self, tag: str, words: str, inner: str) -> str:
        attributes = ""
        if words and self.chance(0.85):
            own = words.split()
            attributes = f' {self.pick(["class", "class", "id"])}="{" ".join(self.pick(own) for _ in range(int(self.rng.integers(1, 3))))}"'
        return f"<{tag}{attributes}>{inner}</{tag}>"

    def link(self, text: str) -> str:
        return f'<a href="/{self.rng.integers(999)}">{text}</a>'

    def items(self, kind: str, n: int, links: float) -> str:
        out = []
        for _ in range(n):
            text = self.pick(_SAY[kind]) + f" {self.serial}y" if self.chance(0.35) else self.sentence(1, 12 if kind in ("ad", "notice", "footer") else 5)
            self.serial += 1
            if self.chance(links):
                text = self.link(text)
            out.append(text)
        shape = self.pick(["li", "li", "p", "div", "span", "bare"])
        if shape == "li":
            return "<ul>" + "".join(f"<li>{t}</li>" for t in out) + "</ul>"
        if shape == "span":
            return " &middot; ".join(f"<span>{t}</span>" for t in out)
        if shape == "bare":
            return " &middot; ".join(out)
        return "".join(f"<{shape}>{t}</{shape}>" for t in out)

    def part(self, kind: str) -> str:
        tag, words = self.pick(_KINDS[kind])
        if kind == "comments":
            inner = "".join(self.element(self.pick(["div", "li", "article", "p"]), "comment reply item", f"<p>{self.sentence(3, 40)}</p>")
                            for _ in range(int(self.rng.integers(1, 7))))
            inner = (f"<h3>{self.pick(_SAY[kind])}</h3>" if self.chance(0.6) else "") + inner
        elif kind in ("ad", "notice", "footer", "header") and self.chance(0.6):
            inner = self.sentence(2, 25)
            if kind == "footer":
                inner = f"&copy; {self.some(1, 2)} &middot; {inner}"
            if self.chance(0.3):
                inner = f"<p>{inner}</p>"
            if kind == "header" and self.chance(0.4):
                inner = f"<h1>{inner}</h1>"
        elif kind == "form":
            inner = "".join(f"<label>{self.pick(_SAY[kind])} {self.serial}z</label><input name=q>" for _ in range(int(self.rng.integers(1, 3))))
            inner += f"<button>{self.pick(_SAY[kind])}</button>" + (f"<p>{self.sentence(3, 15)}</p>" if self.chance(0.4) else "")
        elif kind == "aside" and self.chance(0.5):
            inner = f"<h3>{self.pick(_SAY[kind])}</h3>" + "".join(f"<p>{self.sentence(4, 30)}</p>" for _ in range(int(self.rng.integers(1, 4))))
        else:
            inner = self.items(kind, int(self.rng.integers(1, 9)), {"nav": 0.95, "share": 0.8, "aside": 0.7, "footer": 0.6}.get(kind, 0.3))
        return self.element(tag, words, inner)

    def paragraph(self) -> str:
        body = self.sentence(1, 90 if self.chance(0.7) else 8)
        if self.chance(0.15):
            half = self.sentence(2, 12)
            self.main.add(half)
            self.main.add(body)
            shape = self.pick(["ul", "blockquote", "h2", "table", "pre", "br", "figure", "dl"])
            return {"ul": f"<ul><li>{body}</li><li>{half}</li></ul>", "blockquote": f"<blockquote><p>{body}</p></blockquote><p>{half}</p>",
                    "h2": f"<h2>{half}</h2><p>{body}</p>", "table": f"<table><tr><td>{half}</td><td>{body}</td></tr></table>",
                    "pre": f"<pre>{body}</pre><p>{half}</p>", "br": f"<p><b>{half}<br><p>{body}</p>",
                    "figure": f"<figure><img src=x><figcaption>{half}</figcaption></figure><p>{body}</p>",
                    "dl": f"<dl><dt>{half}</dt><dd>{body}</dd></dl>"}[shape]
        self.main.add(body)
        return self.pick(["<p>{}</p>", "<p>{}</p>", "<p>{}</p>", "<p>{}", "<div>{}</div>"]).format(body)

    def body(self) -> str:
        tag, words = self.pick(_MAIN)
        out = []
        if self.chance(0.75):
            title = self.sentence(1, 12)
            self.main.add(title)
            head = f"<{(h := self.pick(['h1', 'h1', 'h2']))}>{title}</{h}>"
            out.append(f"<header>{head}</header>" if self.chance(0.15) else head)
        bare = self.chance(0.1)
        n = int(self.rng.integers(1, 5)) if self.chance(0.4) else int(self.rng.integers(3, 25)) if self.chance(0.8) else int(self.rng.integers(25, 80))
        for _ in range(n):
            out.append(self.paragraph())
            if self.chance(0.06):
                out.append(self.part(self.pick(["ad", "ad", "aside", "share", "notice", "form", "nav"])))
        inner = "".join(out)
        if self.chance(0.15):
            inner += self.part("comments")
        if bare:
            return inner
        for _ in range(int(self.rng.integers(0, 3))):
            inner = self.element("div", self.pick(["", "wrap inner container row col", "content entry-content post-body"]), inner)
        return self.element(tag, words, inner)

    def page(self) -> str:
        self.main, self.serial = set(), 0
        if self.chance(0.03):  # no markup around it
            return self.paragraph()
        p = self.chance
        top = [self.part(k) for k, c in (("header", 0.5), ("notice", 0.3), ("nav", 0.8), ("ad", 0.45), ("form", 0.2)) if p(c)]
        if p(0.4):
            self.rng.shuffle(top)
        low = [self.part(k) for k, c in (("share", 0.2), ("ad", 0.25), ("comments", 0.35), ("aside", 0.4), ("form", 0.25), ("nav", 0.2),
                                         ("notice", 0.15), ("footer", 0.75)) if p(c)]
        side = [self.part("aside")] if p(0.2) else []
        inner = "".join([*top, *side, self.body(), *low])
        if p(0.4):
            inner = self.element("div", "page wrapper container site layout root", inner)
        return ("<!DOCTYPE html><html><head><title>" + self.some(1, 8) + "</title><style>p{margin:0}</style><script>var t='</p>';</script></head>"
                "<body>" + inner + "</body></html>")


def made_pages(words: list[str], n: int, seed: int) -> Iterator[tuple[str, Callable[[str], bool]]]:
    """``n`` pages, each with a test of a block's text: is it main text?"""
    maker = _Maker(words, seed)
    for _ in range(n):
        html = maker.page()
        main = frozenset(" ".join(t.split()) for t in maker.main)
        yield html, main.__contains__
