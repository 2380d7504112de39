"""Labelled pages to train the page model on: layouts drawn at random, states known by design."""

from __future__ import annotations

import random

_SYLLABLES = "an be co da el fi go hu in ja ke lo mi no or pa qui re sa ti un ve wo ya zu".split()


def _words(rng: random.Random, low: int, high: int) -> str:
    return " ".join(
        "".join(rng.choice(_SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(low, high))
    )


class _Writer:
    """Writes well-formed elements and notes the state of each, in document order."""

    def __init__(self):
        self.html: list[str] = []
        self.states: list[bool] = [False]

    def put(self, tag: str, content: bool, *inside, attributes: str = "") -> None:
        self.states.append(content)
        self.html.append(f"<{tag}{' ' + attributes if attributes else ''}>")
        for part in inside:
            if callable(part):
                part()
            else:
                self.html.append(part)
        if tag not in ("br", "hr", "meta", "link", "input", "img"):
            self.html.append(f"</{tag}>")


def labelled_page(rng: random.Random) -> tuple[str, list[bool]]:
    """One page as ``(html, states)``."""
    w = _Writer()

    def invented() -> str:
        """A name that says nothing, or none."""
        return rng.choice(("", "", f'class="{_words(rng, 1, 1)}"', f'id="{_words(rng, 1, 1)}"'))

    def wrapped(content: bool, *inside) -> None:
        """The parts in a chain of plain elements, most often none or few, at times very many."""
        depth = rng.choice((0, 0, 0, 1, 1, 2, 3, 4, 6, 12))

        def level(left: int) -> None:
            if left:
                w.put(rng.choice(("div", "div", "div", "section")), content, lambda: level(left - 1), attributes=invented())
            else:
                for part in inside:
                    part()

        level(depth)

    def name(*names: str) -> str:
        kind = rng.choice(("class", "class", "id"))
        more = rng.choice(("", "", " box", " wide", " main-2", " x1"))
        return f'{kind}="{rng.choice(names)}{more if kind == "class" else ""}"'

    def some(*parts) -> None:
        for part in parts:
            if rng.random() < 0.7:
                part()

    def links(content: bool = False, low: int = 2, high: int = 8) -> None:
        for _ in range(rng.randint(low, high)):
            w.put("li", content, lambda: w.put("a", content, _words(rng, 1, 3), attributes='href="/x"'))

    def menu() -> None:
        inner = lambda: w.put("ul", False, links)
        if rng.random() < 0.6:
            w.put("nav", False, inner, attributes=rng.choice(("", name("menu", "nav", "navbar"))))
        else:
            w.put("div", False, inner, attributes=name("menu", "nav", "navigation", "topnav", "breadcrumb", "menue", "navegacion", "kopf"))

    def header() -> None:
        w.put("header", False, lambda: w.put(rng.choice(("h1", "h2", "div", "p")), False, _words(rng, 1, 5)),
              lambda: some(menu, search), attributes=rng.choice(("", name("header", "masthead", "top"))))

    def search() -> None:
        w.put("form", False, lambda: w.put("label", False, _words(rng, 1, 2)), lambda: w.put("input", False),
              lambda: w.put("button", False, _words(rng, 1, 2)), attributes=rng.choice(("", name("search", "newsletter", "signup", "subscribe"))))

    def advert() -> None:
        body = lambda: w.put("p", False, _words(rng, 3, 30))
        tag = rng.choice(("div", "div", "aside", "section", "p"))
        w.put(tag, False, _words(rng, 2, 40) if tag == "p" or rng.random() < 0.5 else body,
              attributes=name("ad", "ads", "advert", "advertisement", "banner", "promo", "sponsored", "sponsor", "promoted", "commercial",
                              "werbung", "anzeige", "publicite", "pub", "reclame", "publicidad", "anuncio", "annonce"))

    def notice() -> None:
        w.put(rng.choice(("div", "section", "p")), False, _words(rng, 4, 30),
              attributes=name("cookie", "cookies", "notice", "consent", "alert", "gdpr", "popup", "modal", "banner",
                              "hinweis", "avis", "aviso", "warning", "disclaimer"))

    def aside() -> None:
        title = lambda: w.put(rng.choice(("h2", "h3", "h4")), False, _words(rng, 1, 4))
        listed = lambda: w.put("ul", False, links)
        plain = lambda: w.put("p", False, _words(rng, 4, 40))
        tag, attributes = ("aside", rng.choice(("", name("sidebar")))) if rng.random() < 0.5 else (
            "div", name("sidebar", "related", "widget", "share", "social", "recommended", "trending", "tags", "toc",
                        "seitenleiste", "barra", "lateral", "verwandt", "mehr"))
        w.put(tag, False, title, rng.choice((listed, plain, listed)), attributes=attributes)

    def footer() -> None:
        inner = rng.choice((
            lambda: w.html.append("&copy; " + _words(rng, 4, 25)),
            lambda: w.put("p", False, "&copy; " + _words(rng, 3, 30)),
            lambda: w.put("ul", False, links),
        ))
        if rng.random() < 0.7:
            w.put("footer", False, inner, attributes=rng.choice(("", name("footer"))))
        else:
            w.put("div", False, inner, attributes=name("footer", "copyright", "legal", "bottom", "impressum", "pied", "pie", "fuss"))

    def comments() -> None:
        def one() -> None:
            w.put(rng.choice(("div", "li", "article")), False, lambda: some(lambda: w.put("span", False, _words(rng, 1, 2), attributes='class="author"')),
                  lambda: w.put("p", False, _words(rng, 3, 60)), attributes=name("comment", "reply", "kommentar", "commentaire", "comentario", "antwort"))
        w.put(rng.choice(("section", "div", "ol")), False, lambda: w.put(rng.choice(("h2", "h3")), False, _words(rng, 1, 2)),
              *[one] * rng.randint(1, 5), lambda: some(search), attributes=name("comments", "discussion", "responses", "comment-list", "kommentare", "commentaires", "comentarios", "disqus", "replies"))

    def inline() -> None:
        for _ in range(rng.randint(1, 4)):
            w.html.append(_words(rng, 1, 30) + " ")
            if rng.random() < 0.3:
                w.put(rng.choice(("b", "i", "em", "strong", "span", "code", "a", "small", "sup")), True, _words(rng, 1, 8))
            if rng.random() < 0.05:
                w.put("math", True, lambda: w.put("mi", True, _words(rng, 1, 1)), lambda: w.put("mo", True, "="), lambda: w.put("mn", True, "2"))
            if rng.random() < 0.1:
                w.put("br", True)

    def paragraph() -> None:
        attributes = "" if rng.random() < 0.9 else rng.choice((invented(), 'class="ad-free"', 'class="lead intro"', 'class="text"'))
        w.put("p", True, rng.choice((inline, lambda: w.html.append(_words(rng, 1, 90)), lambda: w.put("b", True, _words(rng, 1, 40)),
                                     lambda: w.html.append(_words(rng, 1, 2)))), attributes=attributes)

    def body() -> None:
        kind = rng.random()
        if kind < 0.74:
            paragraph()
        elif kind < 0.82:
            w.put(rng.choice(("h2", "h3", "h4")), True, _words(rng, 1, 8))
        elif kind < 0.88:
            w.put(rng.choice(("ul", "ol")), True, *[lambda: w.put("li", True, _words(rng, 1, 25))] * rng.randint(1, 5))
        elif kind < 0.92:
            w.put("blockquote", True, paragraph)
        elif kind < 0.93:
            wrapped(True, paragraph, paragraph)
        elif kind < 0.94:
            w.put("pre", True, _words(rng, 2, 30))
        elif kind < 0.95:
            cells = [lambda: w.put(rng.choice(("td", "th")), True, _words(rng, 1, 4))] * rng.randint(1, 4)
            w.put("table", True, *[lambda: w.put("tr", True, *cells)] * rng.randint(1, 3))
        elif kind < 0.96:
            w.put("figure", True, lambda: w.put("img", True), lambda: w.put("figcaption", True, _words(rng, 2, 12)))
        else:
            rng.choice((advert, advert, aside))()

    def article() -> None:
        title = lambda: w.put("h1", True, _words(rng, 1, 14))
        parts = [title, *[body] * rng.randint(1, 12)] if rng.random() < 0.85 else [body] * rng.randint(1, 12)
        if rng.random() < 0.07:
            parts = [paragraph]
        if rng.random() < 0.15:
            parts.append(comments)
        if rng.random() < 0.3:  # the heading, or nothing, beside a chain of wrappers
            parts = [*parts[:1], lambda rest=parts[1:]: wrapped(True, *rest)] if rng.random() < 0.7 else [lambda all_=parts: wrapped(True, *all_)]
        kind = rng.random()
        if kind < 0.5:
            w.put("article", True, *parts, attributes=rng.choice(("", "", name("post", "article", "entry"), invented())))
        elif kind < 0.72:
            w.put(rng.choice(("div", "section", "main")), True, *parts,
                  attributes=name("content", "post", "article", "entry-content", "story", "article-body", "post-body", "text"))
        elif kind < 0.86:  # a name that says nothing
            w.put(rng.choice(("div", "div", "section", "main")), True, *parts, attributes=invented())
        else:  # no element of its own
            for part in parts:
                part()

    def middle() -> None:
        inside = [article]
        for part in (advert, aside, comments, notice, search):
            if rng.random() < 0.35:
                inside.insert(rng.randint(0, len(inside)), part)
        layout = rng.random()
        if layout < 0.5:
            for part in inside:
                part()
        elif layout < 0.75:
            w.put("main", False, *inside)
        elif layout < 0.87:
            w.put("div", False, *inside, attributes=name("wrapper", "container", "page", "layout", "row"))
        else:
            wrapped(False, *inside)

    def page_body() -> None:
        some(notice, header, menu)
        if rng.random() < 0.5:
            advert()
        if rng.random() < 0.15:  # an article and nothing else
            article()
            return
        middle()
        some(footer)

    def head() -> None:
        w.put("meta", False)
        w.put("title", False, _words(rng, 1, 8))
        some(lambda: w.put("style", False, "p{margin:0}"), lambda: w.put("script", False, "var a=1;"))

    if rng.random() < 0.1:  # a fragment
        rng.choice((page_body, article))()
    else:
        w.put("html", False, lambda: w.put("head", False, head), lambda: w.put("body", False, page_body))
    return "".join(w.html), w.states


def labelled_pages(count: int = 800, seed: int = 3) -> list[tuple[str, list[bool]]]:
    rng = random.Random(seed)
    return [labelled_page(rng) for _ in range(count)]
