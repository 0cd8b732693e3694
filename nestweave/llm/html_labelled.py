"""The labelled table of the decision tree: invented pages, part by part.

A page is a list of (keep, html, wrap): every block in ``html`` has that label. ``wrap`` puts the part
into a plain element of its own. The pages show the same roles by many means: named elements, named
classes, names that say nothing, and none, where only words and links tell. ``PAGES`` are written out;
:func:`composed_pages` puts pages together from parts of invented prose, by a fixed rule.
"""

from __future__ import annotations

import random

_LONG = "The river had risen over night, and by the morning the lower fields lay under a sheet of grey water that reached the mill."
_MORE = "Nobody could say when the bridge had gone; the baker, who crossed it before dawn, swore that it still stood when the bells rang four."
_THIRD = "In the afternoon the mayor came with two engineers, looked at the pillars from the bank, and promised boats before the week was out."
_SHORT = "The water fell slowly."
_TITLE = "After the flood"


def _links(*names: str) -> str:
    return "".join(f'<li><a href="/{n}">{n}</a></li>' for n in names)


def _story(tag: str = "p") -> str:
    return "".join(f"<{tag}>{x}</{tag}>" for x in (_LONG, _MORE, _SHORT, _THIRD))


Page = list[tuple[bool, str, bool]]

PAGES: list[Page] = [
    [
        (False, f"<nav><ul>{_links('Home', 'World', 'Sport', 'Weather')}</ul></nav>", False),
        (False, '<div class="ad">Buy our boots today. They keep your feet dry in any weather.</div>', False),
        (True, f"<article><h1>{_TITLE}</h1>{_story()}</article>", False),
        (False, "<footer>&copy; The valley paper &middot; all rights reserved by the owners of it</footer>", False),
    ],
    [
        (False, "<header><h1>The valley paper</h1><p>News of the valley since the year of the comet</p></header>", False),
        (True, f"<main><h2>{_TITLE}</h2>{_story()}<ul><li>{_SHORT}</li><li>Boats are on the way.</li></ul></main>", False),
        (False, f'<aside><h3>Read next</h3><p>{_MORE}</p><ul>{_links("Mill", "Bridge")}</ul></aside>', False),
        (False, '<footer><p>Write to us at the office on the market square at any time.</p></footer>', False),
    ],
    [
        (False, f'<div id="menu">{"".join(f"<a href=/{n}>{n}</a> " for n in ("Start", "Arts", "Money"))}</div>', False),
        (False, '<div class="cookie-notice"><p>We use cookies to make this site better for all who read it. Accept them or choose.</p></div>', False),
        (True, f'<div class="post-content"><p>{_LONG}</p><blockquote>{_SHORT}</blockquote><p>{_MORE} <a href="/m">Map</a></p></div>', False),
        (False, f'<div class="comments"><h3>Comments</h3><p>I was there too and I saw the bridge go, it was a sight I will not forget.</p><p>{_SHORT}</p></div>', False),
    ],
    [
        (False, f"<ul>{_links('Home', 'About us', 'Contact', 'Terms')}</ul>", True),
        (False, "<p>Home / News / Valley</p>", True),
        (True, f"<h1>{_TITLE}</h1>{_story()}", True),
        (True, f"<p>{_THIRD}</p><p>{_LONG}</p>", True),
        (False, f"<ul>{_links('Older stories', 'Newer stories', 'Archive')}</ul>", True),
        (False, "<p>Privacy</p>", True),
    ],
    [
        (False, "<p>Menu</p>", True),
        (False, f"<table><tr><td><a href=/1>News</a></td><td><a href=/2>Local</a></td><td><a href=/3>Sport</a></td></tr></table>", True),
        (True, f"{_story('div')}", True),
        (False, "<p><a href=/x>Share this page with your friends</a></p>", True),
        (False, "<p>Copyright of the paper</p>", True),
    ],
    [
        (False, "<form><label>Your name</label><p>Tell us what you think of the story and we may print your letter in the paper.</p></form>", False),
        (True, f'<section class="story"><h2>{_TITLE}</h2><p>{_MORE}</p><h3>The mill</h3><p>{_SHORT}</p><p>{_THIRD}</p></section>', False),
        (False, f'<div class="related"><h3>More like this</h3><p>{_LONG}</p></div>', False),
        (False, '<div class="newsletter">Get the best of the valley in your post box each Friday before noon.</div>', False),
    ],
    [
        (True, f"<article><header><h1>{_TITLE}</h1><p>By our reporter in the valley</p></header>{_story()}<p>Yes.</p></article>", False),
        (False, f'<div class="sidebar"><p>{_THIRD}</p></div>', False),
        (False, '<div role="contentinfo"><p>Printed in the valley by the mill street press and bound by hand there.</p></div>', False),
    ],
    [
        (False, f'<div class="share social">{"".join(f"<a href=/{n}>{n}</a> " for n in ("Post", "Mail"))}</div>', False),
        (True, f'<div id="main-text"><p>{_LONG}</p><p>Three days.</p><p>{_MORE}</p><pre>water level 312 cm</pre><p>{_THIRD}</p></div>', False),
        (False, f'<div id="comments"><div>{_LONG}</div><div>So true, my uncle said the very same thing.</div></div>', False),
    ],
    [
        (True, f"<article><p>{_SHORT}</p></article>", False),
        (False, "<footer><p>Paper of the valley</p></footer>", False),
    ],
    [
        (True, f"<article><h1>{_TITLE}</h1><p><b>{_LONG}<br><p>{_MORE}</p><p>No.</p><ul><li><a href=/a>The mill</a></li></ul></article>", False),
        (False, '<div class="alert">Storm warning for the coast until the evening, please stay at home if you can do so.</div>', False),
    ],
    [
        (True, f"<article><h1>{_TITLE}</h1><p>{_LONG}</p><p>Then silence.</p>", False),
        (False, f'<aside><p>{_MORE}</p><p>See also</p></aside><form><label>Your mail</label><p>{_SHORT}</p></form>', False),
        (True, f"<p>{_THIRD}</p>", False),
        (False, '<div class="ad">Boots that keep you dry, now at half the price in our shop by the bridge.</div>', False),
        (True, f"<p>{_SHORT}</p>", False),
        (False, f'<div class="comments"><p>{_MORE}</p><p>Agreed.</p></div><footer>Filed under: floods</footer></article>', False),
    ],
    [
        (False, f"<nav>{_links('Home', 'Town')}</nav>", False),
        (True, f"<article><h1>Low water</h1><p>{_SHORT}</p></article>", False),
        (False, "<footer><p>Paper of the valley</p></footer>", False),
    ],
    [
        (False, '<nav><a href="/">Front page</a></nav>', False),
        (True, f"<main><h2>Rain</h2><p>Still no rain.</p><h2>Wind</h2><p>{_SHORT}</p></main>", False),
        (False, '<div class="footer">All rights are ours</div>', False),
    ],
    [
        (False, f'<div class="nav"><ul>{_links("Start", "Search")}</ul></div>', False),
        (True, f'<div class="entry"><h3>Ice</h3><p>{_MORE}</p><p>It held.</p></div>', False),
    ],
]


#: How a part is wrapped: by a named element, a named class, a name that says nothing, or not at all.
STYLES = ("element", "class", "opaque", "none")
_ELEMENTS = {"menu": "nav", "article": "article", "foot": "footer", "side": "aside", "ad": "aside", "comments": "section"}
_CLASSES = {
    "menu": ("navbar", "main-menu", "breadcrumbs"), "article": ("post-content", "entry", "story", "article-body"), "foot": ("footer", "site-footer"),
    "side": ("sidebar", "related", "widget"), "ad": ("ad", "promo-box", "newsletter", "cookie-notice"), "comments": ("comments", "comment-list"),
}
_SYLLABLES = "ma ri to len sa ko ve du par ni sol ten ga hu wi bel cor da fe lo".split()


class _Writer:
    """Invented words, sentences and parts of pages, the same for a seed."""

    def __init__(self, seed: int):
        self.rng = random.Random(seed)

    def word(self) -> str:
        return "".join(self.rng.choice(_SYLLABLES) for _ in range(self.rng.choice((1, 2, 2, 3))))

    def words(self, least: int, most: int) -> str:
        return " ".join(self.word() for _ in range(self.rng.randint(least, most)))

    def prose(self, least: int, most: int, links: float = 0.0) -> str:
        """Sentences, of whose words about a share ``links`` is linked."""
        out = []
        for word in self.words(least, most).split():
            out.append(f"<a href=/{word}>{word}</a>" if self.rng.random() < links else word)
        return " ".join(out).capitalize() + "."

    def links(self, n: int, tag: str = "li") -> str:
        names = [self.words(1, 3) for _ in range(n)]
        if tag == "p":
            return "<p>" + " | ".join(f"<a href=/x>{x}</a>" for x in names) + "</p>"
        return "<ul>" + "".join(f"<li><a href=/x>{x}</a></li>" for x in names) + "</ul>"

    def menu(self) -> str:
        return self.links(self.rng.randint(3, 8), self.rng.choice(("li", "li", "p")))

    def article(self) -> str:
        """A heading and paragraphs, some of them short or with links, now and then a list or a list of links."""
        out = [f"<h1>{self.words(2, 9)}</h1>"] if self.rng.random() < 0.8 else []
        for _ in range(self.rng.randint(2, 7)):
            turn = self.rng.random()
            if turn < 0.6:
                out.append(f"<p>{self.prose(25, 120, 0.04)}</p>")
            elif turn < 0.78:
                out.append(f"<p>{self.prose(2, 14)}</p>")
            elif turn < 0.86:
                out.append(f"<h2>{self.words(1, 6)}</h2><p>{self.prose(20, 80)}</p>")
            elif turn < 0.93:
                out.append(f"<p>{self.prose(20, 60, 0.45)}</p>")
            else:
                out.append("<ul>" + "".join(f"<li>{self.prose(4, 20, 0.3)}</li>" for _ in range(3)) + "</ul>")
        out.append(f"<p>{self.prose(25, 90)}</p>")
        return "".join(out)

    def brief(self) -> str:
        """What only its name shows to be an article: a few short lines, now and then linked ones, or very many."""
        lines = [f"<p>{self.prose(1, 9, self.rng.choice((0, 0, 0.5, 1)))}</p>" for _ in range(self.rng.choice((1, 1, 2, 3, 5, 12, 60)))]
        if self.rng.random() < 0.4:
            lines.insert(self.rng.randrange(len(lines) + 1), self.links(self.rng.randint(1, 4)))
        return (f"<h1>{self.words(1, 4)}</h1>" if self.rng.random() < 0.5 else "") + "".join(lines)

    def foot(self) -> str:
        text = f"<p>&copy; {self.words(2, 9)}</p>"
        return text + self.links(self.rng.randint(2, 4), "p") if self.rng.random() < 0.5 else text

    def side(self) -> str:
        return f"<h3>{self.words(1, 3)}</h3>" + self.links(self.rng.randint(2, 6))

    def ad(self) -> str:
        return "".join(f"<p>{self.words(3, self.rng.choice((12, 40, 80)))}</p>" for _ in range(self.rng.choice((1, 1, 2, 4))))

    def comments(self) -> str:
        return f"<h3>{self.words(1, 2)}</h3>" + "".join(f"<p>{self.prose(4, 40)}</p>" for _ in range(self.rng.randint(1, 3)))

    def wrapped(self, role: str, style: str) -> str:
        inner = getattr(self, role)()
        if style == "element" and role != "comments":
            name = _ELEMENTS["article" if role == "brief" else role]
            return f"<{name}>{inner}</{name}>"
        if style in ("element", "class"):
            names = _CLASSES["article" if role == "brief" else role]
            return f'<div class="{self.rng.choice(names)}">{inner}</div>'
        if style == "opaque":
            return f'<div class="c{self.rng.randint(10, 99)}x">{inner}</div>'
        return f"<div>{inner}</div>"


def composed_pages(n: int = 200, seed: int = 1, styles: tuple[str, ...] = STYLES) -> list[Page]:
    """``n`` pages of a menu, now and then an advertisement or a list beside, an article, and what follows it.

    What only a name can tell, an advertisement, a comment of whole sentences or an article of a few words, is there
    only where names are.
    """
    pages: list[Page] = []
    for i in range(n):
        write, style = _Writer(seed * 10_000 + i), styles[i % len(styles)]
        named = style in ("element", "class")
        brief = named and write.rng.random() < 0.5
        roles = ["menu"] if not brief or write.rng.random() < 0.7 else []
        if named and write.rng.random() < 0.6:
            roles.append("ad")
        if write.rng.random() < 0.3:
            roles.append("side")
        roles.append("brief" if brief else "article")
        if named and write.rng.random() < 0.4:
            roles.append("comments")
        if write.rng.random() < 0.4:
            roles.append("side")
        if not brief or write.rng.random() < 0.7:
            roles.append("foot")
        pages.append([(role in ("article", "brief"), write.wrapped(role, style), False) for role in roles])
    return pages


def labelled_pages() -> list[Page]:
    return [*PAGES, *composed_pages()]
