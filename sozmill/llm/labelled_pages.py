"""Pages labelled by hand: ``data-label`` is 1 for content, 0 for what is beside it.

An element without a label has that of the element around it. The sentences are
made up; what is learned are tags, names, shapes and links.
"""

from __future__ import annotations

# Sentences of all lengths, used for content and for what stands beside it alike.
_SENTENCES = (
    "Two lanes.", "Nobody was hurt, the police said.", "It opens in June, if the weather holds until then.",
    "The council met on Tuesday to talk about the new bridge over the river.",
    "After two hours of debate it voted to build it. Work begins in spring, said the mayor, and ends soon.",
    "I could not agree more with this, thank you for writing it up. My town has had the same trouble for years now.",
    "We use cookies to improve this site, and so does everyone. By going on you agree to our policy, which you can "
    "read here. You can change your mind.",
    "The council met on Tuesday to talk about the new bridge, and after two hours of debate it voted to build it. "
    "Work begins in spring, said the mayor, and should take three years, as she told this paper on the phone.",
)
_LINKS = '<li><a href="/a">Home</a></li><li><a href="/b">News</a></li><li><a href="/c">Sport</a></li>'

# Names that authors give to parts of a page.
_BESIDE = (
    "ad ads advert advertisement sponsored promo banner", "cookie consent notice gdpr", "sidebar widget related",
    "menu navigation navbar breadcrumb", "footer copyright legal", "share social buttons", "newsletter subscribe signup",
    "comments comment respond discussion", "popup modal overlay", "login search toolbar", "pagination pager tags",
    "header masthead topbar logo",
)
_CONTENT = ("content", "post entry", "article body", "story text", "main page", "blog prose")


#: Bodies of articles and of what stands beside them; {0} and so on are sentences.
_BODIES = (
    "<h1>{0}</h1><p>{1}</p><h2>{2}</h2><p>{3}</p><ul><li>{0}</li><li>{2}</li></ul><blockquote><p>{1}</p></blockquote>"
    "<table><tr><th>{0}</th><td>{2}</td></tr></table><pre>{3}</pre><figure><figcaption>{2}</figcaption></figure><p>{0}</p>",
    "<p>{0}</p><p>{1}</p><p>{2}</p>", "<h1>{0}</h1><p>{1}</p>", "<p>{0}</p>", "<h2>{3}</h2><p>{0}</p><p>{1}</p>",
    "<h1>{0}</h1><p>{1}</p><ol><li>{2}</li><li>{3}</li></ol>", "<div><p>{0}</p><p>{1}</p></div><p>{2}</p>",
    "<header><h1>{0}</h1><p>{2}</p></header><p>{1}</p>", "<h1>{1}</h1><section><h2>{0}</h2><p>{2}</p></section>",
)
_ASIDES = (
    "{0}", "<p>{0}</p><ul>{links}</ul>", "<h3>{1}</h3><p>{0}</p>", "<ul>{links}</ul>", "<p>{0}</p>",
    "<h2>{2}</h2><div><p>{0}</p><p>{1}</p></div>", "<p>{0}</p><p>{3}</p>", "<a href='/x'>{2}</a>",
    "<h3>{1}</h3><ol><li>{0}</li><li>{2}</li></ol>", "<label>{0}</label><p>{1}</p>",
)


def _page(*parts: str) -> str:
    return "<html><head><title>Bridge</title></head><body>" + "".join(parts) + "</body></html>"


def _fill(shape: str, turn: int) -> str:
    n = len(_SENTENCES)
    return shape.format(*[_SENTENCES[(turn * k + k * k) % n] for k in (1, 3, 5, 7)], links=_LINKS)


def labelled_pages() -> list[str]:
    """Every name of what is beside the article, inside it and outside, with shells and bodies in turn."""
    content = [name for names in _CONTENT for name in names.split()]
    shells = ['<article data-label="1">{}</article>', '<main data-label="1">{}</main>',
              '<main data-label="1"><article>{}</article></main>', '<section><article data-label="1">{}</article></section>',
              '<article data-label="1">{}</article>', '<div class="page-wrapper"><article data-label="1">{}</article></div>']
    shells += [f'<div class="{name}" data-label="1">{{}}</div>' for name in content]
    shells += [f'<div class="wrapper"><div id="{name}" data-label="1">{{}}</div></div>' for name in content]
    tags = ("div", "section", "aside", "form", "div", "ul")
    names = [name for line in _BESIDE for name in line.split()]
    pages, turn = [], 0
    for name in names:
        for k, tag in enumerate(tags):
            turn += 1
            part = f'<{tag} {("class", "id")[k % 2]}="{name}" data-label="0">{_fill(_ASIDES[(turn + k) % len(_ASIDES)], turn)}</{tag}>'
            bare = f'<{("nav", "form", "aside", "form", "footer", "aside")[k]} data-label="0">{_fill(_ASIDES[turn % len(_ASIDES)], turn + 2)}</{("nav", "form", "aside", "form", "footer", "aside")[k]}>'
            head = f"<header><h1>{_SENTENCES[turn % 3]}</h1><nav><ul>{_LINKS}</ul></nav></header>" if turn % 2 else f"<nav>{_LINKS}</nav>"
            foot = f"<footer><p>{_SENTENCES[turn % len(_SENTENCES)]}</p><ul>{_LINKS}</ul></footer>"
            for place in range(3):  # inside and at the end, before, after
                body = _fill(_BODIES[(turn + place) % len(_BODIES)], turn + place)
                inside = body + (bare if turn % 2 else part) + (_fill("<p>{0}</p>", turn) if turn % 4 < 2 else "") if place == 0 else body
                shell = shells[(turn * 3 + place) % len(shells)].format(inside)
                around = (part if place == 1 else "", shell, part if place == 2 else "", bare if turn % 3 == place else "")
                pages.append(_page(head if (turn + place) % 3 else "", *around, foot if (turn + place) % 4 else ""))
    for turn in range(40):  # the shells alone, and pages without any
        body = _fill(_BODIES[turn % len(_BODIES)], turn)
        pages.append(_page(shells[turn % len(shells)].format(body)))
        plain = _fill("<h1>{0}</h1><p>{1}</p><p>{2}</p><p>{3}</p>", turn)
        pages.append(_page(plain.replace("<p>", '<p data-label="1">').replace("<h1>", '<h1 data-label="1">')))
    return pages
