"""Whole web pages as token streams: structural elements, text runs and their link characters.

Inline markup is white space or nothing and never ends a run of text; scripts, styles, titles and
other raw elements, comments and declarations leave no token. End tags that HTML lets a page
leave out are put in, end tags without a start are ignored, a stream that breaks off is closed.
Every step moves forward, so the time is in proportion to the page.
"""

from __future__ import annotations

import re
from html import unescape

# ---- Fixed values: names of HTML and common words of class and id attributes ----
INLINE = frozenset("a abbr acronym b bdi bdo big blink cite code data del dfn em font i ins kbd label mark nobr q rb rp rt rtc ruby s samp small span strike strong sub sup time tt u var".split())
VOID = frozenset("area base basefont br col embed frame hr img input keygen link meta param source track wbr".split())
RAW = frozenset("script style title textarea iframe noembed noframes xmp".split())
#: Elements whose whole content is never main text.
ASIDE = frozenset("nav footer aside form noscript template button select option optgroup datalist dialog menu object svg math canvas audio video applet map head".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
#: Words of class and id that name boilerplate around an article.
WORDS = frozenset(
    "nav navbar navigation menu menus submenu breadcrumb breadcrumbs footer sidebar widget widgets ad ads adv advert adverts advertisement advertising adsense sponsor sponsored sponsors"
    " promo promos promotion banner banners cookie cookies consent gdpr notice notices notification notifications popup modal overlay newsletter subscribe subscription signup login search"
    " share sharing social comment comments commentlist disqus reply replies respond related recommended recommendations pagination pager toolbar copyright".split()
)
#: Words that name it only outside an article.
OUTER_WORDS = frozenset("header masthead topbar".split())
#: Words that take an article element itself for something else than the article.
COMMENT_WORDS = frozenset("comment comments reply replies ad ads advert advertisement promo sponsored related".split())
CONTENT_WORDS = frozenset("articlebody postbody storybody entrycontent postcontent articlecontent articletext".split())
#: An opening tag of the key ends an open element of the values, up to one of the third set.
ENDS_P = frozenset(
    "address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre search section summary table ul".split()
)
CLOSES = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "tr": (frozenset(["tr"]), frozenset(["table"])),
    "tbody": (frozenset(["thead", "tbody", "tfoot"]), frozenset(["table"])),
    "tfoot": (frozenset(["thead", "tbody", "tfoot"]), frozenset(["table"])),
    "body": (frozenset(["head"]), frozenset()),
}
# ---- End of fixed values ----

#: Elements whose class says nothing about the page's structure.
_PLAIN = frozenset("p h1 h2 h3 h4 h5 h6 li td th tr dt dd html body blockquote pre".split())
#: Elements below this depth join the one above: no recursion is deeper.
DEPTH = 96
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>\"']*+)([>\"']?)")
_REST = re.compile(r"[^>\"']*+([>\"']?)")
_ATTRIBUTE = re.compile(r"(class|id|role|itemprop)\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++))", re.I)
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_WORD = re.compile(r"[a-z]+")


class Item:
    """A node of a page or wrapper: element, group or text slot, with occurrences of its texts."""

    __slots__ = ("label", "opt", "rep", "kids", "marks")

    def __init__(self, label: str, opt: bool = False, rep: bool = False, kids: list | None = None, marks: list | None = None) -> None:
        self.label, self.opt, self.rep = label, opt, rep
        self.kids, self.marks = kids if kids is not None else [], marks if marks is not None else []


TEXT = "#"


def label(tag: str, attributes: str, inside: bool) -> str:
    """Name of an element in the stream: ``!`` marks boilerplate, ``*`` the article's root, ``+`` the main part.

    ``inside``: whether it is part of an article.
    """
    words, roles, props = set(), set(), set()
    if attributes:
        for name, *values in _ATTRIBUTE.findall(attributes):
            value = next((v for v in values if v), "")
            name = name.lower()
            if name in ("class", "id"):
                words.update(_WORD.findall(_CAMEL.sub(" ", value).lower()))
                props.update(re.sub(r"[^a-z ]", "", value.lower()).split() if name == "class" else ())
            else:
                (roles if name == "role" else props).add(value.strip().lower())
    root = tag == "article" or "article" in roles or bool(props & CONTENT_WORDS)
    if tag in ("html", "body"):
        return tag
    if root:
        kind = "!" if words & COMMENT_WORDS else "*"
    elif tag in ASIDE or roles & ROLES or words & WORDS or (not inside and (tag == "header" or words & OUTER_WORDS)):
        kind = "!" if tag != "main" else "+"
    else:
        kind = "+" if tag == "main" or "main" in roles else ""
    names = "" if tag in _PLAIN or tag in INLINE else ".".join(sorted(words)[:4])
    return f"{kind}{tag}.{names}" if names else kind + tag


def read_page(html: str | None) -> tuple[Item, list[str], list[int]]:
    """The page's tree of elements and text runs, the runs in page order and their link characters.

    A run is the text between two structural tags, decoded, with white space as single blanks.
    """
    html = html or ""
    root = Item("")
    # tag, node, part of an article, part of boilerplate; two neighbours may share a node
    stack: list[tuple[str, Item, bool, bool]] = [("", root, False, False)]
    texts: list[str] = []
    links: list[int] = []
    parts: list[str] = []
    linked = link_depth = 0
    dead: set[str] = set()
    labels: dict[tuple[str, str, bool], str] = {}

    def text(piece: str) -> None:
        nonlocal linked
        if piece:
            piece = unescape(piece) if "&" in piece else piece
            parts.append(piece)
            if link_depth:
                linked += len(piece)

    def flush() -> None:
        nonlocal linked
        if parts:
            run = " ".join("".join(parts).split())
            if run:
                if stack[-1][0] == "head":  # text ends the head
                    stack.pop()
                stack[-1][1].kids.append(Item(TEXT, marks=[len(texts)]))
                texts.append(run)
                links.append(min(linked, len(run)))
            parts.clear()
        linked = 0

    def find(what: str, at: int) -> int:
        if what in dead:
            return -1
        found = html.find(what, at)
        if found < 0:
            dead.add(what)
        return found

    at, size = 0, len(html)
    while at < size:
        start = html.find("<", at)
        if start < 0:
            text(html[at:])
            break
        if start > at:
            text(html[at:start])
        found = _TAG.match(html, start)
        if not found:
            if html.startswith("<!--", start):
                end = find("-->", start + 4)
                at = size if end < 0 else end + 3
            elif html.startswith(("<!", "<?", "</"), start):
                end = find(">", start)
                at = size if end < 0 else end + 1
            else:
                text("<")
                at = start + 1
            continue
        closing, tag, attributes, stop = found.groups()
        tag, at = tag.lower(), found.end()
        while stop == '"' or stop == "'":
            begin, end = at, find(stop, at)
            found = _REST.match(html, at if end < 0 else end + 1)  # a quote that never ends is a character
            at, stop = found.end(), found.group(1)
            attributes += html[begin - 1 : at - len(stop)]
        if tag in RAW:
            if not closing and tag not in dead:
                found = re.compile("</" + tag, re.I).search(html, at)
                if not found:
                    dead.add(tag)
                end = _TAG.match(html, found.start()) if found else None
                at = size if not found else end.end() if end else found.end()
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            elif tag == "br":
                parts.append(" ")
            continue
        if closing:
            k = next((k for k in range(len(stack) - 1, 0, -1) if stack[k][0] == tag), 0)
            if tag in INLINE:
                link_depth = max(0, link_depth - (tag == "a"))
                if not k:
                    continue
            if tag not in INLINE or any(stack[m][1] is not stack[m - 1][1] for m in range(k, len(stack))):
                flush()
                link_depth = 0
            if k:
                del stack[k:]
            continue
        _, above, inside, out = stack[-1]
        key = (tag, attributes, inside)
        name = labels.get(key) or labels.setdefault(key, label(tag, attributes, inside))
        if tag in INLINE and name[0] not in "!*":
            link_depth += tag == "a"
            if any(x[0] == tag for x in stack):  # inside one that counts: its end tag is not that one's
                stack.append((tag, above, inside, out))
            continue
        flush()
        link_depth = 0
        if (tag in ENDS_P and stack[-1][0] == "p") or (stack[-1][0] == "head" and tag not in ("noscript", "template")):
            stack.pop()
        if tag in CLOSES:
            ended, limit = CLOSES[tag]
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] in limit:
                    break
                if stack[k][0] in ended:
                    del stack[k:]
                    break
        _, above, inside, out = stack[-1]
        if len(stack) > DEPTH and (out or name[0] != "!"):
            stack.append((tag, above, inside, out))
        else:
            node = Item(name)
            above.kids.append(node)
            stack.append((tag, node, inside or name[0] == "*", out or name[0] == "!"))
    flush()
    return root, texts, links
