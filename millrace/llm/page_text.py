"""The parts of a web page: text blocks in order, and the element subtrees that may be templates."""

from __future__ import annotations

import html
import re

import xxhash

#: Elements whose content is no text of the page.
RAW = {"script", "style", "title", "textarea", "iframe", "xmp", "noembed", "noframes"}
#: Elements left out with all they hold.
LEFT_OUT = {
    "head", "nav", "header", "footer", "aside", "noscript", "template", "menu", "dialog", "button", "select",
    "object", "svg", "canvas", "audio", "video", "map",
}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6", "hgroup"}
#: Whole names in a class, id or role that mark what is left out; what has other names is left to the counts by host.
MARKS = {
    "ad", "ads", "ad-box", "ad-slot", "ad-banner", "ad-container", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "promotion",
    "banner", "cookie", "cookies", "consent", "notice", "notices", "alert", "popup", "modal", "overlay",
    "menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "pagination", "toolbar", "topbar", "masthead",
    "header", "footer", "sidebar", "widget", "complementary", "contentinfo", "search", "newsletter", "subscribe", "signup", "login",
    "share", "sharing", "social", "related", "recommended",
}
#: Words that mark a name of two parts, as in main-nav, site_footer or comments-area, unless the other part only tells of a whole page.
STRONG = {
    "nav", "navbar", "navigation", "menu", "footer", "sidebar", "breadcrumb", "breadcrumbs", "comments", "cookie", "cookies", "advert", "adverts",
    "advertisement", "newsletter", "pagination", "sponsored", "subscribe",
}
TELLING = {"has", "no", "with", "without", "is", "not"}
#: Names of readers' comments, whose articles are no main content.
COMMENTS = {"comment", "comments", "user-comment", "user-comments", "comment-list", "commentlist", "disqus", "disqus_thread", "replies"}
#: What leaves an element out: a form or a name yields to main content inside it.
FORM, NAME, SURE = 1, 2, 3
VOID = {"br", "img", "hr", "input", "meta", "link", "source", "wbr", "col", "area", "base", "embed", "track", "param"}
BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "caption", "dd", "details", "dialog", "div", "dl", "dt", "fieldset",
    "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html", "legend", "li",
    "main", "menu", "nav", "ol", "option", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
#: Elements that a starting element closes, looked for up to the nearest of STOPS.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "tbody": {"tr", "td", "th", "thead"}, "tfoot": {"tr", "td", "th", "tbody"},
}
#: Elements that may be templates within the main content; a heading, paragraph, cell or item by itself may recur by chance or as a quotation.
CONTAINERS = {"div", "section", "aside", "ul", "ol", "dl", "table", "figure"}
#: Elements that are counted outside the main content of a page that marks it.
OUTSIDE = CONTAINERS | {"nav", "header", "footer", "form", "menu"}
STOPS = {"ul", "ol", "dl", "table", "select", "div", "section", "article", "main", "body", "html", "blockquote", "nav", "aside", "menu"}

_TAG = re.compile(
    r"""<!--.*?(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)"""
    r"""|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*(?:"[^"]*(?:"|\Z)|'[^']*(?:'|\Z))|[^>])*+)(?:>|\Z)""",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)(?:"|\Z)|'([^']*)(?:'|\Z)|([^\s"'>]+)))?""")
_MASK = (1 << 64) - 1


#: Attribute texts whose marks a task remembers at most.
REMEMBERED = 4096


def _marks(attributes: str, known: dict) -> tuple[frozenset[str], bool, bool]:
    """The names of an element's class, id and role; whether it is hidden, and whether its role is main. ``known`` remembers some."""
    found = known.get(attributes)
    if found is None:
        names: set[str] = set()
        hidden = main = False
        for name, *values in _ATTRIBUTE.findall(attributes):
            name = name.lower()
            if name in ("class", "id", "role"):
                value = "".join(values).lower().split()
                names.update(value)
                main |= name == "role" and "main" in value
            hidden |= name == "hidden"
        if len(known) >= REMEMBERED:
            known.clear()
        found = known[attributes] = frozenset(names), hidden, main
    return found


def _strong(name: str) -> bool:
    """Whether a name has two parts, one of which marks what is left out."""
    parts = re.split("[-_]", name)
    return len(parts) == 2 and not TELLING & set(parts) and bool(STRONG & set(parts))


def _left_out(tag: str, attributes: str, level: int, known: dict) -> int:
    """What leaves an element out, or 0."""
    # what heads or ends an article's own text is part of it; the page's header and footer are not
    if tag in LEFT_OUT and not (tag == "header" and level == 2):
        return SURE
    names, hidden, _ = _marks(attributes, known) if attributes and tag not in ("html", "body") else (frozenset(), False, False)
    if hidden or names & COMMENTS:
        return SURE
    found = names & MARKS
    if level == 2 or tag in HEADINGS:
        found -= {"header"}
    if found or any(map(_strong, names)):
        return NAME
    return FORM if tag == "form" else 0


class Page:
    """A parsed page.

    ``blocks`` holds (level, text, element): level 2 inside an article, 1 inside a main element, else 0, with 10 added for
    what stands in a form and 100 for an article or main element that a name leaves out;
    ``element`` is the nearest subtree around it that may be a template, or -1. ``keys`` and ``parents`` describe
    those subtrees in the order of their start tags: block elements, only containers within the main content, with a hash of all they
    hold (0 for one that holds no text, or the article or main element), another one within the main content than outside it. ``tags`` has
    their elements, ``levels`` the level each stands in, -1 where it is left out. ``known`` is what a task remembers of attributes.
    """

    def __init__(self, source: str, known: dict | None = None):
        self._known = {} if known is None else known
        self.blocks: list[tuple[int, str, int]] = []
        self.keys: list[int] = []
        self.parents: list[int] = []
        self.levels: list[int] = []
        self.tags: list[str] = []
        self._source = source
        self._read()

    def _read(self) -> None:
        source, size = self._source, len(self._source)
        # open elements: [tag, what leaves out from here or 0, level, index among subtrees or -1, 100 if marked out by a name]
        stack: list[list] = [["", 0, 0, -1, 0]]
        sums: list[list] = []  # of each subtree: [running hash, holds text, holds main content]
        self._buffer: list[str] = []
        at = 0
        while at < size:
            found = _TAG.search(source, at)
            upto = found.start() if found else size
            if upto > at:
                self._text(source[at:upto], stack[-1], sums)
            if not found:
                break
            at = found.end()
            tag = found[2]
            if not tag:
                continue
            tag = tag.lower()
            if found[1]:
                self._close(tag, stack, sums)
                continue
            if tag in VOID:
                self._flush(stack[-1]) if tag == "hr" else self._buffer.append(" ")
                continue
            if tag in RAW:
                end = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(source, at)
                at = end.start() if end else size
                closing = source.find(">", at)
                at = closing + 1 if closing >= 0 else size
                continue
            self._open(tag, found[3], stack, sums)
        while len(stack) > 1:
            self._pop(stack, sums)
        self._flush(stack[0])
        self.keys = [s[0] if s[1] and not s[2] else 0 for s in sums]

    def _text(self, text: str, inside: list, sums: list) -> None:
        if inside[1] <= FORM or inside[3] >= 0:
            plain = html.unescape(text) if "&" in text else text
            if inside[1] <= FORM:
                self._buffer.append(plain)
            if inside[3] >= 0 and not plain.isspace():
                own = sums[inside[3]]
                own[0] = (own[0] * 0x9E3779B97F4A7C15 + xxhash.xxh3_64_intdigest(" ".join(plain.split()))) & _MASK
                own[1] = True

    def _flush(self, inside: list) -> None:
        if self._buffer:
            text = " ".join("".join(self._buffer).split())
            self._buffer = []
            if text and inside[1] <= FORM:
                self.blocks.append((inside[2] + 10 * inside[1] + inside[4], text, inside[3]))

    def _open(self, tag: str, attributes: str, stack: list, sums: list) -> None:
        block = tag in BLOCKS
        if block:
            self._flush(stack[-1])
            shut = CLOSES.get(tag, {"p"})
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] in shut:
                    while len(stack) > depth:
                        self._pop(stack, sums)
                    break
                if stack[depth][0] in STOPS:
                    break
        _, out, level, subtree, named = stack[-1]
        out = max(out, _left_out(tag, attributes, level, self._known))
        article = tag == "article" and (level < 2 or not out)
        if out < SURE and (article or (level < 1 and (tag == "main" or (attributes and _marks(attributes, self._known)[2])))):
            named = 100 if out == NAME else named
            out = 0
            while level < 2 and subtree >= 0 and not sums[subtree][2]:
                sums[subtree][2] = True
                subtree = self.parents[subtree]
            level = 2 if tag == "article" else 1
        if block and tag not in ("html", "body") and (not level or tag in CONTAINERS):
            self.parents.append(subtree)
            self.tags.append(tag)
            self.levels.append(level + 10 * out + named if out <= FORM else -1)
            sums.append([xxhash.xxh3_64_intdigest(f"{'in ' if level else ''}{tag} {attributes.strip()}"), False, False])
            subtree = len(sums) - 1
        stack.append([tag, out, level, subtree, named])

    def _pop(self, stack: list, sums: list) -> None:
        tag, _, _, subtree, _ = stack[-1]
        if tag in BLOCKS:
            self._flush(stack[-1])
        stack.pop()
        above = stack[-1][3]
        if subtree >= 0 and subtree != above and above >= 0:
            own, outer = sums[subtree], sums[above]
            outer[0] = ((outer[0] ^ own[0]) * 0xC2B2AE3D27D4EB4F + 1) & _MASK
            outer[1] |= own[1]

    def _close(self, tag: str, stack: list, sums: list) -> None:
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth][0] == tag:
                while len(stack) > depth:
                    self._pop(stack, sums)
                return
        if tag in BLOCKS:
            self._flush(stack[-1])

    def main_blocks(self) -> tuple[set[int], list[tuple[int, str, int]]]:
        """The blocks of the highest level that the page has, and their levels.

        What a form or a name leaves out is taken where it holds the main content: more text than there is without it.
        """
        def size(levels: set[int]) -> int:
            return sum(len(text) for level, text, _ in self.blocks if level in levels)

        found = {b[0] for b in self.blocks}
        top = max((x for x in found if x < 10), default=0)
        levels = {top}
        form = max((x - 10 for x in found if 10 <= x < 100), default=-1)
        if form >= top and size({form + 10}) > size(levels):
            top, levels = form, {form, form + 10}
        named = max((x % 10 for x in found if x >= 100), default=-1)
        if named >= 0 and top < 2 and size({named + 100, named + 110}) > size(levels):
            levels = {named + 100}
            if size({named + 110}) > size(levels):
                levels.add(named + 110)
        return levels, [b for b in self.blocks if b[0] in levels]

    def subtrees(self) -> tuple[list[int], set[int]]:
        """Hashes of the subtrees that may be deleted from the text, by number (0: may not), and of others that are counted."""
        levels = self.main_blocks()[0]
        marked = levels != {0}
        within = [k if at in levels else 0 for k, at in zip(self.keys, self.levels)]
        others = {k for k, at, tag in zip(self.keys, self.levels, self.tags) if at not in levels and (tag in OUTSIDE or not marked)}
        return within, others - set(within) - {0}

    def text(self, templates: set[int]) -> str:
        """The blocks of the main content, or of the whole page where none is marked, without templates."""
        _, blocks = self.main_blocks()
        return without([b[1] for b in blocks], [b[2] for b in blocks], self.keys, self.parents, templates)


def used(elements, keys, parents) -> tuple[list[int], list[int], list[int]]:
    """The subtrees that lie around the given ones, and the given ones, numbered anew."""
    wanted: set[int] = set()
    for e in elements:
        while e >= 0 and e not in wanted:
            wanted.add(e)
            e = parents[e]
    place = {-1: -1} | {e: i for i, e in enumerate(sorted(wanted))}
    return [place[e] for e in elements], [keys[e] for e in sorted(wanted)], [place[parents[e]] for e in sorted(wanted)]


def without(texts, elements, keys, parents, templates: set[int]) -> str:
    """Block texts that lie in no template, joined by newlines."""
    deleted: list[bool] = []
    for key, parent in zip(keys, parents):
        deleted.append(key in templates or (parent >= 0 and deleted[parent]))
    return "\n".join(t for t, e in zip(texts, elements) if not (e >= 0 and deleted[e]))
