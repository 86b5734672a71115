"""Main text of web pages by tree scoring.

Each paragraph gives points, for being there, for its length and its commas, to its parent in
full and to further ancestors in falling shares. A container's points are cut by its link
density. The best container, and around it the siblings of it and of its ancestors that hold prose
of the same kind or score well, are the article; their
blocks of text are returned in page order. Parts that cannot be article (menus, forms, adverts,
comments and the like) are left out before scoring where tag or role tell it. Where only class
or id do, they are weighed against the prose: wrappers that hold most of the page, headings and
sections of prose inside the article stay, and a page that would lose most of its prose is read
again without the names.
"""

from __future__ import annotations

import re
from collections import Counter
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param",
         "source", "track", "wbr"}
_INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn",
           "em", "font", "i", "img", "ins", "kbd", "label", "mark", "nobr", "q", "rp", "rt", "ruby",
           "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var",
           "wbr", "br",
           "math", "mi", "mn", "mo", "ms", "mrow", "mtext", "mspace", "msup", "msub", "msubsup", "mfrac", "msqrt",
           "mroot", "mover", "munder", "munderover", "mstyle", "mfenced", "semantics", "annotation", "annotation-xml"}
_LEFT_OUT = {"script", "style", "noscript", "template", "head", "title", "nav", "footer", "aside",
             "form", "button", "select", "option", "textarea", "iframe", "svg", "canvas",
             "object", "audio", "video", "dialog", "menu", "datalist", "annotation", "annotation-xml"}
# Of these, the ones that broken or old markup puts around whole articles: when they took most of a
# page, it is read again and they are weighed like parts of a doubtful name.
_WEIGHED = {"form", "noscript", "nav", "aside", "footer"}
_ROLES = {"navigation", "banner", "contentinfo", "complementary", "dialog", "alertdialog", "alert",
          "search", "menu", "menubar", "form", "toolbar"}
# Words that name parts beside the article, in class or id; compared with whole words of them. The
# first may as well be an article's subject, the others hardly.
_MAYBE = re.compile(
    r"^(promos?|promotions?|banners?|aside|rail|foot|masthead|discussion|notices?|notifications?|alerts?|"
    r"overlay|toast|paywall|subscription|login|search|share|sharing|social|related|recommended|"
    r"recommendations|widgets?|skip|disclaimer|copyright)$")
_BESIDE = re.compile(
    r"^(nav|navbar|navigation|menus?|submenu|breadcrumbs?|sidebar|sidebars|footer|topbar|toolbar|popup|"
    r"popups|modal|subscribe|newsletter|signup|pagination|pager|hidden)$")
_ADVERT = re.compile(
    r"^(ads?|adverts?|advertisements?|advertising|adsense|adslot|adbox|adunit|sponsor(ed|s|ship)?|cookies?|"
    r"consent|gdpr)$")
_COMMENT = re.compile(r"^(comments?|commentlist|respond|replies|disqus)$")
# With one of these in it, a name tells about an element ("with-sidebar"), it is not its name.
_ABOUT = {"with", "without", "has", "have", "no", "non", "not", "is", "layout", "free", "open", "closed",
          "enabled", "disabled", "on", "off", "xs", "sm", "md", "lg", "xl", "print", "mobile", "desktop"}
_ARTICLE = re.compile(r"^(article|post|entry|story|content|main|body|text|page)$")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
# An open element that a new one of the same list closes by itself.
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
           "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_HOLDS = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"},
          "th": {"tr", "table"}, "option": {"select"}}
_CUT_TAG = re.compile(r"<[A-Za-z/!][^<>]*\Z")
_SEMANTIC = {"article", "main"}
_PARAGRAPH = {"p", "pre", "li", "td", "th", "dd", "dt", "blockquote", "figcaption",
              "h1", "h2", "h3", "h4", "h5", "h6"}
_OWN_PROSE = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre"}
_TAG_POINTS = {"article": 25, "main": 15, "section": 3, "div": 5, "td": 3, "pre": 3,
               "blockquote": 3, "ul": -3, "ol": -3, "dl": -3}
_LEVELS = 5
_LEAST_CHARS = 25
_SIBLING_SHARE = 0.2
_SIBLING_POINTS = 10
_LINKED = 0.25
# Characters of prose that clear a part of a doubtful name.
_MUCH_PROSE = 140
_MOST = 0.5
# A page is read again if this much prose, and so many times the result, is lost by names.
_LOST_CHARS = 500
_LOST_TIMES = 3


def _left_out(tag: str, attrs: dict, inside_article: bool, weighing: bool) -> bool:
    if tag in _LEFT_OUT and not (weighing and tag in _WEIGHED) or "hidden" in attrs or (attrs.get("aria-hidden") or "").lower() == "true":
        return True
    if tag == "header" and not inside_article:
        return True
    if (attrs.get("role") or "").lower() in _ROLES:
        return True
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attrs.get("style") or ""):
        return True
    # Inline elements have no block of their own to be weighed by: their class alone tells.
    return tag in _INLINE and _level(attrs.get("class")) > (tag != "a")


def _level(names: str | None) -> int:
    """How surely class or id name a part beside the article: 0 not at all, 1 maybe, 2 by one of
    several words, 3 by the whole name, 4 adverts and consents, 5 comments."""
    level = 0
    for name in (names or "").split():
        found = [w.lower() for w in _WORD.findall(name)]
        if not _ABOUT.isdisjoint(found):
            continue
        for w in found:
            level = max(level, 5 if _COMMENT.match(w) else 4 if _ADVERT.match(w) else
                        1 if _MAYBE.match(w) else 0 if not _BESIDE.match(w) else 3 if len(found) == 1 else 2)
    return level


def _named(tag: str, attrs: dict, weighing: bool) -> tuple[int, bool]:
    """Level of an element, and whether it is a section that only its id names."""
    if tag == "fieldset":  # of a form, or a box of prose
        return max(1, _level(attrs.get("class")), _level(attrs.get("id"))), False
    if weighing and tag in _WEIGHED:
        return 2, False
    if tag in ("html", "body", "main", "h1", "h2", "h3", "h4", "h5", "h6") or tag in _INLINE:
        return 0, False
    by_class = _level(attrs.get("class"))
    if tag == "article":
        reply = {"reply", "comment", "comments"}
        return (5 if any(not reply.isdisjoint(w) and _ABOUT.isdisjoint(w) for w in (
            {x.lower() for x in _WORD.findall(name)} for name in (attrs.get("class") or "").split())) else 0), False
    by_id = _level(attrs.get("id"))
    return max(by_class, by_id), tag == "section" and by_class == 0 and by_id > 0


class _Page(HTMLParser):
    """Elements in page order (parent, tag, points) and blocks of text with their element."""

    def __init__(self, weighing: bool = False):
        super().__init__(convert_charrefs=True)
        self.weighing = weighing
        self.lost = 0  # characters in parts that a second reading would weigh
        self.parent, self.tag, self.points = [-1], ["#root"], [0.0]
        self.name = [""]  # class
        self.named: dict[int, tuple[int, bool, bool]] = {}  # level, section by id, inside an article
        self.open = [0]
        self.out: int | None = None  # depth of the open part that is left out
        self.blocks: list[tuple[int, str, int]] = []
        self.text: list[str] = []
        self.links = self.link_chars = self.articles = self.mains = 0

    def handle_starttag(self, tag, attrs):
        if tag in _VOID:
            if tag not in _INLINE:
                self.flush()
            elif tag == "br":
                self.text.append(" ")
            return
        if tag not in _INLINE:
            self.flush()
            self._close_implied(tag)
        attrs = dict(attrs)
        node = len(self.tag)
        self.parent.append(self.open[-1])
        self.tag.append(tag)
        self.name.append(attrs.get("class") or "")
        named = [w.lower() for w in _WORD.findall(attrs.get("class") or "")]
        self.points.append(_TAG_POINTS.get(tag, 0) + 10 * any(map(_ARTICLE.match, named)))
        self.open.append(node)
        self.links += tag == "a"
        if self.out is None and _left_out(tag, attrs, self.articles > 0, self.weighing):
            self.out = len(self.open)
        level, by_id = _named(tag, attrs, self.weighing)
        if level:
            self.named[node] = level, by_id, self.articles + self.mains > 0
        self.articles += tag == "article"
        self.mains += tag == "main"

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID and tag not in ("p", "div", "span", "a", "article", "section", "body"):
            self.handle_endtag(tag)

    def _close_implied(self, tag):
        names = self.tag
        if any(names[n] == "p" for n in self.open[-1:]) or self._open_p():
            self._pop_to(self._open_p())
        closes = _CLOSES.get(tag)
        for at in range(len(self.open) - 1, 0, -1) if closes else ():
            name = names[self.open[at]]
            if name in closes:
                self._pop_to(at)
            elif name in _HOLDS[tag]:
                break

    def _open_p(self) -> int:
        """Depth of an open p with nothing but inline elements in it; 0 if there is none."""
        for at in range(len(self.open) - 1, 0, -1):
            name = self.tag[self.open[at]]
            if name == "p":
                return at
            if name not in _INLINE:
                return 0
        return 0

    def _pop_to(self, at: int):
        while at and len(self.open) > at:
            name = self.tag[self.open.pop()]
            self.links -= name == "a"
            self.articles -= name == "article"
            self.mains -= name == "main"
            if self.out is not None and len(self.open) < self.out:
                self.out = None

    def handle_endtag(self, tag):
        if tag in _VOID:
            return
        if tag not in _INLINE:
            self.flush()
        for at in range(len(self.open) - 1, 0, -1):
            name = self.tag[self.open[at]]
            if name == tag:
                self._pop_to(at)
                return
            if tag in _INLINE and name not in _INLINE:
                return

    def handle_data(self, data):
        if self.out is None:
            self.text.append(data)
            self.link_chars += len(data.strip()) if self.links else 0
        elif self.tag[self.open[self.out - 1]] in _WEIGHED and self.tag[self.open[-1]] not in ("script", "style"):
            self.lost += len(data.strip())

    def flush(self):
        if self.out is not None:
            return  # what was read before an inline part that is left out goes on after it
        if self.text:
            text = " ".join("".join(self.text).split())
            if text:
                at = len(self.open) - 1
                while self.tag[self.open[at]] in _INLINE:
                    at -= 1
                self.blocks.append((self.open[at], text, min(self.link_chars, len(text))))
        self.text, self.link_chars = [], 0


def main_text(html: str | None) -> str:
    """The article's blocks, white space folded, joined by two line feeds; empty if none."""
    # A tag that the end of the page cuts off is no text.
    body = _CUT_TAG.sub("", html or "")
    page = _read(body, False)
    text = _weighed_text(page)
    prose = min(len(text), sum(len(b[1]) for b in page.blocks if _prose(b)))
    if page.lost >= (_LOST_CHARS if prose >= _MUCH_PROSE else _MUCH_PROSE) and page.lost > _LOST_TIMES * prose:
        again = _weighed_text(_read(body, True))
        text = again if len(again) > prose else text
    return text


def _read(body: str, weighing: bool) -> _Page:
    page = _Page(weighing)
    page.feed(body)
    page.close()
    page.out = None if page.out is not None and page.tag[page.open[page.out - 1]] in _INLINE else page.out
    page.flush()
    return page


def _weighed_text(page: _Page) -> str:
    if not page.blocks:
        return ""
    if not page.named:
        return _article(page, set(), set())
    beside, restored, prose = _beside(page)
    text = _article(page, beside, restored)
    lost = sum(prose[i] for i in beside if page.named[i][0] < 4)
    if lost >= _LOST_CHARS and lost > _LOST_TIMES * len(text) or not text and lost >= _MUCH_PROSE:
        text = max(text, _article(page, {i for i in beside if page.named[i][0] > 3}, set()), key=len)
    if not text and sum(prose[i] for i in beside) >= _MUCH_PROSE:
        text = _article(page, set(), set())
    return text


def _prose(block: tuple[int, str, int]) -> bool:
    return len(block[1]) >= _LEAST_CHARS and block[2] < _LINKED * len(block[1])


def _beside(page: _Page) -> tuple[set, set, list]:
    """Named elements that are not article, outermost only; those of them that are if they turn up
    inside the best container; characters of prose of every element."""
    n = len(page.tag)
    comment = [False] * n
    for node in range(1, n):
        comment[node] = comment[page.parent[node]] or page.named.get(node, (0,))[0] > 3
    chars, links, prose, judged = [0] * n, [0] * n, [0] * n, [0] * n
    for block in page.blocks:
        node, text, link = block
        chars[node] += len(text)
        links[node] += link
        if _prose(block):
            prose[node] += len(text)
            judged[node] += 0 if comment[node] else len(text)
    for node in range(n - 1, 0, -1):
        for value in (chars, links, prose, judged):
            value[page.parent[node]] += value[node]
    beside, restored, within = set(), set(), [False] * n
    for node in range(1, n):
        within[node] = within[page.parent[node]]
        level, by_id, inside = page.named.get(node, (0, False, False))
        if not level or within[node]:
            continue
        low = links[node] < _LINKED * chars[node]
        rich = level == 1 and low and prose[node] >= _MUCH_PROSE
        section = by_id and level < 5 and low and prose[node] > 0
        most = level < 3 and judged[node] > 0 and judged[node] >= _MOST * judged[0]
        if most or inside and (rich or section) or section and level == 1:
            continue
        beside.add(node)
        if rich or section:
            restored.add(node)
        else:
            within[node] = True
    return beside, restored, prose


def _article(page: _Page, beside: set, restored: set) -> str:
    """The article without the elements ``beside``; the ``restored`` ones of them are given out
    where they lie in it, but not scored."""
    n = len(page.tag)
    out, gone = [False] * n, [False] * n
    for node in range(1, n):
        out[node] = out[page.parent[node]] or node in beside
        gone[node] = gone[page.parent[node]] or node in beside and node not in restored
    score, chars, links, last = [0.0] * n, [0] * n, [0] * n, list(range(n))
    for node, text, link in page.blocks:
        if out[node]:
            continue
        chars[node] += len(text)
        links[node] += link
        if len(text) < _LEAST_CHARS:
            points = 0.1
        else:
            points = 1 + sum(text.count(c) for c in ",，、،") + min(len(text) // 100, 3)
        points *= 1 - link / len(text)
        up = page.parent[node] if page.tag[node] in _PARAGRAPH and page.parent[node] > 0 else node
        for level in range(_LEVELS):
            score[up] += points / (1 if level == 0 else 2 if level == 1 else 3 * level)
            up = page.parent[up]
            if up <= 0:
                break
    for node in range(n - 1, 0, -1):
        up = page.parent[node]
        chars[up] += chars[node]
        links[up] += links[node]
        last[up] = max(last[up], last[node])
    total = [(s + p) * (1 - links[i] / chars[i]) if s > 0 else 0.0
             for i, (s, p) in enumerate(zip(score, page.points))]
    if not chars[0]:
        return ""
    best = max(range(n), key=lambda i: (total[i], -i))
    up = best
    while up > 0 and page.tag[up] not in _SEMANTIC:
        up = page.parent[up]
    semantic = up > 0
    if semantic:
        best = up
    chosen, direct = {best}, set()
    bar = max(_SIBLING_POINTS, _SIBLING_SHARE * total[best])
    if semantic:
        chosen |= {node for node in range(1, n) if page.parent[node] == page.parent[best]
                   and page.tag[node] == page.tag[best] and total[node] >= bar}
    else:
        _widen(page, best, bar, total, chars, links, last, out, chosen, direct)
    spans = sorted((c, last[c]) for c in chosen)
    kept, at = [], 0
    for node, text, _ in sorted(enumerate_blocks(page.blocks)):
        while at < len(spans) and spans[at][1] < node:
            at += 1
        if (at < len(spans) and spans[at][0] <= node or node in direct) and not gone[node]:
            kept.append((_, text))
    return "\n\n".join(text for _, text in sorted(kept, key=lambda x: x[0]))


def _widen(page, best, bar, total, chars, links, last, out, chosen, direct):
    """Add to ``chosen`` what belongs to the best container: from it up to the highest ancestor
    that adds a fair share of prose or parts of the same tag and class, the siblings that hold
    prose or score well, and what lies between such. ``direct`` gets the ancestors whose own
    text counts.

    Prose beside counts if it is set like that of the best container: in paragraphs, or in the
    same elements.
    """
    n = len(page.tag)
    prose = [0] * n
    kinds = {page.tag[b[0]] for b in page.blocks if _prose(b) and not out[b[0]] and best <= b[0] <= last[best]}
    kinds |= _PARAGRAPH if kinds & _PARAGRAPH else set()
    for block in page.blocks:
        if _prose(block) and not out[block[0]] and page.tag[block[0]] in kinds:
            prose[block[0]] += len(block[1])
    for node in range(n - 1, 0, -1):
        # A part that is mostly links has no prose to give.
        if links[node] < _LINKED * chars[node] or best >= node and best <= last[node]:
            prose[page.parent[node]] += prose[node]
    alike = Counter((page.parent[i], page.tag[i], page.name[i]) for i in range(1, n) if prose[i] and page.name[i])
    path, top, child, up = [], best, best, page.parent[best]
    while up >= 0:
        path.append(up)
        if (prose[up] - prose[top] >= _SIBLING_SHARE * max(prose[top], 1)
                or alike[up, page.tag[child], page.name[child]] > 1):
            top = up
        child, up = up, page.parent[up]
    # The siblings of the best container are judged even if they add little.
    reach = max(1, path.index(top) + 1 if top != best else 1)
    under = {page.parent[best]: best} | {p: c for c, p in zip(path, path[1:reach])}
    direct.update(p for p in path[:reach] if top != best)
    rows: dict[int, list[int]] = {p: [] for p in under}
    for node in range(1, n):
        if page.parent[node] in rows:
            rows[page.parent[node]].append(node)
    for parent, row in rows.items():
        good = []
        for at, node in enumerate(row):
            plain = chars[node] and links[node] < _LINKED * chars[node]
            if node == under[parent] or plain and (
                    page.tag[node] in _OWN_PROSE or prose[node]) or total[node] >= bar:
                good.append(at)
        for at in range(good[0], good[-1] + 1) if good else ():
            node = row[at]
            if node != under[parent] and (at in good or chars[node] and links[node] < _MOST * chars[node]):
                chosen.add(node)


def enumerate_blocks(blocks):
    """(element, text, place in the page) of each block."""
    return ((node, text, place) for place, (node, text, _) in enumerate(blocks))


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, text of every page; one row per row.

    A null or empty page, and one without any article text, gives an empty text. Broken markup
    is read as far as it goes. Whole pages are read; further columns are ignored; nothing is
    shuffled.
    """
    def run(batches):
        for batch in batches:
            texts = [main_text(x.decode("utf-8", "replace") if x else "")
                     for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())],
                                             names=[key, url, "text"])

    rows = pages.select(F.col(f"`{key}`").cast("long"), F.col(f"`{url}`").cast("string"),
                        F.encode(F.col(f"`{html}`"), "utf-8"))
    return rows.mapInArrow(run, f"`{key}` long, `{url}` string, text string")
