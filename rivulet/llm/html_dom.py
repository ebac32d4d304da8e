"""A small DOM of block elements for main-text extraction: parse, node features, text runs.

Only block elements become nodes; inline markup vanishes, its text belongs to
the block around it, formulas (MathML) included. Elements that a browser does
not show (``hidden``, ``display:none``, ``noscript`` where scripts run), drawings
and form controls leave no text; ``aria-hidden`` elements are shown and stay.
Text directly under the document root has no block to judge and is always kept.
"""

from __future__ import annotations

import html
import re

import numpy as np

# fixed values: HTML element names
_INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q s samp small span strike strong "
                    "sub sup time tt u var wbr input embed source track area base link meta col param nobr ruby rt rp "
                    "math semantics mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle mpadded mphantom menclose mfenced "
                    "msub msup msubsup munder mover munderover mmultiscripts".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript template iframe noframes xmp svg annotation annotation-xml canvas audio video select button datalist".split())
_CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
           "thead": ("tr", "td", "th", "thead", "tbody"), "tbody": ("tr", "td", "th", "thead", "tbody"), "option": ("option",)}
_SCOPE = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"),
          "thead": ("table",), "tbody": ("table",), "option": ()}
_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"""
                    r"""|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>""", re.S)
_ATTR = re.compile(r"""(?:^|[\s"'])(class|id|role|itemprop|style|hidden|aria-hidden|data-y)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"']+)|(?=[\s/]|$))""", re.I)
_LETTERS = re.compile(r"[a-z]+")

# words of class, id and role values, by what they usually name
GROUPS = [frozenset(x.split()) for x in (
    "article content post entry story main text body blog news page prose copy articlebody maincontent",
    "nav menu navigation navbar breadcrumb breadcrumbs tabs pagination pager toc links skip topbar sitemap",
    "comment comments reply replies disqus discussion respond reviews feedback",
    "ad ads advert adverts advertisement banner sponsor sponsored promo promotion commercial dfp adsense",
    "cookie cookies consent gdpr notice alert popup modal overlay warning privacy toast announcement",
    "share social related recommended newsletter subscribe signup widget trending popular tags author meta login search follow",
    "sidebar side aside footer foot header head masthead banner legal copyright complementary contentinfo rail site bottom top",
)]
TAGS = ("p", "div", "section", "article", "main", "nav", "header", "footer", "aside", "ul", "ol", "li", "form", "table", "td", "h1", "h2", "h3",
        "blockquote", "pre", "figure", "figcaption", "body", "label", "fieldset")
_TAG = {t: i for i, t in enumerate(TAGS)}
_HEADS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))


class Dom:
    """Nodes in page order: parent, tag, token groups; runs of text with the node they belong to."""

    __slots__ = ("parent", "tag", "groups", "dead", "label", "run_node", "run_text", "run_link", "links", "inner")

    def __init__(self, page: str):
        self.parent, self.tag, self.groups, self.dead, self.label = [-1], ["#"], [0], [False], [None]
        self.run_node, self.run_text, self.run_link = [], [], []
        self.links, self.inner = [0], [0]
        self._parse(page)

    def _parse(self, page: str) -> None:
        parent, tag, dead, links, inner = self.parent, self.tag, self.dead, self.links, self.inner
        stack, anchor, pos, n = [0], 0, 0, len(page)
        buf: list[str] = []
        linked = 0

        def flush():
            nonlocal linked
            if buf:
                text = " ".join("".join(buf).split())
                buf.clear()
                if text and not dead[stack[-1]]:
                    self.run_node.append(stack[-1])
                    self.run_text.append(text)
                    self.run_link.append(min(linked, len(text)))
            linked = 0

        for m in _TOKEN.finditer(page):
            if m.start() < pos:  # inside a raw element that was skipped
                continue
            if m.start() > pos:
                t = page[pos:m.start()]
                if "&" in t:
                    t = html.unescape(t)
                buf.append(t)
                if anchor:
                    linked += len(t.strip())
            pos = m.end()
            name = m[2] or m[5]
            if not name:
                continue
            name, closing = name.lower(), (m[1] or m[4]) == "/"
            if name in _INLINE:
                if name == "a":
                    anchor = 0 if closing else 1
                    links[stack[-1]] += not closing
                elif name == "br":
                    buf.append(" ")
                inner[stack[-1]] += not closing
                continue
            if closing:
                if name in ("html", "body"):
                    continue
                for d in range(len(stack) - 1, 0, -1):
                    if tag[stack[d]] == name:
                        flush()
                        del stack[d:]
                        break
                continue
            attrs = m[3] if m[2] else m[6]
            if name in _RAW:
                if not attrs.endswith("/"):
                    end = page.lower().find(f"</{name}", pos) if len(page) < 4096 else _find_close(page, name, pos)
                    pos = n if end < 0 else page.find(">", end) + 1 or n
                continue
            if name == "html" or name == "body" and "body" in tag:
                continue
            flush()
            if name in _CLOSES:
                shut, scope = _CLOSES[name], _SCOPE[name]
                for d in range(len(stack) - 1, 0, -1):
                    t = tag[stack[d]]
                    if t in scope:
                        break
                    if t in shut:
                        del stack[d:]
                        if name not in ("tr", "thead", "tbody"):
                            break
            elif tag[stack[-1]] == "p" or tag[stack[-1]] in _HEADS and name in _HEADS:
                del stack[-1]
            anchor = 0
            if name == "hr":
                continue
            up = stack[-1]
            if name == "body":  # ends the head, wherever that was left open
                del stack[1:]
                up = 0
            groups, hide, label = 0, dead[up] or name == "head", None
            if attrs:
                for a in _ATTR.finditer(attrs):
                    k, v = a[1].lower(), (a[2] or "").strip("\"'").lower()
                    if k == "hidden" or k == "style" and "display:none" in v.replace(" ", ""):
                        hide = True
                    elif k == "data-y":
                        label = v
                    elif k != "style":
                        for w in _LETTERS.findall(v):
                            for g, words in enumerate(GROUPS):
                                if w in words:
                                    groups |= 1 << g
            parent.append(up)
            tag.append(name)
            dead.append(hide)
            links.append(0)
            inner.append(0)
            self.groups.append(groups)
            self.label.append(label)
            stack.append(len(tag) - 1)
        if pos < n:
            t = page[pos:]
            buf.append(html.unescape(t))
        flush()


_CLOSERS: dict[str, re.Pattern] = {}


def _find_close(page: str, name: str, pos: int) -> int:
    m = _CLOSERS.setdefault(name, re.compile(f"</{name}", re.I)).search(page, pos)
    return m.start() if m else -1


_PARENTS = ("article", "main", "section", "div", "td", "aside", "form", "li", "body", "nav", "footer", "header", "ul")
FEATURES = 29 + len(TAGS) + 3 * len(GROUPS) + len(_PARENTS)


def features(dom: Dom) -> np.ndarray:
    """nodes x FEATURES: subtree density, attribute tokens, depth and sibling statistics."""
    n = len(dom.tag)
    parent = np.array(dom.parent)
    own, link, punct, words, runs = (np.zeros(n) for _ in range(5))
    start = np.full(n, -1.0)
    at = 0
    for k, t, a in zip(dom.run_node, dom.run_text, dom.run_link):
        size = len(t)
        own[k] += size
        link[k] += a
        punct[k] += t.count(",") + t.count(".") + t.count(";") + t.count("?")
        words[k] += t.count(" ") + 1
        runs[k] += 1
        if start[k] < 0:
            start[k] = at
        at += size
    total, links, tags, para, depth, kids, leaf = own.copy(), link.copy(), np.ones(n) + np.array(dom.inner), np.zeros(n), np.zeros(n), np.zeros(n), np.zeros(n)
    para[[i for i, t in enumerate(dom.tag) if t == "p"]] = 1
    count, marks, word = np.array(dom.links, float), punct.copy(), words.copy()
    up = dom.parent
    for i in range(n - 1, 0, -1):  # children come after their parents
        p = up[i]
        total[p] += total[i]
        links[p] += links[i]
        tags[p] += tags[i]
        para[p] += para[i]
        count[p] += count[i]
        marks[p] += marks[i]
        word[p] += word[i]
        kids[p] += 1
        if start[i] >= 0 and (start[p] < 0 or start[i] < start[p]):
            start[p] = start[i]
    index = np.zeros(n)
    seen = np.zeros(n)
    groups = np.array(dom.groups)
    above = np.zeros(n, int)
    tag_above = np.zeros(n, int)
    for i in range(1, n):
        p = up[i]
        depth[i] = depth[p] + 1
        index[i] = seen[p]
        seen[p] += 1
        above[i] = above[p] | groups[p]
        tag_above[i] = tag_above[p] | (1 << _TAG[dom.tag[p]] if dom.tag[p] in _TAG else 0)
    page = max(total[0], 1.0)
    sib = np.maximum(kids[parent], 1)
    mean = total[parent] / sib
    before, after = np.zeros(n), np.zeros(n)
    last: dict[int, int] = {}
    for i in range(1, n):
        p = up[i]
        if p in last:
            before[i], after[last[p]] = total[last[p]], total[i]
        last[p] = i
    alike: dict[tuple, list] = {}
    for i in range(1, n):
        alike.setdefault((up[i], dom.tag[i]), []).append(i)
    same, same_text = np.ones(n), total.copy()
    for at in alike.values():
        same[at] = len(at)
        same_text[at] = total[at].mean()
    safe = np.maximum(total, 1.0)
    x = np.zeros((n, FEATURES))
    cols = (np.log1p(total), total / page, links / safe, count / np.maximum(word, 1), marks / safe * 100, total / tags, np.log1p(tags),
            para, np.log1p(own), own / safe, depth, index / sib, sib, total / np.maximum(mean, 1.0), np.log1p(before), np.log1p(after),
            np.maximum(start, 0) / page, np.log1p(word), word / np.maximum(para, 1), kids, links[parent] / np.maximum(total[parent], 1.0),
            total[parent] / page, para / np.maximum(kids, 1), link / np.maximum(own, 1.0),
            same / sib, np.log1p(same_text), para[parent], marks[parent] / np.maximum(total[parent], 1.0) * 100, np.log1p(total[parent]))
    for j, c in enumerate(cols):
        x[:, j] = c
    base = len(cols)
    for i, t in enumerate(dom.tag):
        if t in _TAG:
            x[i, base + _TAG[t]] = 1
    base += len(TAGS)
    for g in range(len(GROUPS)):
        x[:, base + g] = groups >> g & 1
        x[:, base + len(GROUPS) + g] = above >> g & 1
    base += 2 * len(GROUPS)
    for j, t in enumerate(("nav", "header", "footer", "aside", "form", "article", "main")):
        x[:, base + j] = tag_above >> _TAG[t] & 1
    base += len(GROUPS)
    for j, t in enumerate(_PARENTS):
        x[:, base + j] = [i > 0 and dom.tag[up[i]] == t for i in range(n)]
    return x


SWITCH, NEUTRAL, TURN = 1.2, 0.5, 0.7  # prices: a dropped part in content, a neutral container, a change between its children


def decode(dom: Dom, p: np.ndarray) -> str:
    """Main text under the cheapest consistent labelling.

    Each node is content (its text stays), dropped (with its whole subtree) or a
    neutral container (its own text goes, its children are free, but each change
    between kept and dropped neighbours has a price). Below a dropped node
    everything is dropped; content may hold dropped parts, at a price; only
    containers without own text can be neutral.
    """
    n = len(dom.tag)
    p = np.clip(p, 1e-4, 1 - 1e-4)
    keep, drop = (-np.log(p)).tolist(), (-np.log(1 - p)).tolist()
    inf = float("inf")
    text = [False] * n  # text somewhere in the subtree
    own = [False] * n
    for k in dom.run_node:
        own[k] = text[k] = True
    up = dom.parent
    kids: list[list[int]] = [[] for _ in range(n)]
    for i in range(n - 1, 0, -1):
        text[up[i]] = text[up[i]] or text[i]
    for i in range(1, n):
        if text[i] and not dom.dead[i]:
            kids[up[i]].append(i)
    keep[0] = drop[0] = inf  # the document itself is neutral
    free, path = [inf] * n, [()] * n
    for i in range(n - 1, -1, -1):
        if not text[i] or dom.dead[i]:
            continue
        for c in kids[i]:
            keep[i] += min(keep[c], drop[c] + SWITCH)
            drop[i] += drop[c]
        if kids[i] and (i == 0 or not own[i]):
            k, d, back = 0.0, 0.0, []  # cheapest ways that end in a kept or a dropped child
            for j, c in enumerate(kids[i]):
                kk, dd = (k, d + TURN if j else inf), (d, k + TURN if j else inf)
                back.append((kk[1] < kk[0], dd[1] < dd[0]))
                k, d = min(kk) + min(keep[c], free[c]), min(dd) + drop[c]
            free[i] = (0.0 if i == 0 else NEUTRAL) + min(k, d)
            kept, ways = k <= d, []
            for to_kept, to_dropped in reversed(back):
                ways.append(kept)
                if to_kept if kept else to_dropped:
                    kept = not kept
            path[i] = ways[::-1]
    state = ["drop"] * n
    state[0] = "free"
    for i in range(n):
        if state[i] == "free":
            for c, kept in zip(kids[i], path[i]):
                state[c] = ("keep" if keep[c] <= free[c] else "free") if kept else "drop"
        elif state[i] == "keep":
            for c in kids[i]:
                state[c] = "keep" if keep[c] <= drop[c] + SWITCH else "drop"
    return " ".join(t for k, t in zip(dom.run_node, dom.run_text) if k == 0 or state[k] == "keep")
