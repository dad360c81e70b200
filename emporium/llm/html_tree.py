"""Pages as trees of block elements and blocks of text.

A forgiving parser: unclosed and misnested tags never fail, scripts, styles and
comments are no text, inline elements belong to the block they stand in.  Of
elements without content of the page (drawings, frames, templates and the like)
what lies between their own two tags is skipped; one that is self-closed, or
never closed, hides nothing after it.  Only a script, a style or a comment that
never ends runs to the end of the page.  Reading takes time in proportion to the
page: quotes that never close count in so many tags only.
"""

from __future__ import annotations

import re
from html import unescape

START = re.compile(r"<(?:!--|[!?]|/?[a-zA-Z])")
TAG = re.compile(r"""<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>"']|"[^"]*"|'[^']*')*+)>""")
PLAIN_TAG = re.compile(r"<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>[^>]*)>")
UNQUOTED = 64  # tags whose quotes never close, after which quotes no longer count in a page
ATTRIBUTE = re.compile(r"""(class|id|role|data-content|data-boiler)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
NAME = re.compile("[a-z]+")

# Fixed values of HTML.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
RAW = {"script", "style", "textarea", "title"}  # hold text up to their end tag
SKIPPED = {"noscript", "template", "svg", "iframe", "object", "math", "select", "datalist", "head"}  # hold no content of the page
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "mark", "q", "rp", "rt",
    "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var",
}
CLOSES = {  # an opened element closes an open one of these, within the elements that hold them
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}),
}
HOLDERS = {"body", "div", "article", "section", "main", "aside", "nav", "header", "footer", "td", "th", "li", "blockquote", "form", "table", "figure"}


class Tree:
    """Nodes in page order; a text block is a leaf.  Lists by node: ``parent``
    (-1 for the root), ``key`` (the element's tag and names, or the block's
    measures), ``text`` (None for elements), ``label`` (True or False below an
    element marked data-content or data-boiler, else None)."""

    def __init__(self, html: str):
        self.parent, self.key, self.text, self.label = [-1], [("root",)], [None], [None]
        self.stack = [("root", 0, None)]  # tag, node (-1 for inline), label
        self.links = 0
        self.words: list[str] = []  # the open block's texts
        self.linked: list[str] = []
        self.n_links = 0
        self._read(html)

    def _flush(self) -> None:
        """Close the open block of text."""
        text = " ".join("".join(self.words).split())
        if text:
            holder = next((x for x in reversed(self.stack) if x[1] >= 0), self.stack[0])
            self.parent.append(holder[1])
            self.key.append(measures(text, len(" ".join("".join(self.linked).split())), self.n_links, holder[0]))
            self.text.append(text)
            self.label.append(holder[2])
        self.words, self.linked, self.n_links = [], [], 0

    def _say(self, raw: str) -> None:
        text = unescape(raw) if "&" in raw else raw
        self.words.append(text)
        if self.links:
            self.linked.append(text)

    def _pop(self, to: int) -> None:
        for tag, *_ in self.stack[to:]:
            self.links -= tag == "a"
        del self.stack[to:]

    def _open(self, tag: str, attrs: str) -> None:
        if tag in INLINE:
            if tag == "a":
                self.links += 1
                self.n_links += 1
            self.stack.append((tag, -1, self.stack[-1][2]))
            return
        self._flush()
        shut, within = CLOSES.get(tag, (None, None))
        if shut is None:
            shut, within = {"p"}, HOLDERS
        for at in range(len(self.stack) - 1, 0, -1):
            if self.stack[at][0] in shut:
                self._pop(at)
                break
            if self.stack[at][0] in within:
                break
        holder = next((x for x in reversed(self.stack) if x[1] >= 0), self.stack[0])
        found = {m[1].lower(): (m[2] or "").strip("\"'").lower() for m in ATTRIBUTE.finditer(attrs)} if attrs.strip() else {}
        label = False if "data-boiler" in found else True if "data-content" in found else holder[2]
        names = sorted({w for k in ("class", "id", "role") for w in NAME.findall(found.get(k, ""))})
        self.parent.append(holder[1])
        self.key.append((tag, *names))
        self.text.append(None)
        self.label.append(label)
        if tag not in VOID:
            self.stack.append((tag, len(self.parent) - 1, label))

    def _close(self, tag: str) -> None:
        for at in range(len(self.stack) - 1, 0, -1):
            open_tag = self.stack[at][0]
            if open_tag == tag:
                if tag not in INLINE:
                    self._flush()
                self._pop(at)
                return
            if tag in INLINE and open_tag not in INLINE:
                return  # misnested: the block goes on
            if open_tag in HOLDERS and tag not in HOLDERS and tag not in ("body", "html", "ul", "ol", "dl", "tbody", "thead", "tr"):
                return

    def _read(self, html: str) -> None:
        at, strict = 0, UNQUOTED
        ends: dict[str, dict[int, int]] = {}
        endless: set[str] = set()  # tags that are not closed any more
        while start := START.search(html, at):
            begin = start.start()
            if start[0] == "<!--":
                end = html.find("-->", begin + 4)
                self._say(html[at:begin])
                at = end + 3 if end >= 0 else len(html)
                continue
            if start[0] in ("<!", "<?"):
                end = html.find(">", begin)
                self._say(html[at:begin] if end >= 0 else html[at : begin + 2])
                at = end + 1 if end >= 0 else begin + 2
                continue
            m = TAG.match(html, begin) if strict else None
            if not m:
                strict = max(0, strict - 1)
                m = PLAIN_TAG.match(html, begin)
            if not m:  # no tag ends any more; only a comment may hide text
                end = html.find("<!--", begin)
                self._say(html[at:end] if end >= 0 else html[at:])
                at = len(html)
                break
            self._say(html[at:begin])
            at = m.end()
            tag = m["tag"].lower()
            if m["end"]:
                self._close(tag)
            elif tag == "br":
                self._say(" ")
            elif tag in RAW:
                end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(html, at) if tag not in endless else None
                if end:
                    at = end.end()
                else:
                    endless.add(tag)
                    after = html.find("<", at) if tag in ("title", "textarea") else -1
                    at = after if after >= 0 else len(html)
            elif tag in SKIPPED:
                if not m["attrs"].endswith("/"):
                    if tag not in ends:
                        ends[tag] = matching_ends(html, tag)
                    at = max(at, ends[tag].get(begin, at))
            else:
                self._open(tag, m["attrs"])
        self._say(html[at:])
        self._flush()


def matching_ends(html: str, tag: str) -> dict[int, int]:
    """Where the element that starts at a place ends, for all elements ``tag``
    that are closed; one that is not holds nothing."""
    starts: list[int] = []
    out: dict[int, int] = {}
    for m in re.finditer(rf"<(/?){tag}(?=[\s/>])[^>]*>", html, re.I):
        if not m[1]:
            if not m[0].endswith("/>"):
                starts.append(m.start())
        elif starts:
            out[starts.pop()] = m.end()
    return out


def measures(text: str, linked: int, links: int, tag: str) -> tuple:
    """What the model sees of a block of text, each in a few steps."""
    n = text.count(" ") + 1
    size = 0 if n < 3 else 1 if n < 6 else 2 if n < 12 else 3 if n < 30 else 4
    share = 0 if not linked else 1 if 3 * linked < len(text) else 2 if 10 * linked < 9 * len(text) else 3
    ended = text[-1] in ".!?…\"'”"
    return ("#text", f"size{size}", f"share{share}", f"links{min(links, 3)}", f"ended{int(ended)}", f"in-{tag}")
