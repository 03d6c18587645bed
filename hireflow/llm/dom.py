"""Element trees of web pages, forgiving of broken markup."""

from __future__ import annotations

from html.parser import HTMLParser

#: Elements without content.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)

#: An element of the key's kind ends when one of these starts inside it.
ENDED_BY = {
    "p": frozenset(
        "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr"
        " main nav ol p pre section table ul".split()
    ),
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "tbody", "tfoot"]),
    "td": frozenset(["td", "th", "tr"]),
    "th": frozenset(["td", "th", "tr"]),
    "option": frozenset(["option", "optgroup"]),
    "head": frozenset(["body"]),
}

#: Elements that the search for an open one does not leave.
BARRIERS = frozenset("table td th ul ol dl div section article main nav aside form body html".split())

#: Elements whose text is no text of the page.
SILENT = frozenset("script style noscript template head title iframe svg math textarea select object".split())

#: Elements that do not separate words.
INLINE = frozenset(
    "a abbr b bdi bdo big cite code data dfn em font i ins del kbd label mark q s samp small span"
    " strong sub sup time tt u var".split()
)


class Tree(HTMLParser):
    """Elements in page order: parent, tag, attributes; and pieces of text with their element."""

    def __init__(self, html: str) -> None:
        super().__init__(convert_charrefs=True)
        self.parent, self.tag, self.attrs = [-1], ["#page"], [""]
        self.pieces: list[tuple[int, str]] = []  # (element, text), page order
        self.open = [0]
        self.silent = 0
        self.feed(html)
        self.close()

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self._end_before(tag)
        self.parent.append(self.open[-1])
        self.tag.append(tag)
        self.attrs.append(" ".join(v.lower() for k, v in attrs if v and k in ("class", "id", "role")))
        if tag not in INLINE:
            self.pieces.append((self.open[-1], " "))
        if tag not in VOID:
            self.open.append(len(self.tag) - 1)
            self.silent += tag in SILENT

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        for i in range(len(self.open) - 1, 0, -1):
            if self.tag[self.open[i]] == tag:
                self._close(i)
                return
            if self.tag[self.open[i]] in BARRIERS and tag not in BARRIERS:
                return

    def handle_data(self, data: str) -> None:
        if not self.silent:
            self.pieces.append((self.open[-1], data))

    def _end_before(self, tag: str) -> None:
        for i in range(len(self.open) - 1, 0, -1):
            name = self.tag[self.open[i]]
            if tag in ENDED_BY.get(name, ()):
                self._close(i)
                return
            if name in BARRIERS:
                return

    def _close(self, i: int) -> None:
        for element in self.open[i:]:
            self.silent -= self.tag[element] in SILENT
            if self.tag[element] not in INLINE:
                self.pieces.append((self.parent[element], " "))
        del self.open[i:]
