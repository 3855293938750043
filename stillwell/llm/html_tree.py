"""A lenient reader of HTML: block elements as a tree, their texts in page order."""

import html
import re

_START = re.compile(r"<(?:!--|[!?]|(/?)([a-zA-Z][^\s/>]*+))")
_REST = re.compile(r"(?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+>")
_SKIPPED = frozenset(
    "script style noscript template title svg math iframe object select textarea button "
    "audio video canvas map head".split())
_RAW = frozenset("script style noscript title iframe textarea".split())
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark output q "
    "ruby rb rp rt s samp small span strike strong sub sup time tt u var nobr".split())
_SPACE = frozenset("br hr".split())
#: A start tag closes an open element of these kinds, if none of the second kinds lies between.
_CLOSES = {
    "li": ({"li"}, {"ul", "ol"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}), "tbody": ({"thead", "tbody", "tr", "td"}, {"table"}),
    "body": ({"head"}, set()),
}


#: Elements below this depth become children of the one that has it.
DEEPEST = 512


class Tags:
    """Tags, comments and declarations of a source, read forward in time linear in its length.

    A tag ends at the first ``>`` outside the quotes of a value. A quote without a second one is a
    letter like any other; once quotes hold all that is left, they do not count any more. What no
    ``>`` ends is text."""

    def __init__(self, source: str):
        self.source, self.last, self.quoted = source, source.rfind(">"), True

    def end(self, at: int) -> int:
        """The end of a tag whose name ends at ``at``; a ``>`` follows somewhere."""
        if self.quoted:
            if found := _REST.match(self.source, at):
                return found.end()
            self.quoted = False
        return self.source.find(">", at) + 1

    def next(self, at: int):
        """(start, end, closing, name, attributes) of the next one from ``at``, None at the end. Name
        is None for comments and declarations."""
        found = _START.search(self.source, at)
        if found is None:
            return None
        start, name = found.start(), found[2]
        if found[0] == "<!--":
            end = self.source.find("-->", found.end())
            return start, len(self.source) if end < 0 else end + 3, False, None, ""
        if start > self.last:
            comment = self.source.find("<!--", start)  # all others need an end
            return None if comment < 0 else (comment, len(self.source), False, None, "")
        if name is None:
            return start, self.source.find(">", start) + 1, False, None, ""
        end = self.end(found.end())
        return start, end, bool(found[1]), name.lower(), self.source[found.end():end - 1]


class Page:
    """Nodes (tag, attributes, parent) and segments (node, text, letters within links)."""

    __slots__ = ("tags", "attributes", "parents", "segments")

    def __init__(self, source: str):
        self.tags, self.attributes, self.parents = ["#page"], [""], [-1]
        self.segments: list[list] = []
        stack, links, at, parts, linked = [0], 0, 0, [], 0
        places: dict[str, list[int]] = {}  # of open elements in the stack, by tag
        skipped = ""  # an element whose content does not count, until its end tag

        def flush():
            nonlocal parts, linked
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                self.segments.append([stack[-1], text, linked])
            parts, linked = [], 0

        def leave(depth):
            for i in stack[depth:]:
                places[self.tags[i]].pop()
            del stack[depth:]

        def innermost(kinds):
            return max((places[k][-1] for k in kinds if places.get(k)), default=0)

        def close(kinds, stop):
            depth = innermost(kinds)
            if depth and depth >= innermost(stop):
                flush()
                leave(depth)

        tags = Tags(source)
        while token := tags.next(at):
            start, end, closing, name, attributes = token
            if start > at and not skipped:
                parts.append(source[at:start])
                if links:
                    linked += start - at
            at = end
            if name is None:
                continue
            if skipped:
                if closing and name == skipped or name == "body":
                    skipped = ""
                if name != "body":
                    continue
            if closing:
                if name == "a":
                    links = 0
                elif name not in _INLINE and name not in _VOID:
                    if name == "p" and not places.get("p"):
                        parts.append(" ")
                    close({name}, {"article", "main", "body"} - {name}
                          if name in ("p", "li") else set())
                continue
            if name in _SKIPPED:
                parts.append(" " if name in ("title", "head") else "")
                if name in _RAW:
                    stop = re.compile(f"</{name}", re.I).search(source, at)
                    at = stop.start() if stop else len(source)
                if not attributes.rstrip().endswith("/"):
                    skipped = name
            elif name == "a":
                links = 1
            elif name in _INLINE:
                continue
            elif name in _VOID:
                if name in _SPACE:
                    parts.append(" ")
            else:
                flush()
                if name in _CLOSES:
                    close(*_CLOSES[name])
                elif self.tags[stack[-1]] == "p":
                    leave(len(stack) - 1)
                leave(min(len(stack), DEEPEST))
                self.tags.append(name)
                self.attributes.append(attributes)
                self.parents.append(stack[-1])
                places.setdefault(name, []).append(len(stack))
                stack.append(len(self.tags) - 1)
        if not skipped and at < len(source):
            parts.append(source[at:])
        flush()
