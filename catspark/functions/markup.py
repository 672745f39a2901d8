"""Markup -> text in one pass (P9): a stack over the marks of a page.

Comments, ``nowiki``, footnotes, tags, templates, tables, links and external
links are read in one left-to-right scan.  A closing mark closes the nearest
open mark of its kind; marks that were opened above it, and marks that nothing
closes, stay in the text as they are.  Every piece of text is moved once, so
the time grows with the length of the text, however deep marks nest and
however many are left open.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: what later rules would read as markup, and what stands for it inside nowiki
PLAIN, GUARDED = "\'=", "\ufdd0\ufdd1"
#: text that a Python worker turns into strings at once
SLICE_BYTES = 2_000_000


def make_strip():
    """The scanner, as a function that carries all it needs to other processes."""
    import re

    marks = re.compile(r"<|\{+\|?|\|\}|\||\}{2,}|\[\[|\]\]|\[(?=https?://)")
    self_closed, footnote = re.compile(r"<ref[^>/]*/>"), re.compile(r"<ref[^>]*>")
    guard = str.maketrans(PLAIN, GUARDED)
    opens = {"}}": "{{", "|}": "{|", "]]": "[["}

    def strip(text):
        """``text`` without its markup; null stays null."""
        if text is None:
            return None
        for c in GUARDED:
            text = text.replace(c, "")
        root = [None, "", None, []]        # kind, mark, parts before the first bar, parts
        stack, depth = [root], {"{{": 0, "{|": 0, "[[": 0}
        nothing_after = set()              # closing strings that do not come any more
        boxes = []                         # open templates and tables, innermost last

        def find(what, start):
            if what in nothing_after:
                return -1
            k = text.find(what, start)
            if k < 0:
                nothing_after.add(what)
            return k

        def put(part):
            if part:
                stack[-1][3].append(part)

        def leave():
            """The innermost frame, closed or not, goes off the stack."""
            frame = stack.pop()
            depth[frame[0]] -= 1
            if frame[0] != "[[":
                boxes.pop()
            return frame

        def as_text(frame):
            before = [] if frame[2] is None else [frame[2], "|"]
            put([frame[1], *before, frame[3]])

        def open_(kind):
            stack.append([kind, kind, None, []])
            depth[kind] += 1
            if kind != "[[":
                boxes.append(kind)

        def close(mark):
            kind = opens[mark]
            if not depth[kind]:
                put(mark)
                return
            while stack[-1][0] != kind:    # opened inside and never closed
                as_text(leave())
            frame = leave()
            if kind == "[[":
                put(frame[3])              # the label, or the target where there is none

        i, end = 0, len(text)
        while i < end:
            m = marks.search(text, i)
            if m is None:
                break
            put(text[i:m.start()])
            at, mark, i = m.start(), m.group(), m.end()
            if mark == "<":
                if text.startswith("<!--", at) and (k := find("-->", at + 4)) >= 0:
                    i = k + 3
                elif text.startswith("<nowiki>", at) and (k := find("</nowiki>", at)) >= 0:
                    put(text[at + 8:k].translate(guard))
                    i = k + 9
                elif (k := find(">", at + 1)) < 0 or k == at + 1:
                    put("<")               # no tag
                else:
                    i = k + 1
                    if text.startswith("<ref", at) and not self_closed.match(text, at):
                        k = find("</ref>", footnote.match(text, at).end())
                        i = k + 6 if k >= 0 else i
            elif mark[0] == "{":
                braces = len(mark) - mark.endswith("|")
                table = mark.endswith("|") and braces % 2 == 1
                if braces % 2 and not table:
                    put("{")
                for _ in range((braces - table) // 2):
                    open_("{{")
                if table:
                    open_("{|")
                elif mark.endswith("|"):
                    i -= 1                 # the bar is read by itself
            elif mark == "|}":
                if boxes and boxes[-1] == "{|":
                    close("|}")
                else:                      # the brace may begin the end of a template
                    i -= 1
                    bar(stack[-1])
            elif mark == "|":
                bar(stack[-1])
            elif mark[0] == "}":
                if len(mark) > 2:
                    i = at + 2             # one pair at a time
                close("}}")
            elif mark == "[[":
                open_("[[")
            elif mark == "]]":
                close("]]")
            else:                          # an external link
                k = find("]", i)
                if k < 0:
                    put("[")
                else:
                    label = text[i:k].split(" ", 1)
                    put(label[1] if len(label) > 1 else "")
                    i = k + 1
        put(text[i:])
        while len(stack) > 1:
            as_text(leave())
        return flat(root[3])

    def bar(frame):
        """The first bar of a link parts its target from its label."""
        if frame[0] == "[[" and frame[2] is None:
            frame[2], frame[3] = frame[3], []
        else:
            frame[3].append("|")

    def flat(parts):
        out, todo = [], [iter(parts)]
        while todo:
            for p in todo[-1]:
                if isinstance(p, str):
                    out.append(p)
                else:
                    todo.append(iter(p))
                    break
            else:
                todo.pop()
        return "".join(out)

    return strip


def strip_marks(markup: Column) -> Column:
    """``markup`` without comments, templates, tables, footnotes, tags and link marks."""
    from collections.abc import Iterator

    import pyarrow as pa
    strip, limit = make_strip(), SLICE_BYTES

    def stripped(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        for texts in batches:
            # a batch holds many pages: some megabytes of them are Python strings at a time
            sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
            group = np.cumsum(sizes.astype(np.int64) + 1) // limit
            cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(texts)]
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                yield pa.array([strip(t.as_py()) for t in texts.slice(lo, hi - lo)], pa.string())

    # annotations name pyarrow by value: the function travels without this package
    stripped.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(stripped, "string")(markup.cast("string"))


def unguarded(text: Column) -> Column:
    """What stood in ``nowiki``, as it was."""
    return F.translate(text, GUARDED, PLAIN)
