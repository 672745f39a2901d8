"""Small tables with every awkward row, and plain-Python versions of the operators."""
from __future__ import annotations

import random
import re
from collections import Counter

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOC = "doc_id long, text string, lang string, source string, n_chars long"
#: columns whose names the operators use inside
CLASH = "_id string, _h string, h long, node long, copy string, part int, ids string, key string"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def make_texts(seed=1, n=60):
    """Texts with copies, near copies, shared passages, junk, empties and a long one."""
    r = random.Random(seed)
    vocab = ["".join(r.choice("aeioubdklmnrst") for _ in range(r.randint(2, 8))) for _ in range(300)]
    say = lambda k: [r.choice(vocab) for _ in range(k)]
    passage, texts = say(70), []
    for i in range(n):
        w = say(r.randint(30, 200))
        if i % 7 == 0:
            w[10:10] = passage[:r.randint(25, 70)]
        texts.append(" ".join(w).capitalize() + ".")
    base = texts[0].split()
    for i in range(6):  # near copies
        w = list(base)
        w[r.randrange(len(w))] = f"edit{i}"
        texts.append(" ".join(w))
    texts += [texts[1], texts[1], texts[2].upper(), "", "   \n\t ", None, "one", "two words",
              "a b c d", "the " * 400, "x\n" * 30, "é ü ñ 日本 語 x " * 8, "!!! ??? ...",
              "\n".join([texts[3]] * 3), " ".join(say(6000)), "tail word\n", "  wide　x"]
    return texts


def documents(spark, seed=1, clash=True):
    texts = make_texts(seed)
    rows = [(i * 3, t, "en" if i % 3 else "de", f"src{i % 2}" if i % 5 else None,
             len(t) if t is not None else None) for i, t in enumerate(texts)]
    rows += [rows[4], rows[4], (None, texts[5], None, None, 1), (None, None, "en", "src0", None)]
    random.Random(seed).shuffle(rows)
    if not clash:
        return spark.createDataFrame(rows, DOC), rows
    extra = ("x", "y", 7, 8, "z", 9, "w", "v")
    return spark.createDataFrame([r + extra for r in rows], f"{DOC}, {CLASH}").repartition(3), rows


def empty(spark):
    return spark.createDataFrame([], DOC)


def removed_words(rows, window):
    """By row: flags of the words that go; rows with equal (id, text) are one document."""
    docs = sorted({(r[0] is None, r[0] or 0, r[1] or "") for r in rows})
    first, out = {}, {}
    for none, i, t in docs:
        w = SPACED.findall(t)
        gone = [False] * len(w)
        for p in range(len(w) - window + 1):
            k = tuple(w[p:p + window])
            if first.setdefault(k, (none, i, t, p)) != (none, i, t, p):
                gone[p:p + window] = [True] * window
        out[none, i, t] = (w, gone)
    return out


def shingles(text, width=5):
    w = WORD.findall(lower(text))
    if not w:
        return Counter()
    return Counter(tuple(w[k:k + width]) for k in range(len(w) - width + 1)) if len(w) >= width \
        else Counter([tuple(w)])


def probability_jaccard(a, b):
    union = a.keys() | b.keys()
    return sum(1 / sum(max(a.get(j, 0) / a[i], b.get(j, 0) / b[i]) for j in union)
               for i in a.keys() & b.keys())


def similarity(a, b):
    common = len(a.keys() & b.keys())
    return max(probability_jaccard(a, b), common / len(a.keys() | b.keys())) if common else 0.0


def classes(nodes):
    """node -> smallest node of its class, for (node, text) pairs; nodes may repeat."""
    parent = {n: n for n, _ in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    bags = [(n, shingles(t)) for n, t in nodes]
    for i, (a, s) in enumerate(bags):
        for b, t in bags[:i]:
            if s and t and (s == t or similarity(s, t) >= 0.8):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {n: root(n) for n in parent}


def contamination(rows, items, window=13):
    found = set()
    for item, t in items:
        w = WORD.findall(lower(t))
        n = min(len(w), window)
        for p in range(len(w) - n + 1 if n else 0):
            found.add((tuple(w[p:p + n]), item))
    by_window, lengths = {}, sorted({len(k) for k, _ in found})
    for k, item in found:
        by_window.setdefault(k, set()).add(item)
    out = []
    for r in rows:
        w = WORD.findall(lower(r[1]))
        hit, ids = [False] * len(w), set()
        for n in lengths:
            for p in range(len(w) - n + 1):
                got = by_window.get(tuple(w[p:p + n]))
                if got:
                    hit[p:p + n] = [True] * n
                    ids |= got
        listed = sorted(str(i) for i in ids if i is not None)
        out.append((r[0], len(w), sum(hit), tuple(listed),
                    sum(hit) > 0 and 20 * sum(hit) >= len(w)))
    return out
