"""Plain-Python Porter stemmer (published algorithm + common extensions),
used only by the tests as a brute-force reference for the SQL steps."""

from catspark.functions.porter import IRREGULAR, STEP2, STEP3, STEP4


def _cons(w, i):
    if w[i] in "aeiou":
        return False
    if w[i] == "y":
        return i == 0 or not _cons(w, i - 1)
    return True


def _m(s):
    cv = "".join("c" if _cons(s, i) else "v" for i in range(len(s)))
    return cv.count("vc")


def _vowel(s):
    return any(not _cons(s, i) for i in range(len(s)))


def _dbl(w):
    return len(w) >= 2 and w[-1] == w[-2] and _cons(w, len(w) - 1)


def _cvc(w):
    if len(w) >= 3 and _cons(w, len(w) - 3) and not _cons(w, len(w) - 2) \
            and _cons(w, len(w) - 1) and w[-1] not in "wxy":
        return True
    return len(w) == 2 and not _cons(w, 0) and _cons(w, 1)


def _rules(w, rules):
    for suf, rep, cond in rules:
        if w.endswith(suf):
            stem = w[:len(w) - len(suf)] if suf else w
            return stem + rep if cond(stem) else w
    return w


def stem(word):
    if word in IRREGULAR:
        return IRREGULAR[word]
    if len(word) <= 2:
        return word
    w = word
    # 1a
    if w.endswith("ies") and len(w) == 4:
        w = w[:-3] + "ie"
    else:
        w = _rules(w, [("sses", "ss", lambda s: True), ("ies", "i", lambda s: True),
                       ("ss", "ss", lambda s: True), ("s", "", lambda s: True)])
    # 1b
    if w.endswith("ied"):
        w = w[:-3] + ("ie" if len(w) == 4 else "i")
    elif w.endswith("eed"):
        if _m(w[:-3]) > 0:
            w = w[:-1]
    else:
        inter = None
        for suf in ("ed", "ing"):
            if w.endswith(suf) and _vowel(w[:-len(suf)]):
                inter = w[:-len(suf)]
                break
        if inter is not None:
            w = inter
            if w.endswith(("at", "bl", "iz")):
                w += "e"
            elif _dbl(w):
                if w[-1] not in "lsz":
                    w = w[:-1]
            elif _m(w) == 1 and _cvc(w):
                w += "e"
    # 1c
    if w.endswith("y") and len(w) > 2 and _cons(w, len(w) - 2):
        w = w[:-1] + "i"
    # 2
    if w.endswith("alli") and _m(w[:-4]) > 0:
        w = w[:-4] + "al"
    r2 = [(s, r, lambda st: _m(st) > 0) for s, r in STEP2]
    r2.append(("logi", "log", lambda st, w=w: _m(w[:-3]) > 0))
    w = _rules(w, r2)
    # 3
    w = _rules(w, [(s, r, lambda st: _m(st) > 0) for s, r in STEP3])
    # 4
    w = _rules(w, [(s, "", (lambda st: _m(st) > 1 and st[-1:] in ("s", "t")) if s == "ion"
                    else (lambda st: _m(st) > 1)) for s in STEP4])
    # 5a
    if w.endswith("e"):
        st = w[:-1]
        if _m(st) > 1 or (_m(st) == 1 and not _cvc(st)):
            w = st
    # 5b
    if w.endswith("ll") and _m(w[:-1]) > 1:
        w = w[:-1]
    return w
