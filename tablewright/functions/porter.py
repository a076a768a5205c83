"""Porter's suffix stripping, with the usual extensions of later implementations."""

from __future__ import annotations

# The published suffix rules (suffix, replacement) of steps 2 to 4.
STEP2 = (
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"),
    ("bli", "ble"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"),
    ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"),
    ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"),
    ("fulli", "ful"),
)
STEP3 = (
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""), ("ness", ""),
)
STEP4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism",
    "ate", "iti", "ous", "ive", "ize",
)
# Words with an irregular stem.
IRREGULAR = {
    "sky": "sky", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "news": "news",
    "innings": "inning", "inning": "inning", "outings": "outing", "outing": "outing",
    "cannings": "canning", "canning": "canning", "howe": "howe", "proceed": "proceed",
    "exceed": "exceed", "succeed": "succeed",
}


def _consonant(w: str, i: int) -> bool:
    if w[i] in "aeiou":
        return False
    return w[i] != "y" or i == 0 or not _consonant(w, i - 1)


def _measure(w: str) -> int:
    """Number of vowel-consonant changes."""
    kinds = [_consonant(w, i) for i in range(len(w))]
    return sum(1 for a, b in zip(kinds, kinds[1:]) if not a and b)


def _has_vowel(w: str) -> bool:
    return any(not _consonant(w, i) for i in range(len(w)))


def _double(w: str) -> bool:
    return len(w) >= 2 and w[-1] == w[-2] and _consonant(w, len(w) - 1)


def _cvc(w: str) -> bool:
    n = len(w)
    if n >= 3:
        return (
            _consonant(w, n - 3) and not _consonant(w, n - 2) and _consonant(w, n - 1) and w[-1] not in "wxy"
        )
    return n == 2 and not _consonant(w, 0) and _consonant(w, 1)


def _plural(w: str) -> str:
    if w.endswith("ies") and len(w) == 4:
        return w[:-1]
    for suffix, new in (("sses", "ss"), ("ies", "i"), ("ss", "ss"), ("s", "")):
        if w.endswith(suffix):
            return w[: len(w) - len(suffix)] + new
    return w


def _past(w: str) -> str:
    if w.endswith("ied"):
        return w[:-1] if len(w) == 4 else w[:-2]
    if w.endswith("eed"):
        return w[:-1] if _measure(w[:-3]) > 0 else w
    for suffix in ("ed", "ing"):
        base = w[: len(w) - len(suffix)]
        if w.endswith(suffix) and _has_vowel(base):
            break
    else:
        return w
    if base.endswith(("at", "bl", "iz")):
        return base + "e"
    if _double(base):
        return base if base[-1] in "lsz" else base[:-1]
    return base + "e" if _measure(base) == 1 and _cvc(base) else base


def _replace(w: str, rules) -> str:
    """The first rule whose suffix fits decides, also when its condition fails."""
    for suffix, new in rules:
        if w.endswith(suffix):
            base = w[: len(w) - len(suffix)]
            return base + new if _measure(base) > 0 else w
    return w


def _step2(w: str) -> str:
    if w.endswith("alli") and _measure(w[:-4]) > 0:
        return _step2(w[:-4] + "al")
    if w.endswith("logi"):
        return w[:-1] if _measure(w[:-3]) > 0 else w
    return _replace(w, STEP2)


def _step4(w: str) -> str:
    for suffix in sorted(STEP4, key=len, reverse=True):
        if w.endswith(suffix):
            base = w[: len(w) - len(suffix)]
            if _measure(base) > 1 and (suffix != "ion" or base[-1:] in ("s", "t")):
                return base
            return w
    return w


def _tidy(w: str) -> str:
    if w.endswith("e"):
        base = w[:-1]
        m = _measure(base)
        if m > 1 or (m == 1 and not _cvc(base)):
            w = base
    return w[:-1] if w.endswith("ll") and _measure(w[:-1]) > 1 else w


def stem(word: str) -> str:
    w = word.lower()
    if w in IRREGULAR:
        return IRREGULAR[w]
    if len(w) <= 2:
        return w
    w = _past(_plural(w))
    if w.endswith("y") and len(w) > 2 and _consonant(w, len(w) - 2):
        w = w[:-1] + "i"
    return _tidy(_step4(_replace(_step2(w), STEP3)))
