"""Slow, plain-Python versions of the jobs, to compare with on small inputs."""

from __future__ import annotations

import re
from collections import Counter, defaultdict


def words_of(line: str) -> list[str]:
    return re.split("[^a-z]+", line.lower())


def counts(word: str) -> bool:
    return bool(re.fullmatch("[a-z]{3,}", word)) and not re.fullmatch("[ivx]+", word)


def pair_counts(lines: list[str], listed: set[str], distance: int) -> Counter:
    firsts = {w for w in listed if counts(w)}
    found = Counter()
    for line in lines:
        ws = words_of(line)
        for i, w1 in enumerate(ws):
            for w2 in ws[i + 1 : i + 1 + distance]:
                if w1 in firsts and w2 in firsts:
                    found[w1, w2] += 1
    return found


def stripes(lines: list[str], listed: set[str], distance: int, checked: bool = True) -> dict[str, dict[str, int]]:
    seconds = {w for w in listed if w and (counts(w) or not checked)}
    result: dict[str, Counter] = defaultdict(Counter)
    for line in lines:
        ws = words_of(line)
        for i, w1 in enumerate(ws):
            if w1 in listed and counts(w1):
                result[w1].update(w2 for w2 in ws[i + 1 : i + 1 + distance] if w2 in seconds)
    return {w1: dict(stripe) for w1, stripe in result.items()}


# -- the stemmer, from the paper's definitions ----------------------------------


def shape(word: str) -> str:
    """c and v for each letter; y is a vowel after a consonant."""
    out = ""
    for letter in word:
        vowel = letter in "aeiou" or (letter == "y" and out.endswith("c"))
        out += "v" if vowel else "c"
    return out


def measure(word: str) -> int:
    return len(re.findall("v+c+", shape(word)))


def doubled(word: str) -> bool:
    return len(word) > 1 and word[-1] == word[-2] and shape(word)[-1] == "c"


def short(word: str) -> bool:
    return shape(word).endswith("cvc") and word[-1] not in "wxy"


def replace_longest(word: str, rules: dict[str, str], allowed) -> str:
    for suffix in sorted(rules, key=len, reverse=True):
        if word.endswith(suffix):
            base = word.removesuffix(suffix)
            return base + rules[suffix] if allowed(base, suffix) else word
    return word


def stem(word: str, tables: list[dict[str, str]]) -> str:
    if len(word) < 3:
        return word
    word = replace_longest(word, {"sses": "ss", "ies": "i", "ss": "ss", "s": ""}, lambda b, s: True)
    if word.endswith("eed"):
        word = word[:-1] if measure(word[:-3]) > 0 else word
    else:
        for suffix in ("ed", "ing"):
            base = word.removesuffix(suffix)
            if base != word:
                if "v" in shape(base):
                    word = base
                    if word.endswith(("at", "bl", "iz")):
                        word += "e"
                    elif doubled(word) and word[-1] not in "lsz":
                        word = word[:-1]
                    elif measure(word) == 1 and short(word):
                        word += "e"
                break
    if word.endswith("y") and "v" in shape(word[:-1]):
        word = word[:-1] + "i"
    step_2, step_3, step_4 = tables
    word = replace_longest(word, step_2, lambda b, s: measure(b) > 0)
    word = replace_longest(word, step_3, lambda b, s: measure(b) > 0)
    word = replace_longest(word, step_4, lambda b, s: measure(b + s[0] if s in ("sion", "tion") else b) > 1)
    if word.endswith("e"):
        base = word[:-1]
        if measure(base) > 1 or (measure(base) == 1 and not short(base)):
            word = base
    if word.endswith("ll") and measure(word) > 1:
        word = word[:-1]
    return word
