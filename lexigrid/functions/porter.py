"""The suffix-stripping algorithm of M. F. Porter (1980) as one SQL expression.

Each step of the algorithm is a CASE over a lambda variable `w`, and `transform`
runs the steps one after the other over a whole array of words. A step mentions
its word many times; the lambda variable binds it once, so the chain stays linear
in size. Written as one projection per step the same rules make a generated
method too large for the JIT to compile, which measured several times slower.

The steps are composed as SQL text because the rules make some thousand nodes:
one parsed expression is built in milliseconds, as many separate column calls
from Python take over a second per query.

Inside the chain a `y` that acts as a consonant is written `Y`, so one character
class tells vowels from consonants. The last step lowers it again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The published rule tables, `suffix:replacement`, with the two
# changes of the author's later revision (bli for abli, and logi).
STEP_2 = (
    "ational:ate tional:tion enci:ence anci:ance izer:ize bli:ble alli:al "
    "entli:ent eli:e ousli:ous ization:ize ation:ate ator:ate alism:al "
    "iveness:ive fulness:ful ousness:ous aliti:al iviti:ive biliti:ble logi:log"
)
STEP_2_AS_OF_1980 = STEP_2.replace(" bli:ble", " abli:able").replace(" logi:log", "")
STEP_3 = "icate:ic ative: alize:al iciti:ic ical:ic ful: ness:"
STEP_4 = (
    "al: ance: ence: er: ic: able: ible: ant: ement: ment: ent: sion:s tion:t "
    "ou: ism: ate: iti: ous: ive: ize:"
)
VOWEL = "[aeiouy]"
CONSONANT = "[^aeiouy]"
# consonant, vowel, consonant at the end, the last one not w, x or y
SHORT_SYLLABLE = "[^aeiouy][aeiouy][^aeiouywxY]$"
# Double consonants other than ll, ss, zz; a double y shows as vowel, consonant.
DOUBLED = "(bb|cc|dd|ff|gg|hh|jj|kk|mm|nn|pp|qq|rr|tt|vv|ww|xx|yY)$"
MIN_STEMMED_LENGTH = 3

# Put behind words too short to stem; no suffix ends in it.
_SHIELD = "."


def parse_rules(table: str) -> list[tuple[str, str]]:
    return [tuple(rule.split(":")) for rule in table.split()]


def _has_vowel(base: str) -> str:
    return f"({base} RLIKE '{VOWEL}')"


def _measure_over_0(base: str) -> str:
    return f"({base} RLIKE '{VOWEL}{CONSONANT}')"


def _measure_over_1(base: str) -> str:
    return f"({base} RLIKE '{VOWEL}{CONSONANT}+{VOWEL}+{CONSONANT}')"


def _short(base: str) -> str:
    return f"({base} RLIKE '{SHORT_SYLLABLE}')"


def _ends(*suffixes: str) -> str:
    return "(" + " OR ".join(f"endswith(w, '{suffix}')" for suffix in suffixes) + ")"


def _without(n: int) -> str:
    return f"substring(w, 1, length(w) - {n})"


def _plus(base: str, ending: str) -> str:
    return f"concat({base}, '{ending}')" if ending else base


def _case(*branches: tuple[str, str], otherwise: str = "w") -> str:
    return "CASE " + " ".join(f"WHEN {test} THEN {value}" for test, value in branches) + f" ELSE {otherwise} END"


def _longest_suffix(table: str, condition: Callable[[str, str], str]) -> str:
    """Apply the rule of the longest matching suffix if its condition holds.

    `condition` sees the word without the suffix and the word the rule would
    make. Rules are grouped by last letter first: most words match no rule of a
    step and leave after a handful of one-letter tests.
    """
    groups: dict[str, list[tuple[str, str]]] = {}
    for suffix, ending in sorted(parse_rules(table), key=lambda rule: -len(rule[0])):
        base = _without(len(suffix))
        result = _plus(base, ending)
        rule = _case((condition(base, result), result))
        groups.setdefault(suffix[-1], []).append((_ends(suffix), rule))
    return _case(*((_ends(letter), _case(*rules)) for letter, rules in groups.items()))


def _mark() -> str:
    """Mark consonant y, and shield short words from every later rule."""
    marked = "regexp_replace(regexp_replace(w, '(^|[aeiou])y', '$1Y'), 'yy', 'yY')"
    return _case((f"length(w) < {MIN_STEMMED_LENGTH}", _plus("w", _SHIELD)), ("contains(w, 'y')", marked))


def _plurals() -> str:
    return _case(
        (f"NOT {_ends('s')}", "w"),
        (_ends("sses", "ies"), _without(2)),
        (_ends("ss"), "w"),
        otherwise=_without(1),
    )


def _past_and_gerund() -> str:
    def removed(suffix: str) -> tuple[str, str]:
        base = _without(len(suffix))
        short = f"{_measure_over_0(base)} AND NOT {_measure_over_1(base)} AND {_short(base)}"
        repaired = _case(
            (_ends(f"at{suffix}", f"bl{suffix}", f"iz{suffix}"), _plus(base, "e")),
            (f"({base} RLIKE '{DOUBLED}')", _without(len(suffix) + 1)),
            (short, _plus(base, "e")),
            otherwise=base,
        )
        return f"{_ends(suffix)} AND {_has_vowel(base)}", repaired

    kept_eed = _case((_measure_over_0(_without(3)), _without(1)))
    return _case((_ends("eed"), kept_eed), removed("ed"), removed("ing"))


def _final_y() -> str:
    return _case((f"{_ends('y', 'Y')} AND {_has_vowel(_without(1))}", _plus(_without(1), "i")))


def _final_e() -> str:
    drop = f"({_measure_over_1('w')} OR ({_measure_over_0('w')} AND NOT {_short(_without(1))}))"
    return _case((f"{_ends('e')} AND {drop}", _without(1)))


def _final_double_l_and_unmark() -> str:
    single = _case((f"{_ends('ll')} AND {_measure_over_1('w')}", _without(1)))
    return f"lower(rtrim('{_SHIELD}', {single}))"


def _steps(revised: bool) -> list[str]:
    return [
        _mark(),
        _plurals(),
        _past_and_gerund(),
        _final_y(),
        _longest_suffix(STEP_2 if revised else STEP_2_AS_OF_1980, lambda base, result: _measure_over_0(base)),
        _longest_suffix(STEP_3, lambda base, result: _measure_over_0(base)),
        # The s or t that -ion leaves behind belongs to the measured part.
        _longest_suffix(STEP_4, lambda base, result: _measure_over_1(result)),
        _final_e(),
        _final_double_l_and_unmark(),
    ]


def stem_words(array_sql: str, revised: bool = True) -> Column:
    """Stem every word of an array of lower-case words, keeping order.

    `array_sql` is the name of an array column or an SQL expression for one.
    `revised` uses the author's later step 2. Words of one or two letters stay.
    """
    chain = array_sql
    for step in _steps(revised):
        chain = f"transform({chain}, w -> {step})"
    return F.expr(chain)


def stem_word(word_sql: str, revised: bool = True) -> Column:
    """Stem one word; for tables with one (distinct) word per row."""
    return F.get(stem_words(f"array({word_sql})", revised), F.lit(0))
