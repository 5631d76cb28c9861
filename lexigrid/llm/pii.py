"""Personal data found by weak supervision.

Fixed patterns give the base spans, which always stay. A wider pattern gives candidates; regular
expressions, gazetteers and the words in front of a candidate each vote for it, against it or not
at all. Numbers that look like nothing in particular (dates, orders, versions) are candidates too: they show what is no
personal data. Expectation-maximisation over the counts of vote patterns estimates how reliable each voter
is, starting from and held near what its votes are taken to mean; the resulting probabilities train the span
classifier, a table of log odds for the candidate's own traits, and candidates it is sure of are added.

A document's candidates stay in its row, so nothing is shuffled but the counts.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexigrid.functions.arrays import bind

from .shared import scratch, stage

KINDS = ["email", "ip", "card", "phone"]

# The base patterns, written so that no match attempt starts inside a run of characters that has
# failed already and nothing is tried twice (++ gives nothing back, and repeats without recursion):
# texts of any shape take time in their length.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
GUARDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][0-9\x20-]{11}", "phone": r"\+[0-9]"}

AT = r"(?:@|[\x20]?[\[(]at[\])][\x20]?)"
DOT = r"(?:\.|[\x20]?[\[(]dot[\])][\x20]?)"
# Number-like candidates. Known shapes come first, and no other number goes on over a blank into one,
# so numbers that stand next to each other are candidates of their own. Other numbers are as
# long as can be. All end in a digit.
END = r"(?![0-9A-Za-z]|[.-][0-9])"
SHAPES = [
    r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}",
    r"6[237][0-9]{2}(?:\x20[0-9]{4}){3}\x20[0-9]{1,3}", r"[0-9]{13,19}",
    *(rf"[0-9]{{4}}{s}(?:[0-9]{{4}}{s}[0-9]{{4}}{s}[0-9]{{1,7}}|[0-9]{{6}}{s}[0-9]{{4,5}})" for s in (r"\x20", "-")),
    r"(?:\+[0-9]{1,3}[\x20.-]?|1[\x20.-])?(?:\([0-9]{2,4}\)[\x20.-]?|[0-9]{2,4}[\x20.-])[0-9]{3,4}[\x20.-]?[0-9]{3,4}",
    r"0[0-9](?:[\x20.-][0-9]{2}){4}",
]
SHAPE = rf"(?:{'|'.join(SHAPES)}){END}"
OTHER = rf"(?:\+|\((?=[0-9]{{1,4}}\)))?[0-9](?:(?!\x20{{1,3}}{SHAPE})[().\x20-]{{0,3}}+[0-9]){{5,18}}(?![0-9A-Za-z])"
WIDE = {
    "email": rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++{AT}[A-Za-z0-9-]++(?:{DOT}[A-Za-z0-9-]++)++",
    "number": rf"(?<![0-9A-Za-z.])(?:{SHAPE}|{OTHER})",
}
WIDE_GUARDS = {"email": r"@|[\[(]at[\])]", "number": r"[0-9][0-9().\x20-]{5}"}

# The gazetteers and context words of the voters.
TOP_DOMAINS = "com net org edu gov io info de fr es uk eu ch at it nl ca us jp cn ru br in au".split()
CALLING_CODES = "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 52 55 61 62 64 65 81 82 86 90 91".split()
ISSUER_DIGITS = "3 4 5 6".split()
SPECIAL_NETS = "0 127 255".split()
CONTEXT = {
    "email": "mail|contact|write|reach|correo|courriel",
    "ip": r"\bip\b|server|host|address|client|login",
    "card": "card|visa|credit|pay|karte|carte|tarjeta",
    "phone": r"phone|\btel|call|fax|mobile|cell|telefon|téléphone|teléfono",
}
AGAINST = r"version|\bv\.?$|order|invoice|isbn|issn|\bref\b|\bid\b|serial|page|chapter|section|\bno\.?$|=\s*\W?$"

SPAN = "struct<start: int, end: int, match: string, before: string, after: string>"


def found(text: str, pattern: str, guard: str) -> Column:
    """All matches of a pattern in the column `text`, leftmost first, without overlaps.

    start and end count code points, end exclusive; before and after hold up to 32 and 1
    characters of context. Ends are running sums, made of whole arrays by doubling steps, so the work is n log n in the
    number of matches.
    """
    p, g = (x.replace("\\", "\\\\").replace("'", "\\'") for x in (pattern, guard))
    sizes = "transform(x.matches, (m, i) -> length(x.pieces[i]) + length(m))"
    added = "transform(a, (n, i) -> n + CASE WHEN i >= shiftleft(1, j) THEN a[i - shiftleft(1, j)] ELSE 0 END)"
    ends = f"aggregate(sequence(0, cast(ceil(log2(greatest(size(x.matches), 1))) AS int)), {sizes}, (a, j) -> {added})"
    span = (
        "named_struct('start', e[i] - length(m), 'end', e[i], 'match', m, "
        "'before', right(x.pieces[i], 32), 'after', left(x.pieces[i + 1], 1))"
    )
    return F.expr(
        f"CASE WHEN {text} RLIKE '{g}' THEN transform(array(named_struct('matches', regexp_extract_all({text}, '{p}', 0), "
        f"'pieces', split({text}, '{p}', -1))), x -> transform(array({ends}), e -> transform(x.matches, (m, i) -> {span}))[0])[0] "
        f"ELSE cast(array() AS array<{SPAN}>) END"
    )


def meets(spans: Column, c: Column) -> Column:
    """Whether one of the spans, in order and apart from each other, overlaps c; found by halving."""
    halvings = F.sequence(F.ceil(F.log2(F.size(spans) + 1)).cast("int"), F.lit(0), F.lit(-1))

    def further(ended: Column, j: Column) -> Column:
        to = ended + F.pow(F.lit(2), j).cast("int")
        return F.when((to <= F.size(spans)) & (F.get(spans, to - 1)["end"] <= c["start"]), to).otherwise(ended)

    ended = F.aggregate(halvings, F.lit(0), further)
    return F.coalesce(F.get(spans, ended)["start"] < c["end"], F.lit(False))


def digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits (at least one) passes the checksum."""

    def added(total: Column, place: Column) -> Column:
        digit = F.substr(number, F.length(number) - place + 1, F.lit(1)).cast("int")
        twice = F.when(place % 2 == 0, digit * 2).otherwise(digit)
        return total + F.when(twice > 9, twice - 9).otherwise(twice)

    return F.aggregate(F.sequence(F.lit(1), F.length(number)), F.lit(0), added) % 10 == 0


def is_ip(match: Column) -> Column:
    def small(part: Column) -> Column:
        bare = F.regexp_replace(part, "^0+(?=[0-9])", "")
        return F.when(F.length(bare) <= 3, bare.cast("int") <= 255).otherwise(False)

    return F.forall(F.split(match, r"\."), small)


def is_card(match: Column) -> Column:
    number = digits(match)
    return F.when(F.length(number).between(13, 19), luhn(number)).otherwise(False)


def is_phone(match: Column) -> Column:
    return F.length(digits(match)).between(9, 15)


VALID = {"email": lambda m: F.lit(True), "ip": is_ip, "card": is_card, "phone": is_phone}


def passes(kind: str) -> Callable[[Column], Column]:
    return lambda s: VALID[kind](s["match"])


def of_kind(kind: str) -> Callable[[Column], Column]:
    return lambda s: s["kind"] == kind


def placed(kind: Column | None = None) -> Callable[[Column], Column]:
    """A span's kind (its own if none is given), start and end."""
    return lambda s: F.struct(
        (s["kind"] if kind is None else kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end")
    )


def number_kind(match: Column) -> Column:
    """The kind a number-like candidate is judged as: by its shape, phone if it has none."""
    n = F.length(digits(match))
    return (
        F.when(match.rlike(r"^[0-9]++(?:\.[0-9]++){3}$"), "ip")
        .when(n.between(13, 19) & match.rlike(r"^[0-9](?:[\x20-]?[0-9])++$"), "card")
        .otherwise("phone")
    )


def votes(kind: Column, c: Column) -> Column:
    """One character a voter: + for personal data, - against it, 0 without an opinion."""
    match, before, n = c["match"], F.lower(c["before"]), digits(c["match"])

    def vote(yes: Column, no: Column | None = None) -> Column:
        out = F.when(yes, "+")
        return (out if no is None else out.when(no, "-")).otherwise("0")

    def of(*named: tuple[str, Column]) -> Column:
        out = F.lit(False)
        for k, condition in named:
            out = out | ((kind == k) & condition)
        return out

    strict = of(
        ("email", match.rlike(r"^[^@\s]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++$")), ("ip", is_ip(match)),
        ("card", is_card(match)), ("phone", is_phone(match) & match.startswith("+")),
    )
    bad = of(("ip", ~is_ip(match)), ("card", ~is_card(match)), ("phone", ~F.length(n).between(7, 15)))
    form = of(
        ("phone", match.rlike(r"^(\+[0-9]{1,3}[\x20-]?)?(\([0-9]{2,4}\)|[0-9]{2,4})[\x20.-][0-9]{3,4}[\x20.-]?[0-9]{3,4}$")),
        ("card", match.rlike(r"^[0-9]{4}([\x20-]?)[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}$")),
        ("email", match.rlike(r"^[A-Za-z]")),
        ("ip", match.rlike(r"^[1-9][0-9]{0,2}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}$")),
    )
    other = of(("phone", match.rlike("^[0-9]+$") | match.rlike(r"^(19|20)[0-9]{2}\D[0-9]{1,2}\D[0-9]{1,2}|^[0-9]{1,2}\D[0-9]{1,2}\D(19|20)[0-9]{2}$")))
    top = F.lower(F.regexp_extract(match, r"[A-Za-z0-9-]+$", 0))
    code = F.regexp_extract(match, r"^\+([0-9]{1,2})", 1)
    listed = of(
        ("email", top.isin(TOP_DOMAINS)), ("phone", code.isin(CALLING_CODES) | F.left(code, F.lit(1)).isin("1", "7")),
        ("card", F.left(n, F.lit(1)).isin(ISSUER_DIGITS)),
    )
    unlisted = of(("ip", F.substring_index(match, ".", 1).isin(SPECIAL_NETS)), ("email", ~top.rlike("^[a-z]{2,}$")))
    context = of(*((k, before.rlike(w)) for k, w in CONTEXT.items()))
    return F.concat(
        vote(strict, bad), vote(form, other), vote(listed, unlisted), vote(context, before.rlike(AGAINST)),
    )


def traits(kind: Column, c: Column) -> Column:
    """What the classifier sees of a candidate: name=value strings from a fixed, small set."""
    match, n = c["match"], F.length(digits(c["match"]))

    def trait(name: str, value: Column) -> Column:
        return F.concat(kind, F.lit(f" {name}="), value.cast("string"))

    return F.array(
        trait("digits", F.least(n, F.lit(20))),
        trait("length", F.least(F.floor(F.length(match) / 4), F.lit(10))),
        trait("separators", F.least(F.length(F.regexp_replace(match, "[A-Za-z0-9]", "")), F.lit(8))),
        trait("start", F.when(match.startswith("+"), "+").when(match.startswith("("), "(").when(match.rlike("^[0-9]"), "9").otherwise("a")),
        trait("before", F.when(F.length(c["before"]) == 0, "").when(c["before"].rlike(r"\s$"), "blank").otherwise("other")),
        trait("after", F.when(F.length(c["after"]) == 0, "").when(c["after"].rlike(r"\s"), "blank").when(c["after"].rlike("[.,;:!?]"), "stop").otherwise("other")),
        trait("checked", F.when(kind == "card", is_card(match)).when(kind == "ip", is_ip(match)).otherwise(F.lit(True))),
        trait("context", F.lower(c["before"]).rlike("|".join(CONTEXT.values()))),
    )


# What votes are taken to mean before anything is known: how often personal data, and anything else, gets each one. The
# first voter applies checks; how often data of a kind and other numbers pass them is known (one number in ten has a right
# last digit by chance) and isn't estimated.
MEANT = {"+": (0.55, 0.15), "0": (0.4, 0.4), "-": (0.05, 0.45)}
CHECKED = {"+": (0.8, 0.1), "0": (0.195, 0.1), "-": (0.005, 0.8)}


def reliabilities(counts: dict[tuple[str, str], int], rounds: int = 50, anchor: float = 0.2) -> dict[str, dict[str, float]]:
    """Probability of being personal data by kind and vote pattern, by expectation-maximisation.

    `counts` has a row for each kind and pattern that occurs: 4 * 3**4 at most. What votes are taken to mean weighs
    as much as `anchor` times the candidates of the kind, at every size: so both classes keep their sense
    even if one of them is nearly empty. What the check means stays as it is.
    """
    out: dict[str, dict[str, float]] = {}
    for kind in sorted({k for k, _ in counts}):
        rows = {v: n for (k, v), n in counts.items() if k == kind}
        meant = [CHECKED] + [MEANT] * (len(next(iter(rows))) - 1)
        total = sum(rows.values())
        held = anchor * total
        prior, rates = 0.5, meant
        for _ in range(rounds):
            p = {}
            for v in rows:
                odds = math.log(prior / (1 - prior)) + sum(math.log(r[c][0] / r[c][1]) for r, c in zip(rates, v, strict=True))
                p[v] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
            yes = sum(n * p[v] for v, n in rows.items())
            prior = (held / 2 + yes) / (held + total)
            rates = [
                {
                    c: (
                        (held * of[c][0] + sum(n * p[v] for v, n in rows.items() if v[voter] == c)) / (held + yes),
                        (held * of[c][1] + sum(n * (1 - p[v]) for v, n in rows.items() if v[voter] == c)) / (held + total - yes),
                    )
                    for c in of
                }
                if voter else of
                for voter, of in enumerate(meant)
            ]
        out[kind] = p
    return out


def log_odds(sums: list[tuple[str, float, float]], weight: float = 2.0) -> dict[str, float]:
    """Log odds of personal data by kind, and what each trait adds, from sums of beliefs (trait, yes, no).

    A trait's share in either class starts as its share in both, with a weight of so many candidates: where a class
    is nearly empty, traits say nothing.
    """
    totals: dict[str, list[float]] = {}
    for trait, yes, no in sums:
        if " digits=" in trait:
            of = totals.setdefault(trait.split(" ")[0], [0.0, 0.0])
            of[0] += yes
            of[1] += no
    odds = {k: math.log((yes + 1) / (no + 1)) for k, (yes, no) in totals.items()}
    for trait, yes, no in sums:
        all_yes, all_no = totals[trait.split(" ")[0]]
        share = (yes + no) / (all_yes + all_no)
        odds[trait] = math.log((yes + weight * share) / (all_yes + weight)) - math.log((no + weight * share) / (all_no + weight))
    return odds


class PersonalData:
    """Personal data in `docs` (doc_id, text, anything else).

    Null texts count as empty and have no spans. Rows are independent, so repeated rows have equal
    results; an empty table gives none. Whole texts are searched, in n log n of their matches. Other columns play no
    part. Candidates that are apart from the base spans are added where the classifier gives them `threshold` or more.
    """

    def __init__(self, docs: DataFrame, threshold: float = 0.9):
        self.threshold = threshold
        rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("t"))
        base = [F.filter(found("t", PATTERNS[k], GUARDS[k]), passes(k)).alias(k) for k in KINDS]
        wide = [found("t", WIDE[k], WIDE_GUARDS[k]).alias(f"wide_{k}") for k in WIDE]
        spans = rows.select("doc_id", *base, *wide)

        def judged(kind: Column, c: Column) -> Column:
            return F.struct(
                kind.alias("kind"), c["start"].alias("start"), c["end"].alias("end"),
                votes(kind, c).alias("votes"), traits(kind, c).alias("traits"),
            )

        emails = F.transform("wide_email", lambda c: judged(F.lit("email"), c))
        numbers = F.transform("wide_number", lambda c: bind(number_kind(c["match"]), lambda kind: judged(kind, c)))
        candidates = F.concat(emails, numbers)
        kept = F.concat(*(F.transform(k, placed(F.lit(k))) for k in KINDS))
        extracted = spans.select("doc_id", kept.alias("base"), candidates.alias("candidates"))
        self.extracted = stage(extracted, scratch(docs.sparkSession, "spans"))
        self._learn()

    def _learn(self) -> None:
        each = self.extracted.select(F.explode("candidates").alias("c"))
        patterns = each.groupBy("c.kind", "c.votes").count().collect()
        self.belief = reliabilities({(k, v): n for k, v, n in patterns})
        known = {f"{kind} {v}": p for kind, by in self.belief.items() for v, p in by.items()}
        p = F.element_at(F.from_json(F.lit(json.dumps(known)), "map<string, double>"), F.concat_ws(" ", "c.kind", "c.votes"))
        weighed = each.select(F.explode("c.traits").alias("trait"), p.alias("p"))
        sums = weighed.groupBy("trait").agg(F.sum("p").alias("yes"), F.sum(1 - F.col("p")).alias("no")).collect()
        self.odds = log_odds([tuple(r) for r in sums])

    def spans(self) -> DataFrame:
        """doc_id, base and spans (base and added): arrays of (kind, start, end) by kind, then start."""
        bar = math.log(self.threshold / (1 - self.threshold))
        odds = F.from_json(F.lit(json.dumps(self.odds)), "map<string, double>")

        def sure(c: Column) -> Column:
            return bar <= F.aggregate(
                F.transform(c["traits"], lambda t: F.coalesce(F.element_at(odds, t), F.lit(0.0))),
                F.coalesce(F.element_at(odds, c["kind"]), F.lit(0.0)), lambda a, x: a + x,
            )

        def apart(c: Column, lists: Column) -> Column:
            return ~F.exists(lists, lambda spans: meets(spans, c))

        span = "array<struct<kind: string, start: int, end: int>>"
        of_kinds = F.array(*(F.filter("base", of_kind(k)) for k in KINDS))
        added = bind(of_kinds, lambda lists: F.filter("candidates", lambda c: sure(c) & apart(c, lists)))
        added = F.transform(added, placed()).cast(span)
        return self.extracted.select(
            "doc_id", by_kind(F.col("base").cast(span)).alias("base"), by_kind(F.concat(F.col("base").cast(span), added)).alias("spans")
        )


def by_kind(spans: Column) -> Column:
    """Spans in the order of KINDS, then of start."""
    return F.flatten(F.array(*(F.array_sort(F.filter(spans, of_kind(k))) for k in KINDS)))


def listed(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
