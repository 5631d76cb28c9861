"""Candidates of personal data wherever a number ends, and what is added of them."""

import pytest

from lexigrid.llm import pii

CASES = {
    "call (212) 555-0199 now": ["(212) 555-0199"],
    "phone 212-555-0199. Bye": ["212-555-0199"],
    "tel 212-555-0199- or": ["212-555-0199"],
    "fax 212-555-0199 212-555-0198 (212) 555-0197 of": ["212-555-0199", "212-555-0198", "(212) 555-0197"],
    "phone 2024 (212) 555-0196, yes": ["(212) 555-0196"],
    "cards 7536784127813050 4845168114407329 here": ["7536784127813050", "4845168114407329"],
    "card 3782 822463 10005 (212) 555-0195 x": ["3782 822463 10005", "(212) 555-0195"],
    "of +33 6 12 34 56 78 1.2.3.4. And": ["+33 6 12 34 56 78", "1.2.3.4"],
    "🙂 phone (212-555-0199) of": ["212-555-0199"],
}


@pytest.fixture(scope="module")
def found(spark):
    many = [f"mobile +1 (212) 555-{i:04}, phone (212) 555-{i:04}, fax 212-555-{i:04} today" for i in range(60)]
    many += [f"order 2024-01-{i % 28 + 1:02}, serial 19.12.{i + 1950}, ref 77.{i:04}.88" for i in range(60)]
    table = spark.createDataFrame(list(enumerate([*CASES, *many])), "doc_id long, text string")
    return pii.PersonalData(table)


def test_numbers_are_candidates_wherever_they_end(found):
    for r in found.extracted.where(f"doc_id < {len(CASES)}").collect():
        text, wanted = list(CASES.items())[r.doc_id]
        assert [text[c.start : c.end] for c in r.candidates] == wanted, text


def test_phones_are_added_before_a_blank_a_stop_and_another(found):
    spans = {r.doc_id: r for r in found.spans().collect()}
    added = {}
    for i, text in enumerate(CASES):
        base = set(map(tuple, spans[i].base))
        added[text] = [text[s.start : s.end] for s in spans[i].spans if s.kind == "phone" and tuple(s) not in base]
    for text in list(CASES)[:4]:
        assert added[text] == CASES[text], text


def test_numbers_that_fail_their_check_are_not_added(spark):
    good = [f"card {x} {y} of" for x, y in [(4111111111111111, 7536784127813050), (4845168114407329, 2353820953013749)] * 20]
    bad = [f"number {9807915762804490 + 1000 * i} of" for i in range(40)]
    table = spark.createDataFrame(list(enumerate(good + bad)), "doc_id long, text string")
    for r in pii.PersonalData(table).spans().collect():
        text = [*good, *bad][r.doc_id]
        for s in r.spans:
            number = text[s.start : s.end]
            assert sum((2 * int(c) - 9 * (c > "4")) if i % 2 else int(c) for i, c in enumerate(reversed(number))) % 10 == 0
