"""Mined URL rules against a count of all token sets, verdicts against all rules, and URLs that share many tokens."""

import itertools
import random

import pytest

from lexigrid.llm import url_rules


def all_rules(rows, min_support, min_confidence):
    """(token set, label) -> confidence, support, counted one by one."""
    sets = {frozenset(c) for tokens, _ in rows for k in range(1, len(tokens) + 1) for c in itertools.combinations(tokens, k)}
    rules = {}
    for own in sets:
        labels = [label for tokens, label in rows if own <= set(tokens)]
        for label in set(labels):
            n = labels.count(label)
            if n >= min_support * len(rows) and n >= min_confidence * len(labels):
                rules[own, label] = n / len(labels), n / len(rows)
    return rules


def brute(rows, min_support, min_confidence):
    rules = {k: x[0] for k, x in all_rules(rows, min_support, min_confidence).items()}
    return {
        (tuple(sorted(own)), label): x for (own, label), x in rules.items()
        if not any(part < own and says == label and y >= x for (part, says), y in rules.items())
    }


def mined(spark, rows, **limits):
    found = url_rules.mine(spark.createDataFrame(rows, "tokens array<string>, label string"), **limits).collect()
    out = {}
    for r in found:
        for tokens in itertools.product(*r.groups):  # any token of each group fires it
            key = tuple(sorted(tokens)), r.label
            assert key not in out
            out[key] = r.confidence
    return out


def test_unsure_rules_stay_beside_thousands_of_redundant_ones(spark):
    long = [f"path:{i:02}" for i in range(13)]  # 8191 rules of confidence 1, all but 13 redundant
    rows = [(long, "block")] * 20 + [(["host:blog"], "block")] * 9 + [(["host:blog"], "allow")]
    assert mined(spark, rows) == {((t,), "block"): 1.0 for t in long} | {(("host:blog",), "block"): 0.9}


def test_redundant_rules_go_by_any_part_of_their_tokens(spark):
    # a is surer than a, b, c, while neither a, b nor a, c nor b, c is a rule.
    rows = [(["a"], "x")] * 60 + [(["a", "b"], "y")] * 3 + [(["a", "c"], "y")] * 3 + [(["b", "c"], "y")] * 6
    rows += [(["a", "b", "c"], "x")] * 8 + [(["a", "b", "c"], "y")] + [(["d", "e"], "x")] * 4 + [(["d"], "y")]
    wanted = brute(rows, 0.002, 0.8)
    assert (("a", "b", "c"), "x") not in wanted and (("a",), "x") in wanted
    assert mined(spark, rows, min_confidence=0.8) == wanted


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_rules_of_tokens_that_come_together(spark, seed):
    draw = random.Random(seed)
    together = [["a", "b"], ["c"], ["d", "e", "f"], ["g"], ["h"], ["label=", "token=a"]]
    rows = []
    for _ in range(150):
        tokens = sum((g for g in together if draw.random() < 0.4), []) + (["b"] if draw.random() < 0.02 and seed == 2 else [])
        rows.append((list(dict.fromkeys(tokens)) or ["z"], "x" if ("a" in tokens and "c" in tokens) or draw.random() < 0.2 else "y"))
    assert mined(spark, rows, min_support=0.02, min_confidence=0.6) == brute(rows, 0.02, 0.6)


def test_tokens_are_one_item_only_if_they_share_all_rows(spark):
    rows = [(1, "a"), (1, "b"), (2, "a"), (2, "b"), (3, "c"), (4, "d"), (5, "c"), (6, "d"), (7, "e")]
    each = spark.createDataFrame(rows, "row long, token string")
    found = {r.token: r.name for r in url_rules.token_groups(each, url_rules.F.lit(2)).collect()}
    assert found == {"a": "a", "b": "a", "c": "c", "d": "d"}


GIVEN = [("block", "bad.org", "/"), ("allow", "good.org", "/"), ("block", "net", "/es/")]


def random_urls(seed, n=300):
    draw = random.Random(seed)
    hosts = ["bad.org", "a.bad.org", "good.org", "blog.good.org", "x.net", "y.net", "blog.net", "new.info", "blog.new.info"]
    parts = ["es", "en", "p1", "p2", "tag", "news", "deep", "deeper"]
    return [
        f"http://{draw.choice(hosts)}/" + "/".join(draw.sample(parts, draw.randrange(4))) + draw.choice(["", "?q=1", "?utm=2&q=3", "#x"])
        for _ in range(n)
    ]


@pytest.mark.parametrize("seed,in_row", [(1, 10_000), (2, 10_000), (1, 0)])
def test_verdicts_are_those_of_all_rules(spark, seed, in_row):
    urls = [*random_urls(seed), None, "", "no url", "http://", "http://new.info/" + "deep/" * 3000]
    table = spark.createDataFrame([(i, u, "kept") for i, u in enumerate(urls)], "page_id long, url string, label string")
    limits = {"min_support": 0.02, "min_confidence": 0.7}
    found = {r.page_id: r for r in url_rules.judge(table, GIVEN, in_row=in_row, **limits).collect()}
    assert all(r.label == "kept" for r in found.values()) and len(found) == len(urls)
    host, path = url_rules.host_and_path(table.url)
    tokens = {r.page_id: r.t for r in table.select("page_id", url_rules.tokens(table.url, host, path).alias("t")).collect()}
    fitting = {i: r._llm_verdict if r._llm_rule else None for i, r in found.items()}
    rules = all_rules([(tokens[i], v) for i, v in fitting.items() if v and tokens[i]], **limits)
    mined_verdicts = 0
    for i, r in found.items():
        if fitting[i]:
            continue
        fired = [(*x, label) for (own, label), x in rules.items() if own <= set(tokens[i])]
        assert r._llm_verdict == (max(fired)[2] if fired else "allow"), urls[i]
        mined_verdicts += bool(fired)
    assert mined_verdicts > 20


def test_urls_that_share_many_tokens(spark):
    urls = [f"http://bad.org/{i}/" + "/".join(f"s{chr(97 + k)}" for k in range(25)) for i in range(20)]
    urls += [f"http://h{i % 50}.good.org/p/{i}" for i in range(2000)] + ["http://other.info/sa/x", "http://other.info/se/p"]
    table = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    found = {r.page_id: r._llm_verdict for r in url_rules.judge(table, GIVEN).collect()}
    assert [found[i] for i in (0, 19, 20, 2020)] == ["block", "block", "allow", "block"]
