"""URL filtering by given rules and by association rules mined from labelled URLs.

FP-growth finds token combinations that are frequent among labelled URLs; those that imply a label
with enough support and confidence become rules. A rule is indexed under its rarest token, so a
URL looks only at the rules listed under its own tokens and checks that it has the rest of theirs.

Two kinds of tokens would make FP-growth list all their combinations to no end, and are taken out first
without losing a rule: tokens that stand in exactly the same labelled URLs count as one item, any of which fires the
rule, and items that imply a label without exception are rules already, which no more tokens can better.
"""

from __future__ import annotations

import json
import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import scratch, stage

LABEL, ITEM = "label=", "token="
RULE = "struct<confidence: double, support: double, label: string, groups: array<array<string>>>"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first :// up to /, ? or #, A-Z lower-cased. Path: then up to ? or #.

    Both are empty for null or without ://.
    """
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def fitting_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """Name (host and path) and verdict of the longest rule (verdict, host, path) that fits, else null.

    A rule fits its host and all subdomains if the path starts with the rule's.
    """
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, of_host, of_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == of_host) | host.endswith(f".{of_host}")) & path.startswith(of_path)
        name = F.when(fits, of_host + of_path).otherwise(name)
        verdict = F.when(fits, says).otherwise(verdict)
    return name, verdict


def tokens(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens: host labels, top-level domain, path segments (digits as #), query keys."""
    labels = F.split(host, r"\.")
    segments = F.transform(F.split(path, "/"), lambda s: F.regexp_replace(s, "[0-9]+", "#"))
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[^?#]*\?([^#]*)", 1)
    keys = F.transform(F.split(query, "&"), lambda q: F.element_at(F.split(q, "="), 1))

    def named(kind: str, words: Column) -> Column:
        return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.concat(F.lit(kind), w))

    top = F.concat(F.lit("top:"), F.element_at(labels, -1))
    return F.array_distinct(
        F.concat(named("host:", labels), F.filter(F.array(top), lambda t: t != "top:"), named("path:", segments), named("key:", keys))
    )


FEW = 50_000  # rows of a token table that is sent to every task


def few(tokens: DataFrame) -> DataFrame:
    """A staged table of tokens, to be broadcast if it is small; what it is joined with grows with the URLs and never is."""
    return F.broadcast(tokens) if tokens.count() <= FEW else tokens


def token_groups(each: DataFrame, least: Column) -> DataFrame:
    """token, name, of `each` (row, token): tokens in at least `least` rows, and a name that those with the same rows share.

    Rows are compared by counts and two hashes of the sets of rows, and then one by one: a group stays if every row
    that has one of its tokens has all of them. Frequent tokens are as many as fit: tokens a row / support.
    """
    row = F.xxhash64("row")
    hashes = [F.bit_xor(row).alias("h1"), F.sum(F.xxhash64("row", F.lit(1)).cast("decimal(38,0)")).alias("h2")]
    often = each.groupBy("token").agg(F.count(F.lit(1)).alias("n"), *hashes).where(F.col("n") >= least)
    often = stage(often, scratch(each.sparkSession, "often"))
    same = often.groupBy("n", "h1", "h2").agg(F.min("token").alias("name"), F.count(F.lit(1)).alias("size"))
    known = stage(often.join(same, ["n", "h1", "h2"]).select("token", "name", "size"), scratch(each.sparkSession, "named"))
    met = each.hint("merge").join(few(known.where("size > 1")), "token").groupBy("row", "name").agg(F.count(F.lit(1)).alias("n"), F.first("size").alias("size"))
    unlike = met.where("n <> size").select("name").distinct().withColumn("unlike", F.lit(True))
    return known.join(unlike, "name", "left").select("token", F.when(F.col("unlike"), F.col("token")).otherwise(F.col("name")).alias("name"))


def mine(labelled: DataFrame, min_support: float = 0.002, min_confidence: float = 0.8) -> DataFrame:
    """Rules of `labelled` (tokens, label): groups (rarest first), label, confidence, support; all that are not redundant.

    A rule fires where each of its groups of tokens has one there. It is redundant if some of its groups
    imply the same label with as much confidence. Without labelled rows there are none. Frequent tokens are at most
    (tokens of a URL) / min_support, whatever the number of URLs, and so are rules of one group.
    """
    spark = labelled.sparkSession
    work = scratch(spark, "rules")
    rows = labelled.where(F.col("label").isNotNull() & (F.size("tokens") > 0)).select(
        F.monotonically_increasing_id().alias("row"), F.array_distinct("tokens").alias("tokens"), F.col("label").cast("string").alias("label")
    )
    rows = stage(rows, f"{work}/rows")
    n = rows.count()
    least = F.lit(math.ceil(min_support * n))
    each = rows.select("row", "label", F.explode("tokens").alias("token"))
    names = stage(token_groups(each, least), f"{work}/names")
    held = stage(each.hint("merge").join(few(names), "token").select("row", "label", "name").distinct(), f"{work}/held")

    of_label = held.groupBy("name", "label").agg(F.count(F.lit(1)).alias("both"))
    of_name = of_label.groupBy("name").agg(F.sum("both").alias("n"))
    confidence = F.col("both") / F.col("n")
    single = of_label.join(of_name, "name").where((F.col("both") >= least) & (confidence >= min_confidence)).select(
        F.array("name").alias("tokens"), "label", confidence.alias("confidence"), (F.col("both") / F.lit(n)).alias("support")
    )
    single = stage(single, f"{work}/single")
    sure = single.where("confidence = 1").select(F.col("tokens")[0].alias("name"))
    unsure = held.join(sure, "name", "left_anti").select("row", F.concat(F.lit(ITEM), "name").alias("item"))
    items = unsure.unionAll(rows.select("row", F.concat(F.lit(LABEL), "label")))
    baskets = items.groupBy("row").agg(F.collect_set("item").alias("items"))
    found = single
    if n:
        baskets = stage(baskets, f"{work}/baskets")
        model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(baskets)
        more = model.associationRules.where(F.col("consequent")[0].startswith(LABEL) & (F.size("antecedent") > 1)).select(
            F.sort_array(F.transform("antecedent", lambda t: F.substring(t, len(ITEM) + 1, 1 << 30))).alias("tokens"),
            F.expr(f"substring(consequent[0], {len(LABEL) + 1})").alias("label"), "confidence", "support",
        )
        found = single.unionByName(more)
    kept = without_redundant(stage(found, f"{work}/found")).withColumn("rule", F.monotonically_increasing_id())
    kept = stage(kept, f"{work}/kept")
    groups = names.groupBy("name").agg(F.array_sort(F.collect_list("token")).alias("group")).join(of_name, "name")
    whole = kept.select("rule", F.explode("tokens").alias("name")).join(groups, "name").groupBy("rule").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("n", "group"))), lambda x: x["group"]).alias("groups")
    )
    return stage(kept.join(whole, "rule").select("groups", "label", "confidence", "support"), f"{work}/rules")


def without_redundant(rules: DataFrame) -> DataFrame:
    """The rules of which no proper part implies the same label with as much confidence.

    Any such part is frequent and sure enough to be a rule itself. Most rules go by a part that
    lacks one token; all parts are made of the others only.
    """
    known = rules.select(F.col("tokens").alias("part"), "label", F.col("confidence").alias("of_part"))

    def left(some: DataFrame, parts: DataFrame) -> DataFrame:
        worse = parts.join(known, ["part", "label"]).where(F.col("of_part") >= F.col("confidence"))
        return some.join(worse.select("tokens", "label").distinct(), ["tokens", "label"], "left_anti")

    without = F.explode(F.transform("tokens", lambda t: F.array_remove("tokens", t)))
    some = left(rules, rules.where(F.size("tokens") > 1).select("tokens", "label", "confidence", without.alias("part")))
    some = stage(some, scratch(rules.sparkSession, "rules-left"))
    masks = some.where(F.size("tokens") > 2).select("*", F.expr("explode(sequence(1L, shiftleft(1L, size(tokens)) - 2))").alias("mask"))
    part = F.expr("filter(tokens, (t, i) -> (shiftright(mask, i) & 1) = 1)")
    return left(some, masks.select("tokens", "label", "confidence", part.alias("part")))


def indexed(rules: DataFrame) -> DataFrame:
    """token, rules: each rule under all tokens of its rarest group."""
    rule = F.struct("confidence", "support", "label", "groups").alias("rule")
    return rules.select(F.explode(F.col("groups")[0]).alias("token"), rule).groupBy("token").agg(F.collect_list("rule").alias("rules"))


def fires(rule: Column, own: Column) -> Column:
    return F.forall(rule["groups"], lambda group: F.arrays_overlap(group, own))


def implied_label(own: Column, index: list[tuple[str, list[dict]]]) -> Column:
    """The label of the firing rule with most confidence (then support, then label); null if none fires."""
    if not index:
        return F.lit(None).cast("string")
    listed = F.from_json(F.lit(json.dumps(dict(index))), f"map<string, array<{RULE}>>")  # a constant for the optimizer
    near = F.flatten(F.filter(F.transform(own, lambda t: F.element_at(listed, t)), lambda r: r.isNotNull()))
    return F.array_max(F.filter(near, lambda r: fires(r, own)))["label"]


def with_implied_label(rows: DataFrame, rules: DataFrame, in_row: int, work: str) -> DataFrame:
    """`rows` (_llm_tokens and others) with _llm_implied.

    Up to `in_row` entries, the index is a constant of every row; a larger one is joined by token.
    """
    index = stage(indexed(rules), f"{work}/index")
    if index.agg(F.coalesce(F.sum(F.size("rules")), F.lit(0))).first()[0] <= in_row:
        entries = [(r.token, [x.asDict() for x in r.rules]) for r in index.collect()]
        return rows.withColumn("_llm_implied", implied_label(F.col("_llm_tokens"), entries))
    numbered = stage(rows.withColumn("_llm_row", F.monotonically_increasing_id()), f"{work}/numbered")
    each = numbered.select("_llm_row", "_llm_tokens", F.explode("_llm_tokens").alias("token")).join(index, "token")
    best = each.select(
        "_llm_row", F.array_max(F.filter("rules", lambda r: fires(r, F.col("_llm_tokens")))).alias("best")
    ).groupBy("_llm_row").agg(F.max("best").alias("best"))
    implied = best.select("_llm_row", F.col("best.label").alias("_llm_implied"))
    return numbered.hint("merge").join(implied, "_llm_row", "left").drop("_llm_row")  # grows with the rows


def judge(
    pages: DataFrame, rules: list[tuple[str, str, str]], default: str = "allow", min_support: float = 0.002,
    min_confidence: float = 0.8, in_row: int = 10_000,
) -> DataFrame:
    """All columns of `pages` with _llm_host, _llm_path, _llm_rule and _llm_verdict.

    The verdict is the fitting rule's; where none fits, the mined one, learned from the URLs that the given rules
    judge; where no mined rule fires, `default`. Null urls have no tokens and get the default. Rows are judged one by
    one, so repeated rows and hot hosts need no care; a url of any length is read whole, and tokens that always come
    together count once in mining. An empty table gives no rows.
    """
    url = F.col("url").cast("string")
    host, path = host_and_path(url)
    parsed = pages.withColumns({"_llm_host": host, "_llm_path": path})
    name, verdict = fitting_rule(F.col("_llm_host"), F.col("_llm_path"), rules)
    parsed = parsed.withColumns({
        "_llm_rule": name, "_llm_verdict": verdict, "_llm_tokens": tokens(url, F.col("_llm_host"), F.col("_llm_path")),
    })
    labelled = parsed.select(F.col("_llm_tokens").alias("tokens"), F.col("_llm_verdict").alias("label"))
    mined = mine(labelled, min_support, min_confidence)
    judged = with_implied_label(parsed, mined, in_row, scratch(pages.sparkSession, "index"))
    own = F.coalesce("_llm_verdict", "_llm_implied", F.lit(default))
    return judged.withColumn("_llm_verdict", own).drop("_llm_tokens", "_llm_implied")
