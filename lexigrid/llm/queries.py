"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, lang_id
from .decontaminate import Decontamination
from .exact_dedup import Dedup
from .hard_negatives import HardNegatives, finite, quantised
from .jaccard_join import JaccardJoin
from .line_dedup import LineDedup
from .mixing import Mixture
from .pii import KINDS, PersonalData, listed, of_kind
from .prefix_trie import PrefixTrie, digests, turn_items
from .quality import Quality
from .shared import held_out, read, scratch, stage
from .sharding import assign_shards
from .url_rules import judge

Query = Callable[[SparkSession, str], DataFrame]


def op1_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    decided = Dedup(read(spark, folder, "documents").select("doc_id", "text")).decisions()
    return decided.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op2_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return LineDedup(read(spark, folder, "documents").select("doc_id", "text")).summary()


def op3_sharding(spark: SparkSession, folder: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    payload = [(F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text).alias("text_crc32")]
    dealt = assign_shards(read(spark, folder, "documents"), shards=40, payload=payload)
    return dealt.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    scores = Quality(read(spark, folder, "documents"), read(spark, folder, "labels")).scores()
    return scores.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


def op5_pii(spark: SparkSession, folder: str) -> DataFrame:
    spans = PersonalData(read(spark, folder, "documents").select("doc_id", "text")).spans()
    counts = [F.size(F.filter("base", of_kind(k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return spans.select(
        "doc_id", *counts, F.sha2(listed(F.col("base")), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans")
    )


def op6_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    documents = read(spark, folder, "documents").select("doc_id", "text")
    report = Decontamination(documents, read(spark, folder, "benchmark"), size=10).report()
    return report.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated"
    )


def op7_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return JaccardJoin(read(spark, folder, "documents").select("doc_id", "text"), size=5, percent=80).groups()


URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


def op8_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = judge(read(spark, folder, "pages").select("page_id", "url"), URL_RULES)
    return judged.select(
        "page_id", F.col("_llm_host").alias("host"), F.col("_llm_path").alias("path"), F.col("_llm_rule").alias("rule"),
        F.col("_llm_verdict").alias("verdict"),
    )


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def op9_bpe(spark: SparkSession, folder: str, path: str | None = None) -> DataFrame:
    import public_tokenizers

    tokenizer = bpe.load_tokenizer(path or vocabulary(), public_tokenizers.PATTERN)
    return bpe.round_trip(read(spark, folder, "documents"), tokenizer)


def op10_language_id(spark: SparkSession, folder: str) -> DataFrame:
    documents, space = read(spark, folder, "documents"), lang_id.Space()
    found = lang_id.identify(documents.select("doc_id", "text"), space, lang_id.learn(documents, space))
    return found.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("_llm_lang").alias("lang_pred"),
        F.col("_llm_score").alias("score"),
    )


def op11_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mix = Mixture(read(spark, folder, "documents").select("doc_id", "text", "source"), weights=(5, 2, 1), percent=150, most=2)
    return mix.plan().select("doc_id", "size", "source_size", "target", "taken")


def rebuilt(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns and members: each conversation c with the first h turns of conversation c - c % 100 for its own first h."""
    h, base = F.crc32(F.col("conv_id").cast("string")) % 6, F.col("conv_id") - F.col("conv_id") % 100
    members = items.select("conv_id").distinct().select("conv_id", base.alias("base"), h.alias("h"))
    starts = items.where("conv_id % 100 = 0 AND pos <= 5")
    lent = members.join(starts.withColumnRenamed("conv_id", "base"), "base").where("pos <= h")
    held = starts.groupBy(F.col("conv_id").alias("base")).agg(F.count(F.lit(1)).alias("n"))
    own = items.withColumns({"base": base, "h": h}).where("pos > h").join(held, "base", "left")
    placed = F.col("pos") - F.col("h") + F.least("h", F.coalesce("n", F.lit(0)))
    turns = lent.select("conv_id", "pos", "item", "weight").unionByName(own.select("conv_id", placed.alias("pos"), "item", "weight"))
    return turns, members.select("conv_id")


def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    items = turn_items(read(spark, folder, "conversations"))
    trie = PrefixTrie(*rebuilt(stage(items, scratch(spark, "placed"))))
    nobody = F.sha2(F.lit(""), 256)
    return trie.nodes().join(digests(trie.ends()), "node", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"),
        F.coalesce("digest", nobody).alias("ends_sha256"),
    )


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    rows, vec_id, label = read(spark, folder, "embeddings"), F.col("vec_id"), F.col("label")
    rows = rows.where(label.isNotNull() & finite(F.col("embedding"))).select(
        vec_id.alias("id"), F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"),
        quantised(F.col("embedding"), 256).alias("vector"), (vec_id % 100 == 0).alias("anchor"),
    )
    return HardNegatives(rows, positives=5, negatives=10, low=30, high=90).found


def build() -> dict[str, Query]:
    named = [
        op1_exact_dedup, op2_line_dedup, op3_sharding, op4_quality, op5_pii, op6_decontamination,
        op7_jaccard_join, op8_url_rules, op9_bpe, op10_language_id,
        op11_mixing, op12_prefix_trie, op13_hard_negatives,
    ]
    return {query.__name__: query for query in named}
