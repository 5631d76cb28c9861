"""Stages of the pipeline on more documents, among them very short ones."""

import corpus_pipeline
from lexigrid.llm.shared import scratch, stage

FOLDER = "/root/testdata/sf0.1"


def test_language_keeps_short_texts_and_drops_long_foreign_ones(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text", "lang")
    points = [0x4E00 + i * 7919 % 20000 for i in range(2000)]
    odd = [(-1 - i, "".join(map(chr, points[i::4])), None) for i in range(4)] + [(-9, "A.", None), (-10, "12 !?", None), (-11, None, None)]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema))
    rows = docs.collect()
    kept = {r.doc_id for r in corpus_pipeline.language(spark, docs, FOLDER).select("doc_id").collect()}
    wanted = {r.doc_id for r in rows if any(c.isalpha() for c in r.text or "")}
    foreign = {-1, -2, -3, -4}
    assert kept - foreign == wanted - foreign
    assert len(foreign & kept) < len(foreign)  # each has a cosine near 0, most of them under the bar


def chained(spark, docs, folder):
    for i, (name, step) in enumerate(corpus_pipeline.STAGES):
        docs = stage(step(spark, docs, folder), scratch(spark, f"chained-{i}"))
        yield name, docs


def test_stages_on_an_empty_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(0)
    for name, out in chained(spark, docs, "/root/testdata/sf0.001"):
        assert out.count() == 0, name


def test_stages_on_null_and_repeated_doc_ids(spark):
    base = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("length(text) > 300 AND lang = 'en'").limit(40)
    rows = [r.asDict() for r in base.collect()]
    near = [r | {"doc_id": None, "text": r["text"] + " more"} for r in rows[:5]]
    odd = [r | {"doc_id": 7} for r in rows[5:10]] + [r | {"doc_id": None} for r in rows[10:15]] + [rows[0] | {"text": None}] * 3 + [rows[1]] * 4
    docs = spark.createDataFrame([tuple(r[c] for c in base.columns) for r in rows + near + odd], base.schema)
    sizes = {}
    for name, out in chained(spark, docs, "/root/testdata/sf0.001"):
        sizes[name] = out
        if name not in ("language", "tokens"):
            texts = [r.text for r in out.collect()]
            assert len(texts) == len(set(texts)), name
    # A near copy stays only if the text it was made of is gone.
    kept = {r.text for r in sizes["near duplicates"].collect()}
    assert not any(r["text"] in kept and r["text"] + " more" in kept for r in rows)
    assert sizes["tokens"].count() == sizes["benchmarks"].count() <= len(kept) <= len({r["text"].lower() for r in rows})
