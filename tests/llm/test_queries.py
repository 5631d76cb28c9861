"""The registered queries against their SQL, and the pipeline stage by stage."""

import duckdb
import pytest

import corpus_pipeline
from lexigrid.llm import oracle, queries
from lexigrid.llm.shared import scratch, stage

FOLDER = "/root/testdata/sf0.001"
QUERIES = queries.build()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in "documents pages benchmark labels conversations embeddings".split():
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", QUERIES)
def test_rows(spark, duck, name):
    found = QUERIES[name](spark, FOLDER)
    columns = sorted(found.columns)
    mine = sorted(map(tuple, found.select(columns).collect()), key=repr)
    if name not in ("op12_prefix_trie", "op13_hard_negatives"):  # the others have a row for each of their table
        table = "pages" if name.startswith("op8") else "documents"
        assert len(mine) == duck.execute(f"SELECT count(*) FROM {table}").fetchone()[0]
    if sql := oracle.build().get(name):
        theirs = duck.execute(f"SELECT {', '.join(columns)} FROM ({sql})").fetchall()
        assert mine == sorted(map(tuple, theirs), key=repr)


def test_pipeline_stages(spark):
    sql = oracle.build()
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    names = docs.columns
    for name, step in corpus_pipeline.STAGES:
        out = stage(step(spark, docs, FOLDER), scratch(spark, "piped"))
        if name == "tokens":
            assert out.count() == docs.count()
            break
        assert out.columns == names
        kept = {r.doc_id for r in out.collect()}
        duck = duckdb.connect()
        duck.execute(f"CREATE VIEW benchmark AS SELECT * FROM '{FOLDER}/benchmark.parquet'")
        duck.register("now", docs.toArrow())
        wanted = {
            "language": "SELECT doc_id FROM now WHERE regexp_matches(text, '\\pL')",
            "exact dedup": f"SELECT doc_id FROM ({sql['op1_exact_dedup']}) WHERE kept",
            "near duplicates": f"SELECT doc_id FROM ({sql['op7_jaccard_join']}) WHERE doc_id = component_id",
            "benchmarks": f"SELECT doc_id FROM ({sql['op6_decontamination']}) WHERE NOT contaminated",
        }[name].replace("FROM documents", "FROM now")
        assert kept == {r[0] for r in duck.execute(wanted).fetchall()}, name
        docs = out
