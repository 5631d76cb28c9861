"""State stores of the exact deduplication's stream."""

from lexigrid.llm.exact_dedup import Dedup


def open_stores(spark):
    """How many state stores this process (driver and executor of a local session) has open."""
    owner = spark._jvm.java.lang.Class.forName("org.apache.spark.sql.execution.streaming.state.StateStore$")
    held = next(f for f in owner.getDeclaredFields() if f.getName().endswith("loadedProviders"))
    held.setAccessible(True)
    return held.get(owner.getField("MODULE$").get(None)).size()


def test_no_store_stays_open(spark):
    before = open_stores(spark)
    docs = spark.createDataFrame([(i, f"text {i % 3}") for i in range(9)], "doc_id long, text string")
    assert sorted(r.doc_id for r in Dedup(docs).kept_rows().collect()) == [6, 7, 8]
    assert open_stores(spark) <= before
