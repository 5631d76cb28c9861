"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR  table folder (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
BENCH_RUNS    timed runs per query, of which the median counts (default 3)

The test tables are files of one row group, which one task would read: so tables are dealt out over all cores here
(`read_table` with `partitions`), which at scale nothing needs and no query does by itself. The shuffle is in the times.
"""

from __future__ import annotations

import functools
import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from catalog import queries as registered  # noqa: E402
from lexigrid.session import build_session  # noqa: E402

HEADLINE = [
    "wordcount_top50",
    *[f"pairs_d{d}" for d in (1, 2, 3, 4)],
    *[f"stripes_d{d}" for d in (1, 2, 3, 4)],
    *[f"pairs_line_rollup_d{d}" for d in (1, 2, 3, 4)],
    *[f"stripes_line_rollup_d{d}" for d in (1, 2, 3, 4)],
    "cooccurrence_from_corpus_d2",
    "document_frequency",
    "document_frequency_of_lines",
    "tfidf_scores",
    "tfidf_from_corpus",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered.read_table = functools.partial(registered.read_table, partitions=int(cpus))
    queries = registered.build()

    def run(name: str) -> float:
        start = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    run("wordcount_top50")  # starts the session and warms the scan; not counted
    seconds = {name: round(statistics.median(run(name) for _ in range(runs)), 3) for name in only}
    result = {
        "metric": "total_query_time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
