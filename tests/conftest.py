from __future__ import annotations

import pytest

from lexigrid.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def lines_from(spark):
    """Rows of `doc_id, line_no, line` from lists of lines by document."""

    def make(documents: dict[str, list[str]]):
        rows = [(doc, i, line) for doc, lines in documents.items() for i, line in enumerate(lines)]
        return spark.createDataFrame(rows, "doc_id string, line_no int, line string")

    return make
