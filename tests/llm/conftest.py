import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def session(spark):
    from martwright.llm.ship import ship
    return ship(spark)


@pytest.fixture
def frame(session):
    """Rows of (doc_id, text) as a table with further columns, some of them named like an operator's own."""
    def make(rows):
        df = session.createDataFrame(rows, "doc_id long, text string")
        return df.selectExpr("doc_id", "text", "'l' AS lang", "1 AS score", "2L AS n_lines", "'s' AS source", "3L AS n_chars")
    return make
