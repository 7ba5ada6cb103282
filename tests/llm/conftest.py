import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from check_queries import compare, connect  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def against_sql(spark):
    duck = connect(SF_DIR)
    return lambda name: compare(spark, duck, SF_DIR, name)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture
def docs_of(spark):
    """Rows of ``documents`` from (doc_id, text) with a clashing extra column."""
    def make(rows, extra="score"):
        return spark.createDataFrame(
            [(i, t, "en", "s", 0 if t is None else len(t), "x") for i, t in rows],
            f"doc_id long, text string, lang string, source string, n_chars long, {extra} string",
        )

    return make
