from __future__ import annotations

import pytest

SF = "/root/testdata/sf0.001"


def documents(spark, rows, extra=""):
    """A documents table of given rows ``(doc_id, text, ...)``."""
    return spark.createDataFrame(rows, f"doc_id bigint, text string{extra}")


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
