from __future__ import annotations

import pytest
from pyspark.sql import functions as F


@pytest.fixture
def docs_of(spark):
    """(id, text) pairs -> documents with columns whose names clash with those used inside."""

    def make(rows):
        df = spark.createDataFrame([(i, t) for i, t in rows], "doc_id long, text string")
        return df.select("doc_id", "text", *(F.lit("x").alias(c) for c in ("cls", "c1", "bucket", "component", "n", "key", "score", "rank")))

    return make
