from __future__ import annotations

import pytest

from tests_llm_data import CLASHING, SCHEMA


@pytest.fixture(scope="session")
def build(spark):
    """Documents from rows of (doc_id, text, lang, source), with clashing columns if wanted."""

    def make(rows, clash=False):
        frame = spark.createDataFrame(list(rows), SCHEMA).repartition(3)
        if clash:
            from pyspark.sql import functions as F

            frame = frame.withColumns({name: F.lit("clash") for name in CLASHING})
        return frame

    return make
