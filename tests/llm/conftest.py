import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def sf():
    if not os.path.isdir(SF):
        pytest.skip("driver tables not present")
    return SF


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from texts (or whole rows), with clashing extra columns."""
    def make(rows, schema=DOCS, **extra):
        full = [r if isinstance(r, tuple) else (i, r, "en", "s", None if r is None else len(r))
                for i, r in enumerate(rows)]
        from pyspark.sql import functions as F

        df = spark.createDataFrame(full, schema)
        for name, value in extra.items():
            df = df.withColumn(name, F.lit(value))
        return df
    return make
