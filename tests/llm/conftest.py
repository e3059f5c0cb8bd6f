import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture
def small():
    if not os.path.isdir(SMALL):
        pytest.skip("no test data")
    return SMALL


@pytest.fixture
def frame(spark):
    """A table from rows and a schema, in several partitions."""

    def make(rows, schema, parts=3):
        df = spark.createDataFrame(rows, schema)
        return df.repartition(parts) if rows else df

    return make
