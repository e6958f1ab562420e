import pytest
from pyspark.sql import types as T


@pytest.fixture
def frame(spark):
    """A frame of documents: (doc_id, text) pairs with further columns of clashing names."""

    def make(rows, schema="doc_id bigint, text string, source string, row bigint, ids string"):
        width = len(T._parse_datatype_string(schema).fields)
        return spark.createDataFrame([(*r, *[None] * (width - len(r))) for r in rows], schema)

    return make
