import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def docs(spark):
    """Documents of (doc_id, text) or of whole rows; missing fields are null."""

    def build(*rows, schema=DOCS, parts=3):
        width = len(schema.split(","))
        rows = [tuple(r) + (None,) * (width - len(r)) for r in rows]
        return spark.createDataFrame(rows, schema).repartition(parts)

    return build
