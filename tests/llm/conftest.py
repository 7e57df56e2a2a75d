import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Documents given as (doc_id, text[, source])."""
    def build(rows):
        full = [(i, t, "en", (rest or ["src0"])[0], len(t) if t is not None else None) for i, t, *rest in rows]
        return spark.createDataFrame(full, DOCUMENTS)
    return build
