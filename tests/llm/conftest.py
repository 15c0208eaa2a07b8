import tempfile

import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table from (doc_id, text) or longer rows, with columns whose names clash."""

    def make(rows, extra=True):
        full = [tuple(r) + (None,) * (4 - len(r)) for r in rows]
        df = spark.createDataFrame(full, "doc_id long, text string, lang string, source string")
        if extra:
            for name in ("key", "size", "row", "leaf", "block", "cls", "shard", "n", "pieces"):
                df = df.selectExpr("*", f"'x' as {name}")
        return df

    return make


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="encore-test-")
