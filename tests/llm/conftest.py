import pytest

from reefgrid.llm.common import ready

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """A documents table from (doc_id, text[, source]) rows; the other columns hold nulls."""
    ready(spark)

    def make(rows, extra=""):
        full = [(r[0], r[1], None, r[2] if len(r) > 2 else None, None) + (("x",) * len(extra.split(",")) if extra else ()) for r in rows]
        return spark.createDataFrame(full, DOCUMENTS + (", " + ", ".join(f"{c} string" for c in extra.split(",")) if extra else ""))
    return make
