"""Shared by these tests: documents with odd rows and clashing extra columns."""

import pytest

SF001 = "/root/testdata/sf0.001"
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def make_docs(spark):
    """Documents from (id, text) or (id, text, source) tuples, with clashing extra columns."""

    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None, "x", 1) for r in rows]
        return spark.createDataFrame(
            full, DOC_SCHEMA + ", t string, id int"
        )

    return make
