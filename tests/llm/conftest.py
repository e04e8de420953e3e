import pytest


@pytest.fixture
def docs(spark):
    """Documents with the columns of the table, from (doc_id, text) or (doc_id, text, lang, source)."""

    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long")

    return make
