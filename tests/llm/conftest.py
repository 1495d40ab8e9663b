import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    def make(rows):
        """Documents from (doc_id, text[, lang[, source]]) tuples."""
        full = [(r[0], r[1], *(list(r[2:]) + ["en", "s0"][len(r) - 2:]), len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOC_SCHEMA)

    return make
