import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    def make(rows, schema=DOC):
        """rows: (doc_id, text) or whole rows."""
        full = [(r[0], r[1], "en", "s", len(r[1]) if r[1] is not None else None) if len(r) == 2 else r for r in rows]
        return spark.createDataFrame(full, schema)

    return make
