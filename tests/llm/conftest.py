import pytest

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs(spark):
    """Builds a documents table, with a clashing extra column, from (doc_id, text[, lang[, source]]) rows."""
    def build(rows):
        rows = [(*r, *[None] * (4 - len(r))) for r in rows]
        return spark.createDataFrame([(r[0], r[1], r[2], r[3], len(r[1] or ""), 7) for r in rows],
                                     "doc_id long, text string, lang string, source string, n_chars long, start int")
    return build
