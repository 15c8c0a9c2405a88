import pytest

#: Columns of the driver's documents table.
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """Builds a documents table from (doc_id, text) or (doc_id, text, source)."""

    def build(rows, partitions=3):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "a", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOCUMENTS).repartition(partitions)

    return build
