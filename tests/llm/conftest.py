import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text) pairs, over several partitions."""
    return lambda rows, parts=3: spark.createDataFrame(
        [(i, t, "en", "src0", None if t is None else len(t)) for i, t in rows], DOCS
    ).repartition(parts)


@pytest.fixture(scope="session")
def given(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
