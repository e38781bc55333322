import pytest

DDL = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def documents(spark):
    """``documents`` with these ids and texts."""
    def build(rows, ddl=DDL):
        return spark.createDataFrame([(i, t, "en", None, len(t or "")) for i, t in rows], ddl)
    return build


@pytest.fixture(scope="session")
def sample(spark, sf_dir):
    """The smallest ``documents`` table and its (id, text) rows."""
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return df, [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


@pytest.fixture()
def narrow(spark):
    """Small files parts, so that one table has many tasks."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    yield spark
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
