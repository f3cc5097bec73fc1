import pytest
from pyspark.sql import functions as F


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    from marginalia.llm.common import ship_package

    ship_package(spark)


@pytest.fixture
def docs_of(spark):
    """A documents-like table from (doc_id, text) rows, with columns whose names clash with the operators' own."""
    def make(rows):
        df = spark.createDataFrame(rows, "doc_id long, text string")
        for name in ("fp", "n", "key", "node", "doc", "v", "length", "part", "class", "item", "score", "label"):
            df = df.withColumn(name, F.lit("x"))
        return df

    return make
