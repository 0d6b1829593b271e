import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # columns whose names an operator may use itself
    T.StructField("score", T.StringType()), T.StructField("node", T.StringType()), T.StructField("id", T.LongType()),
    T.StructField("key", T.StringType()), T.StructField("pos", T.LongType()), T.StructField("size", T.LongType()),
])


@pytest.fixture(scope="session")
def documents(spark):
    """A documents table from ``(doc_id, text[, lang[, source]])``, with columns of clashing names."""
    def make(rows):
        rows = [(*r, *[None] * (4 - len(r))) for r in rows]
        return spark.createDataFrame([(*r, len(r[1] or ""), "x", "x", 1, "x", 1, 1) for r in rows], DOCUMENTS).repartition(3)

    return make


@pytest.fixture(scope="session")
def prose():
    """Seeded sentences of invented words."""
    import random

    def make(seed, n, letters="etaoinshrdlu"):
        draw = random.Random(seed)
        return " ".join("".join(draw.choice(letters) for _ in range(draw.randint(2, 7))) for _ in range(n))

    return make
