import pytest
from pyspark.sql import types as T

from windrisk.llm.common import ship_code

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # Names that the operators use themselves.
    T.StructField("id", T.StringType()), T.StructField("row", T.StringType()), T.StructField("kept", T.StringType()),
    T.StructField("score", T.StringType()), T.StructField("node", T.StringType()), T.StructField("size", T.StringType())])


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text[, lang[, source]]) with extra columns whose names clash with the operators' own."""
    ship_code(spark)

    def make(rows, parts=3):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", None, "x", "x", "x", "x", "x", "x") for r in rows]
        return spark.createDataFrame(full, DOCUMENTS).repartition(parts)

    return make


WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(50)) for _ in range(n))


#: NULLs, empty and blank texts, ties, repeated rows, a long text.
EDGES = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (4, "one"), (None, "one"), (None, None), (5, "One"), (6, "word " * 30_000), (7, "a b c d e f")]
