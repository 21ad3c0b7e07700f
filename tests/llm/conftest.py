import pytest
from cases import EDGES, FOLDER
from pyspark.sql import types as T

# Names that operators use inside, as columns of the input.
CLASHING = ["row", "key", "doc", "n", "id", "size", "copy", "g", "x", "text_b", "page", "score", "counts", "target", "pid"]
SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
    + [T.StructField(c, T.StringType()) for c in CLASHING]
)


@pytest.fixture(scope="session")
def make(spark):
    """Documents from ``(doc_id, text[, lang, source])``, with columns that clash with working names."""

    def build(rows):
        whole = []
        for doc_id, text, *rest in rows:
            lang, source = (*rest, None, None)[:2] if rest else ("en", "a")
            whole.append((doc_id, text, lang, source, None if text is None else len(text), *CLASHING))
        return spark.createDataFrame(whole, SCHEMA)

    return build


@pytest.fixture(scope="session")
def edges(make):
    return make(EDGES)


@pytest.fixture(scope="session")
def nothing(make):
    return make([])


@pytest.fixture(scope="session")
def documents(spark):
    """The smallest test table, as Python rows by id."""
    return {r["doc_id"]: r for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}


@pytest.fixture
def low_limits(spark):
    """Nothing is broadcast, and joins with more than a few rows of a key are salted."""
    for name in ("broadcastRows", "blockRows"):
        spark.conf.set(f"spark.hardwood.{name}", "5")
    yield
    for name in ("broadcastRows", "blockRows"):
        spark.conf.unset(f"spark.hardwood.{name}")
