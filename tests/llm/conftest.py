import pytest
from llm.textkit import DOCS, PROSE


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text) pairs, with the other columns filled in."""
    def build(pairs):
        rows = [(i, t, "en", "src0", len(t or "")) for i, t in pairs]
        return spark.createDataFrame(rows, DOCS)
    return build


@pytest.fixture(scope="session")
def awkward():
    """Null ids and texts, empty, blank, short, very long, odd and repeated texts."""
    long_text = " ".join(f"word{i % 7919} of" for i in range(40_000))
    return [(1, None), (None, PROSE), (2, ""), (3, " \n\t "), (4, "one"), (5, PROSE * 3), (5, PROSE * 3), (6, PROSE * 3),
            (7, long_text), (8, "\u00e9t\u00e9 \u65e5\u672c\u8a9e \U0001f600 ### $$$"), (9, "x" * 30_000), (10, "a b\x0bc\u00a0d\x1ce")]


@pytest.fixture(scope="session")
def clashing(docs_of):
    """Documents with columns named like the operators' own results."""
    def build(pairs):
        from pyspark.sql import functions as F
        names = ("kept", "n_words", "component_id", "node", "key", "score", "ids", "root", "n", "cell", "fold", "label")
        return docs_of(pairs).select("*", *[F.lit(f"mine {c}").alias(c) for c in names])
    return build
