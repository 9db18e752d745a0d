import pytest
from cases import SCHEMA, edge_texts


@pytest.fixture(scope="session")
def edge_rows():
    texts = edge_texts()
    langs, sources = ["en", "de", None], ["s0", "s0", "s1", None]
    rows = [(i, t, langs[i % 3], sources[i % 4], len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[8], rows[8], rows[0]]  # repeated rows
    rows.append((None, "a text without an id", "en", "s0", 20))
    return rows


@pytest.fixture(scope="session")
def edge(spark, edge_rows):
    """Edge cases, with further columns whose names clash with working columns."""
    extra = ("x",) * 11
    return spark.createDataFrame([r + extra for r in edge_rows], SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
