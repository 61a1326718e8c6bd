import pytest

from hearthlake.session import Staging


@pytest.fixture
def staging(spark):
    with Staging(spark) as own:
        yield own


@pytest.fixture
def docs(spark):
    """rows of (doc_id, text[, source]) -> documents, with columns whose names could clash."""

    def make(rows, **more):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "s", *more.values()) for r in rows]
        schema = "doc_id bigint, text string, source string" + "".join(f", {k} string" for k in more)
        return spark.createDataFrame(full, schema)

    return make


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns or df.columns) for r in df.collect()), key=repr)
