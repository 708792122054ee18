import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def make_docs(spark):
    """Documents with optional extra columns whose names clash with results and helpers."""
    def make(rows, clash=()):
        data = [(i, t, "en", s, None if t is None else len(t)) + (7,) * len(clash) for i, t, s in
                (r if len(r) == 3 else (*r, "a") for r in rows)]
        return spark.createDataFrame(data, SCHEMA + "".join(f", `{c}` int" for c in clash))
    return make
