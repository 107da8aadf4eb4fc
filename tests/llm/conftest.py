import pytest

# Names that the operators use inside; documents may have columns of these names too.
CLASHING = {
    "row": 1, "key": "k", "class": "c", "label": 7, "n": 3, "doc": "d", "lines": "l", "digest": "x", "kind": "email",
    "start": 5, "end": 6, "hit": "h", "document": "y", "dropped": "z", "ids": "i", "score": 0.5, "spans": "s", "order": 2,
}


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) pairs, with clashing columns."""

    def make(pairs, clashing=True):
        extra = CLASHING if clashing else {}
        types = ", ".join(f"`{c}` {'string' if isinstance(v, str) else 'double' if isinstance(v, float) else 'long'}" for c, v in extra.items())
        schema = "doc_id long, text string" + (", " + types if types else "")
        return spark.createDataFrame([(i, t, *extra.values()) for i, t in pairs], schema)

    return make
