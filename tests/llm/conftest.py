import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns whose names the operators use themselves.
CLASHING = ("id", "key", "kept", "spans", "n_words", "component_id", "removed", "bands", "blob", "h", "n")


@pytest.fixture(scope="session")
def make_docs(spark):
    """A table of documents from texts or (doc_id, text) pairs."""

    def make(rows, clashing=False):
        pairs = [r if isinstance(r, tuple) else (k, r) for k, r in enumerate(rows)]
        df = spark.createDataFrame([(i, t, "en", "web", len(t) if t is not None else None) for i, t in pairs], DOCS)
        if clashing:
            for name in CLASHING:
                df = df.selectExpr("*", f"'x' AS `{name}`")
        return df

    return make
