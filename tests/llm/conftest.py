import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH", "")]))
sys.path.insert(0, ROOT)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, spans string, row string, key long"


@pytest.fixture(scope="session")
def frame(spark):
    """Rows (id, text) as a table with the columns of documents and some clashing names."""

    def make(rows, lang="en"):
        return spark.createDataFrame([(d, t, lang, None, None if t is None else len(t), 0.5, "x", "y", 1) for d, t in rows], SCHEMA)

    return make


@pytest.fixture(scope="session")
def awkward():
    """Nulls, empty and blank texts, ties, repeated rows, long words and one very long text."""
    base = " ".join(f"word{i % 97} and then" for i in range(120))
    long = " ".join(f"tok{(i * i) % 1013}" for i in range(30_000))
    return [(1, base), (2, base), (2, base), (3, base.replace("word5 ", "other ")), (4, None), (5, ""), (6, " \t\n"),
            (None, base), (None, None), (7, "x"), (8, "é" * 5000), (9, long), (10, "Ünïcode 中文 текст " * 40),
            (11, "one line\nwith words\n" * 30), (12, "\x00 nul 🙂 " * 30), (13, base + " " + base)]
