from __future__ import annotations

import random

import pytest

SF = "/root/testdata/sf0.001"
# names that the operators use inside
CLASHING = ("row", "size", "key", "component", "part", "shard", "n", "rejected", "a", "b", "kept", "rule")


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture
def docs_of(spark):
    """documents from (doc_id, text, lang, source), with further columns of clashing names."""

    def make(rows):
        schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
            f"{c} string" for c in CLASHING)
        full = [(*r, None if r[1] is None else len(r[1]), *("x" for _ in CLASHING)) for r in rows]
        return spark.createDataFrame(full, schema)

    return make


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls, empty and very long texts, repeated rows, near copies, odd white space."""
    rng = random.Random(7)
    vocabulary = [f"w{i}é" if i % 7 == 0 else f"Word{i}" for i in range(400)]

    def prose(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    long = "\n".join(prose(40) for _ in range(600))
    base = prose(120)
    near = base.replace(base.split()[60], "Other", 1)
    rows = [
        (1, None, "en", "s1"), (2, "", "en", "s1"), (3, " \t\r\n\x0b\x0c ", "de", None), (4, "one", None, "s2"),
        (5, "two words", "en", "s2"), (6, base, "en", "s1"), (7, near, "en", "s3"), (8, base, "de", "s3"),
        (8, base, "de", "s3"), (9, long, "fr", "s1"), (10, long + "\nend", "fr", None),
        (None, prose(80), "en", "s1"), (None, None, None, None), (11, prose(70) + "\n\n" + prose(70), "de", "s2"),
        (12, "Shared passage of text\n" + prose(60), "en", "s2"), (13, prose(60) + "\n  SHARED passage of text\t", "es", "s2"),
        (14, "no break space \U0001f600 日本語 \u0085x", "ja", "s4"), (15, "x" * 5000, "en", "s4"),
        (16, "1234 5678 --- !!!", "en", "s4"),
    ]
    rows += [(100 + i, prose(rng.randint(55, 90)), rng.choice(["en", "de"]), rng.choice(["s1", "s2"])) for i in range(20)]
    return rows
