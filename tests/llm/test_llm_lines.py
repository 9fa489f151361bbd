import hashlib
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from tidemark.llm import lines

SPACE = " \t\n\x0b\f\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def expected(rows, min_docs=2):
    held = defaultdict(set)
    for doc, text, *_ in rows:
        for line in (text or "").split("\n"):
            held[line.strip(SPACE).translate(LOWER)].add(doc)
    out = []
    for doc, text, *_ in rows:
        cut = (text or "").split("\n")
        keep = []
        for line in cut:
            key = line.strip(SPACE).translate(LOWER)
            docs = held[key]
            first = min((d for d in docs if d is not None), default=None)
            if not (len(key) >= 10 and len(docs) >= min_docs and doc != first):
                keep.append(line)
        out.append((doc, len(cut), len(cut) - len(keep), "\n".join(keep)))
    return sorted(out, key=str)


@pytest.mark.parametrize("min_docs", [2, 3])
def test_edges_equal_brute_force(docs_of, edge_rows, min_docs):
    rows = edge_rows + [(None, "Shared passage of text", "en", "s9"), (40, "only null and 40", "en", "s1"),
                        (None, "only null and 40", "en", "s1")]
    df = lines.dedup_lines(docs_of(rows), min_docs=min_docs)
    got = sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in df.collect()), key=str)
    assert got == expected(rows, min_docs)
    assert set(docs_of(rows).columns) <= set(df.columns)


def test_empty_table(docs_of):
    assert lines.dedup_lines(docs_of([])).count() == 0


def test_hot_line(docs_of):
    rows = [(i, f"a very common line\nown line number {i}", "en", "s") for i in range(300)]
    got = {r.doc_id: r.text for r in lines.dedup_lines(docs_of(rows)).collect()}
    assert got[0] == "a very common line\nown line number 0"
    assert all(got[i] == f"own line number {i}" for i in range(1, 300))


def test_query_equals_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    df = lines.op3_line_dedup(spark, sf)
    assert sorted(map(tuple, df.select("doc_id", "n_lines", "n_dropped", "kept_sha256").collect())) == sorted(
        con.execute(lines.ORACLE).fetchall())


def test_digest_is_of_the_text(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    text = lines.dedup_lines(docs).where("doc_id = 0").select(F.col("text")).first()[0]
    digest = lines.op3_line_dedup(spark, sf).where("doc_id = 0").first()["kept_sha256"]
    assert digest == hashlib.sha256(text.encode()).hexdigest()
