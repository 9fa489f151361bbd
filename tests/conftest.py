from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark import config as C  # noqa: E402
from tidemark.session import local_session  # noqa: E402
from tidemark.sources.lake import Lake  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        4, memory="4g",
        **{"spark.sql.shuffle.partitions": "4",
           "spark.checkpoint.dir": str(tmp_path_factory.mktemp("scratch"))},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


LOADED = "2024-01-01T00:00:00+00:00"


@pytest.fixture
def bronze_rows(spark):
    """Bronze rows from dicts; missing columns are NULL, lineage has defaults."""

    def make(table: str, *rows: dict):
        columns = (*C.BRONZE_COLUMNS[table], *C.LINEAGE)
        defaults = {"_ingested_at": LOADED, "_source_file": "f.csv", "_batch_id": "b"}
        values = [tuple({**defaults, **row}.get(c) for c in columns) for row in rows]
        return spark.createDataFrame(values, ", ".join(f"{c} string" for c in columns))

    return make
