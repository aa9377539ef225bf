from __future__ import annotations

import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from cellsmith.session import local_session  # noqa: E402
from cellsmith.spec import parse_model  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    yield local_session(cpus="*", shuffle_partitions=8, app="cellsmith-tests",
                        shared=tempfile.mkdtemp(prefix="cellsmith-shared-"))


def pages_df(spark, rows):
    """rows: (source_key, page_model, data, propertys, download_time)."""
    return spark.createDataFrame(
        [(r[0], r[1], r[2], r[3] if len(r) > 3 else None, r[4] if len(r) > 4 else 1528156800000, None)
         for r in rows],
        "source_key string, page_model string, data string, propertys string, "
        "download_time bigint, request_url string")


def detail_model(columns, rowkey=("id",), name="m"):
    return parse_model(name, {"rowkeyColumns": list(rowkey), "columns": columns})


def list_model(columns, name="m", path="foods", regex=None, rowkey=("id",), **extra):
    obj = {"dataPath": path, "columns": columns, **extra}
    if regex:
        obj["rowKeyRegex"] = regex
    else:
        obj["rowkeyColumns"] = list(rowkey)
    return parse_model(name, obj)
