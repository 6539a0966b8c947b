from __future__ import annotations

import json
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from prflow import schemas  # noqa: E402
from prflow.session import local_session  # noqa: E402

TESTDATA = os.environ.get("PRFLOW_TESTDATA", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session("prflow-tests", 4)
    session.conf.set("spark.sql.shuffle.partitions", "4")
    session.conf.set("spark.sql.maxMetadataStringLength", "1000")
    yield session
    session.stop()


@pytest.fixture
def page_frame(spark):
    """Pages of one shape from plain dictionaries."""

    def make(shape, *lines):
        rows = spark.createDataFrame([(json.dumps(line),) for line in lines], "value string")
        from prflow.sources.pages import parse_pages

        return parse_pages(rows, shape).select(*schemas.page_schema(shape).names)

    return make


def page(request_id, data, page_no=0, owner="own", name="repo", **more):
    return {
        "owner": owner, "name": name, "request_id": request_id, "page_no": page_no,
        "body": {"data": data, **more},
    }


def connection(path, edges, **more):
    data = {"edges": edges, **more}
    for part in reversed(path.split(".")):
        data = {part: data}
    return data


def edge(cursor, node):
    return {"cursor": cursor, "node": node}


def write_lines(folder, shape, lines):
    target = os.path.join(folder, shape)
    os.makedirs(target, exist_ok=True)
    name = os.path.join(target, f"part-{len(os.listdir(target)):04d}.json")
    with open(name, "w") as out:
        for line in lines:
            out.write((line if isinstance(line, str) else json.dumps({"shape": shape, **line})) + "\n")
