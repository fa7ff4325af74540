import json
import os
import sys
from datetime import datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from logledger.session import local_session  # noqa: E402
from logledger.sources.landing import Landing  # noqa: E402
from logledger.sources.warehouse import Warehouse  # noqa: E402

NOW = datetime(2026, 1, 28, 12)


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "tests", "4g")
    # Tiny inputs: compiling code takes longer than running without. The query tests and
    # the plan tests turn it back on.
    session.conf.set("spark.sql.codegen.wholeStage", "false")
    session.conf.set("spark.sql.codegen.factoryMode", "NO_CODEGEN")
    session.conf.set("spark.sql.shuffle.partitions", "3")
    yield session
    session.stop()


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, f"file:{tmp_path}/tables").create()


def record(number=1, **changes):
    """One raw line as its writer would send it."""
    fields = {
        "UserName": f"{10000 + number}",
        "CustId": 10000 + number,
        "PartnerName": None,
        "EventDt": f"2026-01-28T10:{number % 60:02d}:00.000Z",
        "Action": "Store",
        "Filename": f"/uploads/{number}.txt",
        "SessionId": f"s-{number}",
        "IpAddress": "10.0.0.1",
        "Source": "LOG-TEST",
        "Bytes": 1024 * number,
        "StatusCode": 226,
        "ServerResponse": "done",
        "RawData": f"STOR /uploads/{number}.txt",
        "HashCode": -number,
    } | changes
    return json.dumps({k: v for k, v in fields.items() if v is not ...})


class Folder:
    """A folder raw files arrive in."""

    def __init__(self, path):
        self.path = path / "logs"
        self.path.mkdir(parents=True)
        self.landing = Landing((f"file:{path}",))

    def put(self, name, lines, end="\n"):
        (self.path / name).write_text(end.join(lines) + end, newline="")
        return f"file:{self.path / name}"


@pytest.fixture
def folder(tmp_path):
    return Folder(tmp_path / "landing")


def name(number, source="LOG-TEST", stamp="20260128-103000"):
    return f"{source}-{stamp}0001-{number}.json"


def lines_frame(spark, texts, uri="gs://bucket/logs/LOG-TEST-20260128-1030000001-a.json"):
    return spark.createDataFrame([(uri, t) for t in texts], "gcs_uri string, data string")


def rows(frame, *columns):
    return sorted(
        (tuple(r) for r in (frame.select(*columns) if columns else frame).collect()), key=repr
    )
