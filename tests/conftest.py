import os
import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).parent), str(Path(__file__).parent.parent)]

from trialmart.session import local_session  # noqa: E402

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, memory="4g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return FOLDER


@pytest.fixture
def raw_rows(spark):
    """Build a raw trial frame from dicts; columns left out are NULL, rows are valid."""
    from trialmart.schemas import RAW, RAW_COLUMNS

    def build(*rows):
        names = [*RAW_COLUMNS, "validation_status"]
        schema = "struct<" + ",".join(f"{n}:{RAW[n].dataType.simpleString()}" for n in names) + ">"
        filled = [tuple({"validation_status": "valid", **row}.get(n) for n in names) for row in rows]
        return spark.createDataFrame(filled, schema[len("struct<") : -1].replace(":", " "))

    return build
