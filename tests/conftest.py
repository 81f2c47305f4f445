from __future__ import annotations

import sys
from datetime import date
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SAMPLE = "/root/testdata/sf0.001"
SAMPLE_LARGER = "/root/testdata/sf0.01"
AS_OF = date(2001, 8, 2)


@pytest.fixture(scope="session")
def spark():
    from patronage.session import build_session

    session = build_session(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="4g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def warehouse(spark):
    from patronage.registry.warehouse import Warehouse

    return Warehouse.of(spark, SAMPLE_LARGER)
