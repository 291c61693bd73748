import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from noticeloom.session import build_session  # noqa: E402

SPAN = "array<struct<start:int,end:int,label:string>>"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[4]",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g", "spark.ui.showConsoleProgress": "false"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture(scope="session")
def docs(spark):
    """Builder of annotated documents from (id, text, [(start, end, label)])."""

    def build(rows):
        return spark.createDataFrame(rows, f"id int, text string, label {SPAN}")

    return build


def tuples(rows):
    return sorted(tuple(r) for r in rows)
