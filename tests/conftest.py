import sys
from datetime import date, datetime
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from asthen.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    # The zone is not UTC on purpose: results must not depend on it.
    session = get_session("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4",
        "spark.sql.session.timeZone": "America/New_York",
        "spark.driver.memory": "6g",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        "spark.ui.showConsoleProgress": "false",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def ts(text):
    """'2024-01-01 10:00' or '2024-01-01' as a datetime; None stays None."""
    return None if text is None else datetime.fromisoformat(text)


def day(text):
    return None if text is None else date.fromisoformat(text)


def rows(df, *columns):
    """All rows as sorted tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: tuple((v is not None, str(v)) for v in r))
