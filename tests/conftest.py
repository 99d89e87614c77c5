import sys
import uuid
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from sedimenta.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = local_session(
        4, "sedimenta-tests", "4g",
        **{"spark.sql.warehouse.dir": str(base / "warehouse"), "spark.checkpoint.dir": str(base / "checkpoint"),
           "spark.sql.shuffle.partitions": "2"},
    )
    yield session
    session.stop()


@pytest.fixture
def name():
    """A table name no other test uses."""
    return f"t_{uuid.uuid4().hex[:10]}"


@pytest.fixture
def rows():
    """Result of a small frame as a sorted list of tuples."""

    def collect(df, *columns):
        return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)

    return collect
