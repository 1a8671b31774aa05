import uuid

import pytest

from lake_ingest.session import build_session

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests",
        {
            "spark.sql.shuffle.partitions": "4",
            "spark.sql.warehouse.dir": str(base / "warehouse"),
            "spark.driver.memory": "4g",
            "spark.ui.showConsoleProgress": "false",
        },
        master="local[4]",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def table_name():
    return f"t_{uuid.uuid4().hex}"


@pytest.fixture
def put(tmp_path):
    """Write a file below an incoming folder, and return the folder."""

    def write(key, content):
        path = tmp_path / "incoming" / key
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(content if isinstance(content, bytes) else content.encode())
        return str(tmp_path / "incoming")

    return write


def rows(df, *columns):
    """Rows as sorted tuples."""
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)
