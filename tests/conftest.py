import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from stipend.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = {"spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse"))}
    session = local_session("8", shuffle_partitions=8, conf=warehouse)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def shared(tmp_path, monkeypatch):
    """The shared folder of this test alone."""
    folder = tmp_path / "shared"
    monkeypatch.setattr("stipend.shared.shared_folder", lambda _: str(folder))
    return folder
