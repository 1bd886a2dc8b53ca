import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from yardline.session import clean_up, local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session("8", 8, "6g")
    session.sparkContext.setLogLevel("ERROR")
    folder = tmp_path_factory.mktemp("checkpoints")
    session.sparkContext.setCheckpointDir(str(folder))
    yield session
    clean_up()
    left = [p for p in folder.rglob("*.parquet")]
    session.stop()
    assert not left, f"intermediate tables are left: {left[:3]}"
