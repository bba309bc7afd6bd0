import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from starling.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("checkpoints"))
    session = get_session(
        **{"spark.checkpoint.dir": folder, "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse"))}
    )
    yield session
    session.stop()
