import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ["PYTHONPATH"] = os.pathsep.join([sys.path[0], os.environ.get("PYTHONPATH", "")])


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tidebar.session import local_session

    session = local_session("4", 4, "4g", "tests", str(tmp_path_factory.mktemp("shared")))
    session.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    yield session
    session.stop()
