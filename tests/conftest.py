import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from newsflow.session import local_session

    session = local_session(cores=4, partitions=4, memory="4g", **{"spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoint"))})
    yield session
    session.stop()
