import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from larkspur.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    os.environ.setdefault("SPARK_LOCAL_IP", "127.0.0.1")
    s = local_session("*", 8, **{"spark.checkpoint.dir": tmp_path_factory.mktemp("shared").as_uri(), "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse"))})
    yield s
    s.stop()
