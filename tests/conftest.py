import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from cutlight.session import session

    s = session("local[4]", 4, **{"spark.checkpoint.dir": tempfile.mkdtemp(prefix="spark-", dir="/tmp"), "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="spark-", dir="/tmp")})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
