import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from newsweft.session import get_session, ship

    s = get_session("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g", "spark.ui.showConsoleProgress": "false",
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")), "spark.checkpoint.dir": f"file://{tmp_path_factory.mktemp('shared')}",
    })
    s.sparkContext.setLogLevel("ERROR")
    return ship(s)


SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf_dir():
    return SF
