import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")
DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from helmwake.session import build_session

    s = build_session(
        "tests",
        "local[4]",
        **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "3g", "spark.ui.showConsoleProgress": "false", "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("wh")), "spark.checkpoint.dir": str(tmp_path_factory.mktemp("cp"))},
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def data():
    return DATA


CLASH = ["t", "p", "v", "m", "w", "k", "n", "id", "kind", "value", "field", "dim", "block", "h", "u", "state", "day", "period", "layer", "ids", "copies", "first_frame", "ref_key", "key", "ord", "data", "size", "profile"]


@pytest.fixture(scope="session")
def clashing():
    """Adds columns whose names the operators use inside."""
    from pyspark.sql import functions as F

    def add(df):
        for c in CLASH:
            if c not in df.columns:
                df = df.withColumn(c, F.lit("clash"))
        return df

    return add
