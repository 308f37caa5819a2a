import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")

DATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    from quillwork.session import build_session

    session = build_session("tests", "local[4]", spark_sql_shuffle_partitions="4", spark_driver_memory="6g", spark_default_parallelism="4")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return f"{DATA}/sf0.001"
