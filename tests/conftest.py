import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from creditlake.session import build_session
    s = build_session("tests", "local[8]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false",
                      spark__ui__showConsoleProgress="false", spark__driver__memory="8g",
                      spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")))
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def tables(spark):
    from creditlake.fixtures import Tables
    return Tables(spark, SF)
