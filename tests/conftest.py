import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from idloom.session import build_session
    s = build_session("local[8]", 8, app="tests", spark__ui__enabled="false", spark__driver__memory="8g",
                      spark__ui__showConsoleProgress="false")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def hot(spark):
    """Every key of more than two rows counts as hot, so the paths for skew are taken."""
    spark.conf.set("idloom.skew.hotRows", "2")
    yield
    spark.conf.unset("idloom.skew.hotRows")
