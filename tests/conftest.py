import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from paths import SMALL  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    from varigrove import session

    s = session.build(
        "local[8]", "tests", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__driver__memory="8g"
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def inputs(spark):
    from varigrove.plans.inputs import Inputs

    return Inputs(spark, SMALL)


@pytest.fixture(scope="session")
def con():
    import compare

    return compare.connect(SMALL)
