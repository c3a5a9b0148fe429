import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from mlspark.session import build_session


@pytest.fixture(scope="session")
def spark():
    # partitions stay apart, so that keys which only look equal cannot meet by luck in a merged one
    return build_session(
        8, "tests", spark__sql__shuffle__partitions="4", spark__sql__adaptive__coalescePartitions__enabled="false"
    )


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
