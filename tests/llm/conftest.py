import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))

from gridclear.session import ship_package


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship_package(spark)
