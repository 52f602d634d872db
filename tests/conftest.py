import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from gleanery.session import local_session

    session = local_session("tests", cores=8, memory="6g")
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def setting(spark):
    """Change a session setting for one test."""
    old = {}

    def change(key, value):
        old.setdefault(key, spark.conf.get(key, None))
        spark.conf.set(key, value)

    yield change
    for key, value in old.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)
