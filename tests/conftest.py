import pytest

from tidemark.session import get_spark


@pytest.fixture(scope="session")
def spark():
    s = get_spark(4, 4, spark__sql__files__maxPartitionBytes="1m")
    s.sparkContext.setLogLevel("ERROR")
    return s
