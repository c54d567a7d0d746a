import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from compare import session as make_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def caller():
    spark = make_session()
    spark.conf.set("spark.tidemark.state.partitions", "2")
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    return spark


@pytest.fixture(scope="session")
def spark(caller):
    from tidemark.session import derive
    return derive(caller)


@pytest.fixture
def root(caller, request):
    from tidemark.session import workspace
    return workspace(caller, request.node.name.split("[")[0])
