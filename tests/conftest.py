import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from daybook.session import local_session

    # Tiny inputs in many different plans: generating code for each would take most of the time. The comparison
    # with SQL in test_queries.py runs with it.
    session = local_session("8", "daybook-tests", spark__sql__shuffle__partitions="2")
    session.conf.set("spark.sql.codegen.wholeStage", "false")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
