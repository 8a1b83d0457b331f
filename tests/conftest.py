import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from actuaria.session import build_session

    scratch = tempfile.mkdtemp(prefix="actuaria-tests-")
    session = build_session(
        "local[4]",
        app_name="actuaria-tests",
        shuffle_partitions=4,
        # spark.checkpoint.dir comes from the session (spark-defaults) when configured;
        # build_session only supplies a temporary folder where it is unset
        extra={
            "spark.sql.warehouse.dir": os.path.join(scratch, "warehouse"),
            "spark.driver.extraJavaOptions": f"-Dderby.system.home={scratch}",
        },
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_small():
    return SF_SMALL
