import os
import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pagequarry.session import local_session, ship_package  # noqa: E402

TESTDATA = Path(os.environ.get("TESTDATA", "/root/testdata"))


@pytest.fixture(scope="session")
def spark():
    home = tempfile.mkdtemp(prefix="pagequarry-tests-")
    session = local_session(
        4,
        partitions=4,
        **{
            "spark.checkpoint.dir": f"{home}/checkpoints",
            "spark.sql.warehouse.dir": f"{home}/warehouse",
        },
    )
    ship_package(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def testdata():
    folder = TESTDATA / "sf0.001"
    if not folder.exists():
        pytest.skip("no test tables here")
    return str(folder)


@pytest.fixture
def name():
    import uuid

    return f"t_{uuid.uuid4().hex}"


def plan(df, mode="formatted"):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)
