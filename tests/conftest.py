import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from strata.session import configure, local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    home = tmp_path_factory.mktemp("spark")
    session = local_session(4, "tests", **{
        "spark.sql.warehouse.dir": str(home / "warehouse"),
        "spark.checkpoint.dir": str(home / "checkpoints"),
    })
    yield session
    session.stop()


@pytest.fixture
def path(tmp_path):
    return lambda name: str(tmp_path / name)


@pytest.fixture(autouse=True)
def sized_for_no_input(request):
    """A query sizes its session's shuffles and scans; the next test finds what the session was
    given."""
    yield
    if "spark" in request.fixturenames:
        configure(request.getfixturevalue("spark"))
