import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tests.session import LARGE, build  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return build()


@pytest.fixture(params=["small", "large"])
def planned(request, spark):
    """Run a test under compact plans and under the plans for large inputs."""
    before = {k: spark.conf.get(k, None) for k in LARGE}
    if request.param == "large":
        for key, value in LARGE.items():
            spark.conf.set(key, value)
    yield request.param
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)
