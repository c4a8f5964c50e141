import sys
from functools import lru_cache
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from foliospark.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, shuffle_partitions=4, memory="6g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def derived_once():
    """Derived tables per data folder, built once for the whole test run."""
    import catalog.registry as registry

    original = registry.derived
    registry.derived = lru_cache(maxsize=None)(original)
    yield registry.derived
    registry.derived = original
