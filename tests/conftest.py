import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent.parent))

from octoseg.runtime import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return session("tests", 4, spark__sql__shuffle__partitions="4", spark__driver__memory="4g")
