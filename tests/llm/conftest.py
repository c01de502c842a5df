import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parent)]


@pytest.fixture
def spark(session):
    """Results do not depend on ANSI mode; the default is on."""
    session.conf.set("spark.sql.ansi.enabled", "true")
    return session
