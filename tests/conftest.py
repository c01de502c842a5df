import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from farelake.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def session(tmp_path_factory):
    spark = local_session(
        4,
        **{
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.checkpoint.dir": f"file://{tmp_path_factory.mktemp('checkpoints')}",
            "spark.farelake.scratch": str(tmp_path_factory.mktemp("scratch")),
        },
    )
    yield spark
    spark.stop()


@pytest.fixture(params=["true", "false"], ids=["ansi", "no-ansi"])
def spark(session, request):
    """The session, once with ANSI mode and once without; results must agree."""
    session.conf.set("spark.sql.ansi.enabled", request.param)
    return session


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    before = {}

    def set_option(name, value):
        before.setdefault(name, spark.conf.get(name, None))
        spark.conf.set(name, value)

    yield set_option
    for name, value in before.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)
