from types import SimpleNamespace

import pytest

from farelake.session import SCRATCH, scratch_path


def fake(**conf):
    return SimpleNamespace(conf=SimpleNamespace(get=lambda name, default: conf.get(name, default)))


def test_scratch_is_below_the_folder_the_session_names():
    spark = fake(**{SCRATCH: "s3a://shared/"})
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first.startswith("s3a://shared/x-") and first != second


def test_there_is_no_folder_by_default():
    with pytest.raises(RuntimeError, match=SCRATCH):
        scratch_path(fake(), "x")
