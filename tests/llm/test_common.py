"""Shared folders: never one machine's own, and freed when asked."""

import os

import pytest

from skerry.llm import common


class Unset:
    """A cluster's session without a shared folder."""

    class conf:
        @staticmethod
        def get(name, default=None):
            return default

    class sparkContext:
        master = "spark://host:7077"

        @staticmethod
        def getCheckpointDir():
            return None


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        common.shared_dir(Unset)


def test_released_tables_go(spark):
    kept = common.Scratch(spark, "kept")
    with common.released():
        inner = common.Scratch(spark, "inner")
        out = kept.put(inner.put(spark.range(5)))
        assert os.path.isdir(inner.root.removeprefix("file://"))
    assert not os.path.isdir(inner.root.removeprefix("file://")) and out.count() == 5
    kept.drop(out)
    assert not os.path.isdir(out._skerry_path.removeprefix("file://"))
    assert spark.conf.get(common.SHUFFLE_CLEANUP, "false") == "false"
