"""The shared folder and scratch output."""

import os
from types import SimpleNamespace

import pytest

from panes import session


def test_a_cluster_must_name_the_shared_folder():
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]", "k8s://x"):
        fake = SimpleNamespace(sparkContext=SimpleNamespace(getCheckpointDir=lambda: None, master=master),
                               conf=SimpleNamespace(get=lambda *a: None))
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            session.ensure_checkpoint_dir(fake)


def test_scratch_output_is_removed(spark):
    path = session.scratch_path(spark, "gone-test")
    other = session.scratch_path(spark, "stays-test")
    for p in (path, other):
        spark.range(3).write.parquet(p)
    local = lambda p: p.removeprefix("file:")
    assert os.path.isdir(local(path))
    session.clear_scratch("gone-test")
    assert not os.path.exists(local(path)) and os.path.isdir(local(other))
    session.clear_scratch("stays-test")
    assert not os.path.exists(local(other))
