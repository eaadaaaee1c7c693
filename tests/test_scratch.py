from types import SimpleNamespace

import pytest

from pagequarry.scratch import materialise, scratch_path, scratch_root


def session(root, master):
    """What a session says about its master and its checkpoint folder."""
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: root or default),
        sparkContext=SimpleNamespace(master=master, applicationId="app-1"),
    )


def test_the_folder_of_the_cluster_is_used():
    assert scratch_root(session("hdfs://x/c/", "yarn")) == "hdfs://x/c"


def test_a_cluster_without_a_folder_is_refused():
    with pytest.raises(ValueError):
        scratch_root(session(None, "spark://x:7077"))


def test_local_mode_has_one_folder_per_application():
    local = session(None, "local[2]")
    assert scratch_root(local) == scratch_root(local)


def test_materialise_writes_below_the_checkpoint_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(f"{root}/pagequarry/")
    stored = materialise(spark.range(5), "five")
    assert stored.count() == 5 and all(root in f for f in stored.inputFiles())
