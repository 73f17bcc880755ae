from types import SimpleNamespace

import pytest
from medallion.session import work_dir


def session(master, folder):
    conf = SimpleNamespace(get=lambda key, default=None: folder or default)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))


def test_work_dir_is_shared_on_a_cluster():
    assert work_dir(session("yarn", "hdfs://a/b/"), "x").startswith("hdfs://a/b/x-")
    with pytest.raises(ValueError):
        work_dir(session("yarn", None), "x")


def test_work_dir_of_a_local_test():
    assert "/x-" in work_dir(session("local[2]", None), "x")
