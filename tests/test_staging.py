import os

import pytest

from shelfgap.sources import staging
from shelfgap.sources.staging import Staging


def test_uses_the_folder_of_the_session(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    with Staging(spark) as staged:
        assert staged.root.startswith(folder)
        assert staged.save(spark.range(5)).count() == 5
        assert os.path.isdir(staged.root)
    assert not os.path.exists(staged.root)


def test_uses_the_folder_that_is_given(spark, tmp_path):
    with Staging(spark, str(tmp_path)) as staged:
        assert staged.root.startswith(str(tmp_path))


def test_is_kept_after_an_error(spark, tmp_path):
    with pytest.raises(ValueError), Staging(spark, str(tmp_path)) as staged:
        saved = staged.save(spark.range(5))
        raise ValueError
    assert saved.count() == 5
    staged.clear()
    assert not os.path.exists(staged.root)


class _Session:
    """A session without the setting, as far as the folder is concerned."""

    def __init__(self, master):
        self.conf = self.sparkContext = self
        self.master = master

    def get(self, name, default=None):
        return "/warehouse" if name == "spark.sql.warehouse.dir" else default

    def getCheckpointDir(self):
        return None


@pytest.mark.parametrize("master", ["local", "local[4]", "local[*, 3]"])
def test_without_the_setting_the_warehouse_holds_it(master):
    assert staging.shared_root(_Session(master)) == "/warehouse/_staging"


@pytest.mark.parametrize("master", ["yarn", "spark://a:1", "local-cluster[2,1,1024]", "k8s://https://a"])
def test_a_cluster_has_to_name_a_folder(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        staging.shared_root(_Session(master))


def test_a_step_is_made_once(spark, tmp_path):
    made = []

    def build():
        made.append(1)
        return spark.range(4)

    with pytest.raises(ValueError), Staging(spark, str(tmp_path)) as staged:
        assert not staged.step("x", build)[1]
        raise ValueError
    with Staging(spark, str(tmp_path)) as staged:
        rows, kept = staged.step("x", build)
        assert kept and rows.count() == 4 and len(made) == 1
        assert not staged.step("y", build)[1]
    assert not os.listdir(tmp_path)


def test_a_step_that_broke_off_is_made_again(spark, tmp_path):
    with Staging(spark, str(tmp_path)) as staged:
        staged.step("x", lambda: spark.range(4))
        os.remove(tmp_path / "shelfgap-step-x" / "_SUCCESS")
        rows, kept = staged.step("x", lambda: spark.range(6))
        assert not kept and rows.count() == 6
