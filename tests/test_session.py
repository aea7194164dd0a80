"""The package on workers that lack it, and the tables in the shared folder."""

import os
import subprocess
import sys

import pytest

from caretide import session

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from caretide.session import build_session, clear_scratch
import __spark_entry__ as entry
spark = build_session("2", **{{"spark.checkpoint.dir": {folder!r}}})
sys.path.remove({repo!r})
print("ROWS", entry.queries()["x01_tree_attributions"](spark, "/root/testdata/sf0.001").count())
clear_scratch(spark)
"""


def test_workers_need_no_package_and_the_folder_ends_empty(tmp_path):
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    (tmp_path / "elsewhere").mkdir()
    (tmp_path / "shared").mkdir()
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run(
        [sys.executable, "-c", SCRIPT.format(repo=repo, folder=f"{tmp_path}/shared")],
        cwd=tmp_path / "elsewhere", env=env, capture_output=True, text=True, timeout=600)
    assert "ROWS" in run.stdout and "ROWS 0" not in run.stdout, run.stderr[-2000:]
    left = [p for p in (tmp_path / "shared").iterdir() if not p.name.startswith(".")]
    assert [p.name for p in left if p.is_dir() and any(p.rglob("*.parquet"))] == []


def test_scratch_block_removes_its_own_tables(spark):
    kept = session.materialize(spark.range(3), "kept")
    with session.scratch(spark):
        gone = session.materialize(spark.range(5), "gone")
        path = gone.inputFiles()[0].removeprefix("file://")
        assert os.path.exists(path)
    assert not os.path.exists(path) and kept.count() == 3


def test_a_cluster_must_name_its_shared_folder():
    class Conf:
        def get(self, key, default):
            return default

    class Cluster:
        conf = Conf()
        sparkContext = type("C", (), {"master": "local-cluster[3,2,1000]"})()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(Cluster())
