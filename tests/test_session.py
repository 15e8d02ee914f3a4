from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest

from propensity.session import checkpointed, drop_frames, materialize, release, shared_dir

WITHOUT_FOLDER = """
from pyspark.sql import SparkSession
from propensity.session import materialize, shared_dir
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
assert spark.conf.get("spark.checkpoint.dir", None) is None
assert "propensity-" in shared_dir(spark) and shared_dir(spark) == shared_dir(spark)
assert materialize(spark.range(3)).count() == 3
"""


def test_named_folder_is_used(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark) == named
    frame = materialize(spark.range(10))
    assert frame.count() == 10 and frame.inputFiles()[0].startswith(f"file://{named}/frames/")
    assert checkpointed(frame).count() == 10


def test_a_scratch_folder_is_made_in_local_mode_only(tmp_path):
    root = str(Path(__file__).parent.parent)
    env = {"SPARK_CONF_DIR": str(tmp_path), "PYTHONPATH": root, "PATH": "/usr/bin:/bin:/usr/local/bin"}
    import os

    subprocess.run([sys.executable, "-c", WITHOUT_FOLDER], check=True, env={**os.environ, **env}, timeout=180)


def test_a_cluster_must_name_the_folder():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Session())


def test_empty_frames_keep_their_schema(spark):
    empty = materialize(spark.createDataFrame([], "a int, b string"))
    assert empty.count() == 0 and empty.dtypes == [("a", "int"), ("b", "string")]


def test_only_own_frames_are_dropped(spark):
    frame = materialize(spark.range(3))
    path = Path(frame.inputFiles()[0].removeprefix("file://"))
    foreign = path.parent.parent.parent / "another-application" / "frame"
    foreign.mkdir(parents=True)
    drop_frames(spark)
    assert not path.exists() and foreign.exists()


def test_released_frames_are_deleted_and_others_stay(spark):
    one, two = (materialize(spark.range(n)) for n in (3, 4))
    release(one, spark.range(5), two.where("id > 1"))
    assert two.count() == 4
    with pytest.raises(Exception):
        one.count()
