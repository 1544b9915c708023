"""The shared folder of sessions whose executors are processes of their own."""

import os
import subprocess
import sys
from pathlib import Path

import pyspark
import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
RUN = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
from siltline.session import settle, shared_root
conf = {{"spark.master": "local-cluster[1,1,1024]", "spark.ui.enabled": "false", "spark.driver.host": "127.0.0.1", "spark.local.dir": "{top}/local",
        "spark.sql.warehouse.dir": "{top}/tables", **{conf!r}}}
spark = SparkSession.builder.config(map=conf).getOrCreate()
if {called}:
    spark.sparkContext.setCheckpointDir("{top}/called")
rows = settle(spark.range(0, 1000, 1, 3), "rows")
print("ROWS", rows.count(), shared_root(spark))
"""


@pytest.mark.parametrize(
    ("conf", "called", "folder"),
    [
        ({}, False, "tables"),  # nothing set
        ({"spark.checkpoint.dir": "{top}/plain"}, False, "plain"),  # no file system in the path
        ({}, True, "called"),
    ],
)
def test_executors_of_their_own(tmp_path, conf, called, folder):
    home = tmp_path / "home"  # executors' logs go to work in Spark's home
    home.mkdir()
    for p in Path(pyspark.__file__).parent.iterdir():
        if p.name != "work":
            (home / p.name).symlink_to(p)
    (tmp_path / "conf").mkdir()  # no defaults of this machine
    conf = {k: v.format(top=tmp_path) for k, v in conf.items()}
    env = os.environ | {"SPARK_HOME": str(home), "SPARK_CONF_DIR": str(tmp_path / "conf"), "SPARK_SCALA_VERSION": "2.13", "SPARK_LOCAL_IP": "127.0.0.1"}
    done = subprocess.run([sys.executable, "-c", RUN.format(repo=REPO, top=tmp_path, conf=conf, called=called)], env=env, cwd=tmp_path, capture_output=True, text=True, timeout=180)
    found = [line.split() for line in done.stdout.splitlines() if line.startswith("ROWS")]
    assert found and found[0][1] == "1000" and found[0][2].startswith(f"file:{tmp_path}/{folder}"), done.stderr[-2000:]
