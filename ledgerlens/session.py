"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Callable
from multiprocessing.pool import ThreadPool
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", memory: str = "8g", name: str = "ledgerlens") -> SparkSession:
    """A session for tests and benchmarks, with a temporary shared folder; on a cluster the caller brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.checkpoint.dir", os.environ.get("SPARK_CHECKPOINT_DIR") or tempfile.mkdtemp(prefix="ledgerlens-"))
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    # One machine: a folder of its own, for sessions that were started without one.
    folder = tempfile.mkdtemp(prefix="ledgerlens-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def new_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    The copy is columnar, so readers still prune columns and the planner knows its true size;
    and it survives the loss of executors, which cached blocks do not.
    """
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def side_by_side(*actions: Callable[[], Any]) -> list[Any]:
    """Run independent steps at once, so that the tail of one leaves no executors idle."""
    session = SparkSession.active()
    started = [inheritable_thread_target(session)(action) for action in actions]
    with ThreadPool(len(actions)) as pool:
        return pool.map(lambda action: action(), started, chunksize=1)
