"""Session settings and the folder shared by all executors."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, **conf) -> SparkSession:
    """A local session for tests and benches; on a cluster use the one you are given."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("cubeweave")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach.

    It is the one named by ``spark.checkpoint.dir``. Only a local session may
    go without: there a temporary folder is made and set, because all tasks
    run on this machine.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if not root:
        context = spark.sparkContext
        if not re.match(r"local(\[|$)", context.master):
            raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder shared by all executors")
        root = context.getCheckpointDir()
        if not root:
            root = tempfile.mkdtemp(prefix="cubeweave-")
            context.setCheckpointDir(root)
        root = root.removeprefix("file:")
    return root.rstrip("/")


def new_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder name under the shared folder."""
    return os.path.join(shared_dir(spark), "cubeweave", f"{purpose}-{uuid.uuid4().hex}")


@contextmanager
def settings(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """Session settings for the length of a block."""
    before = {k: spark.conf.get(k, None) for k in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def released(spark: SparkSession):
    """Shuffle files of the rows that are written inside go when these are written, not when the driver next collects its garbage."""
    return settings(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"})


def stream_settings(spark: SparkSession) -> dict[str, str]:
    """Settings for passes that run to completion.

    A local session gets no more state stores than it has cores; a cluster
    keeps its own number. The empty batch at the end of a pass stays on: it is
    what makes the watermark of a pass count for late rows of the next one.
    """
    context = spark.sparkContext
    if not context.master.startswith("local"):
        return {}
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    return {"spark.sql.shuffle.partitions": str(min(partitions, context.defaultParallelism))}
