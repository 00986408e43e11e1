"""Session helpers: a local session for tests, and the cluster's shared folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import threading
import uuid
import zipfile
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


#: Bytes of a batch of texts on its way to a Python worker; one row may have more.
TEXT_BATCH_BYTES = 4 << 20
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
_SHIPPING = threading.Lock()


def local_session(cpus: int | str = "*", app: str = "tidemark", shuffle_partitions: int = 8) -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.scheduler.mode", "FAIR")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named in ``spark.checkpoint.dir``.

    A folder of our own is made only where none is named, and only for a local master: on a
    cluster a machine-local folder would be lost with its executor.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    made = tempfile.mkdtemp(prefix="tidemark-")
    atexit.register(shutil.rmtree, made, ignore_errors=True)  # our own, so it goes with the process
    spark.sparkContext.setCheckpointDir(made)
    return made


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/tidemark/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    Cuts the lineage: several consumers read one stored result, and a lost executor costs a
    re-read instead of a recomputation.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def text_batches(spark: SparkSession):
    """What is run inside hands rows to Python workers in batches of TEXT_BATCH_BYTES, as 10,000 whole texts would stand in both processes at
    a time; a limit that the session names already stays."""
    if spark.conf.get(_BATCH_BYTES, None) is not None:
        yield
        return
    spark.conf.set(_BATCH_BYTES, str(TEXT_BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.unset(_BATCH_BYTES)


def ship_package(spark: SparkSession) -> None:
    """Give Python workers this package, also where it is not installed; once per application."""
    context = spark.sparkContext
    with _SHIPPING:  # fits side by side ask at the same time
        if getattr(context, "_tidemark_shipped", False):
            return
        root = Path(__file__).resolve().parent
        target = Path(tempfile.mkdtemp(prefix="tidemark-")) / "tidemark.zip"
        with zipfile.ZipFile(target, "w") as archive:
            for source in sorted(root.rglob("*.py")):
                archive.write(source, source.relative_to(root.parent))
        context.addPyFile(str(target))
        context._tidemark_shipped = True
