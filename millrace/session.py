"""Session defaults and the shared folder for staged tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(cores: int | str = 8, memory: str = "12g", partitions: int = 8) -> SparkSession:
    """Session for tests and benches; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("millrace")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A machine-local folder is taken only where nothing is set and the master is
    local, i.e. in tests.
    """
    sc = spark.sparkContext
    named = spark.conf.get(_CHECKPOINT_KEY, None) or sc.getConf().get(_CHECKPOINT_KEY) or sc.getCheckpointDir()
    if named:
        return named
    if not sc.master.startswith("local"):
        raise RuntimeError(f"set {_CHECKPOINT_KEY} to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="run-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


class Staging:
    """Writes intermediate tables to the shared folder; as a context it removes them at the end.

    A staged table is written once in columnar form and read back: the lineage
    is cut, later passes read only the columns they need instead of repeating
    the shuffles above, and lost executors cost nothing that is already written.
    """

    def __init__(self) -> None:
        self._written: list[tuple[SparkSession, str]] = []

    def __call__(self, df: DataFrame, name: str = "stage") -> DataFrame:
        spark = df.sparkSession
        path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
        df.write.parquet(path)
        self._written.append((spark, path))
        return spark.read.schema(df.schema).parquet(path)

    def release(self) -> None:
        """Delete what was staged; call it when no DataFrame over it is needed any more."""
        for spark, path in self._written:
            target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
        self._written.clear()

    def __enter__(self) -> Staging:
        return self

    def __exit__(self, *_) -> None:
        self.release()


def staged(df: DataFrame, name: str = "stage") -> DataFrame:
    """Stage a table that lives as long as the shared folder keeps it."""
    return Staging()(df, name)
