"""Session helpers: building a session, cutting lineage, reading the test tables."""

from __future__ import annotations

import gc
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path
from urllib.request import url2pathname

import pandas as pd
from pyarrow import NativeFile
from pyarrow.fs import FileSystem, LocalFileSystem
from pyarrow.parquet import ParquetFile
from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "corpusweave", cores: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A local session with ANSI mode, adaptive execution and UTC; on a cluster the launcher's settings hold."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    return b.getOrCreate()


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """``checkpoint()`` into the shared folder named by ``spark.checkpoint.dir``.

    The folder is read from the session; a folder of our own is used only where the setting is absent (tests, one machine).
    The files outlive executors, so a lost executor costs no recomputation of the part before the cut.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint(eager)


def shared_folder(spark: SparkSession) -> str:
    """The folder for checkpoints and intermediate tables, which all executors share.

    Off a single machine it must be named by ``spark.checkpoint.dir``: a temporary folder there would be another one on
    every executor.
    """
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="corpusweave_ckpt_"))
    return sc._jsc.sc().getCheckpointDir().get()


_WRITTEN: dict[str, list[str]] = {}


def _delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


class Stage:
    """An intermediate result, or the state of an iteration, as a parquet table in the shared folder.

    A checkpoint keeps whole rows and carries the size estimate of the plan before it; over many passes these estimates
    multiply without limit. A written table is estimated by its files, and what reads it reads the columns it needs.
    ``put`` drops the table before the last, which nothing reads any more; ``release`` drops the rest.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.root, self.kept = spark, f"{shared_folder(spark)}/stage_{uuid.uuid4().hex}", []

    def put(self, df: DataFrame, *folders: str) -> DataFrame:
        """The written table; ``folders`` are columns by whose values it is laid out."""
        path = f"{self.root}_{uuid.uuid4().hex}"
        (df.write.partitionBy(*folders) if folders else df.write).parquet(path)
        self.kept.append(path)
        all_ = _WRITTEN.setdefault(self.spark.sparkContext.applicationId, [])
        all_.append(path)
        while len(self.kept) > 2:
            old = self.kept.pop(0)
            all_.remove(old)
            _delete(self.spark, old)
        return self.spark.read.schema(df.schema).parquet(path)


def _opened(file: str) -> NativeFile:
    scheme, _, rest = file.partition(":")
    fs, path = (LocalFileSystem(), url2pathname("/" + rest.lstrip("/"))) if scheme == "file" else FileSystem.from_uri(file)
    return fs.open_input_file(path)


def stage_batches(files: list[str], columns: list[str]) -> Iterator[list]:
    """The rows of files of a written table, one at a time, read in a task from the shared folder itself."""
    for f in files:
        with _opened(f) as source:
            for b in ParquetFile(source).iter_batches(batch_size=1, columns=columns):
                yield [b.column(c)[0].as_buffer() for c in columns]


def stage_frame(file: str, columns: list[str]) -> pd.DataFrame:
    """One file of a written table, likewise."""
    with _opened(file) as source:
        return ParquetFile(source).read(columns).to_pandas()


def release(spark: SparkSession) -> None:
    """Deletes the intermediate tables of this application; to be called when its results have been consumed."""
    for path in _WRITTEN.pop(spark.sparkContext.applicationId, []):
        _delete(spark, path)


def drop_shuffles(spark: SparkSession) -> None:
    """Spark drops shuffle files that nothing refers to when the driver collects its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the executors, once per application, so that their Python workers can import it."""
    sc = spark.sparkContext
    root = Path(__file__).resolve().parent
    if sc.applicationId in _SHIPPED or not root.is_dir():
        return
    path = Path(tempfile.mkdtemp(prefix="corpusweave_zip_")) / f"{root.name}.zip"  # read by the driver's own file server
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(path))
    _SHIPPED.add(sc.applicationId)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table of a data directory."""
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions_of(spark: SparkSession) -> int:
    """The number of shuffle partitions the session asks for."""
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
