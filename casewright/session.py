"""Session defaults and the staging helper shared by multi-pass operators."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from collections.abc import Sequence
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType


def local_session(name: str = "casewright", cores: str = "*", partitions: int = 8) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        # One-file test tables: let joins shuffle and split small files, so all cores get rows.
        .config("spark.sql.autoBroadcastJoinThreshold", "512k")
        .config("spark.sql.files.openCostInBytes", "256k")
        .config("spark.hadoop.parquet.block.size", str(1 << 20))
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "20000")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers, once per application.

    Not needed where the package is installed on the cluster or was passed with
    ``--py-files``.
    """
    sc = spark.sparkContext
    if _SHIPPED.get("app") == sc.applicationId:
        return
    folder = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="casewright-py-")) / folder.name
    archive = shutil.make_archive(str(target), "zip", folder.parent, folder.name)
    sc.addPyFile(archive)  # copied to every executor by Spark
    _SHIPPED["app"] = sc.applicationId


_SHIPPED: dict[str, str] = {}


def small_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A literal table (grids, edges, contracts): a local relation, not a scan job."""
    types = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    columns = list(zip(*rows)) if rows else [() for _ in types]
    data = pa.table(
        [pa.array(list(c), to_arrow_type(f.dataType)) for c, f in zip(columns, types)],
        names=types.names,
    )
    return spark.createDataFrame(data, types)


def staging_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A local session without that setting (tests, notebooks) stages in a
    temporary folder of its own, once per application; on a cluster, where such
    a folder would be lost with its machine, the setting is required.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="casewright-")
    return _LOCAL_ROOTS[app]


_LOCAL_ROOTS: dict[str, str] = {}


def staged(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where several passes follow (iterative fits, two-branch ranks): the
    passes read narrow Parquet columns, and a lost executor costs a re-read
    instead of a recomputation of the whole lineage.
    """
    spark = df.sparkSession
    path = f"{staging_root(spark)}/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._casewright_staged = True
    back._casewright_path = path
    return back


def discard(df: DataFrame) -> None:
    """Delete the files of a staged table that nothing reads any more."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df._casewright_path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def staged_view(view: DataFrame, source: DataFrame) -> DataFrame:
    """``view``, taken for staged where ``source`` is, as it only filters or adds columns row by row.

    A pass over it reads the files of ``source``, which is cheaper than to write its rows again.
    """
    view._casewright_staged = getattr(source, "_casewright_staged", False)
    return view


def ensure_staged(df: DataFrame) -> DataFrame:
    """``df`` itself where it is a staged table already, else staged now."""
    return df if getattr(df, "_casewright_staged", False) else staged(df)
