"""Session settings, the shared scratch folder and the size check for broadcasts."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A side is broadcast only when it was counted and measured, and has at most so many rows and bytes.
MAX_BROADCAST_ROWS = 200_000
MAX_BROADCAST_BYTES = 32 << 20


def build_session(app: str = "quotegrid", master: str | None = None, **conf: str) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.sql.parquet.compression.codec": "zstd",
        **conf,
    }
    for k, v in settings.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    ship_package(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of its own.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if named:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(named)
        return named
    if sc.getCheckpointDir():
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="quotegrid-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage, survives lost executors, and gives every later reader the same rows.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _row_bytes(df: DataFrame):
    """About the bytes of a row: texts by their length, nested columns by their JSON, other columns 8 each."""
    out = F.lit(0)
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        kind = f.dataType.typeName()
        if kind in ("string", "binary"):
            out = out + F.coalesce(F.octet_length(c), F.lit(0))
        elif kind in ("array", "map", "struct"):
            out = out + F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0))
        else:
            out = out + F.lit(8)
    return out.cast("bigint")


def small_side(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast if ``df`` was counted and measured to be small; else leave the join to Catalyst."""
    rows, size = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(_row_bytes(df)), F.lit(0))).first()
    return F.broadcast(df) if rows <= max_rows and size <= max_bytes else df


def compile_wide_projections(spark: SparkSession) -> None:
    """Keep generated methods small enough for the JVM to compile.

    The feature projection makes one method of more than 8000 bytecodes, which
    HotSpot only interprets; at this limit Spark splits it instead. About eight
    times faster on the production grid. A limit the user set is left alone.
    """
    name = "spark.sql.codegen.hugeMethodLimit"
    if spark.conf.get(name) == "65535":
        spark.conf.set(name, "8000")


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package wherever the driver was started.

    Executors get it as a zip; the workers Spark starts beside the driver (for
    stateful streams) find it on their path.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    _SHIPPED.add(sc.applicationId)
    package = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(package)
    known = sc.environment.get("PYTHONPATH") or os.environ.get("PYTHONPATH")
    sc.environment["PYTHONPATH"] = os.pathsep.join([root, known]) if known else root
    archive = shutil.make_archive(
        os.path.join(tempfile.mkdtemp(prefix="quotegrid-"), "quotegrid"), "zip", root, os.path.basename(package)
    )
    sc.addPyFile(archive)
