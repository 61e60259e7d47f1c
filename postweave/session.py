"""Session defaults and the one place where lineage is cut."""

from __future__ import annotations

import hashlib
import io
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "postweave", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators assume (UTC, AQE, skew handling)."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.showConsoleProgress": "false",
        # Checkpoints go when nothing refers to them any more.
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    for k, v in (defaults | conf).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    if spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.master.startswith("local"):
        ship(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; on a cluster that must be set, a local session makes one of its own."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    ctx = spark.sparkContext
    if ctx._jsc.sc().getCheckpointDir().isEmpty():
        if not named and not ctx.master.startswith("local[") and ctx.master != "local":
            raise ValueError("spark.checkpoint.dir is not set: a cluster needs a folder that all executors share")
        ctx.setCheckpointDir(named or tempfile.mkdtemp(prefix="postweave-ckpt-"))
    return ctx._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and drop its lineage.

    The files live on storage all executors share, so a lost executor costs a re-read only.
    """
    ensure_checkpoint_dir(df.sparkSession)
    ship(df.sparkSession)
    return df.checkpoint(eager=True)


def kept(df: DataFrame) -> DataFrame:
    """``cut`` for wide rows: Parquet files in the checkpoint folder, where columns are packed and read one by one."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/kept-{uuid.uuid4()}"
    ship(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per context, so that they need not have it installed.

    The archive is written to the shared checkpoint folder and handed out by Spark.
    """
    ctx = spark.sparkContext
    if getattr(ctx, "_postweave_sent", False):
        return
    root = Path(__file__).resolve().parent
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.writestr(zipfile.ZipInfo(f"{root.name}/{f.relative_to(root)}"), f.read_bytes())
    body = data.getvalue()
    path = ctx._jvm.org.apache.hadoop.fs.Path(f"{ensure_checkpoint_dir(spark)}/{root.name}-{hashlib.sha256(body).hexdigest()[:16]}.zip")
    out = path.getFileSystem(ctx._jsc.hadoopConfiguration()).create(path, True)
    out.write(bytearray(body))
    out.close()
    ctx.addPyFile(path.toString())
    ctx._postweave_sent = True


def spread(df: DataFrame) -> DataFrame:
    """Rows of a scan dealt out to all cores where its files give fewer parts than that; larger scans are left as they are.

    For steps that cost much more than moving a row; only the columns read move.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def table(spark: SparkSession, sf_dir: str, name: str, wide: bool = False) -> DataFrame:
    """A table of a folder; ``wide`` for those whose rows are costly to work on."""
    ship(spark)
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(df) if wide else df
