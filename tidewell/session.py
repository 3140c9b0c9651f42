"""Session factory and the few session settings that operators read."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(app: str = "tidewell", master: str | None = None, shuffle: int | None = None, **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution. ANSI stays on, as is Spark 4's default."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    settings = DEFAULTS | ({"spark.sql.shuffle.partitions": str(shuffle)} if shuffle else {}) | conf
    for k, v in settings.items():
        b = b.config(k, v)
    return b.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share (``spark.checkpoint.dir``). Only where a
    session has none and runs on this machine alone, as in tests, a folder of this
    machine is set up for it; on a cluster that is an error."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if at is None:
        held = sc._jsc.sc().getCheckpointDir()
        if held.isDefined():
            at = held.get()
        elif sc.master.startswith("local"):
            at = tempfile.mkdtemp(prefix="tidewell-")
        else:
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(at)
    return at


def prepare(spark: SparkSession) -> None:
    """What the registered queries expect of a session that ``build_session`` did
    not make. HotSpot interprets methods above 8,000 bytes of bytecode instead of
    compiling them; above that size a stage of long expressions is faster with one
    projection an operator, which Spark cuts into small methods."""
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", DEFAULTS["spark.sql.codegen.hugeMethodLimit"])


def parallelism(spark: SparkSession, floor: int = 12) -> int:
    """Number of buckets for operators that hash rows themselves."""
    return max(floor, int(spark.conf.get("spark.sql.shuffle.partitions")))
