"""Session settings that the engine expects; every setting can be overridden by the caller."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import SparkSession

#: Matching of names is case-sensitive, instants are UTC, plans are re-planned at run time.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_spark(app: str = "panelloom", master: str | None = None, **conf: str) -> SparkSession:
    """The active session, or a new one with DEFAULTS; conf holds further settings, with "__" for a dot."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in (DEFAULTS | {k.replace("__", "."): v for k, v in conf.items()}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def case_sensitive(spark: SparkSession) -> None:
    """Survey headers such as A and a are different columns; pipelines over raw headers call this first."""
    spark.conf.set("spark.sql.caseSensitive", "true")


def shared_checkpoints(spark: SparkSession) -> None:
    """Make checkpoint() usable: the folder named by the cluster in spark.checkpoint.dir, where that is set.

    Only a local session without one (tests) gets a temporary folder, which goes with the process; on a cluster a
    machine's own folder would lose its part with the machine, so there its absence is an error.
    """
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isDefined():
        return
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("A cluster needs spark.checkpoint.dir, a folder that all its machines share.")
        named = tempfile.mkdtemp(prefix="panelloom-checkpoint-")
        atexit.register(shutil.rmtree, named, ignore_errors=True)
    context.setCheckpointDir(named)
