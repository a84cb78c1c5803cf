"""Incremental ingest of export lines: the operators for whole tables, run over each arriving batch."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from panelloom.operators import rejects

#: Columns of the arriving lines.
LINES = "record_id bigint, file_name string, line_no int, sep string, raw_line string, loaded_at timestamp_ntz"


def read_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of the Parquet files that arrive in a folder, as a stream."""
    return spark.readStream.schema(LINES).parquet(folder)


def ingest(lines: DataFrame, headers: str, loaded: str, rejected: str, checkpoint: str, pending: str | None = None) -> StreamingQuery:
    """Load the valid lines of each batch and set the broken ones aside, exactly once per batch.

    The headers seen so far lie in a table (`headers`), so that a file's later lines are judged although its header came
    in an earlier batch. Lines that arrive before their file's header wait in a table (`pending`, beside `headers` if not
    named), whose folder of the last batch holds all that still wait; the batch that brings the header judges them.
    Batches are written into folders of their own number: a batch that is run again replaces itself.
    """

    waiting = pending or f"{headers}-pending"

    def batch(df: DataFrame, n: int) -> None:
        spark = df.sparkSession
        df.where("line_no = 1").write.mode("overwrite").parquet(f"{headers}/batch={n}")
        known = spark.read.parquet(headers).where(f"batch <= {n}").select(*df.columns)
        lines = df.where("line_no <> 1")
        try:
            lines = lines.unionByName(spark.read.parquet(f"{waiting}/batch={n - 1}"))
        except AnalysisException as e:  # the first batch
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
        # Only the headers of files that this batch has lines of are needed from here on.
        known = known.join(lines.unionByName(df).select("file_name").distinct(), "file_name", "left_semi").select(*df.columns)
        files = known.select("file_name").distinct()
        lines.join(files, "file_name", "left_anti").select(*df.columns).write.mode("overwrite").parquet(f"{waiting}/batch={n}")
        whole = lines.join(files, "file_name", "left_semi").select(*df.columns).unionByName(known)
        rejects.loaded(whole).write.mode("overwrite").parquet(f"{loaded}/batch={n}")
        rejects.rejected(whole).write.mode("overwrite").parquet(f"{rejected}/batch={n}")

    return lines.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
