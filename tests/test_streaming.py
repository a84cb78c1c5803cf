from datetime import datetime

from conftest import rows

from panelloom.streaming import ingest

ID = "R_abcdefghij12345"


def test_headers_of_earlier_batches_count(spark, tmp_path):
    at = datetime(2026, 1, 1)
    folder = str(tmp_path / "in")
    out = {k: str(tmp_path / k) for k in ("headers", "loaded", "rejected", "checkpoint")}
    for data in ([(1, "f", 1, ",", "ResponseId,Q1,Progress", at), (2, "f", 2, ",", f"{ID},1,5", at)], [(3, "f", 3, ",", f"{ID},9,5", at), (4, "f", 4, ",", f"{ID},2,6", at)]):
        spark.createDataFrame(data, ingest.LINES).coalesce(1).write.mode("append").parquet(folder)
        ingest.ingest(ingest.read_lines(spark, folder), **out).awaitTermination(120)
    assert rows(spark.read.parquet(out["loaded"]).select("record_id", "q1")) == [(2, "1"), (4, "2")]
    assert rows(spark.read.parquet(out["rejected"]).select("record_id", "reason", "broken_field")) == [(3, "invalid_value", "Q1")]


def test_lines_before_their_header_wait(spark, tmp_path):
    at = datetime(2026, 1, 1)
    folder = str(tmp_path / "in")
    out = {k: str(tmp_path / k) for k in ("headers", "loaded", "rejected", "checkpoint", "pending")}
    late = [(2, "f", 2, ",", f"{ID},1,5", at), (3, "f", 3, ",", f"{ID},9,5", at), (5, "g", 2, ",", "x", at)]
    for data in (late, [(4, "f", 4, ",", f"{ID},2,6", at)], [(1, "f", 1, ",", "ResponseId,Q1,Progress", at)]):
        spark.createDataFrame(data, ingest.LINES).coalesce(1).write.mode("append").parquet(folder)
        ingest.ingest(ingest.read_lines(spark, folder), **out).awaitTermination(120)
    assert rows(spark.read.parquet(out["loaded"]).select("record_id", "q1")) == [(2, "1"), (4, "2")]
    assert rows(spark.read.parquet(out["rejected"]).select("record_id", "reason", "broken_field")) == [(3, "invalid_value", "Q1")]
    assert rows(spark.read.parquet(out["pending"]).where("batch = 2").select("record_id")) == [(5,)]
