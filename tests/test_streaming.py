import tempfile

from quantspark.plans.cleaning import filter_accounts, vwap_dedup
from quantspark.schemas import TRADES
from quantspark.sources.fixtures import trades_from_events
from quantspark.streaming.clean_stream import clean_stream

SF = "/root/testdata/sf0.001"


def test_stream_sessions_are_batch_sessions(spark):
    d = tempfile.mkdtemp(prefix="qs-stream-", dir="/tmp")
    trades_from_events(spark, SF).write.parquet(d + "/in")
    s = spark.readStream.schema(TRADES).parquet(d + "/in")
    q = (clean_stream(s, gap="1 hour", watermark="0 seconds").writeStream.format("memory")
         .queryName("qs_clean").outputMode("append").start())
    q.processAllAvailable()
    q.stop()
    streamed = {tuple(r) for r in spark.sql("SELECT * FROM qs_clean").collect()}
    batch = {tuple(r) for r in vwap_dedup(filter_accounts(spark.read.parquet(d + "/in")), "1 hour").collect()}
    # append mode emits a session once the watermark passes it: every emitted one is a batch session
    assert streamed and streamed <= {tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in batch} \
        or streamed <= batch
    assert len(batch) - len(streamed) <= 5
