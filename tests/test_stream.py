from tallybook.operators.cdc import latest_by_key
from tallybook.streaming.observations import upsert_latest


def test_stream_equals_batch(spark, tmp_path):
    rows = [(i, i % 5, (i * 7) % 40) for i in range(40)]
    df = spark.createDataFrame(rows, "item_id long, rcno long, observed_at long")
    df.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    upsert_latest(stream, spark, str(tmp_path / "state"), str(tmp_path / "cp")).awaitTermination()
    last = max((tmp_path / "state").iterdir(), key=lambda p: int(p.name[2:]))
    got = {tuple(r) for r in spark.read.parquet(str(last)).select("item_id", "rcno", "observed_at").collect()}
    assert got == {tuple(r) for r in latest_by_key(df, "rcno", "observed_at", "item_id").collect()}
