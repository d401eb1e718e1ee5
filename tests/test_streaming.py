from tessitura.operators.audio import VoiceParams
from tessitura.streaming import voice


def test_sessions_survive_batches(spark, tmp_path):
    schema = "session string, seq bigint, probability double, volume double, control string"
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    params = VoiceParams(confidence=0.5, min_volume=0.0, start_secs=0.064, stop_secs=0.064)
    frames = [("s", i, 1.0 if 3 <= i < 8 else 0.0, 1.0, None) for i in range(12)]
    for n, part in enumerate((frames[:5], frames[4:9], frames[9:])):  # frame 4 comes again, late
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        q = voice.voice_sessions(stream, params).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).start()
        q.processAllAvailable()
        q.stop()
    got = sorted((r.signal_type, round(r.signal_at, 3)) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == [("QUIET", 0.256), ("SPEAKING", 0.096)]
