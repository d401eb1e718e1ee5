"""File sources and sinks: WAV folders, caption files, lists, manifests."""

from __future__ import annotations

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessitura.operators import audio, captions
from tessitura.operators.jobs import first_seen

#: Suffixes of audio files.
AUDIO = ("aac", "flac", "m4a", "mka", "mp3", "mp4", "ogg", "opus", "wav", "webm")
MANIFEST = (
    "audio_id string, video_id string, segment_id string, segment_file string, transcript_file string, start_sec double, end_sec double, duration double, text string, "
    "transcript_source string, transcript_status string, vad_status string, quality_label string, quality_score double, quality_reasons string, source_url string, title string, "
    "reference string, manual_wer double, review_status string"
)


def audio_files(spark: SparkSession, folder: str, recursive: bool = True) -> DataFrame:
    """(path, content, length) of the audio files under a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(folder)
    return files.filter(F.lower(F.element_at(F.split("path", r"\."), -1)).isin(*AUDIO))


def wav_files(spark: SparkSession, folder: str, mono: bool = True) -> DataFrame:
    """(path, wav) of the WAV files of a folder."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.wav").load(folder)
    return audio.with_wav(files, "content", mono).drop("content")


def caption_files(spark: SparkSession, folder: str) -> DataFrame:
    """(video_id, path, text): one caption file a video, Vietnamese ones first, then by name."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.vtt").load(folder)
    name = F.element_at(F.split("path", "/"), -1)

    def texts(s: pd.Series) -> pd.Series:
        return s.map(lambda b: captions.decode(bytes(b)))

    texts.__annotations__ = {"s": pd.Series, "return": pd.Series}
    decode = F.pandas_udf(texts, "string")
    order = F.struct((~F.lower(name).endswith(".vi.vtt")).alias("a"), name.alias("b"))
    return files.withColumn("video_id", F.split(F.regexp_replace(name, r"(?i)(\.vi)?\.vtt$", ""), "__")[0]).groupBy("video_id").agg(F.min_by(F.struct("path", "content"), order).alias("f")).select("video_id", "f.path", decode("f.content").alias("text"))


def text_list(spark: SparkSession, path: str, headers: tuple[str, ...] = ()) -> DataFrame:
    """(line_no, value): lines that aren't blank, comments or headers, the first of those equal but for case."""
    lines = spark.read.text(path).withColumn("line_no", F.monotonically_increasing_id()).withColumn("value", F.trim("value"))
    kept = lines.filter((F.col("value") != "") & ~F.col("value").startswith("#") & ~F.lower("value").isin(list(headers)))
    return first_seen(kept, F.lower("value"), "line_no")


def rows_or_empty(spark: SparkSession, path: str, schema: str, kind: str = "csv") -> DataFrame:
    """A CSV or JSON table; a missing path is an empty one."""
    try:
        reader = spark.read.schema(schema)
        return reader.csv(path, header=True) if kind == "csv" else reader.json(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def write_table(df: DataFrame, path: str, overwrite: bool = True, kind: str = "csv") -> None:
    """A table in full; without overwrite an existing one stays."""
    w = df.write.mode("overwrite" if overwrite else "ignore")
    w.csv(path, header=True) if kind == "csv" else w.json(path)


def tasks(spark: SparkSession, path: str) -> DataFrame:
    """Labelling tasks of JSON files; an array at the root gives a row per task."""
    return spark.read.json(path, multiLine=True)


def annotations(df: DataFrame) -> DataFrame:
    """(id, from_name, value): results of annotations that weren't cancelled, newest annotation first; tasks without
    any give one row with NULLs."""
    live = F.filter("annotations", lambda a: ~F.coalesce(a["was_cancelled"], F.lit(False)))
    ordered = F.array_sort(live, lambda x, y: F.when(x["created_at"] > y["created_at"], -1).when(x["created_at"] < y["created_at"], 1).otherwise(0))
    a = df.select("id", F.posexplode_outer(ordered).alias("annotation_no", "a"))
    return a.select("id", "annotation_no", F.explode_outer("a.result").alias("r")).select("id", "annotation_no", "r.from_name", "r.value")
