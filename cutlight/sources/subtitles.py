"""Subtitle files as cues, probe metadata as columns, and file inventories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_TIME = r"(\d{1,3}):(\d{1,2}):(\d{1,2})[,.](\d{1,3})"
_TIMING = rf"^\s*{_TIME}\s*-->\s*{_TIME}"


def timestamp_seconds(value: Column) -> Column:
    """Seconds of h:mm:ss,mmm (or a point); null where the text is no time or minutes or seconds reach 60."""
    part = lambda i: F.regexp_extract(value, "^" + _TIME + "$", i)
    h, m, s, ms = (part(i) for i in range(1, 5))
    ok = value.rlike("^" + _TIME + "$") & (m.try_cast("int") < 60) & (s.try_cast("int") < 60)
    return F.when(ok, h.try_cast("double") * 3600 + m.try_cast("double") * 60 + s.try_cast("double") + ms.try_cast("double") / F.pow(F.lit(10.0), F.length(ms)))


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """path, text of subtitle files, one row a file."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("text"))


def parse_blocks(files: DataFrame, key: str = "path") -> tuple[DataFrame, DataFrame]:
    """(cues, malformed) of files (key, text).

    cues: key, cue_ord, cue_id, source_index, start_s, end_s, text; malformed: key, block, reason. Blocks are parted by
    blank lines; a first line of digits is the index; the timing line follows; the rest, joined by spaces, is the text.
    """
    text = F.regexp_replace(F.regexp_replace(F.col("text"), "\r\n?", "\n"), "^﻿+", "")
    b = files.select(F.col(key), F.posexplode(F.split(text, r"\n\s*\n")).alias("at", "block"))
    lines = F.filter(F.transform(F.split("block", "\n"), lambda x: F.trim(F.regexp_replace(x, r"^\s+|\s+$", ""))), lambda x: x != "")
    b = b.withColumn("lines", lines).where(F.size("lines") > 0)
    indexed = F.element_at("lines", 1).rlike(r"^\d+$")
    timing = F.get("lines", F.when(indexed, 1).otherwise(0))
    rest = F.array_join(F.slice("lines", F.when(indexed, 3).otherwise(2), F.size("lines")), " ")
    # explode keeps each step as columns: written into one another these expressions would multiply
    b = b.select(key, "at", F.explode(F.array(F.struct("lines", indexed.alias("indexed"), timing.alias("timing"), rest.alias("said")))).alias("s")).select(key, "at", "s.*")
    groups = F.array(*[F.regexp_extract("timing", _TIMING, i) for i in range(1, 9)])
    b = b.select("*", F.explode(F.array(groups)).alias("g"))

    def seconds(first: int) -> Column:
        h, m, s, ms = (F.get("g", first + i) for i in range(4))
        ok = (m.try_cast("int") < 60) & (s.try_cast("int") < 60)
        return F.when(ok, h.try_cast("double") * 3600 + m.try_cast("double") * 60 + s.try_cast("double") + ms.try_cast("double") / F.pow(F.lit(10.0), F.length(ms)))

    b = b.select("*", F.explode(F.array(F.struct(seconds(0).alias("start_s"), seconds(4).alias("end_s")))).alias("t")).select("*", "t.*").drop("t", "g")
    reason = F.when(F.col("timing").isNull(), "missing timing line").when(~F.col("timing").rlike(_TIMING), "malformed timing line").when(F.col("start_s").isNull() | F.col("end_s").isNull(), "invalid timestamp").when(F.col("said") == "", "missing cue text")
    b = b.withColumn("reason", reason)
    n = F.row_number().over(Window.partitionBy(key).orderBy("at"))
    good = b.where("reason is null").withColumn("cue_ord", n.cast("bigint"))
    source = F.when(F.col("indexed"), F.element_at("lines", 1).try_cast("bigint")).otherwise(F.col("at") + 1)
    cues = good.select(key, "cue_ord", F.format_string("SRT_%06d", "cue_ord").alias("cue_id"), source.alias("source_index"), "start_s", "end_s", F.col("said").alias("text"))
    return cues, b.where("reason is not null").select(key, (F.col("at") + 1).alias("block"), "reason")


PROBE = "format struct<format_name:string,duration:string>, streams array<struct<codec_type:string,codec_name:string,width:int,height:int,avg_frame_rate:string,channels:int,tags:struct<language:string>>>"


def probe_metadata(raw: DataFrame, key: str = "movie_id", json_col: str = "probe") -> DataFrame:
    """key, container, duration_s, codec, width, height, fps, n_audio, n_subtitles, languages, error, of probe output in JSON.

    Rates are written num/den; N/A and zero denominators are null; a file without video is an error.
    """
    x = raw.select(key, F.from_json(json_col, PROBE).alias("p"))
    of = lambda kind: F.filter("p.streams", lambda s: s["codec_type"] == kind)
    v = F.get(of("video"), 0)
    rate = F.try_divide(F.split(v["avg_frame_rate"], "/")[0].try_cast("double"), F.split(v["avg_frame_rate"], "/")[1].try_cast("double"))
    number = F.when(F.col("p.format.duration") != "N/A", F.col("p.format.duration").try_cast("double"))
    return x.select(
        key, F.col("p.format.format_name").alias("container"), number.alias("duration_s"), v["codec_name"].alias("codec"), v["width"].alias("width"), v["height"].alias("height"), rate.alias("fps"),
        F.size(of("audio")).alias("n_audio"), F.size(of("subtitle")).alias("n_subtitles"), F.array_sort(F.array_distinct(F.array_compact(F.transform(of("subtitle"), lambda s: s["tags"]["language"])))).alias("languages"),
        F.when(v.isNull(), "no_video_stream").alias("error"),
    )


def file_inventory(spark: SparkSession, path: str) -> DataFrame:
    """name, size, sha of the files under path."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return f.select(F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("size"), F.sha2("content", 256).alias("sha"))


def write_manifest(df: DataFrame, path: str, partition: str = "movie_id") -> None:
    """JSON lines by partition, keys in the order of their names, rows in a fixed order; only partitions that df has are replaced."""
    names = sorted(c for c in df.columns if c != partition)
    df.select(*names, partition).repartition(partition).sortWithinPartitions(partition, *names).write.option("partitionOverwriteMode", "dynamic").partitionBy(partition).mode("overwrite").json(path)


def canonical_cue_errors(cues: DataFrame) -> DataFrame:
    """Per title: cues with a bad or repeated id, without text, out of order, and the number of cues."""
    n = F.count(F.lit(1)).over(Window.partitionBy("movie_id", "cue_id"))
    before = F.lag("start_s").over(Window.partitionBy("movie_id").orderBy("cue_ord"))
    x = cues.withColumn("_n", n).withColumn("_b", before)
    return x.groupBy("movie_id").agg(F.count(F.lit(1)).alias("cues"), F.count_if(~F.col("cue_id").rlike(r"^SRT_\d{6}$")).alias("bad_ids"), F.count_if(F.col("_n") > 1).alias("repeated_ids"), F.count_if(F.trim(F.coalesce("text", F.lit(""))) == "").alias("empty"), F.count_if(F.col("start_s") < F.col("_b")).alias("out_of_order"))
