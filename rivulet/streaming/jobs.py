"""Streaming forms of the jobs that need keyed state (ads, login failures).

The windowed jobs in ``rivulet.plans.jobs`` take streaming DataFrames as
they are (watermark + windowed aggregation in append mode). The two jobs
below need a keyed stateful operator first; it emits ``event_time`` as its
event-time column, so a windowed aggregation can follow it in the same query.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rivulet.functions.timefmt import duration_ms, duration_str
from rivulet.operators.topn import top_n
from rivulet.operators.windows import sliding_count
from rivulet.plans.jobs import url_counts
from rivulet.streaming.revisions import start_sliding_changelog
from rivulet.streaming.sinks import read_latest, upsert_latest
from rivulet.streaming.stateful import (
    CAP_MARKED,
    CAP_OUTPUT,
    CLICK,
    CLICK_NUMBERS,
    LOGIN_OUTPUT,
    ClickCapProcessor,
    ClickCapResetProcessor,
    LoginFailProcessor,
)

SHARDS = 256  # keys of a stateful operator: fixed for the life of a checkpoint


def _by_pair(df: DataFrame, shards: int):
    """Rows of (user_id, ad_id) by the shard of that pair, nulls as 0; each kind of null has shards of its own."""
    user, ad = F.col("user_id").cast("long"), F.col("ad_id").cast("long")
    kind = F.when(user.isNull(), 2).otherwise(0) + F.when(ad.isNull(), 1).otherwise(0)
    shard = F.pmod(F.xxhash64(user, ad), F.lit(shards)) + kind * shards
    rows = df.withColumn("shard", shard.cast("int"))
    return rows.withColumns({"user_id": F.coalesce(user, F.lit(0)), "ad_id": F.coalesce(ad, F.lit(0))}).groupBy("shard")


def _by_user(df: DataFrame, shards: int):
    """Rows by the shard of their user; those without one, as 0, are shard -1."""
    user = F.col("user_id").cast("long")
    shard = F.when(user.isNull(), -1).otherwise(F.pmod(F.xxhash64(user), F.lit(shards)))
    return df.withColumn("shard", shard.cast("int")).withColumn("user_id", F.coalesce(user, F.lit(0))).groupBy("shard")


def click_cap_stream(clicks: DataFrame, max_count: int = 100, watermark="0 seconds", earlier: DataFrame | None = None,
                     shards: int = SHARDS) -> DataFrame:
    """T1 + T2 on a stream: AdClickEvent rows tagged ``kind`` = 'pass' | 'warn' (with ``msg``).

    ``earlier``: ``operators.patterns.click_cap_state`` of a table of the clicks before the stream's; the cap goes on from it.
    ``shards``: into how many keys the (user, ad) pairs are dealt; a call handles a shard's rows of a micro-batch.
    """
    src = clicks.withWatermark("event_time", duration_str(watermark)).select(*CLICK)
    marks = [F.when(F.col(c).isNull(), 1 << i).otherwise(0) for i, c in enumerate(CLICK_NUMBERS)]
    src = src.withColumn("nulls", sum(marks, F.lit(0))).withColumns({c: F.coalesce(c, F.lit(0)) for c in ("ts", "seq")})
    tagged = _by_pair(src, shards).transformWithStateInPandas(
        ClickCapProcessor(max_count), CAP_MARKED, "append", "EventTime",
        initialState=None if earlier is None else _by_pair(earlier, shards), eventTimeColumnName="event_time")
    given = {c: F.when(F.col("nulls").bitwiseAND(1 << i) == 0, F.col(c)) for i, c in enumerate(CLICK_NUMBERS)}
    return tagged.withColumns(given).drop("nulls")


def click_cap_reset_stream(clicks: DataFrame, max_count: int = 100, reset="1 day") -> DataFrame:
    """T1 + T2 with the reference's processing-time reset: counts start anew at each multiple of ``reset`` of the clock.

    Open timers keep such a query going: run it under a processing-time trigger, not ``availableNow``.
    """
    return clicks.select(*CLICK).groupBy("user_id", "ad_id").transformWithStateInPandas(
        ClickCapResetProcessor(max_count, duration_ms(reset)), CAP_OUTPUT, "append", "ProcessingTime")


@dataclass
class AdStatisticsStream:
    by_province: DataFrame  # window_end, province, count
    blacklist: DataFrame  # user_id, ad_id, ts, msg


def ad_clicks_by_province_stream(clicks: DataFrame, max_count: int = 100, size="1 hour", slide="5 seconds",
                                 watermark="0 seconds") -> AdStatisticsStream:
    """The ads job on a stream. Each output is its own streaming query (own sink, own checkpoint)."""
    tagged = click_cap_stream(clicks, max_count, watermark)
    counts = sliding_count(tagged.where(F.col("kind") == "pass"), "province", "event_time", size, slide)
    by_province = counts.select("window_end", "province", "count")
    blacklist = tagged.where(F.col("kind") == "warn").select("user_id", "ad_id", "ts", "msg")
    return AdStatisticsStream(by_province, blacklist)


def start_url_revisions(logs: DataFrame, name: str, path: str, checkpoint: str | None = None, available_now: bool = False,
                        **windows) -> StreamingQuery:
    """URL counts per window in update mode, upserted under ``path``: a late row revises its windows' counts."""
    return upsert_latest(url_counts(logs, **windows), name, path, ["window_end", "url"], "count",
                         checkpoint=checkpoint, available_now=available_now)


def start_url_changelog(logs: DataFrame, name: str, path: str, top: int = 5, size="1 minute", slide="5 seconds", out_of_order="1 second",
                        allowed_lateness="60 seconds", checkpoint: str | None = None, available_now: bool = False) -> StreamingQuery:
    """The top URLs per window as a signed changelog under ``path``; a late row revises its windows' rankings."""
    delay = f"{duration_ms(out_of_order) + duration_ms(allowed_lateness)} milliseconds"
    return start_sliding_changelog(logs, name, path, "url", top, size, slide, delay, checkpoint=checkpoint, available_now=available_now)


def read_url_ranking(spark, path: str, top: int = 5) -> DataFrame:
    """The ranking of every window by the last revision of its counts: window_end, rank, url, count."""
    latest = read_latest(spark, path, ["window_end", "url"])
    return top_n(latest, "window_end", "url", "count", top).select("window_end", "rank", "url", "count")


def login_fail_warnings_stream(logins: DataFrame, max_fails: int = 2, within="2 seconds",
                               out_of_order="5 seconds", earlier: DataFrame | None = None, shards: int = SHARDS) -> DataFrame:
    """T4 on a stream (bounded out-of-orderness watermark, as the reference's 5 s).

    ``earlier``: ``operators.patterns.login_open_episodes`` of a table of the rows before the stream's; those episodes go on.
    ``shards``: into how many keys the users are dealt; a call handles a shard's rows of a micro-batch.
    """
    src = logins.withWatermark("event_time", duration_str(out_of_order)).select("user_id", "event_type", "event_time", "seq")
    return _by_user(src, shards).transformWithStateInPandas(
        LoginFailProcessor(max_fails, duration_ms(within)), LOGIN_OUTPUT, "append", "EventTime",
        initialState=None if earlier is None else _by_user(earlier, shards), eventTimeColumnName="event_time")


@dataclass
class AdPipeline:
    cap: StreamingQuery  # clicks -> tagged rows (pass / warn), parquet, exactly-once
    by_province: StreamingQuery  # tagged 'pass' rows -> sliding counts, parquet
    tagged_path: str
    by_province_path: str

    def blacklist(self, spark) -> DataFrame:
        return spark.read.parquet(self.tagged_path).where(F.col("kind") == "warn").select("user_id", "ad_id", "ts", "msg")


def start_ad_pipeline(clicks: DataFrame, root: str, max_count: int = 100, size="1 hour", slide="5 seconds",
                      watermark="0 seconds", checkpoint_root: str | None = None,
                      available_now: bool = False) -> AdPipeline:
    """The ads job with the keyed cap computed once for both outputs.

    Query 1 runs the stateful cap and appends its tagged rows to a parquet
    table (the file sink is exactly-once through its checkpoint and log).
    Query 2 streams that table into the sliding count by province; the
    blacklist is the table's 'warn' rows. Two independent queries on the
    clicks would each keep their own copy of the cap state.
    """
    import os

    from pyspark.sql.types import StructType

    from rivulet.session import checkpoint_dir

    spark = clicks.sparkSession
    ck = checkpoint_root or os.path.join(checkpoint_dir(spark), "streams", "ads")
    tagged_path, prov_path = os.path.join(root, "tagged"), os.path.join(root, "by_province")

    def run(w):
        return (w.trigger(availableNow=True) if available_now else w).start()

    # the second query may start before the first writes: create the table folder on the
    # (shared) file system first, through Hadoop's API so any scheme works
    jvm = spark.sparkContext._jvm  # noqa: SLF001
    hpath = jvm.org.apache.hadoop.fs.Path(tagged_path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(hpath)  # noqa: SLF001

    cap = run(click_cap_stream(clicks, max_count, watermark).writeStream.format("parquet")
              .option("path", tagged_path).option("checkpointLocation", os.path.join(ck, "cap")).outputMode("append"))
    if available_now:  # the second query ends with what it finds, so the first must be done
        cap.awaitTermination()
    tagged = (spark.readStream.schema(StructType.fromDDL(CAP_OUTPUT)).parquet(tagged_path)
              .withWatermark("event_time", duration_str(watermark)))
    counts = sliding_count(tagged.where(F.col("kind") == "pass"), "province", "event_time", size,
                           slide).select("window_end", "province", "count")
    by_prov = run(counts.writeStream.format("parquet").option("path", prov_path)
                  .option("checkpointLocation", os.path.join(ck, "by_province")).outputMode("append"))
    return AdPipeline(cap, by_prov, tagged_path, prov_path)
