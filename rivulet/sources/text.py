"""Line sources (S1) and the Kafka string source.

A bounded file is read once with ``spark.read.text``; a stream is a directory
watched by ``readStream.text``. Both give one ``value`` string column, which
the parsers in ``rivulet.sources.records`` turn into typed rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_lines(spark: SparkSession, path: str, streaming: bool = False, max_files_per_trigger: int | None = None) -> DataFrame:
    if not streaming:
        return spark.read.text(path)
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def kafka_available(spark: SparkSession) -> bool:
    """The Kafka connector is a separate package; probe the class loader that also sees ``spark.jars``."""
    jvm = spark.sparkContext._jvm  # noqa: SLF001 - classpath probe only
    try:
        jvm.java.lang.Thread.currentThread().getContextClassLoader().loadClass("org.apache.spark.sql.kafka010.KafkaSourceProvider")
        return True
    except Exception:  # noqa: BLE001
        return False


def read_kafka(
    spark: SparkSession,
    bootstrap_servers: str,
    topic: str,
    starting_offsets: str = "latest",
    group_id: str | None = None,
    streaming: bool = True,
) -> DataFrame:
    """Topic values as strings, in a ``value`` column (same shape as ``read_lines``)."""
    if not kafka_available(spark):
        raise RuntimeError("the spark-sql-kafka connector is not on the classpath")
    reader = spark.readStream if streaming else spark.read
    reader = (reader.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers)
              .option("subscribe", topic).option("startingOffsets", starting_offsets))
    if group_id:
        reader = reader.option("kafka.group.id", group_id)
    return reader.load().selectExpr("CAST(value AS STRING) AS value")


def write_kafka(df: DataFrame, bootstrap_servers: str, topic: str) -> None:
    """K2: replay lines (a ``value`` string column) into a topic, as a batch write.

    Needs the spark-sql-kafka connector; without it this raises rather than
    silently doing nothing. (The reference configured a deserializer on its
    producer; the connector serializes ``value`` itself.)
    """
    if not kafka_available(df.sparkSession):
        raise RuntimeError("the spark-sql-kafka connector is not on the classpath")
    (df.selectExpr("CAST(value AS STRING) AS value").write.format("kafka")
     .option("kafka.bootstrap.servers", bootstrap_servers).option("topic", topic).save())
