"""File and topic sources, batch and streaming.

A malformed record fails the job (``mode=FAILFAST``), as the source parser
throws on a bad line.  Schemas are explicit; nothing is inferred.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def _reader(spark: SparkSession, stream: bool):
    return spark.readStream if stream else spark.read


def read_lines(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """Text file(s), one string column ``value`` per line."""
    return _reader(spark, stream).text(path)


def read_records(spark: SparkSession, path: str, schema: StructType,
                 stream: bool = False, sep: str = ",") -> DataFrame:
    """Comma-delimited lines -> typed records; a bad line fails the job.

    An empty field of a string column becomes NULL (CSV reader rule).
    """
    return (_reader(spark, stream).schema(schema)
            .option("mode", "FAILFAST").option("sep", sep)
            .option("header", "false").csv(path))


def with_seq(df: DataFrame, name: str = "seq") -> DataFrame:
    """Arrival sequence for a *single-file, bounded* fixture input.

    ``monotonically_increasing_id`` follows file order within a partition;
    driver tables carry their own unique ids instead.
    """
    return df.withColumn(name, F.monotonically_increasing_id())


# fixed value: the access-log time layout the parser expects
ACCESS_LOG_TIME_FORMAT = "dd/MM/yyyy:HH:mm:ss"


def parse_access_log(lines: DataFrame, col: str = "value") -> DataFrame:
    """Space separated log line: fields 0 ip, 1 user, 3 time, 5 method, 6 url."""
    f = F.split(F.col(col), " ")
    return lines.select(
        f.getItem(0).alias("ip"),
        f.getItem(1).alias("user_id"),
        F.to_timestamp(f.getItem(3), ACCESS_LOG_TIME_FORMAT).alias("event_time"),
        f.getItem(5).alias("method"),
        f.getItem(6).alias("url"),
    )


def read_access_log(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    return parse_access_log(read_lines(spark, path, stream))


def read_topic(spark: SparkSession, servers: str, topic: str, group_id: str | None = None,
               starting_offsets: str = "latest", stream: bool = True) -> DataFrame:
    """Subscribe to a message topic; one string column ``value``.

    Needs the Kafka connector on the classpath (not bundled here).
    """
    r = (_reader(spark, stream).format("kafka")
         .option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic))
    if stream:
        r = r.option("startingOffsets", starting_offsets)
    if group_id:
        r = r.option("kafka.group.id", group_id)
    return topic_values(r.load())


def topic_values(raw: DataFrame) -> DataFrame:
    """The payload projection of a topic record: ``CAST(value AS STRING)``."""
    return raw.select(F.col("value").cast("string").alias("value"))
