"""Small frames for tests."""

from pyspark.sql import functions as F

from msgflow.sources.sink import publish


def messages(spark, rows):
    """(subject, text) pairs as sink rows."""
    df = spark.createDataFrame(rows, "subject string, text string")
    return df.select("subject", F.encode("text", "UTF-8").alias("data"), F.lit(None).cast(
        "map<string,array<string>>").alias("headers"))


def numbered(spark, n, streams=1, subject="s.a"):
    """n messages dealt out to streams S-0, S-1, ..., in order of id."""
    return spark.range(n).select(
        "id",
        F.lit(subject).alias("subject"),
        F.encode(F.concat(F.lit("number "), F.col("id").cast("string")), "UTF-8").alias("data"),
        F.lit(None).cast("map<string,array<string>>").alias("headers"),
        F.concat(F.lit("S-"), (F.col("id") % streams).cast("string")).alias("stream"),
    )


def fill(log, n, streams=1, batch="b0", subject="s.a"):
    df = numbered(log.spark, n, streams, subject)
    return publish(log, df, F.col("stream"), batch, order_by=["id"])


def keys(df):
    return sorted((r["stream"], r["streamSeq"]) for r in df.select("stream", "streamSeq").collect())
