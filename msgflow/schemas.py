"""Fixed schemas of the engine's tables and frames."""

from pyspark.sql import types as T

HEADERS = T.MapType(T.StringType(), T.ArrayType(T.StringType()))

# One delivered message: what the streaming source and to_full_envelope return.
ENVELOPE = T.StructType(
    [
        T.StructField("subject", T.StringType()),
        T.StructField("replyTo", T.StringType()),
        T.StructField("content", T.BinaryType(), nullable=False),
        T.StructField("headers", HEADERS),
        T.StructField("domain", T.StringType()),
        T.StructField("stream", T.StringType()),
        T.StructField("consumer", T.StringType()),
        T.StructField("delivered", T.LongType()),
        T.StructField("streamSeq", T.LongType()),
        T.StructField("consumerSeq", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("pending", T.LongType()),
    ]
)

# On wish next to the envelope: the listener that a message was dealt to.
LISTENER = T.StructField("listener", T.LongType())

TEXT5 = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("subject", "dateTime", "content", "headers", "jsMetadata")]
)

TEXT3 = T.StructType([T.StructField(n, T.StringType()) for n in ("subject", "dateTime", "content")])

# What a micro-batch of a message log holds: the messages (after, upto] of each stream.
RANGES = T.StructType(
    [
        T.StructField("stream", T.StringType()),
        T.StructField("after", T.LongType()),
        T.StructField("upto", T.LongType()),
    ]
)

# What a publisher hands over.
SINK = T.StructType(
    [
        T.StructField("subject", T.StringType(), nullable=False),
        T.StructField("data", T.BinaryType(), nullable=False),
        T.StructField("headers", HEADERS),
    ]
)

# What the log stores; stream and batch are directory columns.
LOG = T.StructType(
    [
        T.StructField("subject", T.StringType()),
        T.StructField("content", T.BinaryType()),
        T.StructField("headers", HEADERS),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("streamSeq", T.LongType()),
        T.StructField("batch", T.StringType()),
        T.StructField("stream", T.StringType()),
    ]
)

DELIVERIES = T.StructType(
    [
        T.StructField("stream", T.StringType()),
        T.StructField("streamSeq", T.LongType()),
        T.StructField("delivered_at", T.TimestampType()),
        T.StructField("attempt", T.LongType()),
        T.StructField("consumer", T.StringType()),
        T.StructField("batch", T.StringType()),
    ]
)

ACKS = T.StructType(
    [
        T.StructField("stream", T.StringType()),
        T.StructField("streamSeq", T.LongType()),
        T.StructField("acked_at", T.TimestampType()),
        T.StructField("consumer", T.StringType()),
        T.StructField("batch", T.StringType()),
    ]
)
