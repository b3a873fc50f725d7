"""Table and message schemas of the data contract."""

from pyspark.sql import types as T


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


MESSAGE = _schema(did=T.StringType(), createdAt=T.StringType(), text=T.StringType())

# One event of the raw feed; only the fields that are read.
RECORD = T.StructType(
    [
        T.StructField("$type", T.StringType(), True),
        T.StructField("createdAt", T.StringType(), True),
        T.StructField("text", T.StringType(), True),
    ]
)
RAW_EVENT = _schema(did=T.StringType(), commit=_schema(record=RECORD))

POSTS = _schema(
    post_id=T.LongType(),
    post_uuid=T.StringType(),
    did=T.StringType(),
    text=T.StringType(),
    created_at=T.TimestampType(),
    language=T.StringType(),
    sfw=T.BooleanType(),
    sentiment_score=T.DoubleType(),  # confidence of the winning label, not a polarity
    sentiment_label=T.StringType(),
    keywords=T.StringType(),  # JSON: [["phrase", score], ...]
)

KEYWORD_TRENDS = _schema(
    keyword=T.StringType(),
    period_start=T.TimestampType(),
    period_end=T.TimestampType(),
    post_count=T.LongType(),
    avg_sentiment_score=T.DoubleType(),
    sentiment_label=T.StringType(),
)
# Folders of a streamed posts table.
POST_DATE, POST_HOUR, BATCH = "post_date", "post_hour", "batch_id"
STREAMED_POSTS = T.StructType([*POSTS.fields, T.StructField(POST_DATE, T.DateType(), True)])

# Hourly sums of posts and sketches of their authors; the last column names folders.
ROLLUPS = _schema(
    period_start=T.TimestampType(),
    label=T.StringType(),
    flag=T.StringType(),
    lang=T.StringType(),
    n=T.LongType(),
    users=T.BinaryType(),
    period_day=T.StringType(),
)

TREND_KEY = ("keyword", "period_start", "sentiment_label")

RAW_POSTS = _schema(post_id=T.LongType(), did=T.StringType(), text=T.StringType(), created_at=T.TimestampType())
KEYWORDS = _schema(keyword_id=T.LongType(), keyword_name=T.StringType())
POST_KEYWORDS = _schema(post_id=T.LongType(), keyword_id=T.LongType())

SENTIMENT = _schema(label=T.StringType(), score=T.DoubleType())
KEYPHRASES = T.ArrayType(_schema(keyword=T.StringType(), score=T.DoubleType()))
STORED_KEYWORDS = T.ArrayType(T.ArrayType(T.StringType()))
