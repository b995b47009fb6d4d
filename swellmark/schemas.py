"""Declared schemas. Every source is read with one of these; nothing is inferred."""

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


NEWS = _struct(
    GlobalEventID=T.LongType(),
    Day=T.StringType(),
    Country=T.StringType(),
    Tone=T.DoubleType(),
    SourceURL=T.StringType(),
)

#: News as `write_news` stores it: the parsed day, and the month as partition column.
STORED_NEWS = T.StructType(
    [
        *NEWS.fields,
        T.StructField("event_date", T.DateType(), True),
        T.StructField("event_month", T.IntegerType(), True),
    ]
)

#: Weekly and hourly price tables share one shape.
RATES = _struct(Date=T.TimestampNTZType(), Route=T.StringType(), Price=T.DoubleType())

DAILY_NEWS = _struct(event_date=T.DateType(), news_count=T.LongType(), avg_conflict_score=T.DoubleType())

GOLD = _struct(
    full_date=T.TimestampNTZType(),
    Price=T.DoubleType(),
    news_count=T.LongType(),
    avg_conflict_score=T.DoubleType(),
)

GOLD_BY_ROUTE = T.StructType([*GOLD.fields, T.StructField("Route", T.StringType(), True)])
