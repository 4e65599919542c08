"""Record types of the event streams, declared by hand (never inferred).

Times stay epoch numbers at the edge, as in the source records; operators turn
them into TIMESTAMP columns with ``functions.timecols.event_time``.
"""

from pyspark.sql.types import (IntegerType, LongType, StringType, StructField,
                               StructType, TimestampType)


def _schema(*fields):
    return StructType([StructField(n, t, True) for n, t in fields])


WATER_SENSOR = _schema(("id", StringType()), ("ts", LongType()), ("vc", IntegerType()))

USER_BEHAVIOR = _schema(("user_id", LongType()), ("item_id", LongType()),
                        ("category_id", IntegerType()), ("behavior", StringType()),
                        ("ts", LongType()))

MARKETING_USER_BEHAVIOR = _schema(("user_id", LongType()), ("behavior", StringType()),
                                  ("channel", StringType()), ("ts_ms", LongType()))

AD_CLICK = _schema(("user_id", LongType()), ("ad_id", LongType()), ("province", StringType()),
                   ("city", StringType()), ("ts", LongType()))

ORDER_EVENT = _schema(("order_id", LongType()), ("event_type", StringType()),
                      ("tx_id", StringType()), ("event_time", LongType()))

TX_EVENT = _schema(("tx_id", StringType()), ("pay_channel", StringType()),
                   ("event_time", LongType()))

LOGIN_EVENT = _schema(("user_id", LongType()), ("ip", StringType()),
                      ("event_type", StringType()), ("event_time", LongType()))

APACHE_LOG = _schema(("ip", StringType()), ("user_id", StringType()),
                     ("event_time", TimestampType()), ("method", StringType()),
                     ("url", StringType()))

HOT_ITEM_COUNT = _schema(("item_id", LongType()), ("item_count", LongType()),
                         ("window_end", TimestampType()))

HOT_PAGE_VIEW = _schema(("url", StringType()), ("view_count", LongType()),
                        ("window_end", TimestampType()))
