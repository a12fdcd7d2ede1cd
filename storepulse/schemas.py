"""Record schemas: wire (JSON) forms and typed tables."""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()
L = T.LongType()
I = T.IntegerType()
D = T.DoubleType()


def _struct(fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Startup log as posted by the app; ``ts`` is set by the collector. ``log_id`` is an
# optional collector sequence number used only to break ties between equal ``ts``.
STARTUP_WIRE = _struct([
    ("type", S), ("mid", S), ("uid", S), ("os", S), ("appid", S), ("area", S),
    ("ch", S), ("vs", S), ("ts", L), ("log_id", L),
])

# Event log (add to cart, click, ...): parsed and routed, never aggregated.
EVENT_WIRE = _struct([
    ("type", S), ("mid", S), ("uid", S), ("os", S), ("appid", S), ("area", S),
    ("evid", S), ("pgid", I), ("npgid", I), ("itemid", I), ("ts", L), ("log_id", L),
])

# Any log line seen by the collector: the union of both kinds.
LOG_WIRE = _struct([
    ("type", S), ("mid", S), ("uid", S), ("os", S), ("appid", S), ("area", S),
    ("ch", S), ("vs", S), ("evid", S), ("pgid", I), ("npgid", I), ("itemid", I),
    ("ts", L), ("log_id", L),
])

# Typed startup record (the ``dau`` table), wire ``type`` mapped to ``log_type``.
STARTUP = _struct([
    ("mid", S), ("uid", S), ("appid", S), ("area", S), ("os", S), ("ch", S),
    ("log_type", S), ("vs", S), ("log_date", S), ("log_hour", S),
    ("log_hour_minute", S), ("ts", L), ("log_id", L),
])

# Order message fields (lowerCamelCase on the wire, every value a string there).
ORDER_FIELDS = [
    "area", "consignee", "orderComment", "consigneeTel", "operateTime", "orderStatus",
    "paymentWay", "userId", "imgUrl", "totalAmount", "expireTime", "deliveryAddress",
    "createTime", "trackingNo", "parentOrderId", "outTradeNo", "id", "tradeBody",
]
ORDER_WIRE = _struct([(n, S) for n in ORDER_FIELDS])

# Row-change envelope of the database change stream.
CDC_COLUMN = _struct([("name", S), ("value", S)])
CDC_ENVELOPE = _struct([
    ("entry_type", S), ("table", S), ("type", S),
    ("rows", T.ArrayType(T.ArrayType(CDC_COLUMN))),
])

# Daily sale detail (warehouse wide table, one partition per ``dt``).
SALE = _struct([
    ("user_id", S), ("sku_id", S), ("user_gender", S), ("user_age", I), ("user_level", S),
    ("sku_price", D), ("sku_name", S), ("sku_tm_id", S), ("sku_category1_id", S),
    ("sku_category2_id", S), ("sku_category3_id", S), ("sku_category1_name", S),
    ("sku_category2_name", S), ("sku_category3_name", S), ("spu_id", S), ("sku_num", L),
    ("order_count", L), ("order_amount", D), ("dt", S),
])


def ddl(schema: T.StructType) -> str:
    return schema.simpleString()[len("struct<"):-1]
