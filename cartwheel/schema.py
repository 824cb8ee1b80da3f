"""Schemas and the fixed values that outputs must reproduce exactly."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values.  These must equal what the original pipeline writes, because
# downstream readers (key-value consumers, text-line readers) depend on them.
#   event types ........ click, add_to_cart, purchase, delivery_status
#   unknown category ... desconhecida
#   key-value family ... cf
#   key-value tables ... insights_categoria, insights_cidade, flink_alertas
#   category cells ..... faturamento, unidades_vendidas
#   city cells ......... faturamento, pedidos
#   alert cells ........ produto, eventos, janela_inicio, janela_fim
#   city row key ....... <state>#<city>
#   alert row key ...... <product>-<window start epoch millis>
#   trending line ...... janela=[<start> -> <end>] produto=<product> eventos=<n>
#   alert threshold .... 5 events per window and product
#   window / slide ..... 60 s / 30 s, watermark delay 40 s
#   original insight table and column names (served as views):
#     faturamento_categoria: category, faturamento, unidades_vendidas
#     faturamento_cidade: city, state, faturamento, pedidos
#     abandono_carrinho: sessoes_com_carrinho, sessoes_que_compraram, taxa_abandono_pct
#     status_entrega: delivery_status, total
# ---------------------------------------------------------------------------
CLICK = "click"
ADD_TO_CART = "add_to_cart"
PURCHASE = "purchase"
DELIVERY_STATUS = "delivery_status"

UNKNOWN_CATEGORY = "desconhecida"

KV_FAMILY = "cf"
KV_TABLE_CATEGORY = "insights_categoria"
KV_TABLE_CITY = "insights_cidade"
KV_TABLE_ALERTS = "flink_alertas"
CATEGORY_CELLS = {"revenue": "faturamento", "units": "unidades_vendidas"}
CITY_CELLS = {"revenue": "faturamento", "orders": "pedidos"}
ALERT_CELLS = {
    "product_id": "produto",
    "events": "eventos",
    "window_start_iso": "janela_inicio",
    "window_end_iso": "janela_fim",
}
ORIGINAL_INSIGHT_NAMES = {
    "revenue_by_category": ("faturamento_categoria", {"revenue": "faturamento", "units": "unidades_vendidas"}),
    "revenue_by_city": ("faturamento_cidade", {"revenue": "faturamento", "orders": "pedidos"}),
    "cart_abandonment": (
        "abandono_carrinho",
        {
            "sessions_with_cart": "sessoes_com_carrinho",
            "sessions_bought": "sessoes_que_compraram",
            "abandonment_pct": "taxa_abandono_pct",
        },
    ),
    "delivery_status": ("status_entrega", {}),
}
TRENDING_LINE_FORMAT = "janela=[%s -> %s] produto=%s eventos=%d"
ALERT_THRESHOLD = 5
WINDOW_SIZE = "60 seconds"
WINDOW_SLIDE = "30 seconds"
WATERMARK_DELAY = "40 seconds"

CORRUPT_COLUMN = "_corrupt_record"

ITEM_SCHEMA = T.StructType(
    [
        T.StructField("product_id", T.StringType()),
        T.StructField("quantity", T.DoubleType()),
        T.StructField("price", T.DoubleType()),
    ]
)
NUMBERS = ("price", "quantity", "total")

# One wide schema for every event type; fields a type does not carry are NULL.
EVENT_FIELDS = [
    ("event_id", T.StringType()),
    ("event_type", T.StringType()),
    ("event_time", T.StringType()),
    ("ingest_time", T.StringType()),
    ("user_id", T.StringType()),
    ("session_id", T.StringType()),
    ("city", T.StringType()),
    ("state", T.StringType()),
    ("device", T.StringType()),
    ("product_id", T.StringType()),
    ("category", T.StringType()),
    ("price", T.DoubleType()),
    ("quantity", T.DoubleType()),
    ("order_id", T.StringType()),
    ("items", T.ArrayType(ITEM_SCHEMA)),
    ("total", T.DoubleType()),
    ("payment", T.StringType()),
    ("delivery_status", T.StringType()),
    ("carrier", T.StringType()),
]
EVENT_SCHEMA = T.StructType([T.StructField(n, t) for n, t in EVENT_FIELDS])
EVENT_SCHEMA_WITH_CORRUPT = T.StructType(
    EVENT_SCHEMA.fields + [T.StructField(CORRUPT_COLUMN, T.StringType())]
)

# What a line is parsed with: numbers as their text (an integer, a fraction
# and a quoted number are all valid), cast to double afterwards.
_ITEM_TEXT = T.StructType([T.StructField(f.name, T.StringType()) for f in ITEM_SCHEMA.fields])
EVENT_TEXT_SCHEMA = T.StructType(
    [
        T.StructField(n, T.ArrayType(_ITEM_TEXT) if n == "items" else T.StringType())
        for n in [*EVENT_SCHEMA.names, CORRUPT_COLUMN]
    ]
)

# The three fields the trending stream needs from a line.
STREAM_FIELDS = T.StructType(
    [
        T.StructField("event_type", T.StringType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("event_time", T.StringType()),
    ]
)

# Output schemas of the four insights.
CATEGORY_OUT = "category string, revenue double, units bigint"
CITY_OUT = "city string, state string, revenue double, orders bigint"
ABANDONMENT_OUT = "sessions_with_cart bigint, sessions_bought bigint, abandonment_pct double"
STATUS_OUT = "delivery_status string, total bigint"

# Long-form key-value cell.
KV_CELL_SCHEMA = T.StructType(
    [
        T.StructField("table", T.StringType()),
        T.StructField("row_key", T.StringType()),
        T.StructField("column", T.StringType()),
        T.StructField("value", T.StringType()),
    ]
)
