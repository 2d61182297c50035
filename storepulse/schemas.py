"""Explicit schemas; nothing in this library infers one from data."""

from __future__ import annotations

from pyspark.sql import types as T

TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "binary": T.BinaryType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def struct(fields: str) -> T.StructType:
    """Schema from ``name type, name type``, with no session needed to read it."""
    pairs = (field.split() for field in fields.split(","))
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in pairs])


# Fields of the four input files, in file order, and the column
# each one becomes.
SALES_FIELDS = {
    "id_transaccion": ("sale_id", "string"),
    "id_cliente": ("customer_id", "string"),
    "id_producto": ("product_id", "string"),
    "cantidad": ("quantity", "int"),
    "precio_unitario": ("unit_price", "double"),
    "monto_total": ("amount", "double"),
    "fecha": ("sold_at", "timestamp"),
    "tienda": ("store", "string"),
}
CUSTOMER_FIELDS = {
    "id_cliente": ("customer_id", "string"),
    "nombre": ("customer_name", "string"),
    "apellido": ("last_name", "string"),
    "edad": ("age", "int"),
    "ciudad": ("city", "string"),
    "segmento": ("segment", "string"),
    "email": ("email", "string"),
}
PRODUCT_FIELDS = {
    "id_producto": ("product_id", "string"),
    "nombre": ("product_name", "string"),
    "categoria": ("category", "string"),
    "precio": ("price", "double"),
    "stock_actual": ("stock", "int"),
    "stock_minimo": ("stock_minimum", "int"),
    "proveedor": ("supplier", "string"),
}
CAMPAIGN_FIELDS = {
    "id_campana": ("campaign_id", "string"),
    "nombre": ("campaign_name", "string"),
    "segmento_objetivo": ("segment", "string"),
    "canal": ("channel", "string"),
    "fecha_inicio": ("start_date", "date"),
    "fecha_fin": ("end_date", "date"),
    "descuento_porcentaje": ("discount_pct", "int"),
}

# The 17 fields of a sale message, as they appear in its JSON.
SALE_EVENT = struct(
    "event_id string, transaction_id string, customer_id string, product_id string, "
    "customer_name string, product_name string, category string, city string, "
    "store string, quantity int, unit_price double, total_amount double, "
    "stock_actual int, stock_minimo int, risk_score double, is_risk boolean, "
    "event_timestamp string"
)

# One superset schema for the four kinds of delivery message; the fields a kind
# does not carry stay NULL.
ORDER_EVENT = struct(
    "event_id string, order_id string, event_type string, district string, "
    "courier_id string, total_amount double, estimated_minutes int, item_count int, "
    "actual_minutes int, rating double, delay_minutes double, delay_reason string, "
    "cancel_reason string, event_timestamp string"
)

# A keyed message as a broker delivers it.
MESSAGE = struct("key binary, value binary, timestamp timestamp")

# The given parquet tables.
TABLES = {name: struct(fields) for name, fields in {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, "
            "p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
              "o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, "
                "l_linenumber int, l_quantity double, l_extendedprice double, "
                "l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string",
}.items()}

# Given tables that the sales model does not use.
MORE_TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def file_schema(fields: dict[str, tuple[str, str]]) -> T.StructType:
    """Schema of an input file under its own field names."""
    return struct(", ".join(f"{name} {kind}" for name, (_, kind) in fields.items()))
