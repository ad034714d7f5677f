"""Record schemas: Spark ``StructType``s and the matching Avro schemas.

The wire records are fixed by the job being modelled. Avro's binary encoding
carries neither record names nor namespaces, so only field names, order and
types below are fixed values; the namespace is ours.
"""

from __future__ import annotations

import json

from pyspark.sql import types as T

# ---- fixed values: field names and order of the wire records --------------
PRICE_TICK_FIELDS = [
    "field_date_application", "field_closing_price", "field_difference",
    "field_var_veille", "field_best_ask_size", "field_transact_time",
    "field_cours_cloture", "field_cours_ajuste", "field_cumul_titres_echanges",
    "field_best_bid_size", "field_capitalisation", "field_opening_price",
    "field_total_trades", "field_cours_courant", "field_best_ask_price",
    "sous_secteur", "ticker", "field_instrument_var_year", "field_var_pto",
    "field_last_traded_time", "label", "field_best_bid_price",
    "field_dynamic_reference_price", "field_static_reference_price",
    "field_low_price", "field_high_price", "field_cumul_volume_echange",
    "field_last_traded_price",
]
# The four tick fields the job reads.
TICK_OPEN = "field_opening_price"
TICK_CURRENT = "field_cours_courant"
TICK_TIME = "field_last_traded_time"
TICK_TICKER = "ticker"

WEIGHT_SNAPSHOT = T.StructType([
    T.StructField("timestamp", T.LongType(), False),
    T.StructField("portfolio_id", T.StringType(), False),
    T.StructField("weights", T.MapType(T.StringType(), T.DoubleType(), False), False),
])
WEIGHT_ROW = T.StructType([
    T.StructField("time", T.StringType(), False),
    T.StructField("portfolio_id", T.StringType(), False),
    T.StructField("ticker", T.StringType(), False),
    T.StructField("weight", T.StringType(), False),
])
PORTFOLIO_STATS = T.StructType([
    T.StructField("timestamp", T.LongType(), False),
    T.StructField("portfolio_id", T.StringType(), False),
    T.StructField("meanReturns", T.MapType(T.StringType(), T.DoubleType(), False), False),
    T.StructField("covarianceMatrix", T.MapType(
        T.StringType(), T.MapType(T.StringType(), T.DoubleType(), False), False), False),
])
# ``sharpRatio`` (sic) is part of the wire schema.
PORTFOLIO_METRICS = T.StructType([
    T.StructField("portfolioId", T.StringType(), False),
    T.StructField("risk", T.DoubleType(), False),
    T.StructField("expectedReturn", T.DoubleType(), False),
    T.StructField("sharpRatio", T.DoubleType(), False),
    T.StructField("timestamp", T.LongType(), False),
])
# ---- end of fixed values ----------------------------------------------------

PRICE_TICK = T.StructType([T.StructField(f, T.StringType(), False) for f in PRICE_TICK_FIELDS])

NAMESPACE = "tickrisk.records"


def _avro_type(dt: T.DataType):
    if isinstance(dt, T.StringType):
        return "string"
    if isinstance(dt, T.LongType):
        return "long"
    if isinstance(dt, T.DoubleType):
        return "double"
    if isinstance(dt, T.MapType):
        return {"type": "map", "values": _avro_type(dt.valueType)}
    raise TypeError(f"no Avro mapping for {dt}")


def avro_schema(name: str, st: T.StructType) -> str:
    """Avro record schema (JSON text) for a flat ``StructType``."""
    return json.dumps({
        "type": "record", "name": name, "namespace": NAMESPACE,
        "fields": [{"name": f.name, "type": _avro_type(f.dataType)} for f in st.fields],
    })


AVRO = {
    "price_tick": avro_schema("PriceTick", PRICE_TICK),
    "weight_snapshot": avro_schema("WeightSnapshot", WEIGHT_SNAPSHOT),
    "weight_row": avro_schema("WeightRow", WEIGHT_ROW),
    "portfolio_stats": avro_schema("PortfolioStats", PORTFOLIO_STATS),
    "portfolio_metrics": avro_schema("PortfolioMetrics", PORTFOLIO_METRICS),
}

STRUCTS = {
    "price_tick": PRICE_TICK,
    "weight_snapshot": WEIGHT_SNAPSHOT,
    "weight_row": WEIGHT_ROW,
    "portfolio_stats": PORTFOLIO_STATS,
    "portfolio_metrics": PORTFOLIO_METRICS,
}
