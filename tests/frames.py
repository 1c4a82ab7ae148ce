"""Small hand-made raw layers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vitrine.sources.raw import RawReader
from vitrine.sources.schemas import RAW, raw_schema


def raw_layer(spark: SparkSession, **tables: list[dict]) -> RawReader:
    """Raw tables from lists of partial rows; columns and tables left out are null or empty."""

    def read(table: str) -> DataFrame:
        schema = raw_schema(table)
        rows = [tuple(row.get(c) for c in schema.names) for row in tables.get(table, [])]
        return spark.createDataFrame(rows, schema)

    unknown = set(tables) - set(RAW)
    assert not unknown, unknown
    return read


def order(key: str, **more) -> dict:
    row = {
        "order_id": key,
        "customer_id": f"c-{key}",
        "order_status": "delivered",
        "order_purchase_timestamp": "2017-03-10 08:00:00",
        "order_delivered_customer_date": "2017-03-15 10:00:00",
        "order_estimated_delivery_date": "2017-03-20 00:00:00",
    }
    return row | more


def item(key: str, seller: str, price: float, number: int = 1, freight: float = 1.0) -> dict:
    return {
        "order_id": key,
        "order_item_id": number,
        "product_id": "p",
        "seller_id": seller,
        "price": price,
        "freight_value": freight,
    }


def payment(key: str, value: float, number: int = 1) -> dict:
    return {"order_id": key, "payment_sequential": number, "payment_value": value}


def review(key: str, score: int, review_id: str = "r") -> dict:
    return {"order_id": key, "review_id": review_id, "review_score": str(score)}


def one(df: DataFrame, **match):
    rows = [r for r in df.collect() if all(r[k] == v for k, v in match.items())]
    assert len(rows) == 1, rows
    return rows[0]
