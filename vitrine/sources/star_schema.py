"""Adapter: the nine raw tables derived from a wholesale star schema.

Every statement is plain SQL that Spark and other engines read alike; `{name}` stands for the
star-schema table. Each runs over whole tables and spreads keys, dates and states so that late,
canceled, unpaid and unreviewed orders all occur.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame, SparkSession

from vitrine.sources.raw import RawReader

STATE_TEXT = "SPRJMGRSPRSCBADFESGOPECEPAMTMAMSPBPIRNALSETOROAMZZ"

# columns the statements below use; declared, so that no job has to look into the files first
STAR_SCHEMA = {
    "orders": """
        o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,
        o_orderdate timestamp_ntz""",
    "lineitem": """
        l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,
        l_quantity double, l_extendedprice double, l_shipdate timestamp_ntz""",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double",
    "customer": "c_custkey bigint, c_nationkey int",
    "supplier": "s_suppkey bigint, s_nationkey int",
    "part": "p_partkey bigint, p_name string, p_type string, p_size int",
}

STAR_SQL: dict[str, tuple[list[str], str]] = {
    "orders": (
        ["orders"],
        """
        select md5(concat('o', cast(o_orderkey as string))) as order_id,
               md5(concat('c', cast(o_custkey as string))) as customer_id,
               case when o_orderstatus = 'F' then 'delivered'
                    when o_orderstatus = 'O' then case when o_orderkey % 4 = 0 then 'shipped' else 'delivered' end
                    when o_orderkey % 5 = 0 then 'canceled'
                    when o_orderkey % 5 = 1 then 'unavailable'
                    else 'processing' end as order_status,
               cast(o_orderdate + interval '1' second * ((o_orderkey * 7919) % 86400) as string) as order_purchase_timestamp,
               cast(o_orderdate + interval '1' second * ((o_orderkey * 7919) % 86400 + 3600) as string) as order_approved_at,
               case when o_orderstatus in ('F', 'O')
                    then cast(o_orderdate + interval '1' second * ((o_orderkey * 7919) % 86400 + 90000) as string)
                    end as order_delivered_carrier_date,
               case when (o_orderstatus = 'F' and o_orderkey % 200 <> 0) or (o_orderstatus = 'O' and o_orderkey % 4 <> 0)
                    then cast(o_orderdate + interval '1' second * (((o_orderkey * 37) % 40) * 86400 + (o_orderkey * 104729) % 86400 + 86400) as string)
                    end as order_delivered_customer_date,
               cast(o_orderdate + interval '1' day * (10 + o_orderkey % 25) as string) as order_estimated_delivery_date
        from {orders}""",
    ),
    "order_items": (
        ["lineitem"],
        """
        select md5(concat('o', cast(l_orderkey as string))) as order_id, l_linenumber as order_item_id,
               md5(concat('p', cast(l_partkey as string))) as product_id,
               md5(concat('s', cast(l_suppkey as string))) as seller_id,
               cast(l_shipdate as string) as shipping_limit_date, l_extendedprice as price, l_quantity as freight_value
        from {lineitem}""",
    ),
    "order_payments": (
        ["orders"],
        """
        select md5(concat('o', cast(o_orderkey as string))) as order_id, 1 as payment_sequential,
               'credit_card' as payment_type, cast(1 + o_orderkey % 10 as int) as payment_installments,
               o_totalprice as payment_value
        from {orders} where o_orderkey % 97 <> 0
        union all
        select md5(concat('o', cast(o_orderkey as string))), 2, 'voucher', 1, 12.5
        from {orders} where o_orderkey % 3 = 0 and o_orderkey % 97 <> 0""",
    ),
    "order_reviews": (
        ["events"],
        """
        select md5(concat('r', cast(event_id - case when event_id % 100 = 1 then 1 else 0 end as string))) as review_id,
               md5(concat('o', cast(event_id - case when event_id % 10 = 9 then 1 else 0 end as string))) as order_id,
               cast(1 + cast(floor(value) as bigint) % 5 as string) as review_score,
               cast(null as string) as review_comment_title, event_type as review_comment_message,
               cast(ts as string) as review_creation_date, cast(ts as string) as review_answer_timestamp
        from {events}""",
    ),
    "customers": (
        ["customer"],
        f"""
        select md5(concat('c', cast(c_custkey as string))) as customer_id,
               md5(concat('u', cast(c_custkey - c_custkey % 2 as string))) as customer_unique_id,
               lpad(cast(c_custkey % 150 as string), 5, '0') as customer_zip_code_prefix,
               concat('city_', cast(c_custkey % 50 as string)) as customer_city,
               substr('{STATE_TEXT}', 1 + 2 * c_nationkey, 2) as customer_state
        from {{customer}}""",
    ),
    "sellers": (
        ["supplier"],
        f"""
        select md5(concat('s', cast(s_suppkey as string))) as seller_id,
               lpad(cast(s_suppkey % 150 as string), 5, '0') as seller_zip_code_prefix,
               concat('city_', cast(s_suppkey % 50 as string)) as seller_city,
               substr('{STATE_TEXT}', 1 + 2 * s_nationkey, 2) as seller_state
        from {{supplier}}
        union all
        select md5(concat('x', cast(s_suppkey as string))), '00000', 'city_0', 'SP'
        from {{supplier}} where s_suppkey % 10 = 0""",
    ),
    "products": (
        ["part"],
        """
        select md5(concat('p', cast(p_partkey as string))) as product_id, lower(p_type) as product_category_name,
               cast(length(p_name) as string) as product_name_lenght,
               cast(length(p_name) * 10 as string) as product_description_lenght,
               cast(1 + p_size % 4 as string) as product_photos_qty, p_size * 100 as product_weight_g,
               p_size as product_length_cm, p_size + 1 as product_height_cm, p_size + 2 as product_width_cm
        from {part}""",
    ),
    "geolocation": (
        ["events"],
        f"""
        select lpad(cast(user_id as string), 5, '0') as geolocation_zip_code_prefix,
               value / 10 - 33 as geolocation_lat, -(event_id % 3600) / 100.0e0 - 34 as geolocation_lng,
               concat('city_', cast(user_id % 50 as string)) as geolocation_city,
               substr('{STATE_TEXT}', cast(1 + 2 * (user_id % 25) as int), 2) as geolocation_state
        from {{events}}""",
    ),
    "category_translation": (
        ["part"],
        """
        select distinct lower(p_type) as product_category_name,
               concat('en_', lower(p_type)) as product_category_name_english
        from {part}""",
    ),
}


# the same rows from one scan, in words that only Spark knows
ONE_SCAN = {
    "order_payments": """
        select md5(concat('o', cast(o_orderkey as string))) as order_id,
               inline(filter(array(
                   struct(1 as payment_sequential, 'credit_card' as payment_type,
                          cast(1 + o_orderkey % 10 as int) as payment_installments, o_totalprice as payment_value),
                   struct(2 as payment_sequential, 'voucher' as payment_type, 1 as payment_installments,
                          12.5d as payment_value)), p -> p.payment_sequential = 1 or o_orderkey % 3 = 0))
        from {orders} where o_orderkey % 97 <> 0""",
}


def read_star_table(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """One star-schema table, as its files lie."""
    return spark.read.schema(STAR_SCHEMA[table]).parquet(f"{folder}/{table}.parquet")


def star_schema(spark: SparkSession, folder: str) -> RawReader:
    """Raw tables computed from the star schema's parquet files in `folder`."""
    star_table = cache(lambda table: read_star_table(spark, folder, table))

    @cache
    def read(table: str) -> DataFrame:
        tables, sql = STAR_SQL[table]
        return spark.sql(ONE_SCAN.get(table, sql), **{t: star_table(t) for t in tables})

    return read
