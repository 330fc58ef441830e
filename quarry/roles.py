"""Role views: the reference's inputs (ratings, movies, reviews, shop tables)
expressed over the driver's parquet tables.

Each role is one SQL text with `{table}` placeholders. Spark runs it through
`spark.sql(text, table=DataFrame)`; the DuckDB oracle runs the same text with
the placeholders replaced by the pre-registered view names, so both engines
see identical inputs. Every role keeps every row of its tables. The modulo
expressions are part of the fixture design: they change some lookup keys so
that facts without a match occur, and make genders outside M/F, boundary and
missing ages and junk scores that the clean tables lack.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

ROLE_SQL: dict[str, str] = {
    "ratings": """
        SELECT o_custkey AS user_id, l_partkey AS movie_id, l_quantity AS rating, o_orderdate AS rated_at
        FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey""",
    "movies": """
        SELECT CASE WHEN p_partkey % 11 = 0 THEN -1 - p_partkey ELSE p_partkey END AS movie_id,
               concat(p_name, ' #', CAST(p_partkey AS STRING)) AS title,
               concat_ws('|', p_type, p_brand, split_part(p_name, ' ', 1)) AS genres
        FROM {part}""",
    "users": """
        SELECT CASE WHEN c_custkey % 13 = 0 THEN -1 - c_custkey ELSE c_custkey END AS user_id,
               CASE c_custkey % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'F' ELSE 'X' END AS gender,
               CAST(10 + c_custkey % 60 AS INT) AS age, c_nationkey AS occupation_id
        FROM {customer}""",
    "occupations": """
        SELECT CASE WHEN n_nationkey % 7 = 0 THEN -1 - n_nationkey ELSE n_nationkey END AS occupation_id,
               n_name AS occupation
        FROM {nation}""",
    "text_users": """
        SELECT CAST(c_custkey AS STRING) AS user_id, CASE c_custkey % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'F' ELSE 'X' END AS gender,
               CASE WHEN c_custkey % 5 = 0 OR c_custkey % 7 = 0 THEN NULL ELSE CAST(10 + c_custkey % 60 AS INT) END AS age,
               CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 3 = 0 THEN lpad(CAST(c_nationkey AS STRING), 3, '0')
                    WHEN c_custkey % 3 = 1 THEN CAST(c_nationkey AS STRING) ELSE concat('K', CAST(c_nationkey AS STRING)) END AS occupation_id
        FROM {customer}""",
    "text_occupations": """
        SELECT CAST(n_nationkey AS STRING) AS occupation_id, concat(n_name, ' 1') AS occupation FROM {nation}
        UNION ALL SELECT lpad(CAST(n_nationkey AS STRING), 3, '0'), concat(n_name, ' 2') FROM {nation}
        UNION ALL SELECT concat('K', CAST(n_nationkey AS STRING)), concat(n_name, ' 3') FROM {nation}""",
    "reviews": """
        SELECT d.doc_id AS id, d.text AS review, d.lang AS topic, d.source AS aspect,
               CASE WHEN l.quality = 1 AND d.doc_id % 5 = 0 THEN ' Positive ' WHEN l.quality = 1 THEN 'positive'
                    WHEN l.quality = 0 AND d.doc_id % 5 = 0 THEN ' Negative ' WHEN l.quality = 0 THEN 'negative' END AS sentiment
        FROM {documents} d LEFT JOIN {labels} l ON d.doc_id = l.doc_id""",
    "stopwords": """
        SELECT * FROM (VALUES ('the'), ('of'), ('de'), ('and'), ('to'), ('in'), ('la'), ('a'), ('der'), ('is'),
                              ('the'), ('such as')) AS t(word)""",
    "shop_orders": """
        SELECT o_orderkey AS order_id, o_custkey AS customer_trx_id, o_orderdate AS purchase_ts,
               CASE WHEN o_orderstatus <> 'O' THEN o_orderdate + INTERVAL 30 DAY END AS carrier_date
        FROM {orders}""",
    "shop_customers": """
        SELECT CASE WHEN c_custkey % 17 = 0 THEN -1 - c_custkey ELSE c_custkey END AS customer_trx_id, n_name AS country
        FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey""",
    "shop_items": """
        SELECT l_orderkey AS order_id, l_partkey AS product_id, l_suppkey AS seller_id,
               CAST(l_extendedprice AS DECIMAL(18,2)) AS price, CAST(l_quantity AS DECIMAL(18,2)) AS freight,
               CASE WHEN l_linenumber <> 7 THEN l_shipdate END AS shipping_limit_date
        FROM {lineitem}""",
    "shop_products": """
        SELECT CASE WHEN p_partkey % 19 = 0 THEN -1 - p_partkey ELSE p_partkey END AS product_id, p_type AS category
        FROM {part}""",
    "shop_reviews": """
        SELECT event_id AS review_id,
               CASE WHEN event_id % 10 = 0 THEN 'n/a' ELSE regexp_extract(props, '([0-9]+)', 1) END AS review_score
        FROM {events}""",
}

_PLACEHOLDER = re.compile(r"\{(\w+)\}")

# Declared schemas of the driver tables (as stored in their parquet files).
# A declared schema skips the footer-reading job at every read and keeps a
# changed file layout from silently changing column types.
TABLE_SCHEMAS: dict[str, str] = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table, read from parquet with its declared schema (tables
    without one fall back to the footer schema)."""
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def role(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A role view as a Spark DataFrame over the tables in `sf_dir`."""
    text = ROLE_SQL[name]
    tables = {t: table(spark, sf_dir, t) for t in set(_PLACEHOLDER.findall(text))}
    return spark.sql(text, **tables)


def role_cte(*names: str) -> str:
    """`WITH` clause defining the given roles over plain table names (oracle side)."""
    parts = [f"{n} AS ({_PLACEHOLDER.sub(lambda m: m.group(1), ROLE_SQL[n])})" for n in names]
    return "WITH " + ",\n".join(parts) + "\n"
