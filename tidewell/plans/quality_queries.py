"""Quality rules and dynamic views."""

from __future__ import annotations

import uuid

from pyspark.sql import Observation
from pyspark.sql import functions as F

from tidewell.operators import quality as Q
from tidewell.operators import tables as T
from tidewell.operators.reader_views import as_reader, close_memberships, create_reader_view
from tidewell.operators.security import masked_view, row_security
from tidewell.plans.common import CUSTOMERS_CTE, with_ctes
from tidewell.plans.registry import query
from tidewell.session import scratch_path
from tidewell.sources import shapes
from tidewell.sources.tables import read_table

ORDER_RULES = {"valid_price": "o_totalprice > 0", "valid_date": "o_orderdate >= TIMESTAMP '1990-01-01'"}
CUSTOMER_RULES = {"non_negative_balance": "c_acctbal >= 0", "known_nation": "c_nationkey BETWEEN 0 AND 24",
                  "named": "c_name IS NOT NULL"}
EVENT_RULES = {"valid_value": "value >= 1", "has_user": "user_id IS NOT NULL"}


@query("check_constraint", "SELECT * FROM orders")
def q_check_constraint(spark, d):
    return Q.check_constraint(read_table(spark, d, "orders"), ORDER_RULES)


@query("expect_fail", "SELECT * FROM orders")
def q_expect_fail(spark, d):
    return Q.expect_fail(read_table(spark, d, "orders"), ORDER_RULES)


@query("validate_existing", """
SELECT 'non_negative_balance' AS "constraint", count(*) FILTER (WHERE NOT coalesce(c_acctbal >= 0, true)) AS violations FROM customer
UNION ALL SELECT 'known_nation', count(*) FILTER (WHERE NOT coalesce(c_nationkey BETWEEN 0 AND 24, true)) FROM customer
UNION ALL SELECT 'named', count(*) FILTER (WHERE NOT coalesce(c_name IS NOT NULL, true)) FROM customer
""")
def q_validate_existing(spark, d):
    return Q.validate_existing(read_table(spark, d, "customer"), CUSTOMER_RULES)


@query("count_violations", """
SELECT count(*) FILTER (WHERE NOT coalesce(value >= 1, true)) AS valid_value,
       count(*) FILTER (WHERE NOT coalesce(user_id IS NOT NULL, true)) AS has_user
FROM events
""")
def q_count_violations(spark, d):
    return Q.count_violations(read_table(spark, d, "events"), EVENT_RULES)


@query("expect_drop", "SELECT event_id, user_id, value FROM events WHERE value >= 1 AND user_id IS NOT NULL")
def q_expect_drop(spark, d):
    e = read_table(spark, d, "events").select("event_id", "user_id", "value")
    return Q.expect_drop(e, EVENT_RULES, Observation("expect_drop"))


@query("expect_warn", "SELECT event_id, user_id, value FROM events")
def q_expect_warn(spark, d):
    e = read_table(spark, d, "events").select("event_id", "user_id", "value")
    return Q.expect_warn(e, EVENT_RULES, Observation("expect_warn"))


@query("assert_unique", "SELECT count(*) AS n_rows, count(DISTINCT c_custkey) AS n_keys, "
       "count(*) = count(DISTINCT c_custkey) AS is_unique FROM customer")
def q_assert_unique(spark, d):
    return Q.assert_unique(read_table(spark, d, "customer"), "c_custkey")


MASK_SQL = with_ctes(CUSTOMERS_CTE) + """
SELECT customer_id, {email} AS email, {name} AS name, country_code, segment, balance FROM cu {where}
"""


@query("masked_view", MASK_SQL.format(email="'REDACTED'", name="'REDACTED'", where=""))
def q_masked_view(spark, d):
    return masked_view(shapes.customers(spark, d), ["email", "name"], is_member=False)


@query("masked_view_admin", MASK_SQL.format(email="email", name="name", where=""))
def q_masked_view_admin(spark, d):
    return masked_view(shapes.customers(spark, d), ["email", "name"], is_member=True)


ALLOWED = "country_code = 6 AND balance > 0"


@query("row_security", MASK_SQL.format(email="'REDACTED'", name="'REDACTED'", where=f"WHERE {ALLOWED}"))
def q_row_security(spark, d):
    v = masked_view(shapes.customers(spark, d), ["email", "name"], is_member=False)
    return row_security(v, False, ALLOWED)


@query("row_security_admin", MASK_SQL.format(email="email", name="name", where=""))
def q_row_security_admin(spark, d):
    v = masked_view(shapes.customers(spark, d), ["email", "name"], is_member=True)
    return row_security(v, True, ALLOWED)


@query("masked_view_sql", MASK_SQL.format(email="'REDACTED'", name="'REDACTED'", where=f"WHERE {ALLOWED}"))
def q_masked_view_sql(spark, d):
    """The SQL form: a dynamic view whose CASE is folded once the role is bound."""
    shapes.customers(spark, d).createOrReplaceTempView("customers_base")
    member = "false"  # the caller's membership, resolved outside Spark
    spark.sql(f"""CREATE OR REPLACE TEMP VIEW customers_vw AS
        SELECT customer_id,
               CASE WHEN {member} THEN email ELSE 'REDACTED' END AS email,
               CASE WHEN {member} THEN name ELSE 'REDACTED' END AS name,
               country_code, segment, balance
        FROM customers_base
        WHERE CASE WHEN {member} THEN true ELSE {ALLOWED} END""")
    return spark.table("customers_vw")


# ---------------------------------------------------------------------------- views bound to the reader

GROUP_EDGES = [("segment BUILDING", "analysts"), ("analysts", "staff"), ("segment MACHINERY", "staff"), ("staff", "analysts of none")]
READER_SEGMENTS = ["BUILDING", "MACHINERY", "HOUSEHOLD"]


@query("reader_view", with_ctes(CUSTOMERS_CTE) + f"""
, readers AS (SELECT segment AS of_segment, min(name) AS reader FROM cu
              WHERE segment IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD') GROUP BY segment)
SELECT reader, customer_id, CASE WHEN of_segment = 'BUILDING' THEN email ELSE 'REDACTED' END AS email,
       CASE WHEN of_segment <> 'HOUSEHOLD' THEN name ELSE 'REDACTED' END AS name, country_code, segment, balance
FROM readers, cu
WHERE of_segment = 'BUILDING' OR (of_segment = 'MACHINERY' AND country_code = 6) OR balance > 9000
""")
def q_reader_view(spark, d):
    """One stored view, three readers.  Customers are members of their segment's group, and groups of groups."""
    base = shapes.customers(spark, d)
    tag = uuid.uuid4().hex[:10]
    source, members, view = (f"{n}_{tag}" for n in ("customers_all", "memberships", "customers_for_reader"))
    T.ctas(base, source)
    edges = (base.select(F.col("name").alias("member"), F.concat(F.lit("segment "), "segment").alias("grp"))
             .unionByName(spark.createDataFrame(GROUP_EDGES, "member string, grp string")))
    T.ctas(close_memberships(edges), members)
    create_reader_view(spark, view, source, members, masked={"email": "analysts", "name": "staff"},
                       rows=[("analysts", "true"), ("staff", "country_code = 6")], everyone="balance > 9000")
    readers = base.filter(F.col("segment").isin(READER_SEGMENTS)).groupBy("segment").agg(F.min("name").alias("reader"))
    path = scratch_path(spark, "seen-by")
    for r in readers.collect():                         # at most one row per named segment
        with as_reader(spark, r["reader"]):
            spark.table(view).withColumn("reader", F.lit(r["reader"])).write.mode("append").parquet(path)
    return spark.read.parquet(path)
