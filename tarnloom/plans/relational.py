"""Relational coverage on the sales tables: joins of every kind, grouping sets, set operations, window frames."""

from __future__ import annotations

from tarnloom.tables import table

_NAMES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
_REVENUE = "round(sum(l_extendedprice * (1 - l_discount)), 2)"

#: The same text runs on both engines; each statement keeps to what both have.
_STATEMENTS = {
    "pricing_summary": f"SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, {_REVENUE} AS revenue, round(avg(l_discount), 6) AS avg_disc, count(*) AS n FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02 00:00:00' GROUP BY l_returnflag, l_linestatus",
    "shipping_priority": f"SELECT o_orderkey, o_orderpriority, {_REVENUE} AS revenue FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey WHERE c_mktsegment = 'BUILDING' GROUP BY o_orderkey, o_orderpriority ORDER BY revenue DESC, o_orderkey LIMIT 10",
    "regional_volume": f"SELECT r_name, n_name, {_REVENUE} AS revenue FROM region JOIN nation ON n_regionkey = r_regionkey JOIN supplier ON s_nationkey = n_nationkey JOIN lineitem ON l_suppkey = s_suppkey GROUP BY r_name, n_name",
    "forecast_revenue": "SELECT round(sum(l_extendedprice * l_discount), 2) AS revenue, count(*) AS n FROM lineitem WHERE l_discount BETWEEN 0.05 AND 0.07 AND l_quantity < 24",
    "customers_without_orders": "SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)",
    "customers_with_large_orders": "SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)",
    "order_distribution": "SELECT n_orders, count(*) AS n_customers FROM (SELECT c_custkey, count(o_orderkey) AS n_orders FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey) AS t GROUP BY n_orders",
    "supplier_customer_nations": "SELECT coalesce(s_nationkey, c_nationkey) AS nationkey, coalesce(ns, 0) AS suppliers, coalesce(nc, 0) AS customers FROM (SELECT s_nationkey, count(*) AS ns FROM supplier GROUP BY s_nationkey) AS s FULL OUTER JOIN (SELECT c_nationkey, count(*) AS nc FROM customer GROUP BY c_nationkey) AS c ON s_nationkey = c_nationkey",
    "revenue_cube": "SELECT coalesce(l_returnflag, '*') AS flag, coalesce(l_linestatus, '*') AS status, count(*) AS n, round(sum(l_quantity), 2) AS qty FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)",
    "priority_rollup": "SELECT coalesce(o_orderpriority, '*') AS priority, coalesce(o_orderstatus, '*') AS status, count(*) AS n FROM orders GROUP BY ROLLUP (o_orderpriority, o_orderstatus)",
    "segment_sets": "SELECT coalesce(c_mktsegment, '*') AS segment, coalesce(cast(c_nationkey AS varchar(10)), '*') AS nation, count(*) AS n FROM customer GROUP BY GROUPING SETS ((c_mktsegment), (c_nationkey), ())",
    "parts_both": "SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' INTERSECT SELECT l_partkey FROM lineitem WHERE l_quantity > 45",
    "parts_never_returned": "SELECT p_partkey FROM part EXCEPT SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R'",
    "all_keys": "SELECT 'customer' AS kind, count(*) AS n FROM customer UNION ALL SELECT 'supplier', count(*) FROM supplier UNION ALL SELECT 'part', count(*) FROM part",
    "order_rank": "SELECT o_custkey, o_orderkey, n FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS n FROM orders) AS t WHERE n <= 2",
    "running_total": "SELECT o_custkey, o_orderkey, round(sum(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 2) AS last_three FROM orders",
    "price_quartiles": "SELECT p_partkey, ntile(4) OVER (PARTITION BY p_brand ORDER BY p_retailprice, p_partkey) AS quartile, dense_rank() OVER (PARTITION BY p_brand ORDER BY p_size) AS size_rank FROM part",
    "brand_pairs": "SELECT a.p_brand, count(*) AS n FROM part a JOIN part b ON a.p_brand = b.p_brand AND a.p_size = b.p_size AND a.p_partkey < b.p_partkey AND b.p_partkey - a.p_partkey <= 100 GROUP BY a.p_brand",
    "late_suppliers": "SELECT s_suppkey, s_name, count(DISTINCT l_orderkey) AS orders FROM supplier JOIN lineitem ON s_suppkey = l_suppkey JOIN orders ON o_orderkey = l_orderkey WHERE l_shipdate > o_orderdate AND o_orderstatus = 'F' GROUP BY s_suppkey, s_name HAVING count(DISTINCT l_orderkey) > 1",
    "above_average": "SELECT c_custkey FROM customer AS c WHERE c_acctbal > (SELECT avg(c_acctbal) FROM customer AS d WHERE d.c_nationkey = c.c_nationkey)",
}


def _query(name: str):
    def run(spark, d):
        sql = _STATEMENTS[name]
        views = {n: table(spark, d, n) for n in _NAMES if n in sql}
        text = sql
        for n in views:
            text = _with_place(text, n)
        return spark.sql(text, **views)

    return run


def _with_place(sql: str, name: str) -> str:
    """Table names as parameters, so that no view is left in the session."""
    import re

    return re.sub(rf"(\b(?:FROM|JOIN)\s+){name}\b(?:\s+(?:AS\s+)?(?!ON\b|JOIN\b|WHERE\b|GROUP\b|ORDER\b|LEFT\b|FULL\b|INTERSECT\b|EXCEPT\b|UNION\b)(\w+))?", lambda m: f"{m[1]}{{{name}}} AS {m[2] or name}", sql)


QUERIES = {name: _query(name) for name in _STATEMENTS}
SQL = dict(_STATEMENTS)
