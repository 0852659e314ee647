"""Windows, sorts and quantile bins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import classify, constants as K, geo
from ..operators import ranks
from .base import CHECKS, query
from .shapes import roads

SCHOOL = "unique_school_id"


@query(
    "w1_first_per_key",
    """
    select l_orderkey, l_quantity, l_linenumber, l_suppkey from lineitem
    qualify row_number() over (partition by l_orderkey order by l_quantity, l_linenumber, l_suppkey, l_partkey) = 1
    """,
)
def _(t):
    rows = t.lineitem.select("l_orderkey", "l_quantity", "l_linenumber", "l_suppkey", "l_partkey")
    return ranks.first_per_key(rows, ["l_orderkey"], ["l_quantity", "l_linenumber", "l_suppkey", "l_partkey"]).drop("l_partkey")


@query("w2_running_weight", "select unique_school_id, geoid, upto, everyone from o_running")
def _(t):
    rows = t.b_member.select(SCHOOL, "geoid", "income", "pop").filter("income is not null")
    return ranks.running_sum(rows, [SCHOOL], ["income", "geoid"], "pop", "upto", "everyone").select(
        SCHOOL, "geoid", "upto", "everyone"
    )


@query(
    "w3_crossing_rows",
    """
    select unique_school_id, max(income) filter (where upto <= everyone / 2) as last_below,
        min(income) filter (where upto > everyone / 2) as first_above
    from o_running group by 1
    """,
)
def _(t):
    rows = t.b_member.select(SCHOOL, "geoid", "income", "pop").filter("income is not null")
    upto = ranks.running_sum(rows, [SCHOOL], ["income", "geoid"], "pop", "upto", "everyone")
    low = F.col("upto") <= F.col("everyone") / 2
    return upto.groupBy(SCHOOL).agg(
        F.max(F.when(low, F.col("income"))).alias("last_below"),
        F.min(F.when(~low, F.col("income"))).alias("first_above"),
    )


@query(
    "w4_top_by_key",
    "select road, round(max_y, 7) as max_y from (select road, max(greatest(y1, y2)) as max_y from b_segment group by 1) order by max_y desc, road limit 1",
)
def _(t):
    tops = roads(t).select("road", geo.envelope("line")["max_y"].alias("max_y"))
    return tops.orderBy(F.desc("max_y"), "road").limit(1).select("road", F.round("max_y", 7).alias("max_y"))


CHECKS["o_edges"] = """
    select list_distinct([lo, q1, q2, q3, q4, hi]) as edges, [q1, q2, q3, q4] as inner_edges from (
        select min(income) as lo, quantile_cont(income, 0.2) as q1, quantile_cont(income, 0.4) as q2,
            quantile_cont(income, 0.6) as q3, quantile_cont(income, 0.8) as q4, max(income) as hi from b_member)"""


@query(
    "w5_quantile_bins",
    """
    select geoid, income, case when income is not null then
        len(list_filter(list_distinct(inner_edges), lambda e: e < income and e > edges_lo)) end as income_class
    from b_member, (select inner_edges, list_min(edges) as edges_lo from o_edges)
    """,
)
def _(t):
    bins = ranks.quantile_bins(t.b_member.select("geoid", "income"), "income", K.QUANTILE_BINS, "income_class")
    return bins.withColumn("income_class", F.col("income_class").cast("long"))


@query("w6_sorted_report", "select l_shipdate, count(*) as lines, sum(l_quantity) as quantity from lineitem group by 1")
def _(t):
    return (
        t.lineitem.groupBy("l_shipdate")
        .agg(F.count(F.lit(1)).alias("lines"), F.sum("l_quantity").alias("quantity"))
        .orderBy("l_shipdate")
    )


@query(
    "w7_first_appearance",
    "select event_type, min(event_id) as first_seen from events group by 1",
)
def _(t):
    return t.events.groupBy("event_type").agg(F.min("event_id").alias("first_seen")).orderBy("first_seen")
