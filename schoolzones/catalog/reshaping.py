"""Set operations and reshaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import constants as K
from ..operators import aggregates, reshape
from ..plans import layers
from .base import query
from .grouping import indexed_schools


@query(
    "u1_union_all",
    "select c_custkey as id, c_acctbal as balance from customer union all select s_suppkey, s_acctbal from supplier",
)
def _(t):
    a = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance"))
    return a.unionByName(t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("balance")))


@query(
    "u2_concat_by_name",
    """
    select c_custkey as id, c_acctbal as balance, c_mktsegment as segment, null as nation from customer
    union all select s_suppkey, s_acctbal, null, s_nationkey from supplier
    """,
)
def _(t):
    a = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    b = t.supplier.select(F.col("s_nationkey").alias("nation"), F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("balance"))
    return reshape.concat(a, b)


@query(
    "u3_missing_keys",
    "select c_custkey as key from customer except select o_custkey from orders where o_totalprice > 200000",
)
def _(t):
    asked = t.customer.select(F.col("c_custkey").alias("key"))
    return reshape.missing_keys(asked, t.orders.filter("o_totalprice > 200000").select(F.col("o_custkey").alias("key")), "key")


@query("u4_distinct_rows", "select distinct school_id, course_number, course_title from b_course")
def _(t):
    return t.b_course.select("school_id", "course_number", "course_title").distinct()


@query("u5_distinct_keys", "select distinct l_suppkey from lineitem")
def _(t):
    return t.lineitem.select("l_suppkey").distinct()


@query("r1_unpivot_groups", "select school as unique_school_id, locale, race, round(ri, 6) as ri from o_indexed_long")
def _(t):
    rows = layers.race_rows(indexed_schools(t))
    return rows.select("unique_school_id", "locale", "race", F.round("ri", 6).alias("ri"))


@query(
    "r2_flat_aggregates",
    "select l_returnflag, l_linestatus, sum(l_quantity) as quantity_sum, max(l_quantity) as quantity_max, count(*) as lines from lineitem group by 1, 2",
)
def _(t):
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        F.sum("l_quantity").alias("quantity_sum"),
        F.max("l_quantity").alias("quantity_max"),
        F.count(F.lit(1)).alias("lines"),
    )


@query(
    "r3_result_columns",
    """
    select unique_school_id, round(coalesce(sum(white), 0) / nullif(sum(pop), 0), 6) as share_white,
        round(sum(distance * pop) / nullif(sum(pop), 0), 6) as mean_distance from b_member group by 1
    """,
)
def _(t):
    out = t.b_member.groupBy("unique_school_id").agg(
        *aggregates.ratio_of_sums(["white"], "pop", "share_"),
        aggregates.weighted_mean("distance", "pop").alias("mean_distance"),
    )
    return out.withColumns({c: F.round(c, 6) for c in ("share_white", "mean_distance")})
