"""Counts, indicators, statistics and top rows (G, T)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates as a
from .base import LEADS_SQL, leads, query, table


@query("select event_type as value, count(*) as n, count(*) * 100.0 / (select count(*) from events) as percent from events group by 1")
def value_counts(spark, sf_dir):
    return a.value_counts(table(spark, sf_dir, "events"), "event_type").withColumn("percent", F.col("percent").cast("double"))


@query("""
    select count(*) as total, count(distinct o_custkey) as n_keys, count(*) filter (where o_orderstatus = 'F') as converted, count(*) filter (where o_orderstatus = 'F') / count(*) as conversion_rate,
           round(sum(cast(o_totalprice as decimal(18, 2)))::double, 2) as total_value, round(sum(cast(o_totalprice as decimal(18, 2)))::double / count(*), 4) as mean_value from orders
""")
def kpis(spark, sf_dir):
    df = table(spark, sf_dir, "orders").withColumn("price", F.col("o_totalprice").cast("decimal(18,2)"))
    out = a.kpis(df, "o_orderstatus = 'F'", "price", "o_custkey")
    return out.withColumns({"total_value": F.round(F.col("total_value").cast("double"), 2), "mean_value": F.round(F.col("total_value").cast("double") / F.col("total"), 4)})


@query("""
    select l_returnflag, l_linestatus, count(*) as n, round(avg(l_quantity), 6) as mean_l_quantity, round(sum(l_quantity), 2) as sum_l_quantity, count(*) filter (where l_discount > 0.05) / count(*) as rate from lineitem group by 1, 2
""")
def group_kpis(spark, sf_dir):
    out = a.group_kpis(table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"], ["l_quantity"], "l_discount > 0.05")
    return out.withColumns({"mean_l_quantity": F.round("mean_l_quantity", 6), "sum_l_quantity": F.round("sum_l_quantity", 2)})


@query("""
    with s as (select * from (values (0, 'view'), (1, 'click'), (2, 'signup'), (3, 'refund'), (4, 'purchase')) t(position, stage)), c as (select event_type, count(*) as n from events group by 1),
    j as (select position, stage, coalesce(n, 0) as n from s left join c on stage = event_type)
    select position, stage, n, n / (select n from j where position = 0) as share_of_first from j
""")
def funnel(spark, sf_dir):
    return a.funnel(table(spark, sf_dir, "events"), "event_type", ["view", "click", "signup", "refund", "purchase"])


@query("""
    select 'l_quantity' as "column", count(l_quantity) as n, round(avg(l_quantity), 6) as mean, round(stddev(l_quantity), 6) as std, min(l_quantity) as min, quantile_cont(l_quantity, 0.25) as q25, median(l_quantity) as median, quantile_cont(l_quantity, 0.75) as q75, max(l_quantity) as max from lineitem
    union all select 'l_discount', count(l_discount), round(avg(l_discount), 6), round(stddev(l_discount), 6), min(l_discount), quantile_cont(l_discount, 0.25), median(l_discount), quantile_cont(l_discount, 0.75), max(l_discount) from lineitem
""")
def describe_numeric(spark, sf_dir):
    out = a.describe_numeric(table(spark, sf_dir, "lineitem"), ["l_quantity", "l_discount"])
    return out.withColumns({"mean": F.round("mean", 6), "std": F.round("std", 6)})


@query("select 'l_returnflag' as \"column\", l_returnflag as value, count(*) as n from lineitem group by 2 union all select 'l_linestatus', l_linestatus, count(*) from lineitem group by 2")
def describe_categorical(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").withColumn("line", F.col("l_orderkey").cast("string"))
    return a.describe_categorical(df, ["l_returnflag", "l_linestatus", "line"])


@query("select 'o_totalprice' as \"column\", count(*) as valid, min(o_totalprice) as min, max(o_totalprice) as max, round(avg(o_totalprice), 4) as mean, median(o_totalprice) as median, round(sum(o_totalprice), 1) as total from orders")
def money_report(spark, sf_dir):
    return a.money_report(table(spark, sf_dir, "orders"), ["o_totalprice"]).withColumns({"mean": F.round("mean", 4), "total": F.round("total", 1)})


@query("select cast(year(o_orderdate) as integer) as year, count(*) as n, min(o_orderdate) as first, max(o_orderdate) as last from orders group by 1")
def by_year(spark, sf_dir):
    return a.by_year(table(spark, sf_dir, "orders"), "o_orderdate")


@query("""
    select cast(date_trunc('month', o_orderdate) as date) as month, count(*) as size, round(avg(o_totalprice), 4) as mean_engagement, count(*) filter (where o_orderstatus = 'F') / count(*) as conversion from orders group by 1 order by 1 desc limit 6
""")
def cohorts(spark, sf_dir):
    return a.cohorts(table(spark, sf_dir, "orders"), "o_orderdate", "o_totalprice", "o_orderstatus = 'F'").withColumn("mean_engagement", F.round("mean_engagement", 4))


@query("""
    with o as (select count(*) as c, sum(cast(o_totalprice as decimal(18, 2)))::double as s from orders where o_orderstatus = 'F')
    select c as customers, round(1000000.0 / c, 6) as cac, round(s / c, 4) as mean_ltv, round(s / c / (1000000.0 / c), 6) as ltv_cac, round(s, 2) as projected_revenue, round((s - 1000000) * 100.0 / 1000000, 6) as roi_percent, round(12000000.0 / s, 8) as payback_months from o
""")
def roi(spark, sf_dir):
    out = a.roi(table(spark, sf_dir, "orders"), 1_000_000, "o_totalprice", "o_orderstatus = 'F'")
    digits = {"cac": 6, "mean_ltv": 4, "ltv_cac": 6, "projected_revenue": 2, "roi_percent": 6, "payback_months": 8}
    return out.withColumns({c: F.round(F.col(c).cast("double"), d) for c, d in digits.items()})


@query("select sum(n)::bigint as rows, count(*) as n_keys, count(*) filter (where n > 1) as duplicate_groups, max(n) as max_group, avg(n) as mean_group, sum(n - 1)::bigint as removed from (select o_custkey, count(*) as n from orders group by 1)")
def dedup_stats(spark, sf_dir):
    return a.dedup_stats(table(spark, sf_dir, "orders"), "o_custkey")


@query("select 'k' as field, count(*) as present, min(cast(json_extract_string(props, '$.k') as double)) as min, avg(cast(json_extract_string(props, '$.k') as double)) as mean, max(cast(json_extract_string(props, '$.k') as double)) as max from events where json_extract_string(props, '$.k') is not null union all select 'none', 0, null, null, null")
def field_presence(spark, sf_dir):
    return a.field_presence(table(spark, sf_dir, "events"), {"k": ["get_json_object(props, '$.flat.k')", "get_json_object(props, '$.k')"], "none": ["get_json_object(props, '$.absent')"]})


@query("select user_id as id, bool_or(event_type = 'purchase') as any_paid, count(*) filter (where event_type = 'purchase') as n_paid, round(sum(value), 4) as total_amount from events group by 1")
def payment_totals(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("id"), (F.col("event_type") == "purchase").alias("paid"), F.col("value").alias("amount"))
    return a.payment_totals(e).withColumn("total_amount", F.round("total_amount", 4))


@query(f"""
    with l as (select id, cargo, case when id % 10 = 0 then null else valor end as v from {LEADS_SQL}),
    m as (select cargo from l where cargo is not null group by cargo order by count(*) desc, cargo limit 1)
    select id, coalesce(cargo, (select cargo from m)) as cargo, coalesce(v, (select median(v) from l)) as v from l
""")
def impute(spark, sf_dir):
    return a.impute(leads(spark, sf_dir).select("id", "cargo", F.when(F.col("id") % 10 != 0, F.col("valor")).alias("v")))


@query("select o_orderkey, cast(o_totalprice > (select quantile_cont(o_totalprice, 0.8) from orders) as integer) as flag from orders")
def percentile_flag(spark, sf_dir):
    return a.flag_above_percentile(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", 0.8).select("o_orderkey", "flag")


@query("select p_partkey, case when p_size <= lo + w then 'A' when p_size <= lo + 2 * w then 'B' when p_size <= lo + 3 * w then 'C' when p_size <= lo + 4 * w then 'D' else 'E' end as band from part, (select min(p_size) as lo, (max(p_size) - min(p_size)) / 5 as w from part)")
def cut_equal(spark, sf_dir):
    return a.cut_equal(table(spark, sf_dir, "part").select("p_partkey", "p_size"), "p_size", list("ABCDE")).select("p_partkey", "band")


@query("""
    select 'c_mktsegment' as "column", count(*) as rows, count(c_mktsegment) as non_null, count(distinct c_mktsegment) as n_distinct, min(c_mktsegment) as least from customer
    union all select 'c_nationkey', count(*), count(c_nationkey), count(distinct c_nationkey), min(cast(c_nationkey as varchar)) from customer
""")
def data_dictionary(spark, sf_dir):
    out = a.data_dictionary(table(spark, sf_dir, "customer").select("c_mktsegment", "c_nationkey"), exact=True)
    return out.select("column", "rows", "non_null", "n_distinct", F.col("examples")[0].alias("least"))


@query(f"select 'email' as \"column\", count(*) filter (where email is null) as blank_before, count(*) filter (where email is null or email = 'bad mail') as blank_after, count(*) filter (where email = 'bad mail' or email <> lower(email)) as changed from {LEADS_SQL}")
def change_counts(spark, sf_dir):
    before = leads(spark, sf_dir).select("id", "email")
    return a.change_counts(before, before.withColumn("email", F.when(F.col("email") != "bad mail", F.lower("email"))), "id")


@query("select s_suppkey, round((s_acctbal - (select avg(s_acctbal) from supplier)) / (select stddev(s_acctbal) from supplier), 8) as s_acctbal_z from supplier")
def zscore(spark, sf_dir):
    return a.zscore(table(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal"), ["s_acctbal"]).select("s_suppkey", F.round("s_acctbal_z", 8).alias("s_acctbal_z"))


@query(f"""
    select 'email' as "column", count(*) filter (where email is not null) as filled, count(*) as total, count(*) filter (where email is not null) * 100.0 / count(*) as percent from {LEADS_SQL}
    union all select 'cargo', count(*) filter (where cargo is not null), count(*), count(*) filter (where cargo is not null) * 100.0 / count(*) from {LEADS_SQL}
""")
def completeness(spark, sf_dir):
    return a.completeness(leads(spark, sf_dir), ["email", "cargo"]).withColumn("percent", F.col("percent").cast("double"))


@query("""
    with o as (select o_orderkey, o_totalprice, o_custkey % 101 as score, (o_custkey % 97) / 97 as p, (o_orderkey % 89) / 89 as churn from orders)
    select o_orderkey, round(0.4 * score / 100 + 0.3 * p + 0.2 * o_totalprice / (select max(o_totalprice) from orders) + 0.1 * (1 - churn), 8) as ranking from o order by 0.4 * score / 100 + 0.3 * p + 0.2 * o_totalprice / (select max(o_totalprice) from orders) + 0.1 * (1 - churn) desc, o_orderkey limit 20
""")
def rank_leads(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", (F.col("o_custkey") % 101).alias("score"), (F.col("o_custkey") % 97 / 97).alias("p"), (F.col("o_orderkey") % 89 / 89).alias("churn"))
    return a.rank_leads(o, "score", "p", "o_totalprice", "churn", "o_orderkey").select("o_orderkey", F.round("ranking", 8).alias("ranking"))


@query("select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 10")
def top_conversions(spark, sf_dir):
    return a.top_conversions(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", "o_orderkey")


@query("select count(*) filter (where p > 0.7) as high, count(*) filter (where p between 0.4 and 0.7) as medium, count(*) filter (where p < 0.4) as low from (select (o_custkey % 97) / 97 as p from orders)")
def probability_bands(spark, sf_dir):
    return a.probability_bands(table(spark, sf_dir, "orders").select((F.col("o_custkey") % 97 / 97).alias("p")), "p")


@query("select o_orderkey, o_totalprice from orders where o_orderstatus = 'O' order by o_totalprice desc, o_orderkey limit 50 offset 100")
def list_leads(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", F.col("o_orderstatus").alias("status"))
    return a.list_leads(o, "O", "o_totalprice", "o_orderkey", 50, 100).drop("status")


@query("select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 25")
def nlargest(spark, sf_dir):
    return a.nlargest(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), 25, "o_totalprice", "o_orderkey")
