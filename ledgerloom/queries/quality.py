"""Quality reports, profiles, drift and monitoring (G8 to G12, D)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates, forests, monitoring, quality as q
from ..sources.folders import work_folder as folder
from .base import LEADS_SQL, leads, query, table
from .cleaning import CPF_SQL, EMAIL_SQL

RUN = "2024-06-01 00:00:00"


@query("""
    with g as (select source, lang, count(*) as n from documents group by 1, 2)
    select sum(n)::bigint as rows, sum(case when n > 1 then n else 0 end)::bigint as duplicate_rows, sum(case when n > 1 then n else 0 end) * 100.0 / sum(n) as duplicate_percent, count(*) filter (where n > 1) as groups from g
""")
def duplicate_report(spark, sf_dir):
    return q.duplicate_report(table(spark, sf_dir, "documents").select("source", "lang"), ["source", "lang"]).withColumn("duplicate_percent", F.col("duplicate_percent").cast("double"))


@query("select text_md5, count(*) as n from (select md5(text) as text_md5 from documents) group by 1 having count(*) > 1 order by n desc, text_md5 limit 10")
def duplicate_examples(spark, sf_dir):
    return q.duplicate_examples(table(spark, sf_dir, "documents").select(F.md5("text").alias("text_md5")), ["text_md5"])


@query(f"select 'mail_and_phone' as rule, count(*) filter (where email is not null and telefone is not null) as violations, count(*) filter (where email is not null and telefone is not null) * 100.0 / count(*) as rate from {LEADS_SQL}")
def consistency(spark, sf_dir):
    return q.consistency(leads(spark, sf_dir), {"mail_and_phone": ["email", "telefone"]}).withColumn("rate", F.col("rate").cast("double"))


@query(f"""
    with g as (select email, count(*) as n from {LEADS_SQL} group by 1), d as (select 100 - sum(case when n > 1 then n else 0 end) * 100.0 / sum(n) as d from g),
    c as (select (count(nome) + count(email) + count(cargo)) * 100.0 / count(*) / 3 as c, 100 - count(*) filter (where cep is not null and telefone is not null) * 100.0 / count(*) as r from {LEADS_SQL})
    select round(d, 8) as duplicate_score, round(c, 8) as completeness_score, round(r, 8) as consistency_score, round((d + c + r) / 3, 8) as overall_score from d, c
""")
def quality_report(spark, sf_dir):
    out = q.quality_report(leads(spark, sf_dir), ["email"], ["nome", "email", "cargo"], {"a": ["cep", "telefone"]})
    return out.select(*[F.round(F.col(c).cast("double"), 8).alias(c) for c in ("duplicate_score", "completeness_score", "consistency_score", "overall_score")])


@query(f"""
    with l as (select *, {CPF_SQL} as c, {EMAIL_SQL} as e from {LEADS_SQL})
    select round(((count(id) + count(email) + count(cargo)) / (count(*) * 3.0) * 0.6 + (avg(c::int) + avg(e::int)) / 2 * 0.4) * 100, 2) as quality_score from l
""")
def quality_score(spark, sf_dir):
    from ..functions.validate import is_cpf, is_email

    df = leads(spark, sf_dir).select("id", "email", "cargo", is_cpf("cpf").alias("c"), is_email("email").alias("e"))
    return q.quality_score(df, ["c", "e"])


@query(f"""
    with m as (select 'leads' as entity, count(*) as total, count(*) filter (where nome is not null and email is not null) as complete, count(cpf) - count(distinct cpf) as duplicates, count(*) filter (where email is not null and not {EMAIL_SQL}) as invalid_email, count(*) filter (where telefone is null) as missing_phone from {LEADS_SQL}
               union all select 'suppliers', count(*), count(*) filter (where s_name is not null), count(s_name) - count(distinct s_name), 0, 0 from supplier)
    select *, complete * 100.0 / total as completeness, case when complete * 100.0 / total >= 90 then 'excelente' when complete * 100.0 / total >= 70 then 'bom' when complete * 100.0 / total >= 50 then 'regular' else 'crítico' end as status from m
""")
def entity_metrics(spark, sf_dir):
    tables = {"leads": leads(spark, sf_dir), "suppliers": table(spark, sf_dir, "supplier").select(F.col("s_name").alias("cpf"), F.col("s_name").alias("nome"))}
    out = q.entity_metrics(tables, {"leads": ["nome", "email"], "suppliers": ["nome"]}, "cpf", "email", "telefone")
    return out.withColumn("completeness", F.col("completeness").cast("double"))


@query(f"""
    select 'cpf' as "column", 'phone' as pattern from (select 1) union all select 'email', case when avg(case when email is not null then (contains(email, '@'))::int end) > 0.7 then 'email' end from {LEADS_SQL} union all select 'cargo', null
""")
def detect_patterns(spark, sf_dir):
    return q.detect_patterns(leads(spark, sf_dir), ["cpf", "email", "cargo"])


@query("""
    select 'c_custkey' as "column", 'bigint' as dtype, false as nullable, count(*) as rows, 0::bigint as nulls, count(distinct c_custkey) as n_distinct, min(c_custkey)::double as min_value, max(c_custkey)::double as max_value, null::double as mean_length from customer
    union all select 'c_mktsegment', 'string', false, count(*), 0, count(distinct c_mktsegment), null, null, round(avg(length(c_mktsegment)), 8) from customer
    union all select 'c_acctbal', 'double', false, count(*), 0, count(distinct c_acctbal), min(c_acctbal), max(c_acctbal), null from customer
""")
def profile(spark, sf_dir):
    out = q.profile(table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_acctbal"), "customer", RUN, approximate=False)
    return out.select("column", "dtype", "nullable", "rows", "nulls", "n_distinct", "min_value", "max_value", F.round("mean_length", 8).alias("mean_length"))


def two_profiles(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    new = c.select("c_custkey", F.when(F.col("c_custkey") % 2 == 0, F.col("c_name")).alias("c_name"), F.col("c_acctbal").cast("int").alias("c_acctbal"), F.lit("x").alias("c_mktsegment"), F.lit(1).alias("c_new"))
    return q.profile(c, "customer", RUN, approximate=False), q.profile(new, "customer", RUN, approximate=False)


@query("""
    select * from (values ('c_nationkey', 'removed', 'high', false), ('c_new', 'added', 'high', true), ('c_acctbal', 'type_changed', 'critical', false), ('c_name', 'nullability_changed', 'low', true), ('c_mktsegment', 'cardinality_changed', 'medium', true)) t("column", change_type, impact, auto_fixable)
    where "column" <> 'c_mktsegment' or (select count(distinct c_mktsegment) from customer) > 2
    union all select 'c_acctbal', 'cardinality_changed', 'medium', true from customer having count(distinct cast(trunc(c_acctbal) as integer)) / count(distinct c_acctbal) not between 0.5 and 2
""")
def diff_profiles(spark, sf_dir):
    return q.diff_profiles(*two_profiles(spark, sf_dir)).select("column", "change_type", "impact", "auto_fixable")


@query("""
    with n as (select case when count(distinct c_mktsegment) > 2 then 1 else 0 end + case when count(distinct cast(trunc(c_acctbal) as integer)) / count(distinct c_acctbal) not between 0.5 and 2 then 1 else 0 end as cards from customer)
    select round((0.7 + 0.7 + 1.0 + 0.1 + 0.3 * cards) / (4 + cards), 8) as drift_score, true as breaking, 'review pipelines' as recommendation from n
""")
def drift_report(spark, sf_dir):
    return q.drift_report(q.diff_profiles(*two_profiles(spark, sf_dir))).select(F.round("drift_score", 8).alias("drift_score"), "breaking", "recommendation")


METRICS_SQL = """
    (select event_type as pipeline_name, date_trunc('day', ts) as timestamp, count(*) as records_processed, sum(cast(value as decimal(18, 6)))::double as processing_time_seconds, max(value) * 100 as memory_usage_mb,
            count(*) filter (where value < 5) as error_count, 1 - count(*) filter (where value < 5) / count(*) as success_rate, max(value) * 150 as latency_ms from events group by 1, 2)
"""


def day_metrics(spark, sf_dir):
    """Metrics of a pipeline for each event type, by day."""
    return table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("pipeline_name"), F.date_trunc("day", "ts").alias("timestamp")).agg(
        F.count("*").alias("records_processed"), F.sum(F.col("value").cast("decimal(18,6)")).cast("double").alias("processing_time_seconds"), (F.max("value") * 100).alias("memory_usage_mb"),
        F.count_if(F.col("value") < 5).alias("error_count"), (1 - F.count_if(F.col("value") < 5) / F.count("*")).alias("success_rate"), (F.max("value") * 150).alias("latency_ms"),
    )


_LONG = "(" + " union all ".join(f"select pipeline_name, timestamp, '{m}' as metric, cast({m} as double) as value from m" for m in ("records_processed", "processing_time_seconds", "memory_usage_mb", "error_count", "success_rate", "latency_ms")) + ")"


@query(f"""
    with m as (select * from {METRICS_SQL}), l as {_LONG}
    select pipeline_name, metric, round(avg(value), 6) as mean, round(stddev_pop(value), 6) as std, min(value) as min, max(value) as max, round(quantile_cont(value, 0.25), 6) as q25, round(quantile_cont(value, 0.75), 6) as q75 from l group by 1, 2
""")
def metric_baseline(spark, sf_dir):
    out = monitoring.metric_baseline(day_metrics(spark, sf_dir))
    return out.withColumns({c: F.round(c, 6) for c in ("mean", "std", "q25", "q75")})


@query(f"""
    with m as (select * from {METRICS_SQL}), l as {_LONG}, b as (select pipeline_name, metric, avg(value) as mean, stddev_pop(value) as std from l group by 1, 2)
    select l.pipeline_name, l.timestamp, l.metric, round(value, 6) as value, case when abs(value - mean) > 3 * std then 'critical' when abs(value - mean) > 2.5 * std then 'high' else 'medium' end as severity
    from l join b on l.pipeline_name = b.pipeline_name and l.metric = b.metric where abs(value - mean) > 2 * std and l.metric <> 'records_processed'
""")
def metric_anomalies(spark, sf_dir):
    m = day_metrics(spark, sf_dir)
    return monitoring.metric_anomalies(m, monitoring.metric_baseline(m, quartiles=False)).select("pipeline_name", "timestamp", "metric", F.round("value", 6).alias("value"), "severity")


@query(f"""
    with m as (select * from {METRICS_SQL})
    select pipeline_name, timestamp, 'critical_error_rate' as alert_type, round(success_rate, 8) as value from m where success_rate < 0.8 union all select pipeline_name, timestamp, 'high_latency', round(latency_ms, 8) from m where latency_ms > 10000
    union all select pipeline_name, timestamp, 'memory_spike', round(memory_usage_mb, 8) from m where memory_usage_mb > 1000
""")
def alerts(spark, sf_dir):
    return monitoring.alerts(day_metrics(spark, sf_dir)).select("pipeline_name", "timestamp", "alert_type", F.round("value", 8).alias("value"))


@query(f"""
    with m as (select * from {METRICS_SQL} where pipeline_name = 'view' and timestamp > timestamp '2024-01-10' and timestamp <= timestamp '2024-01-25')
    select count(*) as runs, sum(records_processed)::bigint as records, round(avg(success_rate), 8) as success_rate, sum(error_count)::bigint as errors, max(timestamp) as last_run from m
""")
def run_dashboard(spark, sf_dir):
    from ..operators.dedup import run_dashboard as dashboard

    metrics = day_metrics(spark, sf_dir).withColumn("data_quality_score", F.lit(1.0))
    return dashboard(metrics, "view", "2024-01-25", 15 * 24)[1].select("runs", "records", F.round("success_rate", 8).alias("success_rate"), "errors", "last_run")


@query("""
    with s as (select l_orderkey, l_linenumber, l_partkey, l_extendedprice, sqrt(power((l_quantity - avg(l_quantity) over ()) / stddev_pop(l_quantity) over (), 2) + power((l_extendedprice - avg(l_extendedprice) over ()) / stddev_pop(l_extendedprice) over (), 2)) as d from lineitem)
    select l_orderkey, l_linenumber, l_partkey, l_extendedprice, round(d, 6) as distance from s where d > (select quantile_cont(d, 0.9) from s)
""")
def outliers(spark, sf_dir):
    from ..operators.ml import flag_outliers

    out = flag_outliers(table(spark, sf_dir, "lineitem"), ["l_quantity", "l_extendedprice"], 0.1).filter("outlier = 1")
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", F.round("outlier_distance", 6).alias("distance"))


@query()
def isolation_forest(spark, sf_dir):
    """All lines, scored by a forest; the tenth that is set apart soonest is flagged."""
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    return forests.flag_isolated(table(spark, sf_dir, "lineitem"), cols).select("l_orderkey", "l_linenumber", "path_length", "anomaly_score", "is_anomaly")


@query("""
    select l_orderkey % 100 = 0 and l_linenumber = 1 as planted, count(*) as n, case when l_orderkey % 100 = 0 and l_linenumber = 1 then count(*) else 0 end as found
    from lineitem where l_linenumber is not null group by 1 order by 1
""")
def planted_anomalies(spark, sf_dir):
    """Lines of absurd amounts score above all others."""
    lines = table(spark, sf_dir, "lineitem").filter("l_linenumber is not null").withColumn("planted", (F.col("l_orderkey") % 100 == 0) & (F.col("l_linenumber") == 1))
    lines = lines.withColumns({c: F.when(F.col("planted"), F.col(c) * 40 + 4000).otherwise(F.col(c)) for c in ("l_quantity", "l_extendedprice")})
    lines = lines.withColumn("l_extendedprice", F.when(F.col("planted"), F.col("l_extendedprice") + 5_000_000).otherwise(F.col("l_extendedprice")))
    scored = monitoring.run_anomalies(lines, ["l_quantity", "l_extendedprice"], 0.001, isolated=True)
    top = scored.filter("not planted").agg(F.coalesce(F.max("anomaly_score"), F.lit(0.0)).alias("top"))  # one row
    return scored.crossJoin(F.broadcast(top)).groupBy("planted").agg(F.count("*").alias("n"), F.count_if(F.col("anomaly_score") > F.col("top")).alias("found"))


@query("""
    with l as (select l_quantity, l_extendedprice, l_returnflag, l_partkey, case when l_linenumber > 1 then l_tax end as l_tax from lineitem)
    select * from (
        select 'l_quantity' as "column", count(*) as rows, 0::bigint as nulls, min(l_quantity)::double as min_value, max(l_quantity)::double as max_value, null::double as mean_length, true as distinct_near, true as median_near from l
        union all select 'l_extendedprice', count(*), 0, min(l_extendedprice), max(l_extendedprice), null, true, true from l
        union all select 'l_partkey', count(*), 0, min(l_partkey), max(l_partkey), null, true, true from l
        union all select 'l_tax', count(*), count(*) - count(l_tax), min(l_tax), max(l_tax), null, true, true from l
        union all select 'l_returnflag', count(*), 0, null, null, round(avg(length(l_returnflag)), 8), true, null from l)
""")
def united_profiles(spark, sf_dir):
    """Profiles of each month's lines, kept, and put together; held against exact counts of the whole."""
    lines = table(spark, sf_dir, "lineitem").select("l_shipdate", "l_quantity", "l_extendedprice", "l_returnflag", "l_partkey", F.when(F.col("l_linenumber") > 1, F.col("l_tax")).alias("l_tax"))
    cols = lines.columns[1:]
    q.partial_profiles(lines, "lineitem", F.date_format("l_shipdate", "yyyy-MM")).write.parquet(path := folder(spark, "profiles"))
    united = q.united_profile(spark.read.parquet(path)).filter(F.col("column") != "l_shipdate")
    exact = aggregates.distinct_counts(lines, cols).withColumnRenamed("n_distinct", "exact")
    numbers = [c for c in cols if c != "l_returnflag"]
    med = united.agg(F.map_from_entries(F.collect_list(F.struct("column", "median"))).alias("m"))  # one row
    below = lines.crossJoin(F.broadcast(med)).agg(*[F.struct(F.lit(c).alias("column"), F.count_if(F.col(c) < F.col("m")[c]).alias("under"), F.count_if(F.col(c) <= F.col("m")[c]).alias("upto"), F.count(c).alias("known")).alias(f"s{i}") for i, c in enumerate(numbers)])
    ranks = below.select(F.inline(F.array(*[F.col(f"s{i}") for i in range(len(numbers))])))
    error = q.SKETCH_ERROR
    near = (F.col("under") <= (0.5 + error) * F.col("known")) & (F.col("upto") >= (0.5 - error) * F.col("known"))
    out = united.join(F.broadcast(exact), "column").join(F.broadcast(ranks), "column", "left")
    return out.select("column", "rows", "nulls", "min_value", "max_value", F.round("mean_length", 8).alias("mean_length"), (F.abs(F.col("n_distinct") - F.col("exact")) <= 1 + error * F.col("exact")).alias("distinct_near"), near.alias("median_near"))


@query("select sum(n)::bigint as rows, (sum(n) - count(*))::bigint as duplicates, 0::bigint as missing, 0.0::double as missing_percent from (select l_returnflag, l_linestatus, count(*) as n from lineitem group by 1, 2)")
def run_report(spark, sf_dir):
    return q.run_report(table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity").drop("l_quantity").withColumn("n", F.lit(1)), "lineitem", RUN)[2].withColumn("missing_percent", F.col("missing_percent").cast("double"))
