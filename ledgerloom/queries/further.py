"""Operators that no other query shows whole: categories, amounts, filters, remaining documents, samples, rules, models."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import standardise as s
from ..operators import aggregates, ml, monitoring, quality, restructure, schema, scoring
from ..sources import readers
from ..sources.folders import work_folder
from .base import AS_OF, LEADS_SQL, leads, query, table
from .quality import METRICS_SQL, day_metrics


@query("""
    select c_custkey, case c_custkey % 7 when 0 then 'TECNOLOGIA' when 1 then 'CONSTRUCAO' when 2 then 'EDUCACAO' when 3 then 'SAUDE' when 4 then 'FINANCAS' when 5 then 'COMERCIO' else 'OUTROS' end as segment,
           case c_custkey % 7 when 0 then 'tecnologia' when 2 then 'educação' when 3 then 'tecnologia' else 'outros' end as sector from customer
""")
def segment_categories(spark, sf_dir):
    """C19; a hospital is of the technology sector, since its name has one of that sector's keywords in it."""
    names = F.array(*map(F.lit, ("Software House", "Construtora Norte", "Escola Azul", "Hospital Sul", "BANCO real", "Varejo Total")))
    df = table(spark, sf_dir, "customer").select("c_custkey", F.get(names, (F.col("c_custkey") % 7).cast("int")).alias("ramo"))
    out = s.categorise_segment(s.categorise_segment(df, "ramo").withColumnRenamed("ramo_category", "segment"), "ramo", "sector")
    return out.select("c_custkey", "segment", F.col("ramo_category").alias("sector"))


@query("""
    select o_orderkey, concat('R$ ', replace(replace(replace(format('{:,.2f}', cast(cast(o_totalprice as decimal(15, 2)) as double)), ',', '#'), '.', ','), '#', '.')) as amount,
           concat('R$ ', replace(replace(replace(format('{:,.2f}', cast(cast(o_totalprice as decimal(15, 2)) as double)), ',', '#'), '.', ','), '#', '.')) as from_text from orders
""")
def formatted_money(spark, sf_dir):
    """C9, of numbers and of texts."""
    x = F.col("o_totalprice").cast("decimal(15,2)")
    df = table(spark, sf_dir, "orders").select("o_orderkey", x.alias("amount"), x.cast("string").alias("from_text"))
    return s.format_money(df, ["amount", "from_text"])


@query("select o_orderkey, cast(o_orderdate as date) as day from orders")
def sorted_submissions(spark, sf_dir):
    """T4."""
    return aggregates.sort_submissions(table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day")), "day", "o_orderkey")


@query(f"select id, nome, cargo from (select case when id % 10 = 3 then null else id end as id, case when id % 10 = 3 then ' ' else nome end as nome, case when id % 10 = 3 then null else cargo end as cargo from {LEADS_SQL}) where id is not null and cargo = 'CEO'")
def equal_filter(spark, sf_dir):
    """P5 and P6."""
    empty = F.col("id") % 10 == 3
    df = leads(spark, sf_dir).select(F.when(~empty, F.col("id")).alias("id"), F.when(empty, " ").otherwise(F.col("nome")).alias("nome"), F.when(~empty, F.col("cargo")).alias("cargo"))
    return schema.where_equals(schema.drop_empty_rows(df, blank_is_missing=True), "cargo", "CEO")


@query("select o_orderkey as id, 'c@d.com' as email, cast(o_orderdate as date) as day, o_orderkey % 3 as n_questions, coalesce(length(questions), 0) > 1 as written from (select *, case when o_orderkey % 3 > 0 then '[..]' end as questions from orders)")
def interactions(spark, sf_dir):
    """Interactions."""
    asked = F.slice(F.array(F.lit("a"), F.lit("b")), F.lit(1), (F.col("o_orderkey") % 3).cast("int"))
    df = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.lit("n").alias("name"), F.lit("C@d.com").alias("email"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("createdAt"), F.lit(True).alias("consent"), F.when(F.col("o_orderkey") % 3 > 0, asked).alias("questions"))
    out = restructure.project_misc(df, "interactions")
    return out.select("id", "email", F.to_date("created_at").alias("day"), F.col("n_questions").cast("long").alias("n_questions"), F.coalesce(F.length("questions") > 1, F.lit(False)).alias("written"))


@query("select 'bigNumbers' as id, count(*) as totalValuations, cast(sum(cast(o_totalprice as decimal(18, 2))) as double) as totalPaidValue from orders")
def big_numbers(spark, sf_dir):
    """Metrics; the row of another id goes."""
    o = table(spark, sf_dir, "orders")
    one = lambda name: o.agg(F.lit(name).alias("id"), F.count("*").alias("totalValuations"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("totalPaidValue"), F.lit(1).alias("other"))
    return restructure.project_misc(one("bigNumbers").unionByName(one("old")), "metrics")


@query("select cast(o_custkey as varchar) as id, string_agg(distinct o_orderstatus, ', ' order by o_orderstatus) as collections, count(distinct o_orderstatus) as n_collections from orders group by 1")
def collections(spark, sf_dir):
    """What collections a document is in."""
    df = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").cast("string").alias("id")).agg(F.sort_array(F.collect_set("o_orderstatus")).alias("collections"))
    return restructure.project_misc(df, "collections").withColumn("n_collections", F.col("n_collections").cast("long"))


@query(f"select id, cast(case when valor > 5000 then 20 else 0 end + case when cargo = 'CEO' then 7 else 0 end as double) as score from {LEADS_SQL}")
def replaced_rule(spark, sf_dir):
    """A rule of the same name takes the first one's place, another is added."""
    rules = scoring.add_rule([scoring.ScoringRule("Valor", "valor", ">", 1, 50, 2.0)], scoring.ScoringRule("Valor", "valor", ">", 5000, 10, 2.0))
    rules = scoring.add_rule(rules, scoring.ScoringRule("Cargo", "cargo", "==", "CEO", 7, 1.0))
    return scoring.score_rules(leads(spark, sf_dir), rules, AS_OF).select("id", F.col("score").cast("double").alias("score"))


@query("select c_custkey as id, c_name from customer")
def renamed_table(spark, sf_dir):
    """The table itself."""
    return schema.rename_map(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), {"c_custkey": "id", "gone": "x"})[0]


@query("select s_suppkey, 'Ana' as primeiro_nome, concat('Silva', cast(s_suppkey as varchar)) as ultimo_nome from supplier")
def name_parts(spark, sf_dir):
    """C28."""
    df = table(spark, sf_dir, "supplier").select("s_suppkey", F.concat(F.lit("  Ana  de Souza Silva"), F.col("s_suppkey").cast("string"), F.lit(" ")).alias("n"))
    return s.name_parts(df, "n").select("s_suppkey", "primeiro_nome", "ultimo_nome")


@query("select true as sized, 0::bigint as strangers, count(*) as whole from orders")
def sampled_part(spark, sf_dir):
    """S14 with a real sample of about 500 rows; and a table under the limit, which stays whole."""
    o = table(spark, sf_dir, "orders")
    part = readers.profile_sample(o, n=500, above=0)
    facts = part.agg(F.count("*").between(350, 650).alias("sized"))
    strangers = part.join(o, ["o_orderkey", "o_custkey"], "left_anti").agg(F.count("*").alias("strangers"))
    whole = readers.profile_sample(o, n=1, above=1 << 60).agg(F.count("*").alias("whole"))
    return facts.crossJoin(F.broadcast(strangers)).crossJoin(F.broadcast(whole))  # one row each


@query(f"""
    with m as (select pipeline_name, timestamp, cast(records_processed as double) as a, processing_time_seconds as b, cast(error_count as double) as c from {METRICS_SQL}),
    f as (select avg(a) as ma, stddev_pop(a) as sa, avg(b) as mb, stddev_pop(b) as sb, avg(c) as mc, stddev_pop(c) as sc from m),
    d as (select pipeline_name, timestamp, sqrt(coalesce(case when sa > 0 then power((a - ma) / sa, 2) end, 0) + coalesce(case when sb > 0 then power((b - mb) / sb, 2) end, 0) + coalesce(case when sc > 0 then power((c - mc) / sc, 2) end, 0)) as distance from m, f)
    select pipeline_name, timestamp, cast(distance > (select quantile_cont(distance, 0.9) from d) as integer) as is_anomaly from d
""")
def anomaly_verdicts(spark, sf_dir):
    """The verdict of each run."""
    m = monitoring.run_anomalies(day_metrics(spark, sf_dir), ["records_processed", "processing_time_seconds", "error_count"])
    return m.select("pipeline_name", "timestamp", "is_anomaly")


@query(f"""
    with l as (select id, case when valor > 4000 then 1.0 else 0.0 end as label, coalesce(nullif(upper(trim(cargo)), ''), 'DESCONHECIDO') as cargo from {LEADS_SQL})
    select id, cargo, round(case when label = 1 then n / (2 * p) else n / (2 * (n - p)) end, 9) as weight from l, (select count(*) as n, sum(label) as p from l)
""")
def class_weights(spark, sf_dir):
    """What the models are given, weights by class and texts without blanks."""
    df = leads(spark, sf_dir).select("id", "cargo", (F.col("valor") > 4000).cast("double").alias("label"))
    return ml.with_weights(ml.encode(df, ["cargo"]), "label").select("id", "cargo", F.round("_weight", 9).alias("weight"))


@query(f"select id, true as agrees, true as tells, case when valor > 4000 then 'Alta' else 'Baixa' end as told from {LEADS_SQL} where valor > 5000 or valor < 3000")
def saved_model(spark, sf_dir):
    """M1 to M3: a model that was written and loaded says the same of each row, tells held-out rows apart (AUC over 0.95),
    and is right on rows that are clear of the border between the classes."""
    df = leads(spark, sf_dir).withColumn("quality", F.when(F.col("valor") > 4000, "Alta").otherwise("Baixa")).select("id", "valor", "segmento", "quality")
    model, facts = ml.train_lead_model(df, "quality", "id")
    ml.save_model(model, path := work_folder(spark, "model"))
    one, two = (ml.predict(df, m, facts["numbers"], facts["texts"]).select("id", "valor", "qualidade_predita", "confianca_predicao") for m in (model, ml.load_model(path)))
    both = one.join(two.select("id", F.col("confianca_predicao").alias("again")), "id").filter("valor > 5000 or valor < 3000")
    return both.select("id", (F.col("again") == F.col("confianca_predicao")).alias("agrees"), F.lit(facts["auc"] > 0.95).alias("tells"), F.col("qualidade_predita").alias("told"))


@query(" union all ".join(f"select '{c}' as \"column\", count(*) as rows, count(*) - count({c}) as nulls, count(distinct {c}) as n_distinct from lineitem" for c in ("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag", "l_shipdate")))
def lineitem_profile(spark, sf_dir):
    """D1 on the largest table."""
    df = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag", "l_shipdate")
    return quality.profile(df, "lineitem", "2024-06-01", approximate=False).select("column", "rows", "nulls", "n_distinct")


@query("select o_orderkey, cast(case when o_totalprice > 100000 then 60 else 0 end + case when o_orderstatus = 'F' then 20 else 0 end as double) as score from orders")
def order_scores(spark, sf_dir):
    """L1 on orders."""
    rules = [scoring.ScoringRule("large", "o_totalprice", ">", 100000, 30, 2.0), scoring.ScoringRule("done", "o_orderstatus", "==", "F", 20, 1.0)]
    return scoring.score_rules(table(spark, sf_dir, "orders"), rules, AS_OF).select("o_orderkey", F.col("score").cast("double").alias("score"))
