"""Documents made of the tables, and the remaining column jobs and reports (R, C, P, L, D, J, T)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import standardise as s, validate as v
from ..operators import aggregates, joins, monitoring, quality as q, restructure, schema, scoring
from ..sources.folders import work_folder as folder
from .base import AS_OF, LEADS_SQL, leads, query, table
from .cleaning import CNPJ_SQL, CPF_SQL
from .quality import METRICS_SQL, day_metrics
from .scores import PREPARED_SQL, prepared


#: Orders of a document, about.
DOC_ORDERS = 1000


def payment_documents(orders, pairs, most: int = DOC_ORDERS):
    """(o_custkey, doc): the orders of a customer as one document, or as several of about `most` orders each."""
    parts = orders.groupBy("o_custkey").agg(F.ceil(F.count("*") / most).alias("parts"))
    wide = parts.filter("parts > 1")  # at most one in `most` orders
    dealt = orders.join(wide, orders["o_custkey"].eqNullSafe(wide["o_custkey"]), "left").select(orders["*"], F.pmod(F.xxhash64("o_orderkey"), F.coalesce("parts", F.lit(1))).alias("part"))
    return dealt.groupBy("o_custkey", "part").agg(F.to_json(F.map_from_entries(F.flatten(F.collect_list(pairs)))).alias("doc")).drop("part")


@query("""
    select concat('payment_', cast(o_orderkey as varchar)) as payment_id, concat('c', cast(o_custkey as varchar), '@x.com') as customer_email, cast(o_orderdate as date) as paid_on, cast(cast(o_totalprice as decimal(15, 2)) as double) as amount, o_orderstatus = 'F' as payment_status from orders
""")
def payments(spark, sf_dir):
    name = lambda f: F.concat(F.lit("valuations."), F.col("o_orderkey").cast("string"), F.lit(f))
    pairs = F.array(F.struct(name(".date"), F.date_format("o_orderdate", "dd/MM/yyyy")), F.struct(name(".amount"), s.money_text("o_totalprice")), F.struct(name(".paid"), (F.col("o_orderstatus") == "F").cast("string")))
    docs = payment_documents(table(spark, sf_dir, "orders"), pairs)
    docs = docs.select(F.col("o_custkey").cast("string").alias("id"), F.concat(F.lit("c"), F.col("o_custkey").cast("string"), F.lit("@x.com")).alias("email"), "doc")
    out = restructure.project_payments(docs)
    return out.select("payment_id", "customer_email", F.to_date("payment_date").alias("paid_on"), F.col("payment_amount").cast("double").alias("amount"), "payment_status")


@query(f"""
    select cast(id as varchar) as valuation_id, concat('Empresa ', upper(substr(segmento, 1, 1)), lower(substr(segmento, 2)), ' Ltda') as company_name, lower(email) as email, cast(cast(valor as decimal(15, 2)) as double) as valuation_amount, cast(nacao as integer) as stock_days, id % 2 = 0 as privacy_accepted from {LEADS_SQL}
""")
def dotted_valuations(spark, sf_dir):
    df = leads(spark, sf_dir).select(
        F.col("id").cast("string").alias("id"), F.col("empresa").alias("overview.company"), F.lit("other").alias("company"), F.col("email"), F.col("valor").cast("decimal(15,2)").cast("string").alias("valuation"),
        F.col("nacao").cast("string").alias("financials.timeframes.stock"), F.when(F.col("id") % 2 == 0, "true").otherwise("false").alias("privacy"),
    )
    out = restructure.project_valuations(df)
    return out.select("valuation_id", "company_name", "email", F.col("valuation_amount").cast("double").alias("valuation_amount"), "stock_days", "privacy_accepted")


@query("select cast(c_custkey as varchar) as valuation_id, c_name as company, c_acctbal as valuation, cast(c_nationkey as double) as debt, case when c_custkey % 3 = 0 then 'CRM' else 'SENSE' end as method, concat('[', cast(c_nationkey as varchar), ']') as growth_rates from customer")
def nested_valuations(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    docs = c.select(
        F.col("c_custkey").cast("string").alias("id"), F.lit(1700000000000).alias("timestamp"), F.col("c_acctbal").alias("valuation"), F.struct(F.col("c_name").alias("company")).alias("overview"),
        F.struct(F.col("c_nationkey").cast("double").alias("currentDebt"), F.array("c_nationkey").alias("growthRates")).alias("financials"), F.when(F.col("c_custkey") % 3 == 0, F.create_map(F.lit("a"), F.lit("1"))).alias("scorecard"),
    )
    return restructure.project_nested_valuations(docs).select("valuation_id", "company", "valuation", "debt", "method", "growth_rates")


def crm(spark, sf_dir):
    """Valuation documents of a CRM, one for each lead."""
    return leads(spark, sf_dir).select(
        F.col("id").cast("string").alias("ID"), F.col("empresa").alias("Nome da Startup"), F.col("cidade_estado").alias("Cidade/Estado"), F.col("segmento").alias("Mercado"), s.money_text("valor").alias("MRR"), F.col("nome").alias("Nome do Respondente"), F.col("email").alias("Email"), F.col("telefone").alias("Telefone"),
        F.when(F.col("id") % 3 == 0, "Empreendedor").when(F.col("id") % 3 == 1, "Pre-Money").otherwise("?").alias("Tipo de Valuation"), F.when(F.col("id") % 5 != 0, F.date_format("data_cadastro", "dd/MM/yyyy")).alias("Data de Valuation"),
        s.money_text("valor").alias("Resultado_Valuation"), F.when(F.col("id") % 2 == 0, "Sim").otherwise("Não").alias("Pretende_Captar"), F.lit(None).cast("string").alias("Faturamento_LTM"),
    )


@query(f"select cast(id as varchar) as company_id, concat('Empresa ', upper(substr(segmento, 1, 1)), lower(substr(segmento, 2)), ' Ltda') as company_name, cidade_estado as location, segmento as market, cast(cast(valor as decimal(15, 2)) as double) as mrr from {LEADS_SQL}")
def companies(spark, sf_dir):
    return restructure.project_companies(crm(spark, sf_dir), AS_OF).select("company_id", "company_name", "location", "market", F.col("mrr").cast("double").alias("mrr"))


@query(f"select concat('contact_', cast(id as varchar)) as contact_id, case when contains(email, '@') then lower(email) end as email from {LEADS_SQL} where contains(email, '@') or telefone is not null")
def contacts(spark, sf_dir):
    return restructure.project_contacts(crm(spark, sf_dir)).select("contact_id", "email")


@query(f"""
    select cast(id as varchar) as company_id, data_cadastro as valuation_date, cast(cast(valor as decimal(15, 2)) as double) as amount, case id % 3 when 0 then 'sense' when 1 then 'pre-money' else 'other' end as valuation_type, id % 2 = 0 as fundraising_interest from {LEADS_SQL} where id % 5 <> 0
""")
def financial_valuations(spark, sf_dir):
    return restructure.project_financials(crm(spark, sf_dir))[0].withColumn("amount", F.col("amount").cast("double"))


@query(f"select cast(id as varchar) as company_id, data_cadastro as period_start, cast(cast(valor as decimal(15, 2)) as double) as mrr, cast(cast(valor as decimal(15, 2)) * 12 as double) as arr from {LEADS_SQL} where id % 5 <> 0 and cast(valor as decimal(15, 2)) <> 0")
def financial_snapshots(spark, sf_dir):
    out = restructure.project_financials(crm(spark, sf_dir))[1]
    return out.select("company_id", "period_start", F.col("mrr").cast("double").alias("mrr"), F.col("arr").cast("double").alias("arr"))


@query("select cast(o_orderkey as varchar) as id, lower(o_orderstatus) as status, cast(cast(o_totalprice as decimal(15, 2)) as double) as amount, cast(o_orderdate as date) as day from orders")
def payment_links(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("id"), F.lit("u").alias("url"), F.lit("A@B.com").alias("email"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").cast("decimal(15,2)").alias("amount"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("createdAt"))
    return restructure.project_misc(o, "links").select("id", "status", F.col("amount").cast("double").alias("amount"), F.to_date("created_at").alias("day"))


@query("select l_orderkey as valuation_id, min(l_linenumber) as line from lineitem group by 1 union all select -1 - s_suppkey, s_nationkey from supplier")
def all_valuations(spark, sf_dir):
    a = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("valuation_id"), F.col("l_linenumber").alias("line"), F.col("l_orderkey").alias("own"), F.lit("2020-01-01").alias("valued_at"))
    b = table(spark, sf_dir, "supplier").select((-1 - F.col("s_suppkey")).alias("valuation_id"), F.col("s_nationkey").alias("line"), (-1 - F.col("s_suppkey")).alias("own"), F.lit("2021-01-01").alias("valued_at"))
    return restructure.all_valuations(a, b).select("valuation_id", "line")


@query(f"select id as c_id, nome as nome_do_cliente, cpf as c_p_f from {LEADS_SQL}")
def clean_names(spark, sf_dir):
    df = leads(spark, sf_dir).select(F.col("id").alias(" C-ID "), F.col("nome").alias("Nome do Cliente!"), F.col("cpf").alias("C P F"))
    return schema.normalise_names(df)


@query("select 'c_custkey' as source, 'id' as target, true as mapped from (select count(*) from customer) union all select 'c_name', 'c_name', false union all select 'gone', 'x', false")
def rename_report(spark, sf_dir):
    return schema.rename_map(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), {"c_custkey": "id", "gone": "x"})[1]


@query(f"select id, coalesce(email, '') as email, '' as site, 'crm' as fonte_dados from {LEADS_SQL} where cargo is not null")
def ensured_columns(spark, sf_dir):
    df = schema.add_lineage(schema.drop_null_keys(leads(spark, sf_dir), ["cargo"]), "crm", AS_OF)
    return schema.ensure_columns(df, ["email", "site"]).select("id", "email", "site", "fonte_dados")


@query(f"select id, case when contains(email, '@') then lower(email) end as email, id % 12 + 1 <= 12 and id % 3 <> 0 as day_valid from {LEADS_SQL}")
def repaired_contacts(spark, sf_dir):
    df = leads(spark, sf_dir).select("id", F.concat(F.lit(" "), F.replace("email", F.lit("@"), F.lit(" @")), F.lit(" ")).alias("email"), F.when(F.col("id") % 3 == 0, "31/31/2020").otherwise("2020-01-31").alias("day"))
    return v.flag_date(v.repair_email(df, "email"), "day").select("id", "email", "day_valid")


@query(f"""
    select id, case id % 4 when 0 then 'São Paulo' when 1 then 'Rio de Janeiro' when 2 then 'Brasília' else 'Nowhere' end as city, case id % 3 when 0 then 'Casado' when 1 then 'Não informado' else 'Xyz' end as civil from {LEADS_SQL}
""")
def reference_values(spark, sf_dir):
    k = F.col("id")
    df = leads(spark, sf_dir).select("id", F.when(k % 4 == 0, "SAO PAULO").when(k % 4 == 1, "rio de janeiro").when(k % 4 == 2, "brasilia").otherwise("NOWHERE").alias("city"), F.when(k % 3 == 0, "married").when(k % 3 == 1, " ").otherwise("xyz").alias("civil"))
    return s.standardise_enum(s.standardise_dim(df, "city", "cities"), "civil", "marital")


@query("select n_nationkey, concat('Nation ', r_name) as nation from nation join region on n_regionkey = r_regionkey")
def table_dimension(spark, sf_dir):
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    dim = r.select(F.concat(F.lit("region"), F.col("r_regionkey").cast("string")).alias("key"), F.concat(F.lit("Nation "), "r_name").alias("value"))
    return s.standardise_dim(n.select("n_nationkey", F.concat(F.lit("Région "), F.col("n_regionkey").cast("string")).alias("nation")), "nation", dim)


@query(f"select id, case when contains(email, '@') then lower(email) end as email, concat(substr(cpf, 1, 3), '.', substr(cpf, 4, 3), '.', substr(cpf, 7, 3), '-', substr(cpf, 10, 2)) as cpf, cast(cast(valor as decimal(15, 2)) as varchar) as valor from {LEADS_SQL}")
def routed_columns(spark, sf_dir):
    df = leads(spark, sf_dir).select("id", "email", "cpf", s.money_text("valor").alias("valor"))
    return s.auto_standardise(df)


@query("select c_custkey, case c_custkey % 3 when 0 then 1 when 1 then 7 else 0 end as headcount_score, case c_custkey % 3 when 0 then 'pequena' when 1 then 'grande' else 'não informado' end as size_class, 'Customer' as primeiro_nome, 'Of Things' as ultimo from customer")
def headcounts_and_names(spark, sf_dir):
    k = F.col("c_custkey")
    df = table(spark, sf_dir, "customer").select("c_custkey", F.when(k % 3 == 0, "1-10").when(k % 3 == 1, "5000+").alias("faixa_funcionarios"), F.lit(" Customer  of Things ").alias("n"))
    out = s.name_parts(s.headcount_band(df), "n")
    return out.select("c_custkey", "headcount_score", "size_class", "primeiro_nome", F.initcap(F.substring_index(s.squeezed("n"), " ", -2)).alias("ultimo"))


@query("select s_suppkey, concat('R. ', cast(s_suppkey as varchar), ', AV. CENTRAL') as address, '01310-100' as address_cep, 'Um dia. Outro dia' as note from supplier")
def addresses(spark, sf_dir):
    df = table(spark, sf_dir, "supplier").select("s_suppkey", F.concat(F.lit("rua "), F.col("s_suppkey").cast("string"), F.lit(", avenida central")).alias("address"), F.lit("UM DIA. outro DIA").alias("note"))
    cep = s.address_fields(df.select("s_suppkey", F.lit("x 01310100 y").alias("address")), "address").select("s_suppkey", "address_cep")
    return s.sentence_case(s.address_fields(df, "address").drop("address_cep"), ["note"]).join(cep, "s_suppkey")


@query(f"select id, substr(md5(concat('{{\"id\":', cast(id as varchar), ',\"cpf\":\"', cpf, '\"}}')), 1, 16) as hash_registro from {LEADS_SQL}")
def row_hashes(spark, sf_dir):
    return s.row_hash(leads(spark, sf_dir).select("id", "cpf")).select("id", "hash_registro")


@query("select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 20")
def top_actions(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", F.lit("call").alias("action"))
    return aggregates.top_actions(o, "o_totalprice", "o_orderkey").drop("action")


@query("select o_orderkey, case when o_orderkey % 2 = 0 then o_totalprice end as score from orders")
def attached_predictions(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return joins.join_predictions(o.select("o_orderkey"), o.filter("o_orderkey % 2 = 0").withColumnRenamed("o_totalprice", "score"), "o_orderkey")


@query(f"""
    with p as (select * from {PREPARED_SQL}), g as (select max(c) as c from (select segmento, count(*) as c from p group by 1)),
    o as (select count(*) filter (where email is null or email = 'bad mail') / count(*) as bad, count(*) filter (where e < 30) / count(*) as low, count(*) filter (where rev >= 4)::double as large, count(*) as n from p),
    m as (select mo from (select month(data_cadastro) as mo, count(*) as c from p group by 1) order by c desc, mo limit 1)
    select * from (select 'invalid_email' as insight, 'high' as severity, round(bad, 8) as value, bad > 0.1 as on_ from o union all select 'low_engagement', 'medium', round(low, 8), low > 0.5 from o union all select 'large_accounts', 'info', large, large > 0 from o
      union all select 'peak_month', 'info', mo::double, true from m union all select 'concentration', 'medium', round(c / n, 8), c / n > 0.4 from o, g) where on_
""".replace("select * from (select 'invalid_email'", "select insight, severity, value from (select 'invalid_email'"))
def insight_rows(spark, sf_dir):
    df = prepared(spark, sf_dir).withColumn("ok", F.coalesce(F.col("email").contains("@"), F.lit(False)))
    return scoring.insights(df, "ok", "engagement_score", "revenue_score", "data_cadastro", "segmento").withColumn("value", F.round("value", 8))


@query("select 'segments' as area, 'medium' as priority from (select max(c) * 1.0 / sum(c) as s from (select count(*) as c from customer group by c_mktsegment)) where s > 0.1 union all select 'conversion', 'high' from (select count(*) as c from customer where c_acctbal > 9000) where c > 0")
def recommendation_rows(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    share = c.groupBy("c_mktsegment").agg(F.count("*").alias("n")).agg((F.max("n") / F.sum("n") * 4).alias("share"))
    roi = c.agg((F.count("*") * 0.0 + 5.0).alias("ltv_cac"))
    bands = c.agg(F.count_if(F.col("c_acctbal") > 9000).alias("high"))
    none = c.filter("c_custkey < 0").select(F.lit("x").alias("insight"))
    return scoring.recommendations(roi, share, bands, none).select("area", "priority")


@query(f"select pipeline_name, count(*) as runs from {METRICS_SQL} group by 1")
def anomaly_runs(spark, sf_dir):
    m = monitoring.run_anomalies(day_metrics(spark, sf_dir), ["records_processed", "processing_time_seconds", "error_count"])
    return m.groupBy("pipeline_name").agg(F.count("is_anomaly").alias("runs"))


@query("select count(*) as records_processed, count(*) filter (where value < 5) as error_count, (count(*) - count(*) filter (where value < 5)) / count(*) as success_rate from events")
def job_metrics(spark, sf_dir):
    return monitoring.run_metrics(table(spark, sf_dir, "events"), "events", 0.0, 1.0, "value < 5").select("records_processed", "error_count", "success_rate")


@query("select 'big' as pipeline_name, count(*) as records_processed, count(*) filter (where l_quantity < 10) as error_count, (count(*) - count(*) filter (where l_quantity < 10)) / count(*) as success_rate, count(*) as written from lineitem where l_extendedprice > 20000")
def observed_job(spark, sf_dir):
    """Metrics taken while a job's rows are written, beside the rows that it wrote."""
    build = lambda session: table(session, sf_dir, "lineitem").filter("l_extendedprice > 20000")
    done = monitoring.write_measured(spark, build, path := folder(spark, "observed"), "big", "l_quantity < 10")
    written = spark.read.parquet(path).agg(F.count("*").alias("written"))  # one row, from the files' footers
    return done.select("pipeline_name", "records_processed", "error_count", "success_rate").crossJoin(F.broadcast(written))


@query("select 'customer' as source, 2::bigint as columns, count(*) as rows, true as changed from customer union all select 'customer', 3, count(*), false from customer")
def profile_history(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    history = q.profile(c.select("c_custkey", "c_name", "c_acctbal"), "customer", "2024-05-01").unionByName(q.profile(c.select("c_custkey", "c_name"), "customer", "2024-05-02"))
    return q.drift_history(history, "customer", 365, AS_OF).select("source", "columns", "rows", "changed")


@query("select 'c_custkey' as \"column\", count(*) as rows from customer union all select 'c_name', count(*) from customer")
def last_profile(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    history = q.profile(c, "customer", "2024-05-01").unionByName(q.profile(c.select("c_custkey", "c_name"), "customer", "2024-05-02"))
    return q.latest_profile(history, "customer").select("column", "rows")


@query(f"select id, case when {CNPJ_SQL} then 'PJ' when {CPF_SQL} then 'PF' else 'unknown' end as document_type from {LEADS_SQL}")
def document_types(spark, sf_dir):
    return s.document_type(leads(spark, sf_dir)).select("id", "document_type")
