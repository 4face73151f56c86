"""Lead scores, life cycle and rule reports (L)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import standardise as s
from ..operators import scoring
from .base import AS_OF, LEADS_SQL, leads, query, table

RULES = [
    scoring.ScoringRule("value", "valor", ">", 5000, 50, 2.0), scoring.ScoringRule("mail", "email", "contains", "@empresa.com", 30, 1.5), scoring.ScoringRule("job", "cargo", "in", ["CEO", "Diretor"], 40, 1.8),
    scoring.ScoringRule("poor", "valor", "<", 0, -10), scoring.ScoringRule("nation", "nacao", "==", 3, 5), scoring.ScoringRule("fresh", "data_cadastro", "days_ago", 365, 25, 1.2), scoring.ScoringRule("off", "id", ">", 0, 99, active=False),
]
DAYS = f"datediff('day', data_cadastro, date '{AS_OF}')"
SCORE_SQL = f"""
    round(case when valor > 5000 then 100.0 else 0 end + case when contains(lower(email), '@empresa.com') then 45.0 else 0 end + case when contains(lower(cargo), 'ceo') or contains(lower(cargo), 'diretor') then 72.0 else 0 end
          + case when valor < 0 then -10.0 else 0 end + case when nacao = 3 then 5.0 else 0 end + case when {DAYS} <= 365 then 25.0 * (365 - {DAYS}) / 365 * 1.2 else 0 end, 2)
"""
STATUS_SQL = "case when score >= 100 then 'qualificado' when score >= 70 then 'quente' when score >= 40 then 'morno' else 'frio' end"


@query(f"with s as (select id, cast({SCORE_SQL} as double) as score from {LEADS_SQL}) select id, score, {STATUS_SQL} as status from s")
def score_rules(spark, sf_dir):
    return scoring.score_rules(leads(spark, sf_dir), RULES, AS_OF).select("id", "score", "status")


@query(f"with s as (select id, cast({SCORE_SQL} as double) as score from {LEADS_SQL}), t as (select {STATUS_SQL} as status, score from s) select status, count(*) as n, round(avg(score), 6) as mean_score, min(score) as min_score, max(score) as max_score from t group by 1")
def score_stats(spark, sf_dir):
    return scoring.score_stats(scoring.score_rules(leads(spark, sf_dir), RULES, AS_OF)).withColumn("mean_score", F.round("mean_score", 6))


@query(f"with s as (select id, cast({SCORE_SQL} as double) as score from {LEADS_SQL}) select id, score from s where score >= 70")
def qualified(spark, sf_dir):
    return scoring.qualified(scoring.score_rules(leads(spark, sf_dir), RULES, AS_OF)).select("id", "score")


@query(f"""
    select id, cast(least(case when contains(lower(coalesce(cargo, '')), 'ceo') then 15.0 else 0 end + case when telefone is not null then 10.0 else 0 end + case when segmento in ('BUILDING', 'MACHINERY') then 10.0 else 0 end, 20.0) as double) as score_prof,
           cast(least(case when faixa_faturamento = 'Acima de 100 milhões' then 20.0 else 0 end + case when length(coalesce(nome, '')) > 20 then 10.0 else 0 end, 40.0) as double) as score_pot from {LEADS_SQL}
""")
def score_groups(spark, sf_dir):
    spec = {
        "prof": {"max": 20, "criteria": [("cargo", "contains", "ceo", 15), ("telefone", "not_null", None, 10), ("segmento", "in", ["BUILDING", "MACHINERY"], 10)]},
        "pot": {"max": 40, "criteria": [("faixa_faturamento", "equals", "Acima de 100 milhões", 20), ("nome", "longer", 20, 10)]},
    }
    return scoring.score_groups(leads(spark, sf_dir), spec).select("id", "score_prof", "score_pot")


@query(f"""
    with l as (select id, (1 + cast(email is not null as int) + 1 + cast(telefone is not null as int)) / 4 as c, (1 + cast(cargo is not null as int) + cast(faixa_faturamento is not null as int)) / 3 as i,
               coalesce(regexp_matches(lower(email), '^[a-z0-9._%+-]+@[a-z0-9.-]+\\.[a-z]{{2,}}$'), false)::int as e, cast(cep is not null as int) / 1 as g, 1 / (1 + {DAYS} / 30) as r from {LEADS_SQL}),
    s as (select id, c * 0.3 + i * 0.2 + e * 0.15 + g * 0.15 + r * 0.2 as q from l)
    select id, round(q, 8) as score_qualidade_lead, case when q <= 0 then null when q <= 0.3 then 'Baixa' when q <= 0.5 then 'Média' when q <= 0.7 then 'Alta' when q <= 1 then 'Muito Alta' end as classificacao_lead from s
""")
def lead_quality(spark, sf_dir):
    out = scoring.lead_quality(leads(spark, sf_dir), AS_OF, "data_cadastro", ["nome", "email", "empresa", "telefone"], ["segmento", "cargo", "faixa_faturamento"], ["cep"])
    return out.select("id", F.round("score_qualidade_lead", 8).alias("score_qualidade_lead"), "classificacao_lead")


@query(f"""
    with l as (select id, {DAYS} as d, 10 * cast(telefone is not null as int) + 15 * cast(cep is not null as int) + 20 * cast(email is not null as int) + 10 * cast(cargo is not null as int) + 15 * cast(faixa_faturamento is not null as int) as e from {LEADS_SQL})
    select id, 'inscrito' as lifecycle_stage, cast(d as integer) as dias_desde_inscricao, e as engagement_score, case when e <= 0 then null when e <= 30 then 'baixo' when e <= 60 then 'médio' else 'alto' end as potencial_cliente from l
""")
def lifecycle(spark, sf_dir):
    weights = {"telefone": 10, "cep": 15, "email": 20, "cargo": 10, "faixa_faturamento": 15}
    return scoring.lifecycle(leads(spark, sf_dir), AS_OF, "data_cadastro", weights).select("id", "lifecycle_stage", "dias_desde_inscricao", "engagement_score", "potencial_cliente")


def prepared(spark, sf_dir):
    df = s.revenue_band(s.job_level(leads(spark, sf_dir), "cargo"))
    df = scoring.potential(df, "cargo_level", "revenue_score")
    return scoring.lifecycle(df, AS_OF, "data_cadastro", {"telefone": 10, "cep": 15, "email": 20, "cargo": 10, "faixa_faturamento": 15})


PREPARED_SQL = f"""
    (select id, segmento, email, data_cadastro, {DAYS} as days, case id % 4 when 1 then 3 when 2 then 5 else 1 end as rev,
            case when cargo = 'CEO' then 5 when cargo = 'Diretor de Vendas' then 4 when cargo = 'analista' then 1 else 0 end as lvl,
            10 * cast(telefone is not null as int) + 15 * cast(cep is not null as int) + 20 * cast(email is not null as int) + 10 * cast(cargo is not null as int) + 15 * cast(faixa_faturamento is not null as int) as e from {LEADS_SQL})
"""
ACTION_SQL = "case when e < 40 then 'email_nurturing' when rev >= 3 and e > 60 then 'sales_call' when e between 40 and 60 then 'webinar_invite' when lvl * rev > 15 then 'vip_program' when days > 90 then 'reactivation' end"


@query(f"select id, lvl * rev as potencial_score, {ACTION_SQL} as action from {PREPARED_SQL}")
def next_action(spark, sf_dir):
    return scoring.next_action(prepared(spark, sf_dir), revenue="revenue_score").select("id", "potencial_score", "action")


@query(f"select action, count(*) as n from (select {ACTION_SQL} as action from {PREPARED_SQL}) where action is not null group by 1")
def action_distribution(spark, sf_dir):
    return scoring.action_distribution(scoring.next_action(prepared(spark, sf_dir), revenue="revenue_score"))


@query(f"select id, case when contains(lower(segmento), 'it') then 'tecnologia' else 'outros' end as setor, case when rev >= 4 then 3 when rev >= 3 then 2 else 1 end + cast(lvl >= 4 as int) as points from {PREPARED_SQL}")
def estimate_company(spark, sf_dir):
    out = scoring.estimate_company(prepared(spark, sf_dir), "segmento", "revenue_score", "cargo_level")
    points = F.when(F.col("revenue_score") >= 4, 3).when(F.col("revenue_score") >= 3, 2).otherwise(1) + F.col("cargo_level").isin("C-Level", "Diretoria").cast("int")
    return out.select("id", "setor", points.alias("points"))


@query(f"""
    with p as (select * from {PREPARED_SQL}), g as (select segmento as name, count(*) as n from p group by 1)
    select * from (select 'top_segment' as kind, name, n from g order by n desc, name limit 5) union all select * from (select 'underserved_segment', name, n from g where n < 10 order by n, name limit 5)
    union all select 'high_potential', null, count(*) from p where lvl * rev > 15 union all select 'low_engagement', null, count(*) from p where e < 30 union all select 'enterprise', null, count(*) from p where rev >= 5
    union all select 'invalid_documents', null, count(*) from p where email is null or email = 'bad mail'
""")
def opportunities(spark, sf_dir):
    df = prepared(spark, sf_dir).withColumn("ok", F.coalesce(F.col("email").contains("@"), F.lit(False)))
    return scoring.opportunities(df, "segmento", "potencial_score", "engagement_score", "revenue_score", "ok")


@query(f"""
    with p as (select * from {PREPARED_SQL})
    select count(*) as rows, count(*) filter (where id % 3 = 0) as consents, count(*) filter (where id % 3 = 0) / count(*) as consent_rate, 'email,cpf,telefone' as exposed_fields, count(*) filter (where days > 730) as expired from p
""")
def privacy_report(spark, sf_dir):
    df = leads(spark, sf_dir).withColumn("consent", F.col("id") % 3 == 0)
    return scoring.privacy_report(df, AS_OF, "consent", "data_cadastro")


@query("""
    with o as (select o_custkey, o_orderpriority, (o_custkey % 100) / 100 as churn from orders)
    select o_orderpriority as segment, count(*) filter (where churn < 0.3) as low, count(*) filter (where churn >= 0.3 and churn < 0.7) as medium, count(*) filter (where churn >= 0.7) as high, round(avg(churn), 8) as mean_risk from o group by 1
""")
def churn_bands(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("segment"), (F.col("o_custkey") % 100 / 100).alias("churn"))
    return scoring.churn_bands(o, "churn", "segment").withColumn("mean_risk", F.round("mean_risk", 8))


@query("""
    select o_orderkey, case when o_custkey % 2 = 0 and o_totalprice > 300000 then 'VIP' when o_custkey % 2 = 0 or o_totalprice > 300000 then 'Premium' when o_totalprice > 100000 then 'Standard' else 'Basic' end as customer_segment,
           case when o_custkey % 80 < 25 then '18-24' when o_custkey % 80 < 35 then '25-34' when o_custkey % 80 < 50 then '35-49' else '50+' end as age_group, strftime(o_orderdate, '%Y-%m') as purchase_month from orders
""")
def customer_segments(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumns({"premium": F.col("o_custkey") % 2 == 0, "age": F.col("o_custkey") % 80})
    return scoring.customer_segments(o, "o_totalprice", "premium", "age", "o_orderdate", 300_000, 100_000).select("o_orderkey", "customer_segment", "age_group", "purchase_month")


@query("select o_orderkey, case when s <= 0 then null when s <= 30 then 'Cold' when s <= 50 then 'Cool' when s <= 70 then 'Warm' when s <= 85 then 'Hot' else 'Premium' end as score_band from (select o_orderkey, o_orderkey % 101 as s from orders)")
def score_bands(spark, sf_dir):
    return scoring.score_bands(table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_orderkey") % 101).alias("s")), "s").select("o_orderkey", "score_band")


@query("""
    with o as (select (o_custkey % 100) / 100 as churn, o_orderkey % 60 as stale, (o_custkey % 97) / 97 as p, o_orderkey % 101 as q from orders)
    select count(*) filter (where churn > 0.7) as critical, count(*) filter (where stale > 30) as stale, count(*) filter (where p > 0.8) as top_opportunities, count(*) filter (where q < 50) as low_quality from o
""")
def action_lists(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select((F.col("o_custkey") % 100 / 100).alias("churn"), (F.col("o_orderkey") % 60).alias("stale"), (F.col("o_custkey") % 97 / 97).alias("p"), (F.col("o_orderkey") % 101).alias("q"))
    return scoring.action_lists(o, "churn", "stale", "p", "q")


@query(f"""
    select id, coalesce((contains(email, '@') and not contains(email, 'gmail'))::int, 0) as corporate_email, coalesce((cargo in ('CEO', 'Diretor de Vendas'))::int, 0) as decision_maker, cast({DAYS} as integer) as days_since, round(ln(1 + greatest(valor, 0)), 8) as log_value from {LEADS_SQL}
""")
def lead_features(spark, sf_dir):
    out = scoring.lead_features(leads(spark, sf_dir), AS_OF, value="valor", region="cidade_estado")
    return out.select("id", "corporate_email", "decision_maker", "days_since", F.round("log_value", 8).alias("log_value"))


@query(f"""
    with l as (select id, valor, (id % 100) / 100 as p, coalesce((contains(email, '@') and not contains(email, 'gmail'))::int, 0) as c, coalesce((cargo in ('CEO', 'Diretor de Vendas'))::int, 0) as d from {LEADS_SQL})
    select id, round(valor * case when p > 0.8 then 1.5 when p > 0.6 then 1.2 else 1.0 end * case when d = 1 then 1.3 else 1.0 end, 6) as predicted_value, case when p > 0.8 or p < 0.2 then 'high' when p > 0.6 or p < 0.4 then 'medium' else 'low' end as confidence,
           cast((d = 1)::int + (c = 1)::int + (p > 0.7)::int as integer) as n_strengths from l
""")
def explain_rules(spark, sf_dir):
    df = scoring.lead_features(leads(spark, sf_dir), AS_OF, value="valor", region="cidade_estado").withColumn("p", F.col("id") % 100 / 100)
    return scoring.explain_rules(df, "p", "valor").select("id", F.round("predicted_value", 6).alias("predicted_value"), "confidence", F.size("strengths").alias("n_strengths"))
