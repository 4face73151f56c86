"""Lead scores, life cycle, actions, insights and action lists by declarative rules."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import dims
from ..functions.standardise import banded, first_group
from ..functions.validate import VALIDATORS, is_blank, is_email


@dataclass(frozen=True)
class ScoringRule:
    """A rule: points times weight where a field meets a condition: > < == contains in days_ago."""

    name: str
    field: str
    condition: str
    value: object
    points: float
    weight: float = 1.0
    active: bool = True


#: The rules to begin with.
RULES = [
    ScoringRule("Valor Alto", "valor_estimado", ">", 5000, 50, 2.0),
    ScoringRule("Email Empresarial", "email", "contains", "@empresa.com", 30, 1.5),
    ScoringRule("Cargo Decisor", "cargo", "in", ["CEO", "CTO", "Diretor", "Gerente"], 40, 1.8),
    ScoringRule("Segmento Premium", "segmento", "in", ["Tecnologia", "Saúde", "Finanças"], 35, 1.5),
    ScoringRule("Região SP", "regiao", "contains", "São Paulo", 20, 1.0),
    ScoringRule("Lead Recente", "data_cadastro", "days_ago", 7, 25, 1.2),
    ScoringRule("Fonte Qualificada", "fonte", "in", ["Indicação", "Site", "LinkedIn"], 15, 1.0),
]


def add_rule(rules: list[ScoringRule], rule: ScoringRule) -> list[ScoringRule]:
    """The rules with one more; one of the same name is replaced."""
    return [*(r for r in rules if r.name != rule.name), rule]


def rule_points(rule: ScoringRule, as_of) -> Column:
    """The weighted points of a rule; none for a null field."""
    x, points = F.col(f"`{rule.field}`"), F.lit(float(rule.points))
    text = F.lower(x.cast("string"))
    if rule.condition == "days_ago":
        days = F.floor((F.unix_timestamp(F.lit(as_of).cast("timestamp")) - F.unix_timestamp(x.cast("timestamp"))) / 86400)
        hit, points = days <= rule.value, points * (rule.value - days) / rule.value
    elif rule.condition in (">", "<", "=="):
        hit = {">": x > F.lit(rule.value), "<": x < F.lit(rule.value), "==": x == F.lit(rule.value)}[rule.condition]
    else:
        words = rule.value if rule.condition == "in" else [rule.value]
        hit = reduce(Column.__or__, (text.contains(str(w).lower()) for w in words))
    return F.when(hit, points * rule.weight).otherwise(0.0)


def score_bands_of(score: Column) -> Column:
    return F.when(score >= 100, "qualificado").when(score >= 70, "quente").when(score >= 40, "morno").otherwise("frio")


def score_rules(df: DataFrame, rules: list[ScoringRule] | None = None, as_of=None) -> DataFrame:
    """L1: score (two decimals) and status. Rules on fields that the table lacks don't count."""
    own = [r for r in (RULES if rules is None else rules) if r.active and r.field in df.columns]
    score = F.round(sum((rule_points(r, as_of) for r in own), F.lit(0.0)), 2)
    return df.withColumn("score", score).withColumn("status", score_bands_of(F.col("score")))


def score_stats(df: DataFrame) -> DataFrame:
    """L2: (status, n, mean, least and greatest score)."""
    return df.groupBy("status").agg(F.count("*").alias("n"), F.avg("score").alias("mean_score"), F.min("score").alias("min_score"), F.max("score").alias("max_score"))


def qualified(df: DataFrame, statuses: tuple[str, ...] = ("qualificado", "quente")) -> DataFrame:
    return df.filter(F.col("status").isin(*statuses))


def score_groups(df: DataFrame, spec: dict[str, dict]) -> DataFrame:
    """L3: groups of criteria, each capped: {group: {"max": m, "criteria": [(field, test, value, points)]}}. Tests: valid
    (a validator's name), contains, not_null, in, equals, longer. Adds score_<group> and total_score."""
    out = {}
    for group, own in spec.items():
        points = F.lit(0.0)
        for field, test, value, worth in own["criteria"]:
            x = F.col(f"`{field}`")
            text = F.lower(F.coalesce(x.cast("string"), F.lit("")))
            hit = {
                "valid": lambda: VALIDATORS[value][0](x), "contains": lambda: text.contains(str(value).lower()), "not_null": lambda: ~is_blank(field),
                "in": lambda: x.isin(*value), "equals": lambda: x == F.lit(value), "longer": lambda: F.length(text) > value,
            }[test]()
            points = points + F.when(hit, float(worth)).otherwise(0.0)
        out[f"score_{group}"] = F.least(points, F.lit(float(own["max"])))
    df = df.withColumns(out)
    return df.withColumn("total_score", sum((F.col(c) for c in out), F.lit(0.0)))


CRITICAL = ["nome_completo", "email", "empresa_nome", "whatsapp"]
IMPORTANT = ["segmento_atuacao", "cargo_atual", "faixa_funcionarios", "faixa_faturamento"]
OPTIONAL = ["linkedin", "objetivo_aprendizado", "dores_empresa"]


def lead_quality(df: DataFrame, as_of, date: str = "submit_date", critical: list[str] | None = None, important: list[str] | None = None, optional: list[str] | None = None, email: str = "email") -> DataFrame:
    """L4: 0.3 critical + 0.2 important + 0.15 e-mail + 0.15 engagement + 0.2 recency, with 1 / (1 + days / 30) for
    recency and 999 days for none; bands Baixa, Média, Alta, Muito Alta at 0.3, 0.5, 0.7 (0 has no band)."""

    def share(cols: list[str]) -> Column:
        return sum(((~is_blank(c)).cast("int") for c in cols if c in df.columns), F.lit(0)) / float(len(cols))

    days = F.coalesce(F.datediff(F.lit(as_of).cast("date"), F.col(date).cast("date")), F.lit(999)) if date in df.columns else None
    out = {
        "completude_criticos": share(CRITICAL if critical is None else critical), "completude_importantes": share(IMPORTANT if important is None else important),
        "email_valido": is_email(email).cast("int") if email in df.columns else F.lit(0), "score_engajamento": share(OPTIONAL if optional is None else optional),
        "score_recencia": 1 / (1 + days / 30) if days is not None else F.lit(0.5),
    }
    df = df.withColumns(out)
    score = F.col("completude_criticos") * 0.3 + F.col("completude_importantes") * 0.2 + F.col("email_valido") * 0.15 + F.col("score_engajamento") * 0.15 + F.col("score_recencia") * 0.2
    return df.withColumn("score_qualidade_lead", score).withColumn("classificacao_lead", banded(F.col("score_qualidade_lead"), [0, 0.3, 0.5, 0.7, 1.0], ["Baixa", "Média", "Alta", "Muito Alta"]))


#: Points of filled fields.
ENGAGEMENT = {"linkedin": 10, "objetivos": 15, "dores_necessidades": 20, "empresa": 10, "cargo": 10, "faturamento_score": 15}


def lifecycle(df: DataFrame, as_of, date: str = "data_inscricao", weights: dict[str, int] | None = None) -> DataFrame:
    """lifecycle_stage, dias_desde_inscricao, engagement_score and potencial_cliente (0 has no band)."""
    weights = {c: w for c, w in (ENGAGEMENT if weights is None else weights).items() if c in df.columns}
    score = sum((F.col(f"`{c}`").isNotNull().cast("int") * w for c, w in weights.items()), F.lit(0))
    has = date in df.columns
    df = df.withColumns({
        "lifecycle_stage": F.when(F.col(date).isNotNull(), "inscrito").otherwise("lead") if has else F.lit("lead"),
        "dias_desde_inscricao": F.datediff(F.lit(as_of).cast("date"), F.col(date).cast("date")) if has else F.lit(None).cast("int"),
        "engagement_score": score,
    })
    return df.withColumn("potencial_cliente", banded(F.col("engagement_score"), [0, 30, 60, 100], ["baixo", "médio", "alto"]))


def potential(df: DataFrame, level: str, revenue_score: str) -> DataFrame:
    """Job level (C-Level 5 to Operacional 0) times revenue score."""
    rank = F
    for i, (name, _) in enumerate(dims.JOB_LEVELS):
        rank = rank.when(F.col(level) == name, 5 - i)
    return df.withColumn("potencial_score", rank.otherwise(0) * F.coalesce(F.col(revenue_score), F.lit(0)))


def next_action(df: DataFrame, engagement: str = "engagement_score", revenue: str = "faturamento_score", points: str = "potencial_score", days: str = "dias_desde_inscricao") -> DataFrame:
    """The first action whose condition holds, and its score. Without the random factor all actions of a row tie."""
    e = F.coalesce(F.col(engagement), F.lit(0))
    action = (
        F.when(e < 40, "email_nurturing")
        .when((F.coalesce(F.col(revenue), F.lit(0)) >= 3) & (e > 60), "sales_call")
        .when((e >= 40) & (e <= 60), "webinar_invite")
        .when(F.coalesce(F.col(points), F.lit(0)) > 15, "vip_program")
        .when(F.coalesce(F.col(days), F.lit(0)) > 90, "reactivation")
    )
    return df.withColumn("action", action).withColumn("action_score", F.when(F.col("action").isNotNull(), F.coalesce(F.col(points), F.lit(1))))


def action_distribution(df: DataFrame) -> DataFrame:
    return df.filter("action is not null").groupBy("action").agg(F.count("*").alias("n"))


def estimate_company(df: DataFrame, name: str, revenue: str = "faturamento_score", level: str = "nivel_cargo") -> DataFrame:
    """Setor by keywords of the name; porte from revenue score and job level."""
    r = F.coalesce(F.col(revenue), F.lit(0))
    points = F.when(r >= 4, 3).when(r >= 3, 2).otherwise(1) + F.coalesce(F.col(level).isin("C-Level", "Diretoria").cast("int"), F.lit(0))
    return df.withColumns({"setor": first_group(F.coalesce(F.col(name), F.lit("")), dims.SECTORS, "outros"), "porte": F.when(points >= 4, "grande").when(points >= 2, "média").otherwise("pequena")})


def opportunities(df: DataFrame, segment: str, score: str, engagement: str, revenue: str, valid: str) -> DataFrame:
    """(kind, name, n): top and under-served segments, and counts of high potential, low engagement, enterprise and invalid rows."""
    seg = df.filter(F.col(segment).isNotNull()).groupBy(F.col(segment).alias("name")).agg(F.count("*").alias("n"))
    top = seg.orderBy(F.desc("n"), "name").limit(5).select(F.lit("top_segment").alias("kind"), "name", "n")
    low = seg.filter("n < 10").orderBy("n", "name").limit(5).select(F.lit("underserved_segment").alias("kind"), "name", "n")
    one = df.agg(F.count_if(F.col(score) > 15).alias("high_potential"), F.count_if(F.col(engagement) < 30).alias("low_engagement"), F.count_if(F.col(revenue) >= 5).alias("enterprise"), F.count_if(~F.col(valid).cast("boolean")).alias("invalid_documents"))
    flat = one.select(F.inline(F.array(*[F.struct(F.lit(c).alias("kind"), F.lit(None).cast("string").alias("name"), F.col(c).alias("n")) for c in one.columns])))
    return top.unionByName(low).unionByName(flat)


def insights(df: DataFrame, email_valid: str, engagement: str, revenue: str, date: str, segment: str) -> DataFrame:
    """(insight, severity, value) of those that hold: invalid e-mails over 10 %, low engagement over half, large
    accounts, the month with most rows, and a segment with over 40 %."""
    n = F.count("*")
    one = df.agg((F.count_if(~F.col(email_valid).cast("boolean")) / n).alias("bad"), (F.count_if(F.col(engagement) < 30) / n).alias("low"), F.count_if(F.col(revenue) >= 4).cast("double").alias("large"), F.mode(F.month(F.col(date)), True).cast("double").alias("peak"), F.mode(F.col(segment), True).alias("seg"), n.alias("n"))
    share = df.groupBy(segment).agg(F.count("*").alias("c")).agg(F.max("c").alias("c"))
    rows = [
        ("invalid_email", "high", F.col("bad"), F.col("bad") > 0.1), ("low_engagement", "medium", F.col("low"), F.col("low") > 0.5), ("large_accounts", "info", F.col("large"), F.col("large") > 0),
        ("peak_month", "info", F.col("peak"), F.col("peak").isNotNull()), ("concentration", "medium", F.col("c") / F.col("n"), F.col("c") / F.col("n") > 0.4),
    ]
    built = F.array_compact(F.array(*[F.when(on, F.struct(F.lit(i).alias("insight"), F.lit(s).alias("severity"), v.cast("double").alias("value"))) for i, s, v, on in rows]))
    return one.crossJoin(F.broadcast(share)).select(F.inline(built))


def recommendations(roi: DataFrame, segments: DataFrame, bands: DataFrame, found: DataFrame) -> DataFrame:
    """(area, priority, recommendation) from one-row ROI, segment shares (share), probability bands and insights."""
    best = segments.agg(F.max("share").alias("share"))
    bad = found.agg(F.count_if((F.col("insight") == "invalid_email")).alias("bad_mail"))
    one = roi.crossJoin(F.broadcast(best)).crossJoin(F.broadcast(bands)).crossJoin(F.broadcast(bad))
    rows = [
        ("roi", "high", "review acquisition cost", F.col("ltv_cac") < 3), ("segments", "medium", "diversify segments", F.col("share") > 0.4),
        ("conversion", "high", "call leads of high probability", F.col("high") > 0), ("quality", "medium", "validate e-mails at entry", F.col("bad_mail") > 0),
    ]
    return one.select(F.inline(F.array_compact(F.array(*[F.when(on, F.struct(F.lit(a).alias("area"), F.lit(p).alias("priority"), F.lit(t).alias("recommendation"))) for a, p, t, on in rows]))))


SENSITIVE = ("cpf", "rg", "email", "telefone", "whatsapp", "endereco", "data_nascimento")


def privacy_report(df: DataFrame, as_of, consent: str, date: str, days: int = 730) -> DataFrame:
    """One row: rows, consents, their rate, exposed columns, rows older than `days`."""
    exposed = [c for c in df.columns if c.lower() in SENSITIVE]
    given = F.count_if(F.col(consent).cast("boolean"))
    return df.agg(F.count("*").alias("rows"), given.alias("consents"), (given / F.nullif(F.count("*"), F.lit(0))).alias("consent_rate"), F.lit(",".join(exposed)).alias("exposed_fields"), F.count_if(F.datediff(F.lit(as_of).cast("date"), F.col(date)) > days).alias("expired"))


def lead_features(df: DataFrame, as_of, created: str = "data_cadastro", email: str = "email", company: str = "empresa", job: str = "cargo", value: str = "valor_estimado", segment: str = "segmento", region: str = "regiao") -> DataFrame:
    """Hour, weekday, business hours, days since, corporate e-mail, company length, decision maker, log value, segment category and capital region."""
    x, domain = F.col(created), F.lower(F.substring_index(F.col(email), "@", -1))
    return df.withColumns({
        "hour": F.hour(x), "weekday": F.weekday(x), "business_hours": F.coalesce(((F.hour(x) >= 9) & (F.hour(x) < 18) & (F.weekday(x) < 5)).cast("int"), F.lit(0)), "days_since": F.datediff(F.lit(as_of).cast("date"), x),
        "corporate_email": F.coalesce((F.col(email).contains("@") & ~domain.isin(*dims.PERSONAL_MAIL)).cast("int"), F.lit(0)), "company_length": F.length(F.coalesce(F.col(company), F.lit(""))),
        "decision_maker": F.coalesce(F.lower(F.col(job)).rlike("ceo|cto|cfo|diretor|gerente|presidente|fundador").cast("int"), F.lit(0)), "log_value": F.log1p(F.greatest(F.coalesce(F.col(value).cast("double"), F.lit(0.0)), F.lit(0.0))),
        "segment_category": first_group(F.coalesce(F.col(segment), F.lit("")), dims.SEGMENTS, "OUTROS"), "capital_region": F.coalesce(F.lower(F.col(region)).rlike("são paulo|rio de janeiro|minas gerais|sp|rj|mg").cast("int"), F.lit(0)),
    })


def explain_rules(df: DataFrame, probability: str, value: str, decision: str = "decision_maker", corporate: str = "corporate_email") -> DataFrame:
    """predicted_value (1.5 over 0.8, 1.2 over 0.6, 1.3 more for decision makers), confidence, and lists of strengths, risks and recommendations."""
    p, decides, mail = F.col(probability), F.col(decision) == 1, F.col(corporate) == 1
    factor = F.when(p > 0.8, 1.5).when(p > 0.6, 1.2).otherwise(1.0) * F.when(decides, 1.3).otherwise(1.0)
    listed = lambda *rows: F.slice(F.array_compact(F.array(*[F.when(on, F.lit(t)) for on, t in rows])), 1, 3)
    return df.withColumns({
        "predicted_value": F.col(value) * factor, "confidence": F.when((p > 0.8) | (p < 0.2), "high").when((p > 0.6) | (p < 0.4), "medium").otherwise("low"),
        "strengths": listed((decides, "decision maker"), (mail, "corporate e-mail"), (p > 0.7, "high probability")), "risks": listed((~mail, "personal e-mail"), (~decides, "not a decision maker"), (p < 0.3, "low probability")),
        "recommendations": listed((p > 0.8, "call today"), ((p > 0.5) & (p <= 0.8), "send proposal"), (p <= 0.5, "nurture by e-mail")),
    })


def action_lists(df: DataFrame, churn: str, stale_days: str, probability: str, quality: str) -> DataFrame:
    """One row of counts: critical churn over 0.7, stale over 30 days, top opportunities over 0.8, low quality under 50."""
    return df.agg(F.count_if(F.col(churn) > 0.7).alias("critical"), F.count_if(F.col(stale_days) > 30).alias("stale"), F.count_if(F.col(probability) > 0.8).alias("top_opportunities"), F.count_if(F.col(quality) < 50).alias("low_quality"))


def churn_bands(df: DataFrame, churn: str, segment: str) -> DataFrame:
    """(segment, low, medium, high, mean_risk): bands at 0.3 and 0.7."""
    x = F.col(churn)
    return df.groupBy(segment).agg(F.count_if(x < 0.3).alias("low"), F.count_if((x >= 0.3) & (x < 0.7)).alias("medium"), F.count_if(x >= 0.7).alias("high"), F.avg(x).alias("mean_risk"))


def customer_segments(df: DataFrame, value: str, premium: str, age: str, date: str, high: float = 1000.0, middle: float = 500.0) -> DataFrame:
    """VIP (premium and high value), Premium, Standard, Basic; age group and purchase month."""
    v, p = F.col(value), F.coalesce(F.col(premium).cast("boolean"), F.lit(False))
    seg = F.when(p & (v > high), "VIP").when(p | (v > high), "Premium").when(v > middle, "Standard").otherwise("Basic")
    band = F.when(F.col(age) < 25, "18-24").when(F.col(age) < 35, "25-34").when(F.col(age) < 50, "35-49").when(F.col(age).isNotNull(), "50+")
    return df.withColumns({"customer_segment": seg, "age_group": band, "purchase_month": F.date_format(date, "yyyy-MM")})


def score_bands(df: DataFrame, score: str) -> DataFrame:
    """Cold, Cool, Warm, Hot, Premium at 30, 50, 70, 85, right-closed; 0 has no band."""
    return df.withColumn("score_band", banded(F.col(score), [0, 30, 50, 70, 85, 100], ["Cold", "Cool", "Warm", "Hot", "Premium"]))
