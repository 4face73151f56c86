"""Documents to relational rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.standardise import blank_to_null, formatted_phone, money, parsed_date, proper_name, squeezed
from ..functions.validate import is_email
from .dedup import dedup_exact_then_id, dedup_ignore_dates
from .schema import union_tables


def unpivot_keys(df: DataFrame, json_col: str, prefix: str, fields: list[str], keep: list[str] | None = None) -> DataFrame:
    """Keys such as <prefix>.<id>.<field> of a JSON text become one row per id, with a column per field.

    All within a row, without a shuffle: equal documents keep rows of their own. Entries are sorted by id once, and an id's
    fields are its neighbours, so the work is that of sorting. Of a key that comes twice one value is taken.
    """
    keep = [c for c in df.columns if c != json_col] if keep is None else keep
    pattern = rf"^\Q{prefix}\E\.([^.]+)\.({'|'.join(fields)})$"
    entries = F.map_entries(F.from_json(F.col(json_col), "map<string,string>"))
    named = F.filter(F.transform(entries, lambda e: F.struct(F.regexp_extract(e["key"], pattern, 1).alias("id"), F.regexp_extract(e["key"], pattern, 2).alias("field"), e["value"].alias("value"))), lambda e: e["id"] != "")
    ordered = df.select(*keep, F.array_sort(named).alias("_s"))
    once = F.filter("_s", lambda e, i: (i == 0) | (F.get("_s", i - 1)["id"] != e["id"]) | (F.get("_s", i - 1)["field"] != e["field"]))
    parsed = ordered.select(*keep, once.alias("_e"))
    begins = F.filter(F.transform("_e", lambda e, i: F.when((i == 0) | (F.get("_e", i - 1)["id"] != e["id"]), i)), lambda i: i.isNotNull())
    at = lambda i, k: F.get("_e", i + k)
    value = lambda i, f: F.coalesce(*[F.when((at(i, k)["id"] == at(i, 0)["id"]) & (at(i, k)["field"] == f), at(i, k)["value"]) for k in range(len(fields))])
    runs = F.transform(begins, lambda i: F.struct(at(i, 0)["id"].alias("entry_id"), *[value(i, f).alias(f) for f in fields]))
    return parsed.select(*keep, F.inline(runs))


def project_payments(df: DataFrame, json_col: str = "doc", email: str = "email", key: str = "id") -> DataFrame:
    """Payment rows: payment_id, customer_email, valuation_id, date, amount, status, type."""
    rows = unpivot_keys(df, json_col, "valuations", ["date", "amount", "paid", "type"], [key, email]).filter("date is not null")
    return rows.select(
        F.concat(F.lit("payment_"), "entry_id").alias("payment_id"), F.coalesce(email, key).alias("customer_email"), F.col("entry_id").alias("valuation_id"), parsed_date("date").alias("payment_date"),
        F.coalesce(money("amount"), F.lit(0).cast("decimal(15,2)")).alias("payment_amount"), F.coalesce(F.lower("paid") == "true", F.lit(False)).alias("payment_status"), F.col("type").alias("service_type"),
    )


def pick(df: DataFrame, *names: str) -> Column:
    """The first of the named columns that the table has and that is filled; names may hold dots."""
    own = [F.col(f"`{n}`").cast("string") for n in names if n in df.columns]
    return F.coalesce(*own) if own else F.lit(None).cast("string")


#: Output column -> (source names, how it is read).
VALUATION_FIELDS = {
    "valuation_id": (("id",), "text"), "company_name": (("overview.company", "company"), "name"), "full_name": (("overview.fullName",), "name"), "email": (("overview.email", "email"), "email"),
    "whatsapp": (("overview.whatsapp",), "phone"), "website": (("overview.website",), "text"), "city": (("overview.city",), "text"), "state": (("overview.state",), "text"), "market": (("overview.market",), "text"),
    "company_type": (("overview.type",), "text"), "foundation_date": (("overview.foundationDate",), "date"), "valuation_amount": (("valuation",), "money"), "valuation_type": (("valuationType",), "text"),
    "planned_revenue": (("financials.currentPlannedRevenue",), "money"), "planned_ebitda": (("financials.currentPlannedEBITDA",), "money"), "planned_investments": (("financials.currentPlannedInvestments",), "money"),
    "yearly_investments": (("financials.yearlyPlannedInvestments",), "money"), "current_debt": (("financials.currentDebt",), "money"), "fixed_assets": (("financials.fixedAssets",), "money"),
    "stock_cash_values": (("financials.stockAndCashValues",), "money"), "receipt_days": (("financials.timeframes.receipt",), "int"), "suppliers_days": (("financials.timeframes.suppliers",), "int"),
    "stock_days": (("financials.timeframes.stock",), "int"), "working_capital_days": (("financials.timeframes.workingCapital",), "int"), "privacy_accepted": (("privacy",), "bool"), "valued_at": (("timestamp",), "date"),
}
READ = {
    "text": blank_to_null, "name": proper_name, "email": lambda c: F.lower(F.trim(c)), "phone": formatted_phone, "date": parsed_date, "money": money, "int": lambda c: c.try_cast("int"),
    "bool": lambda c: F.coalesce(F.lower(c) == "true", F.lit(False)),
}


def project_valuations(df: DataFrame) -> DataFrame:
    """R2: documents with dotted keys to typed columns, with fallbacks."""
    return df.select(*[READ[kind](pick(df, *names)).alias(out) for out, (names, kind) in VALUATION_FIELDS.items()], F.lit("valuation-detailed").alias("data_source"))


def has_path(schema: T.StructType, path: str) -> bool:
    kind = schema
    for part in path.split("."):
        if not isinstance(kind, T.StructType) or part not in kind.names:
            return False
        kind = kind[part].dataType
    return True


def at(df: DataFrame, path: str, kind: str = "string") -> Column:
    """A nested field, or null where the schema lacks it."""
    return F.col(path).cast(kind) if has_path(df.schema, path) else F.lit(None).cast(kind)


def project_nested_valuations(df: DataFrame) -> DataFrame:
    """Nested documents to typed columns; method CRM if there is a scorecard, else SENSE; growth rates as JSON text."""
    as_json = lambda p: F.to_json(F.col(p)) if has_path(df.schema, p) else F.lit(None).cast("string")
    scorecard = F.col("scorecard").isNotNull() if has_path(df.schema, "scorecard") else F.lit(False)
    stamp = at(df, "timestamp", "long")
    return df.select(
        at(df, "id").alias("valuation_id"), F.when(stamp > 10_000_000_000, F.timestamp_millis(stamp)).otherwise(F.timestamp_seconds(stamp)).alias("valued_at"), at(df, "valuation", "double").alias("valuation"),
        F.coalesce(at(df, "overview.company"), at(df, "overview.startup")).alias("company"), at(df, "overview.fullName").alias("full_name"), at(df, "overview.email").alias("email"), at(df, "overview.city").alias("city"),
        at(df, "overview.state").alias("state"), at(df, "overview.market").alias("market"), *[at(df, f"financials.{n}", "double").alias(o) for n, o in (("currentRevenue", "revenue"), ("currentEBITDA", "ebitda"), ("currentPlannedRevenue", "planned_revenue"), ("currentDebt", "debt"), ("fixedAssets", "fixed_assets"))],
        at(df, "financials.timeframes.suppliers", "int").alias("suppliers_days"), at(df, "financials.timeframes.customers", "int").alias("customers_days"), as_json("financials.growthRates").alias("growth_rates"), F.when(scorecard, "CRM").otherwise("SENSE").alias("method"),
    )


def project_companies(df: DataFrame, as_of) -> DataFrame:
    """Valuation documents of a CRM to companies."""
    return df.select(
        pick(df, "ID").alias("company_id"), proper_name(pick(df, "Nome da Startup")).alias("company_name"), blank_to_null(pick(df, "Site")).alias("website"), squeezed(pick(df, "Cidade/Estado")).alias("location"),
        pick(df, "Estágio Operacional").alias("operational_stage"), pick(df, "Modelo de Negócio").alias("business_model"), pick(df, "Mercado").alias("market"), pick(df, "Estágio de Investimento").alias("investment_stage"),
        money(pick(df, "Captação")).alias("funding"), money(pick(df, "Valuation")).alias("valuation"), money(pick(df, "MRR")).alias("mrr"), money(pick(df, "LTM")).alias("ltm"), pick(df, "Tipo de Valuation").alias("valuation_type"),
        parsed_date(pick(df, "Data de Valuation")).alias("valued_at"), F.lit(as_of).cast("timestamp").alias("created_at"),
    )


def project_contacts(df: DataFrame) -> DataFrame:
    """The documents' respondents; rows with neither mail nor phone go."""
    mail = F.lower(F.trim(pick(df, "Email")))
    rows = df.select(
        F.concat(F.lit("contact_"), pick(df, "ID")).alias("contact_id"), pick(df, "ID").alias("company_id"), proper_name(pick(df, "Nome do Respondente")).alias("full_name"), F.when(is_email(mail), mail).alias("email"), formatted_phone(pick(df, "Telefone")).alias("phone"),
    )
    return rows.filter("email is not null or phone is not null")


def project_misc(df: DataFrame, kind: str) -> DataFrame:
    """Interactions (questions as JSON text and their number), links (with amounts), or metrics (the row bigNumbers)."""
    if kind == "interactions":
        return df.select("id", "name", F.lower("email").alias("email"), parsed_date("createdAt").alias("created_at"), "consent", F.to_json("questions").alias("questions"), F.coalesce(F.size("questions"), F.lit(0)).alias("n_questions"))
    if kind == "links":
        return df.select("id", "url", F.lower("email").alias("email"), F.lower("status").alias("status"), money(F.col("amount").cast("string")).alias("amount"), parsed_date("createdAt").alias("created_at"))
    if kind == "metrics":
        names = ["totalValuations", "averageValuation", "averageRevenue", "averageEBITDA", "totalPaidValuations", "totalPaidValue"]
        return df.filter("id = 'bigNumbers'").select("id", *[F.col(n) for n in names if n in df.columns])
    return df.select("id", F.array_join("collections", ", ").alias("collections"), F.size("collections").alias("n_collections"))


#: Types that stay; empreendedor is sense, all others are other.
VALUATION_TYPES = ["sense", "pre-money", "post-money", "assessment"]


def project_financials(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valuations with their type and interest in raising funds, and monthly snapshots (ARR = 12 MRR) where MRR or
    LTM is there. Rows without a date have neither."""
    low = F.lower(F.coalesce(pick(df, "Tipo de Valuation"), F.lit("other")))
    kind = F.when(low == "empreendedor", "sense").when(low.isin(*VALUATION_TYPES), low).otherwise("other")
    asks = F.lower(pick(df, "Pretende_Captar"))
    base = df.select(
        pick(df, "ID").alias("company_id"), F.to_date(parsed_date(pick(df, "Data de Valuation"))).alias("valuation_date"), money(pick(df, "Resultado_Valuation")).alias("amount"), kind.alias("valuation_type"),
        F.when(asks.contains("sim") | asks.contains("pretende"), True).when(asks.contains("não") | asks.contains("nao"), False).alias("fundraising_interest"), money(pick(df, "MRR")).alias("mrr"), money(pick(df, "Faturamento_LTM")).alias("ltm_revenue"),
    ).filter("valuation_date is not null")
    snapshots = base.filter("coalesce(mrr, 0) != 0 or coalesce(ltm_revenue, 0) != 0").select("company_id", F.col("valuation_date").alias("period_start"), F.col("valuation_date").alias("period_end"), F.lit("monthly").alias("period_type"), "mrr", F.when(F.col("mrr") != 0, F.col("mrr") * 12).cast("decimal(15,2)").alias("arr"), "ltm_revenue")
    return base.drop("mrr", "ltm_revenue"), snapshots.dropDuplicates(["company_id", "period_start"])


def all_valuations(crm: DataFrame, metrics: DataFrame, key: str = "valuation_id", date: str = "valued_at") -> DataFrame:
    """Both systems' valuations, distinct, one per id, and of rows alike but for dates the newest."""
    both = union_tables([crm, metrics])
    order = [c for c in both.columns if c != key]
    return dedup_ignore_dates(dedup_exact_then_id(both, key, order), date, [key])


def explode_single_column(df: DataFrame, col: str, fields: list[str], least: int = 3) -> DataFrame:
    """Rows that came as one column, cut at commas into the fields; short rows fill the first ones, shorter than
    `least` parts they go."""
    parts = F.split(F.col(f"`{col}`"), ",")
    rows = df.withColumn("_p", parts).filter(F.size("_p") >= least)
    return rows.select(*[c for c in df.columns if c != col], *[F.nullif(F.trim(F.get("_p", F.lit(i))), F.lit("")).alias(f) for i, f in enumerate(fields)])


def flatten(df: DataFrame, max_level: int = 3, sep: str = "_") -> DataFrame:
    """Struct fields as columns with joined names, down to max_level. A name that is taken gets a number."""
    taken: set[str] = set()

    def free(label: str) -> str:
        name, n = label, 1
        while name.lower() in taken:
            name, n = f"{label}{sep}{n + 1}", n + 1
        taken.add(name.lower())
        return name

    def walk(schema: T.StructType, path: str, name: str, level: int) -> list[Column]:
        out = []
        for f in schema:
            here, label = f"{path}`{f.name}`", f"{name}{f.name}"
            if isinstance(f.dataType, T.StructType) and level < max_level:
                out += walk(f.dataType, here + ".", label + sep, level + 1)
            else:
                out.append(F.col(here).alias(free(label)))
        return out

    return df.select(*walk(df.schema, "", "", 0))


def explode_records(df: DataFrame, record_path: str, meta: list[str]) -> DataFrame:
    """A row for each element of an array, with fields of its document; empty arrays keep one row."""
    rows = df.select(*[F.col(m).alias(m.replace(".", "_")) for m in meta], F.explode_outer(F.col(record_path)).alias("_r"))
    kind = rows.schema["_r"].dataType
    own = [F.col(f"_r.{n}").alias(n) for n in kind.names] if isinstance(kind, T.StructType) else [F.col("_r").alias("value")]
    return rows.select(*[m.replace(".", "_") for m in meta], *own)


def json_structure(df: DataFrame, col: str, depth: int = 3) -> DataFrame:
    """(path, type, n): what stands at each path of JSON texts, down to `depth` levels of objects and arrays, and how often.

    a.b is field b of the object a, a[] an element of the array a. Null texts and texts that are no JSON don't count. Documents
    are read once: each level opens one more of theirs, in the row, and what was passed stays with the first of its parts.
    """
    none = F.array().cast("array<struct<path string, type string>>")
    rows = df.select(F.lit("").alias("path"), F.try_parse_json(F.col(f"`{col}`")).alias("v"), none.alias("nodes"))
    v = F.col("v")
    here = F.when(F.col("key").isNull() & F.col("pos").isNotNull(), F.concat("path", F.lit("[]"))).when(F.col("path") == "", F.col("key")).otherwise(F.concat("path", F.lit("."), "key"))
    # containers are known by what they can be read as, so that nothing below them is looked at
    kind = F.when(F.try_variant_get(v, "$", "struct<>").isNotNull(), "OBJECT").when(F.try_variant_get(v, "$", "array<struct<>>").isNotNull(), "ARRAY").otherwise(F.schema_of_variant(v))
    for _ in range(depth):
        opened = rows.lateralJoin(rows.sparkSession.tvf.variant_explode_outer(v.outer()))
        kept = F.when(F.coalesce("pos", F.lit(0)) == 0, F.col("nodes")).otherwise(none)
        parts = opened.select(here.alias("path"), F.col("value").alias("v"), kept.alias("nodes"))
        rows = parts.withColumn("nodes", F.when(v.isNotNull(), F.array_append("nodes", F.struct("path", kind.alias("type")))).otherwise(F.col("nodes")))
    named = F.when(F.col("type").isin("OBJECT", "ARRAY", "STRING", "BOOLEAN"), F.lower("type")).when(F.col("type") == "VOID", "null").when(F.col("type") == "BIGINT", "integer").otherwise("number")
    return rows.select(F.inline("nodes")).groupBy("path", named.alias("type")).agg(F.count("*").alias("n"))
