"""Validation and standardisation over leads, orders, parts and documents (V, C, P, R)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dims, standardise as s, validate as v
from ..operators import restructure, schema
from .base import AS_OF, LEADS_SQL, leads, query, table

LETTERS, PLAIN = dims.accent_table()


def _check_sql(text: str, size: int, weights: tuple[list[int], list[int]]) -> str:
    parts = []
    for w in weights:
        total = " + ".join(f"cast(substr({text}, {i + 1}, 1) as integer) * {x}" for i, x in enumerate(w))
        parts.append(f"(case when 11 - ({total}) % 11 >= 10 then 0 else 11 - ({total}) % 11 end) = cast(substr({text}, {len(w) + 1}, 1) as integer)")
    return f"coalesce(case when length({text}) = {size} and replace({text}, substr({text}, 1, 1), '') <> '' then {parts[0]} and {parts[1]} else false end, false)"


CPF_SQL, CNPJ_SQL = _check_sql("cpf", 11, v.CPF_WEIGHTS), _check_sql("cnpj", 14, v.CNPJ_WEIGHTS)
EMAIL_SQL = "coalesce(regexp_matches(lower(email), '^[a-z0-9._%+-]+@[a-z0-9.-]+\\.[a-z]{2,}$'), false)"
DIGITS = "regexp_replace({0}, '[^0-9]', '', 'g')".format
PHONE_SQL = f"coalesce(regexp_matches({DIGITS('telefone')}, '^(1[1-9]|[2-9][0-9])([0-9]{{8}}|9[0-9]{{8}})$'), false)"


@query(f"select id, cpf, {CPF_SQL} as cpf_valid from {LEADS_SQL}")
def check_cpf(spark, sf_dir):
    return v.flag_cpf(leads(spark, sf_dir), "cpf").select("id", "cpf", "cpf_valid")


@query(f"select id, cnpj, {CNPJ_SQL} as cnpj_valid from {LEADS_SQL}")
def check_cnpj(spark, sf_dir):
    return v.flag_cnpj(leads(spark, sf_dir), "cnpj").select("id", "cnpj", "cnpj_valid")


@query(f"select id, case when id % 2 = 0 then 'cpf' else 'cnpj' end as doc_type, case when id % 2 = 0 then {CPF_SQL} else {CNPJ_SQL} end as doc_valid from {LEADS_SQL}")
def check_document(spark, sf_dir):
    df = leads(spark, sf_dir).withColumn("doc", F.when(F.col("id") % 2 == 0, F.col("cpf")).otherwise(F.col("cnpj")))
    return v.flag_document(df, "doc").select("id", "doc_type", "doc_valid")


@query(f"select id, {EMAIL_SQL} as email_valid, {PHONE_SQL} as telefone_valid, coalesce(length({DIGITS('cep')}) = 8, false) as cep_valid, coalesce(valor between 0 and 5000, false) as valor_valid from {LEADS_SQL}")
def check_contacts(spark, sf_dir):
    df = v.flag_cep(v.flag_phone(v.flag_email(leads(spark, sf_dir), "email"), "telefone"), "cep")
    return v.flag_range(df, "valor", 0, 5000).select("id", "email_valid", "telefone_valid", "cep_valid", "valor_valid")


@query(f"""
    with l as (select *, {CPF_SQL} as c, {EMAIL_SQL} as e, {PHONE_SQL} as p from {LEADS_SQL}),
    f as (select 'cpf' as field, count(*) as total, count(*) filter (where c) as n_valid from l
          union all select 'email', count(*), count(*) filter (where email is not null and e) from l
          union all select 'telefone', count(*), count(*) filter (where telefone is null or p) from l
          union all select 'rg', count(*), 0 from l)
    select field, total, n_valid, total - n_valid as n_invalid, (total - n_valid) / total as error_rate from f
""")
def validate_summary(spark, sf_dir):
    rules = [v.FieldRule("cpf", "cpf", True), v.FieldRule("email", "email", True), v.FieldRule("telefone", "phone"), v.FieldRule("rg", "cpf", True)]
    return v.validate(leads(spark, sf_dir), rules)[1]


@query(f"""
    select id, cast(coalesce(regexp_matches(trim(telefone), '^(\\+55\\s*\\([0-9]{{2}}\\)\\s*[0-9]{{4,5}}-?[0-9]{{4}}|\\+55\\s*[0-9]{{2}}\\s*[0-9]{{4,5}}-?[0-9]{{4}}|\\([0-9]{{2}}\\)\\s*[0-9]{{4,5}}-?[0-9]{{4}}|[0-9]{{2}}\\s*[0-9]{{4,5}}-?[0-9]{{4}}|\\+?55[0-9]{{10,11}}|[0-9]{{10,11}})$'), false) as integer) as phone_valid,
           cast(coalesce(length({DIGITS('telefone')}) >= 10 and substr(right({DIGITS('telefone')}, 9), 1, 1) = '9', false) as integer) as phone_mobile,
           cast(coalesce(contains(telefone, '+55') or starts_with(telefone, '55'), false) as integer) as phone_country_code
    from {LEADS_SQL}
""")
def phone_features(spark, sf_dir):
    return v.phone_features(leads(spark, sf_dir)).select("id", "phone_valid", "phone_mobile", "phone_country_code")


@query(f"""
    select id, cast(length(nome) as integer) as nome_length, cast(coalesce(contains(email, '@'), false) as integer) as has_email, cast(coalesce(contains(telefone, '55'), false) as integer) as has_whatsapp,
           cast(coalesce(contains(email, '@'), false) as integer) + cast(length(nome) > 5 as integer) as data_quality_score
    from {LEADS_SQL}
""")
def contact_features(spark, sf_dir):
    return v.contact_features(leads(spark, sf_dir), names={"whatsapp": "telefone"}).select("id", "nome_length", "has_email", "has_whatsapp", "data_quality_score")


@query(f"""
    select id, (cast(email is not null as integer) + cast(telefone is not null as integer) + cast(cep is not null as integer) + cast(cargo is not null as integer)) / 4.0 as completeness,
           cast(email is not null as integer) + cast(telefone is not null as integer) + cast(cep is not null as integer) + cast(cargo is not null as integer) as key_indicators
    from {LEADS_SQL}
""")
def row_completeness(spark, sf_dir):
    return v.row_completeness(leads(spark, sf_dir), ["email", "telefone", "cep", "cargo"]).select("id", F.col("completeness").cast("double").alias("completeness"), "key_indicators")


@query(f"""
    select id, concat(substr(cpf, 1, 3), '.', substr(cpf, 4, 3), '.', substr(cpf, 7, 3), '-', substr(cpf, 10, 2)) as cpf,
           concat(substr(cnpj, 1, 2), '.', substr(cnpj, 3, 3), '.', substr(cnpj, 6, 3), '/', substr(cnpj, 9, 4), '-', substr(cnpj, 13, 2)) as cnpj,
           case when length(cep) = 8 then concat(substr(cep, 1, 5), '-', substr(cep, 6, 3)) end as cep
    from {LEADS_SQL}
""")
def format_documents(spark, sf_dir):
    return s.format_cep(s.format_documents(leads(spark, sf_dir), {"cpf": "cpf", "cnpj": "auto"}), "cep").select("id", "cpf", "cnpj", "cep")


@query(f"""
    with d as (select id, telefone, {DIGITS('telefone')} as a from {LEADS_SQL}),
    n as (select id, telefone, case when length(a) in (12, 13) and starts_with(a, '55') then substr(a, 3) else a end as n from d)
    select id, case length(n) when 11 then concat('(', substr(n, 1, 2), ') ', substr(n, 3, 5), '-', substr(n, 8)) when 10 then concat('(', substr(n, 1, 2), ') ', substr(n, 3, 4), '-', substr(n, 7))
                              when 9 then concat(substr(n, 1, 5), '-', substr(n, 6)) when 8 then concat(substr(n, 1, 4), '-', substr(n, 5)) else telefone end as telefone
    from n
""")
def format_phones(spark, sf_dir):
    return s.format_phones(leads(spark, sf_dir), ["telefone"]).select("id", "telefone")


_SMALL = ", ".join(f"'{w}'" for w in dims.PREPOSITIONS["short"])


@query(f"""
    with t as (select id, trim(regexp_replace(trim(regexp_replace(nome, '\\s+', ' ', 'g')), '^((DR|DRA|SR|SRA|PROF|dr|dra|sr|sra|prof|Dr|Dra|Sr|Sra|Prof)\\.?\\s+)+', '')) as t from {LEADS_SQL}),
    w as (select id, string_split(t, ' ') as w from t)
    select id, array_to_string(list_transform(w, lambda x, i: case when i > 1 and lower(x) in ({_SMALL}) then lower(x) else concat(upper(substr(x, 1, 1)), lower(substr(x, 2))) end), ' ') as nome from w
""")
def proper_names(spark, sf_dir):
    return s.proper_names(leads(spark, sf_dir), ["nome"], strip_titles=True).select("id", "nome")


@query(f"select doc_id, md5(lower(translate(text, '{LETTERS}', '{PLAIN}'))) as folded_md5, cast(length(regexp_replace(lower(translate(text, '{LETTERS}', '{PLAIN}')), '[^a-z0-9]', '', 'g')) as integer) as key_length from documents")
def fold_text(spark, sf_dir):
    df = table(spark, sf_dir, "documents").select("doc_id", "text")
    return df.select("doc_id", F.md5(s.folded("text")).alias("folded_md5"), F.length(s.match_key("text")).alias("key_length"))


@query("select doc_id, md5(trim(regexp_replace(regexp_replace(text, '[^a-zA-ZÀ-ÿ0-9\\s]', '', 'g'), '\\s+', ' ', 'g'))) as clean_md5 from documents")
def clean_text(spark, sf_dir):
    df = s.clean_text(table(spark, sf_dir, "documents").select("doc_id", "text"), ["text"], ["specials", "squeeze"])
    return df.select("doc_id", F.md5("text").alias("clean_md5"))


@query("select o_orderkey, cast(cast(o_totalprice as decimal(15, 2)) as double) as amount, concat('R$ ', translate(format('{:,.2f}', cast(o_totalprice as decimal(15,2))), ',.', '.,')) as amount_text from orders")
def money_round_trip(spark, sf_dir):
    df = table(spark, sf_dir, "orders").select("o_orderkey", s.money_text("o_totalprice").alias("amount_text"))
    return s.parse_money(df.withColumn("amount", F.col("amount_text")), ["amount"]).select("o_orderkey", F.col("amount").cast("double").alias("amount"), "amount_text")


@query("""
    select o_orderkey, o_orderdate as parsed, cast(o_orderdate as date) as parsed_date, '00:00:00' as parsed_time from orders
""")
def parse_dates(spark, sf_dir):
    x = F.col("o_orderdate")
    k = F.col("o_orderkey") % 7
    text = (
        F.when(k == 0, F.date_format(x, "dd/MM/yyyy")).when(k == 1, F.date_format(x, "yyyy-MM-dd")).when(k == 2, F.date_format(x, "dd/MM/yyyy HH:mm")).when(k == 3, F.date_format(x, "dd/MM/yyyy, HH:mm:ss"))
        .when(k == 4, F.date_format(x, "dd-MM-yyyy")).when(k == 5, F.date_format(x, "yyyy-MM-dd HH:mm:ss")).otherwise(F.unix_timestamp(x).cast("string"))
    )
    df = table(spark, sf_dir, "orders").select("o_orderkey", text.alias("parsed"))
    return s.split_datetime(s.parse_dates(df, ["parsed"]), ["parsed"])


@query("select o_orderkey, cast(o_orderdate as date) as day from orders")
def parse_dates_pt(spark, sf_dir):
    x = F.col("o_orderdate")
    month = F.element_at(F.array(*[F.lit(m.upper()) for m in dims.MONTHS]), F.month(x))
    df = table(spark, sf_dir, "orders").select("o_orderkey", F.concat_ws(" ", F.date_format(x, "dd"), month, F.date_format(x, "yyyy")).alias("day"))
    return s.parse_dates_pt(df, ["day"])


@query(f"""
    select id, case id % 4 when 0 then 'São Paulo' when 1 then 'Rio de Janeiro' when 2 then 'Curitiba' else 'Recife' end as cidade_estado_city,
           case id % 4 when 0 then 'SP' when 1 then 'RJ' when 2 then 'PR' end as cidade_estado_state from {LEADS_SQL}
""")
def split_location(spark, sf_dir):
    return s.split_location(leads(spark, sf_dir), "cidade_estado").select("id", "cidade_estado_city", "cidade_estado_state")


@query(f"""
    select id, concat('Empresa ', upper(substr(segmento, 1, 1)), lower(substr(segmento, 2)), ' LTDA') as empresa, concat('empresa', lower(segmento)) as empresa_key from {LEADS_SQL}
""")
def company_names(spark, sf_dir):
    return s.company_names(leads(spark, sf_dir), "empresa").select("id", "empresa", "empresa_key")


@query(f"""
    select id, case when contains(email, '@') then lower(split_part(email, '@', 2)) end as email_domain, case when contains(email, '@gmail.com') then 'personal' when contains(email, '@') then 'corporate' end as email_kind,
           case when cargo is null then 'não informado' when cargo = 'CEO' then 'C-Level' when cargo = 'Diretor de Vendas' then 'Diretoria' when cargo = 'analista' then 'Especialista' else 'Operacional' end as cargo_level,
           case when cargo = 'CEO' then 5 when cargo = 'Diretor de Vendas' then 4 when cargo = 'analista' then 1 else 0 end as cargo_seniority,
           coalesce(cargo in ('CEO', 'Diretor de Vendas'), false) as decision_maker
    from {LEADS_SQL}
""")
def domains_and_levels(spark, sf_dir):
    return s.job_level(s.domains(leads(spark, sf_dir), email="email"), "cargo").select("id", "email_domain", "email_kind", "cargo_level", "cargo_seniority", "decision_maker")


@query(f"""
    select id, case id % 4 when 1 then 1e7 when 2 then 1e8 else 0.0 end as revenue_min, case id % 4 when 0 then 1e6 when 1 then 5e7 when 2 then 1e9 else 0.0 end as revenue_max,
           case id % 4 when 1 then 3 when 2 then 5 else 1 end as revenue_score from {LEADS_SQL}
""")
def revenue_bands(spark, sf_dir):
    return s.revenue_band(leads(spark, sf_dir)).select("id", "revenue_min", "revenue_max", "revenue_score")


@query(f"""
    with a as (select id, datediff('day', data_cadastro, date '{AS_OF}') / 365.25 as idade from {LEADS_SQL})
    select id, idade, case when idade > 0 and idade <= 25 then '<25' end as faixa_etaria from a
""")
def age_bands(spark, sf_dir):
    return s.age_bands(leads(spark, sf_dir), "data_cadastro", AS_OF).select("id", F.col("idade").cast("double").alias("idade"), "faixa_etaria")


@query(f"""
    select o_orderkey, cast(year(o_orderdate) as integer) as d_year, cast(month(o_orderdate) as integer) as d_month, cast(day(o_orderdate) as integer) as d_day, cast((dayofweek(o_orderdate) + 6) % 7 as integer) as d_weekday,
           cast(quarter(o_orderdate) as integer) as d_quarter, case when dayofweek(o_orderdate) in (0, 6) then 1 else 0 end as d_weekend, cast(hour(o_orderdate) as integer) as d_hour, cast(datediff('day', o_orderdate, date '{AS_OF}') as integer) as d_days_ago from orders
""")
def temporal_features(spark, sf_dir):
    return s.temporal_features(table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").alias("d")), ["d"], AS_OF).drop("d")


@query("""
    select doc_id, cast(length(text) as integer) as text_length, cast(len(regexp_extract_all(text, '[^ \\t\\n\\x0b\\f\\r]+')) as integer) as text_words, cast(len(regexp_extract_all(text, '[0-9]')) as integer) as text_digits,
           cast(len(regexp_extract_all(text, '[A-Z]')) as integer) as text_upper, cast(len(regexp_extract_all(text, '[a-z]')) as integer) as text_lower, cast(contains(text, '@') as integer) as text_has_at from documents
""")
def text_features(spark, sf_dir):
    return s.text_features(table(spark, sf_dir, "documents").select("doc_id", "text"), ["text"]).select("doc_id", "text_length", "text_words", "text_digits", "text_upper", "text_lower", "text_has_at")


@query(f"""
    select id, substr(md5(cpf), 1, 16) as id_unico, substr(sha256(cast(id as string)), 1, 12) as id_anonimo, concat(substr(cpf, 1, 3), '********') as cpf_anonimizado,
           case when contains(email, '@') then concat('U***@', split_part(email, '@', 2)) end as email from {LEADS_SQL}
""")
def privacy(spark, sf_dir):
    df = s.apply_privacy(s.anon_id(s.natural_id(leads(spark, sf_dir), ["cpf"]), "id"))
    return s.mask_email(df, "email").select("id", "id_unico", "id_anonimo", "cpf_anonimizado", "email")


@query("select o_orderkey, datediff('minute', timestamp '1990-01-01', o_orderdate) * 1.0::double as minutes from orders")
def minutes_between(spark, sf_dir):
    df = table(spark, sf_dir, "orders").withColumn("start", F.lit("1990-01-01").cast("timestamp"))
    return s.minutes_between(df, "start", "o_orderdate").select("o_orderkey", F.col("minutes").cast("double").alias("minutes"))


@query("select l_orderkey, l_linenumber, l_quantity / (l_discount + 1e-8) as l_quantity_l_discount_ratio, l_quantity * l_discount as l_quantity_l_discount_product from lineitem")
def interaction_features(spark, sf_dir):
    return s.interactions(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount"), ["l_quantity", "l_discount"]).drop("l_quantity", "l_discount")


@query(f"select id, upper(cargo) as cargo_std, case when segmento = 'BUILDING' then 'obra' when segmento = 'MACHINERY' then 'maquina' else 'outro' end as segmento_category, case when valor > 1000 then 'alto' else 'baixo' end as faixa from {LEADS_SQL}")
def conditional_columns(spark, sf_dir):
    df = schema.categorise(leads(spark, sf_dir), "segmento", {"BUILDING": "obra", "MACHINERY": "maquina"}, default="outro")
    df = schema.conditional(df, "faixa", "valor > 1000", F.lit("alto"), F.lit("baixo"))
    return s.clean_text(df.withColumn("cargo_std", F.col("cargo")), ["cargo_std"], ["upper"]).select("id", "cargo_std", "segmento_category", "faixa")


@query(f"select id as id_unico, nome as nome_completo, cpf, email, telefone, empresa, cargo, segmento, faixa_faturamento, valor as extra_valor, data_cadastro as extra_data_cadastro from {LEADS_SQL}")
def map_schema(spark, sf_dir):
    out = schema.map_schema(leads(spark, sf_dir))
    return out.select("id_unico", "nome_completo", "cpf", "email", "telefone", "empresa", "cargo", "segmento", "faixa_faturamento", "extra_valor", "extra_data_cadastro")


@query(f"select id, nome, email from {LEADS_SQL} where email is not null and contains(lower(empresa), 'build') and regexp_matches(upper(trim(cidade_estado)), '(^|[ /,-])SP$')")
def filters(spark, sf_dir):
    df = schema.where_contains(schema.where_filled(leads(spark, sf_dir), ["email"]), "empresa", "BUILD")
    return schema.where_state(df, "cidade_estado", "SP").select("id", "nome", "email")


@query("select l_orderkey, cast(l_linenumber as string) as entry_id, cast(l_shipdate as string) as date, cast(l_quantity as string) as amount, case when l_returnflag = 'R' then 'true' else 'false' end as paid from (select l_orderkey, l_linenumber, max(l_shipdate)::date as l_shipdate, max(l_quantity) as l_quantity, max(l_returnflag) as l_returnflag from lineitem group by all)")
def unpivot_keys(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_shipdate").alias("d"), F.max("l_quantity").alias("q"), F.max("l_returnflag").alias("r"))
    name = lambda f: F.concat(F.lit("valuations."), F.col("l_linenumber").cast("string"), F.lit(f))
    pairs = F.array(F.struct(name(".date"), F.date_format("d", "yyyy-MM-dd")), F.struct(name(".amount"), F.col("q").cast("string")), F.struct(name(".paid"), F.when(F.col("r") == "R", "true").otherwise("false")))
    docs = lines.groupBy("l_orderkey").agg(F.to_json(F.map_from_entries(F.flatten(F.collect_list(pairs)))).alias("doc"))
    return restructure.unpivot_keys(docs, "doc", "valuations", ["date", "amount", "paid"])


@query("select props_key as path, type, count(*) as n from (select 'k' as props_key, 'integer' as type from events) group by all")
def json_structure(spark, sf_dir):
    return restructure.json_structure(table(spark, sf_dir, "events"), "props")


@query("""
    with l as (select * from orders join lineitem on o_orderkey = l_orderkey), o as (select distinct o_orderkey, o_custkey from l)
    select path, type, count(*) as n from (
        select unnest(['order', 'order.lines']) as path, unnest(['object', 'array']) as type from o union all select 'order.key', 'integer' from o
        union all select 'order.customer', case when o_custkey % 3 = 0 then 'null' when o_custkey % 3 = 1 then 'string' else 'object' end from o union all select 'order.customer.key', 'integer' from o where o_custkey % 3 = 2
        union all select unnest(['order.lines[]', 'order.lines[].ship', 'order.lines[].ship.late']), unnest(['object', 'object', 'boolean']) from l
        union all select 'order.lines[].ship.tags', 'array' from l union all select 'order.lines[].ship.tags[]', 'string' from l where l_linenumber = 1 union all select 'order.lines[].price', 'number' from l
    ) group by 1, 2
""")
def nested_structure(spark, sf_dir):
    """Documents of four levels, one for each order, with its lines inside."""
    line = F.struct(F.struct((F.col("l_linenumber") > 3).alias("late"), F.when(F.col("l_linenumber") == 1, F.array("l_returnflag")).otherwise(F.array().cast("array<string>")).alias("tags")).alias("ship"), (F.floor("l_extendedprice") + 0.5).alias("price"))
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.to_json(F.collect_list(line)).alias("lines"))
    o = table(spark, sf_dir, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
    customer = F.when(F.col("o_custkey") % 3 == 0, "null").when(F.col("o_custkey") % 3 == 1, F.concat(F.lit('"'), F.col("o_custkey").cast("string"), F.lit('"'))).otherwise(F.concat(F.lit('{"key": '), F.col("o_custkey").cast("string"), F.lit("}")))
    docs = o.select(F.concat(F.lit('{"order": {"key": '), F.col("o_orderkey").cast("string"), F.lit(', "customer": '), customer, F.lit(', "lines": '), "lines", F.lit("}}")).alias("doc"))
    return restructure.json_structure(docs, "doc", depth=6)


@query("select c_custkey, c_name, n_name as nation_name, r_name as nation_region_name from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey")
def flatten_documents(spark, sf_dir):
    c, n, r = (table(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    docs = c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey).select("c_custkey", "c_name", F.struct(F.col("n_name").alias("name"), F.struct(F.col("r_name").alias("name")).alias("region")).alias("nation"))
    return restructure.flatten(docs)
