"""Standardisation of texts, contacts, dates, places and money, as native column expressions and jobs."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from . import dims
from .validate import ColumnLike, as_col, digits, is_blank, is_cnpj, is_cpf, is_email


def each(df: DataFrame, cols: Iterable[str], fn) -> DataFrame:
    """fn over each of the columns, in one projection."""
    return df.withColumns({c: fn(F.col(f"`{c}`")) for c in cols})


def lookup(mapping: dict[str, str], key: Column) -> Column:
    """The value of a key in a fixed map, null if it isn't there."""
    return F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])[key] if mapping else F.lit(None).cast("string")


def blank_to_null(c: ColumnLike) -> Column:
    return F.when(~is_blank(c), F.trim(as_col(c).cast("string")))


# --- C1 to C3: documents, phones, postal codes ------------------------------------------------------------------------


def cut(text: Column, pattern: str) -> Column:
    """Digits laid into a pattern, # for each."""
    parts, at, literal = [], 1, ""
    for ch in pattern:
        if ch == "#":
            if literal:
                parts.append(F.lit(literal))
                literal = ""
            parts.append(F.substring(text, at, 1))
            at += 1
        else:
            literal += ch
    return F.concat(*parts, *([F.lit(literal)] if literal else []))


def formatted_document(c: ColumnLike, kind: str = "auto") -> Column:
    """CPF 000.000.000-00, CNPJ 00.000.000/0000-00; shorter digits are padded if the kind is given; else null."""
    text = digits(c)
    if kind != "auto":
        text = F.when((F.length(text) > 0) & (F.length(text) <= {"cpf": 11, "cnpj": 14}[kind]), F.lpad(text, {"cpf": 11, "cnpj": 14}[kind], "0"))
    return F.when(F.length(text) == 11, cut(text, "###.###.###-##")).when(F.length(text) == 14, cut(text, "##.###.###/####-##"))


def format_documents(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """kinds: column -> cpf, cnpj, auto or digits."""
    return df.withColumns({c: digits(c) if k == "digits" else formatted_document(c, k) for c, k in kinds.items()})


def formatted_phone(c: ColumnLike, style: str = "national", ddd: str = "11") -> Column:
    """national (DD) NNNNN-NNNN; international +55 (DD) NNNNN-NNNN; local NNNNN-NNNN; default_ddd national with the given
    area code where it lacks; digits. A country code 55 goes only from 12 or 13 digits. What fits no layout stays."""
    all_of = digits(c)
    number = F.when(F.length(all_of).isin(12, 13) & all_of.startswith("55"), F.substring(all_of, 3, 11)).otherwise(all_of)
    if style == "digits":
        return number
    if style == "default_ddd":
        number = F.when(F.length(number).isin(8, 9), F.concat(F.lit(ddd), number)).otherwise(number)
    area, own = F.substring(number, 1, 2), F.substring(number, 3, 9)
    short = F.when(F.length(number).isin(8, 9), number).otherwise(own)
    line = F.when(F.length(short) == 9, F.concat(F.substring(short, 1, 5), F.lit("-"), F.substring(short, 6, 4))).otherwise(F.concat(F.substring(short, 1, 4), F.lit("-"), F.substring(short, 5, 4)))
    with_area = F.concat(F.lit("+55 (" if style == "international" else "("), area, F.lit(") "), line)
    whole = line if style == "local" else with_area
    return F.when(F.length(number).isin(10, 11), whole).when(F.length(number).isin(8, 9), line).otherwise(as_col(c))


def format_phones(df: DataFrame, cols: Iterable[str], style: str = "national", ddd: str = "11") -> DataFrame:
    return each(df, cols, lambda c: formatted_phone(c, style, ddd))


def format_cep(df: DataFrame, col: str) -> DataFrame:
    """00000-000, or null without eight digits."""
    return df.withColumn(col, F.when(F.length(digits(col)) == 8, cut(digits(col), "#####-###")))


# --- C4 to C8: names and texts ----------------------------------------------------------------------------------------


def squeezed(c: ColumnLike) -> Column:
    return F.trim(F.regexp_replace(as_col(c), r"\s+", " "))


def capital(word: Column) -> Column:
    """First letter upper, the rest lower; also behind apostrophes."""
    return F.array_join(F.transform(F.split(word, "'"), lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.lower(F.substring(p, 2, 1 << 20)))), "'")


def proper_name(c: ColumnLike, prepositions: str | list[str] = "short", strip_titles: bool = False) -> Column:
    """Each word with a capital, but the prepositions behind the first; titles at the start go if asked. Blank gives null."""
    small = dims.PREPOSITIONS[prepositions] if isinstance(prepositions, str) else prepositions
    text = squeezed(c)
    if strip_titles:
        text = F.regexp_replace(text, r"(?i)^(?:(?:" + "|".join(dims.TITLES) + r")\.?\s+)+", "")
    words = F.transform(F.split(text, " "), lambda w, i: F.when((i > 0) & F.lower(w).isin(*small), F.lower(w)).otherwise(capital(w)))
    return F.when(F.length(text) > 0, F.array_join(words, " "))


def proper_names(df: DataFrame, cols: Iterable[str], prepositions: str | list[str] = "short", strip_titles: bool = False) -> DataFrame:
    return each(df, cols, lambda c: proper_name(c, prepositions, strip_titles))


def company_name(c: ColumnLike) -> Column:
    """A proper name with its legal form in capitals."""
    text = proper_name(c)
    return reduce(lambda t, form: F.regexp_replace(t, r"(?i)(?<=\s)" + form.replace(".", r"\.") + r"(?=$|[\s,.])", form), dims.LEGAL_FORMS, text)


def company_key(c: ColumnLike) -> Column:
    """For matching: without legal form, accents and case."""
    forms = "|".join(f.replace(".", r"\.") for f in dims.LEGAL_FORMS)
    return match_key(F.regexp_replace(squeezed(c), r"(?i)[\s,]+(?:" + forms + r")\.?$", ""))


def company_names(df: DataFrame, col: str) -> DataFrame:
    """The name, and <col>_key for matching."""
    return df.withColumns({col: company_name(col), f"{col}_key": company_key(col)})


#: Operations of clean_text by name.
TEXT_OPS = {
    "trim": lambda c: F.trim(c),
    "squeeze": squeezed,
    "specials": lambda c: F.regexp_replace(c, r"[^a-zA-ZÀ-ÿ0-9\s]", ""),
    "edges": lambda c: F.regexp_replace(c, r"^[\s\p{Punct}]+|[\s\p{Punct}]+$", ""),
    "lines": lambda c: F.regexp_replace(c, r"[\r\n\t]+", " "),
    "upper": F.upper,
    "lower": F.lower,
    "title": lambda c: F.array_join(F.transform(F.split(c, " "), capital), " "),
    "null_blank": blank_to_null,
}


def clean_text(df: DataFrame, cols: Iterable[str], ops: Iterable[str] = ("squeeze",)) -> DataFrame:
    """The named operations in order."""
    return each(df, cols, lambda c: reduce(lambda t, op: TEXT_OPS[op](t), ops, c))


def sentence_case(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """A capital at the start of each sentence, the rest lower."""

    def run(c: Column) -> Column:
        parts = F.transform(F.split(F.lower(squeezed(c)), r"(?<=[.!?]) "), lambda s: F.concat(F.upper(F.substring(s, 1, 1)), F.substring(s, 2, 1 << 20)))
        return F.array_join(parts, " ")

    return each(df, cols, run)


def folded(c: ColumnLike) -> Column:
    """Without accents, in lower case."""
    return F.lower(F.translate(as_col(c), *dims.accent_table()))


def match_key(c: ColumnLike) -> Column:
    return F.regexp_replace(folded(c), "[^a-z0-9]", "")


def fold_text(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    return each(df, cols, folded)


def match_keys(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    return df.withColumns({f"{c}_key": match_key(c) for c in cols})


# --- C9 to C12: money, dates ------------------------------------------------------------------------------------------


def money(c: ColumnLike) -> Column:
    """R$ 1.234,56 or 1234.56 as DECIMAL(15,2): with a comma dots are thousands, without one a dot is the point."""
    text = F.regexp_replace(as_col(c).cast("string"), r"[^0-9,.\-]", "")
    plain = F.when(text.contains(","), F.replace(F.replace(text, F.lit(".")), F.lit(","), F.lit("."))).otherwise(text)
    return plain.try_cast("decimal(15,2)")


def money_text(c: ColumnLike, symbol: bool = True, mode: str = "round") -> Column:
    """R$ 1.234,56; half up, or cut off with mode truncate. Null gives R$ 0,00."""
    value = as_col(c).cast("decimal(38,6)")
    value = (F.floor(F.abs(value) * 100) / 100 * F.signum(value) if mode == "truncate" else F.round(value, 2)).cast("decimal(18,2)")
    text = F.translate(F.format_number(F.coalesce(value, F.lit(0).cast("decimal(18,2)")), 2), ",.", ".,")
    return F.concat(F.lit("R$ "), text) if symbol else text


def parse_money(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    return each(df, cols, money)


def format_money(df: DataFrame, cols: Iterable[str], symbol: bool = True, mode: str = "round") -> DataFrame:
    kinds = dict(df.dtypes)
    return df.withColumns({c: money_text(money(c) if kinds[c] == "string" else c, symbol, mode) for c in cols})


#: Layouts of dates by the pattern that lets them in.
DATE_LAYOUTS = [
    (r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}.*$", None), (r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$", "yyyy-MM-dd HH:mm:ss"), (r"^\d{4}-\d{2}-\d{2}$", "yyyy-MM-dd"),
    (r"^\d{2}/\d{2}/\d{4}, \d{2}:\d{2}:\d{2}$", "dd/MM/yyyy, HH:mm:ss"), (r"^\d{2}/\d{2}/\d{4} \d{2}:\d{2}:\d{2}$", "dd/MM/yyyy HH:mm:ss"),
    (r"^\d{2}/\d{2}/\d{4} \d{2}:\d{2}$", "dd/MM/yyyy HH:mm"), (r"^\d{2}/\d{2}/\d{4}$", "dd/MM/yyyy"), (r"^\d{2}-\d{2}-\d{4}$", "dd-MM-yyyy"),
    (r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}:\d{2} [AP]M$", "M/d/yyyy h:mm:ss a"),
]


def parsed_date(c: ColumnLike, layouts: Iterable[tuple[str, str | None]] = tuple(DATE_LAYOUTS)) -> Column:
    """A timestamp from the first layout that fits: ISO, Brazilian, US 12-hour, compact ddmmyyyy (or yyyymmdd where that
    alone is a date), seconds or milliseconds since 1970. Null if none does."""
    text = F.trim(as_col(c).cast("string"))
    found = [F.when(text.rlike(p), F.try_to_timestamp(text) if f is None else F.try_to_timestamp(text, F.lit(f))) for p, f in layouts]
    compact = F.when(text.rlike(r"^\d{8}$"), F.coalesce(F.try_to_timestamp(text, F.lit("ddMMyyyy")), F.try_to_timestamp(text, F.lit("yyyyMMdd"))))
    epoch = F.when(text.rlike(r"^\d{12,13}$"), F.timestamp_millis(text.try_cast("long"))).when(text.rlike(r"^\d{9,10}$"), F.timestamp_seconds(text.try_cast("long")))
    return F.coalesce(*found, compact, epoch)


def parse_dates(df: DataFrame, cols: Iterable[str], on_fail: str = "null") -> DataFrame:
    """Timestamps; with on_fail keep the texts stay and the timestamps go to <col>_ts."""
    return df.withColumns({c if on_fail == "null" else f"{c}_ts": parsed_date(c) for c in cols})


def date_pt(c: ColumnLike) -> Column:
    """Dates such as 02 OUTUBRO 1968 or 2 de outubro de 1968."""
    text = folded(c)
    months = {dims.fold(m): i + 1 for i, m in enumerate(dims.MONTHS)}
    pattern = r"(\d{1,2})\s+(?:de\s+)?([a-z]+)\s+(?:de\s+)?(\d{4})"
    month = F.create_map(*[F.lit(x) for kv in months.items() for x in kv])[F.regexp_extract(text, pattern, 2)]
    day, year = F.regexp_extract(text, pattern, 1), F.regexp_extract(text, pattern, 3)
    return F.try_to_timestamp(F.concat_ws("-", F.when(year != "", year), month.cast("string"), F.when(day != "", day)), F.lit("yyyy-M-d")).cast("date")


def parse_dates_pt(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    return each(df, cols, date_pt)


def split_datetime(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """<col>_date and <col>_time."""
    return df.withColumns({k: v for c in cols for k, v in ((f"{c}_date", F.to_date(F.col(f"`{c}`"))), (f"{c}_time", F.date_format(F.col(f"`{c}`"), "HH:mm:ss")))})


# --- C13 to C20: places, dimensions, categories -----------------------------------------------------------------------


def split_location(df: DataFrame, col: str) -> DataFrame:
    """<col>_city and <col>_state: a state code behind / - , or a blank, or a state's name behind one of the marks."""
    text = squeezed(col)
    code = F.upper(F.regexp_extract(text, r"(?:[/,\-]\s*|\s)([A-Za-z]{2})$", 1))
    known = code.isin(*dims.STATES)
    name = lookup({dims.fold(v): k for k, v in dims.STATES.items()}, folded(F.regexp_extract(text, r"[/,\-]\s*([^/,\-]+)$", 1)))
    state = F.when(known, code).otherwise(name)
    city = F.when(known, F.regexp_replace(text, r"\s*[/,\-]?\s*[A-Za-z]{2}$", "")).when(name.isNotNull(), F.regexp_replace(text, r"\s*[/,\-]\s*[^/,\-]+$", "")).otherwise(text)
    return df.withColumns({f"{col}_city": F.when(F.length(city) > 0, standard_value(city, "cities")), f"{col}_state": state})


def standard_value(c: ColumnLike, dim: str) -> Column:
    """The dimension's spelling of a value, found without accents and case (markets and stages also without blanks); else as a name."""
    table = dims.dimension(dim)
    key = F.trim(F.regexp_replace(folded(c), r"\s+", "" if dim == "markets" else " "))
    return F.coalesce(lookup(table, key), proper_name(c))


def standardise_dim(df: DataFrame, col: str, dim: str | DataFrame, key: str = "key", value: str = "value") -> DataFrame:
    """By a fixed dimension (states, cities, markets, stages), or by a table of match keys and values."""
    if isinstance(dim, str):
        return df.withColumn(col, standard_value(col, dim))
    table = dim.select(F.col(key).alias("_dim_key"), F.col(value).alias("_dim_value")).dropDuplicates(["_dim_key"])
    return df.join(table, match_key(col) == F.col("_dim_key"), "left").withColumn(col, F.coalesce("_dim_value", proper_name(col))).drop("_dim_key", "_dim_value")


def standardise_enum(df: DataFrame, col: str, mapping: str | dict[str, str]) -> DataFrame:
    """Marital status, gender, education or a map of one's own by upper case; blank is Não informado, unknown as a title."""
    table = {"marital": dims.MARITAL, "gender": dims.GENDER, "education": dims.EDUCATION}[mapping] if isinstance(mapping, str) else mapping
    known = F.coalesce(lookup(table, F.upper(F.trim(as_col(col)))), TEXT_OPS["title"](F.trim(as_col(col))))
    return df.withColumn(col, F.when(is_blank(col), "Não informado").otherwise(known))


#: Parts of column names and the standardiser for them, in order; city with state comes before either.
ROUTES = [
    (("email", "e_mail"), lambda c: F.coalesce(F.when(is_email(c), F.lower(F.trim(c))))),
    (("cpf", "cnpj"), lambda c: F.coalesce(formatted_document(c), c)),
    (("telefone", "phone", "whatsapp", "celular"), formatted_phone),
    (("cep",), lambda c: F.when(F.length(digits(c)) == 8, cut(digits(c), "#####-###"))),
    (("cidade_estado", "cidade_e_estado"), squeezed),
    (("cidade", "city"), lambda c: standard_value(c, "cities")),
    (("estado", "state", "uf"), lambda c: standard_value(c, "states")),
    (("mercado", "market", "setor"), lambda c: standard_value(c, "markets")),
    (("empresa", "company"), company_name),
    (("nome", "name"), proper_name),
    (("data", "date"), lambda c: F.date_format(parsed_date(c), "dd/MM/yyyy HH:mm:ss")),
    (("valor", "value", "receita", "revenue", "preco"), lambda c: money(c).cast("string")),
]


def auto_standardise(df: DataFrame) -> DataFrame:
    """Each text column by the first route whose part its name has; others are squeezed. One projection."""
    out = {}
    for name, kind in df.dtypes:
        if kind == "string":
            fn = next((fn for parts, fn in ROUTES if any(p in dims.fold(name) for p in parts)), squeezed)
            out[name] = fn(F.col(f"`{name}`"))
    return df.withColumns(out)


def domains(df: DataFrame, url: str | None = None, email: str | None = None) -> DataFrame:
    """url_domain (without www), email_domain and email_kind (personal or corporate)."""
    out = {}
    if url:
        host = F.regexp_extract(F.lower(F.trim(as_col(url))), r"^(?:[a-z]+://)?(?:www\.)?([^/:?#\s]+)", 1)
        out["url_domain"] = F.when(host.contains("."), host)
    if email:
        domain = F.when(as_col(email).contains("@"), F.lower(F.trim(F.substring_index(as_col(email), "@", -1))))
        out |= {"email_domain": domain, "email_kind": F.when(domain.isin(*dims.PERSONAL_MAIL), "personal").when(domain.isNotNull(), "corporate")}
    return df.withColumns(out)


def first_group(c: ColumnLike, groups: list[tuple[str, list[str]]], default: str, blank: str | None = None) -> Column:
    """The first group one of whose keywords the text has."""
    text = F.lower(as_col(c))
    out = F.when(as_col(c).isNull(), blank) if blank is not None else F
    for name, words in groups:
        out = out.when(reduce(Column.__or__, (text.contains(w) for w in words)), name)
    return out.otherwise(default)


def job_level(df: DataFrame, col: str) -> DataFrame:
    """<col>_level, <col>_seniority (5 to 0) and decision_maker."""
    level = first_group(col, dims.JOB_LEVELS, "Operacional", "não informado")
    rank = lookup({n: str(5 - i) for i, (n, _) in enumerate(dims.JOB_LEVELS)}, level).cast("int")
    return df.withColumns({f"{col}_level": level, f"{col}_seniority": F.coalesce(rank, F.lit(0)), "decision_maker": F.coalesce(rank >= 3, F.lit(False))})


def categorise_segment(df: DataFrame, col: str, scheme: str = "segment") -> DataFrame:
    groups, default = (dims.SEGMENTS, "OUTROS") if scheme == "segment" else (dims.SECTORS, "outros")
    return df.withColumn(f"{col}_category", first_group(F.coalesce(as_col(col), F.lit("")), groups, default))


def revenue_band(df: DataFrame, col: str = "faixa_faturamento") -> DataFrame:
    """revenue_min, revenue_max and revenue_score (1 to 5); unknown bands are 0, 0 and 1."""
    text, low, high = F.lower(as_col(col)), F, F
    for name, a, b in dims.REVENUE:
        low, high = low.when(text.contains(name), F.lit(a)), high.when(text.contains(name), F.lit(b))
    low, high = low.otherwise(F.lit(0.0)), high.otherwise(F.lit(0.0))
    score = F.when(low >= 1e8, 5).when(low >= 5e7, 4).when(low >= 1e7, 3).when(low >= 1e6, 2).otherwise(1)
    return df.withColumns({"revenue_min": low, "revenue_max": high, "revenue_score": score})


def headcount_band(df: DataFrame, col: str = "faixa_funcionarios") -> DataFrame:
    """headcount_score (1 to 7, unknown 0) and size_class."""
    score = F.coalesce(lookup({b: str(i + 1) for i, b in enumerate(dims.HEADCOUNT)}, F.trim(as_col(col))).cast("int"), F.lit(0))
    return df.withColumns({"headcount_score": score, "size_class": F.when(score >= 6, "grande").when(score >= 3, "média").when(score >= 1, "pequena").otherwise("não informado")})


def banded(c: Column, edges: list[float], labels: list[str], right: bool = True) -> Column:
    """Labels of bins, closed on the right (the lowest edge is outside) or on the left."""
    out = F
    for lo, hi, label in zip(edges[:-1], edges[1:], labels, strict=True):
        out = out.when((c > lo) & (c <= hi) if right else (c >= lo) & (c < hi), label)
    return out.otherwise(F.lit(None).cast("string"))


def age_bands(df: DataFrame, birth: str, as_of, scheme: str = "leads") -> DataFrame:
    """idade (days / 365.25) and faixa_etaria; scheme leads: right-closed, report: left-closed bins."""
    age = F.datediff(F.lit(as_of).cast("date"), as_col(birth).cast("date")) / 365.25
    if scheme == "leads":
        band = banded(age, [0, 25, 35, 45, 55, 65, 100], ["<25", "25-34", "35-44", "45-54", "55-64", "65+"])
    else:
        band = banded(age, [0, 18, 25, 35, 45, 55, 65, 200], ["<18", "18-24", "25-34", "35-44", "45-54", "55-64", "65+"], right=False)
    return df.withColumns({"idade": age, "faixa_etaria": band})


# --- C22 to C29: features, hashes, privacy ----------------------------------------------------------------------------


def temporal_features(df: DataFrame, cols: Iterable[str], as_of) -> DataFrame:
    """year, month, day, weekday (Monday 0), quarter, weekend, hour and days ago of each column."""
    out = {}
    for c in cols:
        x = F.col(f"`{c}`")
        out |= {f"{c}_year": F.year(x), f"{c}_month": F.month(x), f"{c}_day": F.dayofmonth(x), f"{c}_weekday": F.weekday(x), f"{c}_quarter": F.quarter(x), f"{c}_weekend": (F.weekday(x) >= 5).cast("int"), f"{c}_hour": F.hour(x), f"{c}_days_ago": F.datediff(F.lit(as_of).cast("date"), x)}
    return df.withColumns(out)


def text_features(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """length, words, digits, specials, upper, lower, has_at, has_title and title_case of each column."""
    out = {}
    for c in cols:
        x = F.coalesce(F.col(f"`{c}`"), F.lit(""))
        out |= {
            f"{c}_length": F.length(x), f"{c}_words": F.regexp_count(x, F.lit(r"\S+")), f"{c}_digits": F.regexp_count(x, F.lit("[0-9]")), f"{c}_specials": F.regexp_count(x, F.lit(r"[^A-Za-zÀ-ÿ0-9\s]")),
            f"{c}_upper": F.regexp_count(x, F.lit("[A-Z]")), f"{c}_lower": F.regexp_count(x, F.lit("[a-z]")), f"{c}_has_at": x.contains("@").cast("int"),
            f"{c}_has_title": x.rlike(r"(?i)^(?:dr|dra|sr|sra|prof)\.?\s").cast("int"),
        }
    return df.withColumns(out)


def interactions(df: DataFrame, cols: list[str]) -> DataFrame:
    """Ratio (divisor + 1e-8) and product of each two of the columns."""
    out = {}
    for i, a in enumerate(cols):
        for b in cols[i + 1 :]:
            out |= {f"{a}_{b}_ratio": as_col(a) / (as_col(b) + 1e-8), f"{a}_{b}_product": as_col(a) * as_col(b)}
    return df.withColumns(out)


def minutes_between(df: DataFrame, a: str, b: str, name: str = "minutes") -> DataFrame:
    return df.withColumn(name, (F.unix_timestamp(as_col(b)) - F.unix_timestamp(as_col(a))) / 60)


def document_type(df: DataFrame, cpf: str = "cpf", cnpj: str = "cnpj") -> DataFrame:
    return df.withColumn("document_type", F.when(is_cnpj(cnpj), "PJ").when(is_cpf(cpf), "PF").otherwise("unknown"))


def row_hash(df: DataFrame, cols: list[str] | None = None, name: str = "hash_registro") -> DataFrame:
    """16 hexadecimal digits of the MD5 of the row's JSON."""
    return df.withColumn(name, F.substring(F.md5(F.to_json(F.struct(*[F.col(f"`{c}`") for c in cols or df.columns]))), 1, 16))


def natural_id(df: DataFrame, cols: Iterable[str] = ("cpf", "email"), name: str = "id_unico") -> DataFrame:
    """From the first filled column; without one from the whole row, so that reruns agree."""
    key = F.coalesce(*[blank_to_null(c) for c in cols], F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))
    return df.withColumn(name, F.substring(F.md5(key), 1, 16))


def anon_id(df: DataFrame, col: str, name: str = "id_anonimo") -> DataFrame:
    return df.withColumn(name, F.substring(F.sha2(as_col(col).cast("string"), 256), 1, 12))


def apply_privacy(df: DataFrame, cpf: str = "cpf", rg: str = "rg", consent: str = "autorizacao_imagem", date: str = "data_inscricao") -> DataFrame:
    """Masks that keep three and two characters; consent as a flag with its date."""
    out = {}
    if cpf in df.columns:
        out[f"{cpf}_anonimizado"] = F.concat(F.substring(as_col(cpf), 1, 3), F.lit("*" * 8))
    if rg in df.columns:
        out[f"{rg}_anonimizado"] = F.concat(F.substring(as_col(rg), 1, 2), F.lit("*" * 7))
    if consent in df.columns:
        given = F.coalesce(as_col(consent).try_cast("int") != 0, F.lit(False))
        out["consentimento_dado"] = given
        if date in df.columns:
            out["data_consentimento"] = F.when(given, as_col(date))
    return df.withColumns(out)


def name_parts(df: DataFrame, col: str) -> DataFrame:
    words = F.split(squeezed(col), " ")
    return df.withColumns({"primeiro_nome": F.element_at(words, 1), "ultimo_nome": F.element_at(words, -1)})


def address_fields(df: DataFrame, col: str) -> DataFrame:
    """Upper case with R. and AV. for Rua and Avenida; <col>_cep from the text."""
    text = F.regexp_replace(F.regexp_replace(F.upper(squeezed(col)), r"\bRUA\b", "R."), r"\bAVENIDA\b", "AV.")
    cep = F.regexp_extract(as_col(col), r"\b(\d{5}-?\d{3})\b", 1)
    return df.withColumns({col: text, f"{col}_cep": F.when(cep != "", cut(digits(cep), "#####-###"))})


def mask_email(df: DataFrame, col: str) -> DataFrame:
    """First letter and domain stay."""
    name, domain = F.substring_index(as_col(col), "@", 1), F.substring_index(as_col(col), "@", -1)
    return df.withColumn(col, F.when(as_col(col).contains("@"), F.concat(F.substring(name, 1, 1), F.lit("***@"), domain)))
