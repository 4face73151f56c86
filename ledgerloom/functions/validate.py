"""Validity of identifiers and contacts, as native column expressions and as jobs on tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

ColumnLike = Column | str


def as_col(c: ColumnLike) -> Column:
    return F.col(f"`{c}`") if isinstance(c, str) else c


def digits(c: ColumnLike) -> Column:
    """Only the digits of a text; null stays null."""
    return F.regexp_replace(as_col(c).cast("string"), "[^0-9]", "")


def check_digit(text: Column, weights: list[int]) -> Column:
    """The mod-11 check digit of the first len(weights) digits: 11 less the rest, and 0 where that is 10 or more."""
    total = sum((F.substring(text, i + 1, 1).cast("int") * w for i, w in enumerate(weights)), F.lit(0))
    rest = 11 - total % 11
    return F.when(rest >= 10, 0).otherwise(rest)


#: The weights of the two check digits of CPF and CNPJ.
CPF_WEIGHTS = list(range(10, 1, -1)), list(range(11, 1, -1))
CNPJ_WEIGHTS = [5, 4, 3, 2, 9, 8, 7, 6, 5, 4, 3, 2], [6, 5, 4, 3, 2, 9, 8, 7, 6, 5, 4, 3, 2]


def _checked(c: ColumnLike, size: int, weights: tuple[list[int], list[int]]) -> Column:
    text = digits(c)
    sound = text.rlike(f"^[0-9]{{{size}}}$") & ~text.rlike(r"^([0-9])\1*$")
    first, second = (check_digit(text, w) == F.substring(text, len(w) + 1, 1).cast("int") for w in weights)
    return F.coalesce(F.when(sound, first & second).otherwise(False), F.lit(False))


def is_cpf(c: ColumnLike) -> Column:
    """Eleven digits, not all equal, with both check digits right."""
    return _checked(c, 11, CPF_WEIGHTS)


def is_cnpj(c: ColumnLike) -> Column:
    """Fourteen digits, not all equal, with both check digits right."""
    return _checked(c, 14, CNPJ_WEIGHTS)


#: Patterns of e-mail addresses, strict and loose.
EMAIL = {"strict": r"^[a-z0-9._%+-]+@[a-z0-9.-]+\.[a-z]{2,}$", "loose": r"^[^@\s]+@[^@\s]+\.[^@\s]+$", "contains": "@"}


def is_email(c: ColumnLike, pattern: str = "strict") -> Column:
    return F.coalesce(F.lower(as_col(c).cast("string")).rlike(EMAIL.get(pattern, pattern)), F.lit(False))


#: The layouts in which phone numbers are taken.
PHONE_LAYOUTS = [
    r"\+55\s*\([0-9]{2}\)\s*[0-9]{4,5}-?[0-9]{4}",
    r"\+55\s*[0-9]{2}\s*[0-9]{4,5}-?[0-9]{4}",
    r"\([0-9]{2}\)\s*[0-9]{4,5}-?[0-9]{4}",
    r"[0-9]{2}\s*[0-9]{4,5}-?[0-9]{4}",
    r"\+?55[0-9]{10,11}",
    r"[0-9]{10,11}",
]


def is_phone(c: ColumnLike, mode: str = "digits") -> Column:
    """digits: 10 or 11 digits, area code from 11, the first digit of an 11-digit number 9; layout: one of the layouts."""
    if mode == "layout":
        return F.coalesce(F.trim(as_col(c).cast("string")).rlike("^(?:" + "|".join(PHONE_LAYOUTS) + ")$"), F.lit(False))
    return F.coalesce(digits(c).rlike(r"^(?:1[1-9]|[2-9][0-9])(?:[0-9]{8}|9[0-9]{8})$"), F.lit(False))


def is_cep(c: ColumnLike) -> Column:
    return F.coalesce(F.length(digits(c)) == 8, F.lit(False))


def is_date(c: ColumnLike, fmt: str = "yyyy-MM-dd") -> Column:
    return F.try_to_timestamp(as_col(c).cast("string"), F.lit(fmt)).isNotNull()


def is_number(c: ColumnLike, low: float | None = None, high: float | None = None) -> Column:
    number = as_col(c).try_cast("double")
    ok = number.isNotNull()
    ok = ok if low is None else ok & (number >= low)
    return F.coalesce(ok if high is None else ok & (number <= high), F.lit(False))


def is_blank(c: ColumnLike) -> Column:
    return as_col(c).isNull() | (F.trim(as_col(c).cast("string")) == "")


# --- jobs -------------------------------------------------------------------------------------------------------------


def flag_cpf(df: DataFrame, col: str, name: str | None = None) -> DataFrame:
    return df.withColumn(name or f"{col}_valid", is_cpf(col))


def flag_cnpj(df: DataFrame, col: str, name: str | None = None) -> DataFrame:
    return df.withColumn(name or f"{col}_valid", is_cnpj(col))


def flag_document(df: DataFrame, col: str, kind: str = "auto") -> DataFrame:
    """<col>_type (cpf, cnpj or null, by number of digits) and <col>_valid."""
    size = F.length(digits(col))
    found = F.when(size == 11, "cpf").when(size == 14, "cnpj") if kind == "auto" else F.lit(kind)
    valid = F.when(found == "cpf", is_cpf(col)).when(found == "cnpj", is_cnpj(col)).otherwise(False)
    return df.withColumns({f"{col}_type": found, f"{col}_valid": valid})


def flag_email(df: DataFrame, col: str, pattern: str = "strict") -> DataFrame:
    return df.withColumn(f"{col}_valid", is_email(col, pattern))


def repaired_email(c: ColumnLike) -> Column:
    """Lower case, without blanks, repeated dots as one, no dots at the ends or beside @; null if it still has no address form."""
    text = F.regexp_replace(F.lower(as_col(c)), r"\s+", "")
    text = F.regexp_replace(F.regexp_replace(text, r"\.{2,}", "."), r"^\.|\.$|\.(?=@)|(?<=@)\.", "")
    return F.when(is_email(text), text)


def repair_email(df: DataFrame, col: str) -> DataFrame:
    return df.withColumn(col, repaired_email(col))


def flag_phone(df: DataFrame, col: str, mode: str = "digits") -> DataFrame:
    return df.withColumn(f"{col}_valid", is_phone(col, mode))


def flag_cep(df: DataFrame, col: str) -> DataFrame:
    return df.withColumn(f"{col}_valid", is_cep(col))


def flag_date(df: DataFrame, col: str, fmt: str = "yyyy-MM-dd") -> DataFrame:
    return df.withColumn(f"{col}_valid", is_date(col, fmt))


def flag_range(df: DataFrame, col: str, low: float | None = None, high: float | None = None) -> DataFrame:
    return df.withColumn(f"{col}_valid", is_number(col, low, high))


#: Validators by name, each from (column, parameters) to a Boolean column, with their message.
VALIDATORS: dict[str, tuple[Callable[..., Column], str]] = {
    "cpf": (lambda c, **_: is_cpf(c), "invalid CPF"),
    "cnpj": (lambda c, **_: is_cnpj(c), "invalid CNPJ"),
    "email": (lambda c, pattern="strict", **_: is_email(c, pattern), "invalid e-mail"),
    "phone": (lambda c, mode="digits", **_: is_phone(c, mode), "invalid phone"),
    "cep": (lambda c, **_: is_cep(c), "invalid postal code"),
    "date": (lambda c, format="yyyy-MM-dd", **_: is_date(c, format), "invalid date"),
    "range": (lambda c, min=None, max=None, **_: is_number(c, min, max), "out of range"),
}


def register_validator(name: str, expr: Callable[..., Column], message: str = "invalid value") -> None:
    """expr takes the column and the rule's parameters; a pandas_udf call is a column too."""
    VALIDATORS[name] = (expr, message)


@dataclass(frozen=True)
class FieldRule:
    """A rule of a list: a field, the validator's name, whether it must be filled, parameters and a message of its own."""

    field: str
    validator: str
    required: bool = False
    params: dict = field(default_factory=dict)
    message: str | None = None


def validate(df: DataFrame, rules: Iterable[FieldRule]) -> tuple[DataFrame, DataFrame]:
    """V8: `df` with <field>_valid and <field>_error, and a summary (field, total, n_valid, n_invalid, error_rate).

    An empty value is wrong only if it is required. A field that the table lacks is wrong in each row if required.
    """
    added, rules = {}, list(rules)
    for r in rules:
        expr, message = VALIDATORS[r.validator]
        if r.field not in df.columns:
            valid, error = F.lit(not r.required), F.lit("missing column" if r.required else None).cast("string")
        else:
            valid = F.when(is_blank(r.field), F.lit(not r.required)).otherwise(expr(F.col(f"`{r.field}`"), **r.params))
            error = F.when(is_blank(r.field) & F.lit(r.required), "required").when(~valid, F.lit(r.message or message))
        added |= {f"{r.field}_valid": valid, f"{r.field}_error": error}
    out = df.withColumns(added)
    counts = out.agg(F.count("*").alias("total"), *[F.count_if(F.col(f"`{r.field}_valid`")).alias(f"v{i}") for i, r in enumerate(rules)])
    rows = F.array(*[F.struct(F.lit(r.field).alias("field"), F.col("total"), F.col(f"v{i}").alias("n_valid")) for i, r in enumerate(rules)])
    summary = counts.select(F.inline(rows)).withColumn("n_invalid", F.col("total") - F.col("n_valid"))
    return out, summary.withColumn("error_rate", F.when(F.col("total") > 0, F.col("n_invalid") / F.col("total")).otherwise(0.0))


def phone_features(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """V9: for each phone column its validity by layout, whether it is a mobile (ninth digit from the right is 9), and
    whether it has the country code. Columns that derived flags made are not phones."""
    cols = [c for c in df.columns if any(k in c.lower() for k in ("telefone", "whatsapp", "phone", "fone")) and not c.lower().startswith("has_")] if cols is None else cols
    added = {}
    for c in cols:
        name, number, text = c.replace("telefone", "phone").replace("whatsapp", "whats"), digits(c), as_col(c).cast("string")
        added[f"{name}_valid"] = is_phone(c, "layout").cast("int")
        added[f"{name}_mobile"] = F.coalesce(((F.length(number) >= 10) & (F.substring(number, -9, 1) == "9")).cast("int"), F.lit(0))
        added[f"{name}_country_code"] = F.coalesce((text.contains("+55") | text.startswith("55")).cast("int"), F.lit(0))
    return df.withColumns(added)


def contact_features(df: DataFrame, formula: str = "basic", names: dict[str, str] | None = None) -> DataFrame:
    """Lengths, flags and the data quality score of contacts.

    basic (0 to 3): e-mail, LinkedIn, name over 5. extended (0 to 5): with WhatsApp, and segment over 3. documents (0 to
    6): e-mail, LinkedIn, WhatsApp layout, CPF, CNPJ, name over 5. names: our field -> the table's column.
    """
    names = {n: n for n in ("nome", "empresa_cargo", "linkedin", "email", "whatsapp", "segmento", "cpf", "cnpj")} | (names or {})
    field_of = lambda n: F.coalesce(as_col(names[n]).cast("string"), F.lit("")) if names[n] in df.columns else F.lit("")
    flag = lambda c: c.cast("int")
    whats = is_phone(field_of("whatsapp"), "layout") if formula == "documents" else field_of("whatsapp").contains("55")
    out = {
        "nome_length": F.length(field_of("nome")),
        "empresa_cargo_length": F.length(field_of("empresa_cargo")),
        "has_linkedin": flag(F.lower(field_of("linkedin")).contains("linkedin")),
        "has_email": flag(field_of("email").contains("@")),
        "has_whatsapp": flag(whats),
    }
    long_name = flag(F.length(field_of("nome")) > 5)
    score = out["has_email"] + out["has_linkedin"] + long_name
    if formula == "extended":
        score = score + out["has_whatsapp"] + flag(F.length(field_of("segmento")) > 3)
    if formula == "documents":
        out |= {"cpf_valid": flag(is_cpf(field_of("cpf"))), "cnpj_valid": flag(is_cnpj(field_of("cnpj")))}
        score = score + out["has_whatsapp"] + out["cpf_valid"] + out["cnpj_valid"]
    return df.withColumns(out | {"data_quality_score": score})


def row_completeness(df: DataFrame, cols: list[str] | None = None, weights: dict[str, float] | None = None) -> DataFrame:
    """Completeness (share of filled columns, weighted if weights are given) and key_indicators (how many are filled)."""
    cols = cols or df.columns
    weights = weights or {}
    filled = {c: (~is_blank(c)).cast("int") for c in cols}
    total = float(sum(weights.get(c, 1.0) for c in cols)) or 1.0
    return df.withColumns({"completeness": sum((x * weights.get(c, 1.0) for c, x in filled.items()), F.lit(0.0)) / total, "key_indicators": sum(filled.values(), F.lit(0))})
