"""Declarative lists of steps, run in order over a table (P9), and a folder of saved lists."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import standardise, validate
from ..operators import aggregates, quality, schema, scoring


def _validation(df: DataFrame, config: dict) -> DataFrame:
    rules = [validate.FieldRule(r["field"], r["validator"], r.get("required", False), {k: v for k, v in r.items() if k not in ("field", "validator", "required")}) for r in config["validations"]]
    return validate.validate(df, rules)[0]


def _text(df: DataFrame, config: dict) -> DataFrame:
    for f in config["fields"]:
        df = standardise.clean_text(df, [f["field"]], f["operations"])
    return df


def _formats(df: DataFrame, config: dict) -> DataFrame:
    for f in config["fields"]:
        col, kind = f["field"], f["format"]
        if kind in ("cpf", "cnpj", "auto", "digits"):
            df = standardise.format_documents(df, {col: kind})
        elif kind == "phone":
            df = standardise.format_phones(df, [col], f.get("style", "national"))
        elif kind == "cep":
            df = standardise.format_cep(df, col)
        elif kind == "date":
            df = standardise.parse_dates(df, [col])
        elif kind == "money":
            df = standardise.parse_money(df, [col])
        else:
            raise ValueError(f"unknown format {kind}")
    return df


def _features(df: DataFrame, config: dict) -> DataFrame:
    for f in config["features"]:
        kind, name = f["type"], f["name"]
        if kind == "completeness":
            df = validate.row_completeness(df, f["fields"], f.get("weights")).withColumnsRenamed({"completeness": name})
        elif kind == "category":
            df = schema.categorise(df, f["field"], f["mapping"], name, f.get("default"))
        elif kind == "conditional":
            df = schema.conditional(df, name, f["condition"], F.lit(f["then"]), F.lit(f["else"]))
        elif kind == "minutes_between":
            df = standardise.minutes_between(df, f["start"], f["end"], name)
        elif kind == "expression":
            df = df.withColumn(name, F.expr(f["expression"]))
        else:
            raise ValueError(f"unknown feature {kind}")
    return df


def _checks(df: DataFrame, config: dict) -> DataFrame:
    report = quality.quality_report(df, config["key_fields"], config["required_fields"], {"+".join(f): f for f in config.get("not_both", [])})
    least = config.get("least_score")
    if least is not None and report.first()["overall_score"] < least:
        raise ValueError("quality is below what the steps ask for")
    return df


#: Steps by type, each from (table, configuration).
STEPS: dict[str, Callable[[DataFrame, dict], DataFrame]] = {
    "validation": _validation,
    "text_normalization": _text,
    "format_standardization": _formats,
    "feature_engineering": _features,
    "lead_scoring": lambda df, c: scoring.score_groups(df, {g["name"]: {"max": g["max_score"], "criteria": [tuple(x) for x in g["criteria"]]} for g in c["scoring_rules"]}),
    "quality_validation": _checks,
    "select": lambda df, c: df.select(*c["columns"]),
    "rename": lambda df, c: df.withColumnsRenamed(c["names"]),
    "filter": lambda df, c: df.filter(c["condition"]),
    "aggregate": lambda df, c: df.groupBy(*c["by"]).agg(*[F.expr(e).alias(n) for n, e in c["measures"].items()]),
    "sort": lambda df, c: df.orderBy(*[F.col(x.lstrip("-")).desc() if x.startswith("-") else F.col(x) for x in c["by"]]),
    "limit": lambda df, c: df.limit(c["n"]),
    "value_counts": lambda df, c: aggregates.value_counts(df, c["field"], c.get("k")),
}


def run_steps(df: DataFrame, spec: list[dict]) -> DataFrame:
    """spec: [{"name", "type", "enabled", "config"}]; steps that aren't enabled are passed over. One lazy plan."""
    for step in spec:
        if step.get("enabled", True):
            if step["type"] not in STEPS:
                raise ValueError(f"unknown step {step['type']}")
            df = df.transform(STEPS[step["type"]], step.get("config", {}))
    return df


def save_steps(spark: SparkSession, folder: str, name: str, spec: list[dict]) -> None:
    """One row of JSON text under folder/name, on any path that Spark writes."""
    spark.createDataFrame([(name, json.dumps(spec))], "name string, spec string").coalesce(1).write.mode("overwrite").json(f"{folder}/name={name}")


def load_steps(spark: SparkSession, folder: str, name: str) -> list[dict]:
    row = spark.read.schema("spec string").json(f"{folder}/name={name}").first()
    if row is None:
        raise KeyError(name)
    return json.loads(row["spec"])


def list_steps(spark: SparkSession, folder: str) -> DataFrame:
    """The names of saved lists."""
    return spark.read.schema("spec string, name string").json(folder).select("name").distinct()
