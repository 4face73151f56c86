"""The register of queries, and tables of leads that are derived from the customers and orders."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
#: The time that takes the place of the clock.
AS_OF = "2024-06-01"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a function under its name, with its SQL."""

    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Text that both engines read: columns of leads from a customer.
LEAD_COLUMNS = {
    "id": "c_custkey",
    "nome": "case when c_custkey % 4 = 0 then concat('  dr. maria  DA silva', cast(c_custkey as string)) when c_custkey % 4 = 1 then concat('joão e josé ', cast(c_custkey as string)) else c_name end",
    "email": "case when c_custkey % 7 = 0 then null when c_custkey % 7 = 1 then 'bad mail' else concat('User', cast(c_custkey as string), '@', case when c_custkey % 3 = 0 then 'gmail.com' else 'empresa.com' end) end",
    "cpf": "lpad(cast((c_custkey * 7654321 + 11144477735) % 100000000000 as string), 11, '0')",
    "cnpj": "lpad(cast((c_custkey * 987654321 + 11222333000181) % 100000000000000 as string), 14, '0')",
    "telefone": "case c_custkey % 6 when 0 then concat('55119', lpad(cast(c_custkey % 100000000 as string), 8, '0')) when 1 then concat('11', lpad(cast(c_custkey % 100000000 as string), 8, '3')) when 2 then concat('(21) 9', lpad(cast(c_custkey % 10000 as string), 4, '1'), '-', lpad(cast(c_custkey % 10000 as string), 4, '2')) when 3 then concat('9', lpad(cast(c_custkey % 100000000 as string), 8, '0')) when 4 then '123' else null end",
    "cep": "case when c_custkey % 3 = 0 then lpad(cast(c_custkey % 100000000 as string), 8, '0') when c_custkey % 3 = 1 then '1234' else null end",
    "empresa": "concat('empresa ', lower(c_mktsegment), ' ltda')",
    "cargo": "case c_custkey % 5 when 0 then 'CEO' when 1 then 'Diretor de Vendas' when 2 then 'analista' when 3 then 'Estagiário' else null end",
    "segmento": "c_mktsegment",
    "cidade_estado": "case c_custkey % 4 when 0 then 'SAO PAULO/SP' when 1 then 'Rio de Janeiro - rj' when 2 then 'curitiba, Paraná' else 'Recife' end",
    "faixa_faturamento": "case c_custkey % 4 when 0 then 'Até 1 milhão' when 1 then '10 milhões a 50 milhões' when 2 then 'Acima de 100 milhões' else null end",
    "valor": "c_acctbal",
    "nacao": "c_nationkey",
    "data_cadastro": "cast(concat(cast(2020 + c_custkey % 5 as string), '-', lpad(cast(1 + c_custkey % 12 as string), 2, '0'), '-', lpad(cast(1 + c_custkey % 28 as string), 2, '0')) as date)",
}
LEADS_SQL = "(select " + ", ".join(f"{e} as {n}" for n, e in LEAD_COLUMNS.items()) + " from customer)"


def leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leads with the irregularities of exports, one for each customer."""
    return table(spark, sf_dir, "customer").selectExpr(*[f"{e} as {n}" for n, e in LEAD_COLUMNS.items()])
