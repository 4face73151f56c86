"""Golden cases of validation and standardisation."""

import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from ledgerloom.functions import dims, standardise as s, validate as v


def column(spark, values, fn, kind="string"):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(values)], f"i int, x {kind}")
    return [r.y for r in df.select("i", fn("x").alias("y")).orderBy("i").collect()]


def test_cpf(spark):
    good, bad = ["11144477735", "111.444.777-35", "52998224725"], ["11111111111", "123", "11144477736", None, "", "abc"]
    assert column(spark, good + bad, v.is_cpf) == [True] * 3 + [False] * 6


def test_cnpj(spark):
    assert column(spark, ["11.222.333/0001-81", "11222333000181", "11222333000182", "00000000000000", "11", None], v.is_cnpj) == [True, True, False, False, False, False]


def check_digits(base, weights):
    for w in weights:
        rest = 11 - sum(int(d) * x for d, x in zip(base, w, strict=True)) % 11
        base += str(0 if rest >= 10 else rest)
    return base


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(1, 10**9 - 1), min_size=20, max_size=40))
def test_generated_documents_are_valid(spark, numbers):
    cpfs = [check_digits(f"{n:09d}", v.CPF_WEIGHTS) for n in numbers]
    cpfs = [c for c in cpfs if len(set(c)) > 1]
    assert all(column(spark, cpfs, v.is_cpf))
    wrong = [c[:-1] + str((int(c[-1]) + 1) % 10) for c in cpfs]
    assert not any(column(spark, wrong, v.is_cpf))


def test_contacts(spark):
    assert column(spark, ["a@b.com", "A.B@C.ORG", "bad", "a@b", None, ""], v.is_email) == [True, True, False, False, False, False]
    phones = ["(11) 99999-9999", "1133334444", "11899999999", "0199999999", "123", None]
    assert column(spark, phones, v.is_phone) == [True, True, False, False, False, False]
    layouts = ["+55 (11) 99999-9999", "(11) 99999-9999", "11 99999-9999", "+5511999999999", "5511999999999", "11999999999", "123", "abc"]
    assert column(spark, layouts, lambda c: v.is_phone(c, "layout")) == [True] * 6 + [False] * 2
    assert column(spark, ["01310-100", "01310100", "1", None], v.is_cep) == [True, True, False, False]
    assert column(spark, [" A..B@x.com ", "a b@c.org", "x"], v.repaired_email) == ["a.b@x.com", "ab@c.org", None]


def test_documents_and_phones_are_formatted(spark):
    assert column(spark, ["11144477735", "1"], lambda c: s.formatted_document(c, "cpf")) == ["111.444.777-35", "000.000.000-01"]
    assert column(spark, ["11222333000181", "5"], s.formatted_document) == ["11.222.333/0001-81", None]
    phones = ["+55 11 98765-4321", "11987654321", "1133334444", "987654321", "33334444", "55119", "55987654321", None]
    assert column(spark, phones, s.formatted_phone) == ["(11) 98765-4321", "(11) 98765-4321", "(11) 3333-4444", "98765-4321", "3333-4444", "55119", "(55) 98765-4321", None]
    assert column(spark, ["5511987654321", "1133334444"], lambda c: s.formatted_phone(c, "international")) == ["+55 (11) 98765-4321", "+55 (11) 3333-4444"]
    assert column(spark, ["987654321"], lambda c: s.formatted_phone(c, "default_ddd", "21")) == ["(21) 98765-4321"]
    df = spark.createDataFrame([("01310100",), ("x",)], "cep string")
    assert [r.cep for r in s.format_cep(df, "cep").collect()] == ["01310-100", None]


def test_names(spark):
    names = ["  joão  DA silva ", "MARIA DE SOUZA E SILVA", "d'avila", "dr. josé prof santos", "", None]
    assert column(spark, names, s.proper_name) == ["João da Silva", "Maria de Souza e Silva", "D'Avila", "Dr. José Prof Santos", None, None]
    assert column(spark, ["DRA. ana lima", "sr dr. joao"], lambda c: s.proper_name(c, strip_titles=True)) == ["Ana Lima", "Joao"]
    assert column(spark, ["padaria do zé ltda", "acme s.a."], s.company_name) == ["Padaria do Zé LTDA", "Acme S.A."]
    assert column(spark, ["Padaria do Zé LTDA", "Acmé, S.A."], s.company_key) == ["padariadoze", "acme"]
    assert column(spark, ["Ação ÉÑ"], s.folded) == ["acao en"]
    df = spark.createDataFrame([("OLÁ MUNDO. tudo BEM? sim",)], "t string")
    assert s.sentence_case(df, ["t"]).first().t == "Olá mundo. Tudo bem? Sim"


def test_money(spark):
    texts = ["R$ 1.234,56", "1234.56", "2.571.567,00", "-10,5", "abc", None]
    assert column(spark, texts, s.money) == [Decimal("1234.56"), Decimal("1234.56"), Decimal("2571567.00"), Decimal("-10.50"), None, None]
    assert column(spark, [1234.567, 0.005, None], s.money_text, "double") == ["R$ 1.234,57", "R$ 0,01", "R$ 0,00"]
    assert column(spark, [1234.567], lambda c: s.money_text(c, mode="truncate"), "double") == ["R$ 1.234,56"]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.decimals(min_value=0, max_value=10**10, places=2), min_size=5, max_size=30))
def test_money_round_trip(spark, values):
    assert column(spark, values, lambda c: s.money(s.money_text(c)), "decimal(15,2)") == values


def test_dates(spark):
    texts = ["25/12/1990", "25121990", "25-12-1990", "1990-12-25", "25/12/1990 10:30", "25/12/1990, 10:30:05", "12/25/1990 10:30:05 PM", "1990-12-25T10:30:05Z", "662083200000", "662083200", "99/99/9999", "x", None]
    want = [dt.datetime(1990, 12, 25)] * 4 + [dt.datetime(1990, 12, 25, 10, 30), dt.datetime(1990, 12, 25, 10, 30, 5), dt.datetime(1990, 12, 25, 22, 30, 5), dt.datetime(1990, 12, 25, 10, 30, 5)] + [dt.datetime(1990, 12, 25)] * 2 + [None] * 3
    assert column(spark, texts, lambda c: F.date_format(s.parsed_date(c), "yyyy-MM-dd HH:mm:ss")) == [w and w.strftime("%Y-%m-%d %H:%M:%S") for w in want]
    assert column(spark, ["02 OUTUBRO 1968", "5 de março de 2001", "31 fevereiro 2000", "x", None], s.date_pt) == [dt.date(1968, 10, 2), dt.date(2001, 3, 5), None, None, None]


def test_places(spark):
    df = spark.createDataFrame([("SAO PAULO/SP",), ("Rio de Janeiro - rj",), ("curitiba, Paraná",), ("Recife PE",), ("Campinas",), (None,)], "l string")
    got = [(r.l_city, r.l_state) for r in s.split_location(df, "l").collect()]
    assert got == [("São Paulo", "SP"), ("Rio de Janeiro", "RJ"), ("Curitiba", "PR"), ("Recife", "PE"), ("Campinas", None), (None, None)]
    assert column(spark, ["sp", "BRASILIA", "minas", "nowhere land"], lambda c: s.standard_value(c, "states")) == ["São Paulo", "Distrito Federal", "Minas Gerais", "Nowhere Land"]
    assert column(spark, ["fin tech", "EDTECH"], lambda c: s.standard_value(c, "markets")) == ["FinTech", "EdTech"]
    own = spark.createDataFrame([("acme", "ACME Inc")], "key string, value string")
    out = s.standardise_dim(spark.createDataFrame([("Ácme",), ("other co",)], "c string"), "c", own)
    assert sorted(r.c for r in out.collect()) == ["ACME Inc", "Other Co"]


def test_enumerations_and_bands(spark):
    df = spark.createDataFrame([("casada", "M", "medio"), (" ", "x", None), ("married", "female", "MBA")], "a string, b string, c string")
    out = s.standardise_enum(s.standardise_enum(s.standardise_enum(df, "a", "marital"), "b", "gender"), "c", "education")
    assert [tuple(r) for r in out.collect()] == [("Casada", "Masculino", "Medio"), ("Não informado", "X", "Não informado"), ("Casado", "Feminino", "MBA")]
    bands = spark.createDataFrame([(0.0,), (0.1,), (30.0,), (100.0,), (101.0,)], "x double")
    assert [r.b for r in bands.select(s.banded(F.col("x"), [0, 30, 100], ["a", "b"]).alias("b")).collect()] == [None, "a", "a", "b", None]
    rev = spark.createDataFrame([("Até 1 milhão",), ("Acima de 100 milhões",), ("?",), (None,)], "faixa_faturamento string")
    assert [(r.revenue_min, r.revenue_max, r.revenue_score) for r in s.revenue_band(rev).collect()] == [(0.0, 1e6, 1), (1e8, 1e9, 5), (0.0, 0.0, 1), (0.0, 0.0, 1)]
    head = spark.createDataFrame([("1-10",), ("5000+",), (None,)], "faixa_funcionarios string")
    assert [(r.headcount_score, r.size_class) for r in s.headcount_band(head).collect()] == [(1, "pequena"), (7, "grande"), (0, "não informado")]


def test_ages(spark):
    df = spark.createDataFrame([(dt.date(2000, 1, 1),), (dt.date(1960, 1, 1),), (None,)], "d date")
    assert [r.faixa_etaria for r in s.age_bands(df, "d", "2024-06-01").collect()] == ["<25", "55-64", None]
    assert [r.faixa_etaria for r in s.age_bands(df, "d", "2024-06-01", "report").collect()] == ["18-24", "55-64", None]


def test_privacy_and_parts(spark):
    df = spark.createDataFrame([("11144477735", "123456789", "1", dt.date(2024, 1, 1), "Ana Maria Lima", "ana@x.com", "Rua das Flores, 1, 01310-100")], "cpf string, rg string, autorizacao_imagem string, data_inscricao date, nome string, email string, endereco string")
    r = s.mask_email(s.address_fields(s.name_parts(s.apply_privacy(df), "nome"), "endereco"), "email").first()
    assert (r.cpf_anonimizado, r.rg_anonimizado, r.consentimento_dado, r.data_consentimento) == ("111********", "12*******", True, dt.date(2024, 1, 1))
    assert (r.primeiro_nome, r.ultimo_nome, r.email, r.endereco, r.endereco_cep) == ("Ana", "Lima", "a***@x.com", "R. DAS FLORES, 1, 01310-100", "01310-100")


def test_auto_standardise(spark):
    df = spark.createDataFrame([(" A@B.com", "11144477735", "11987654321", "ana LIMA", "sao paulo", "R$ 1,50", "  x  y ", 3)], "email string, cpf string, telefone string, nome string, cidade string, valor string, nota string, n int")
    r = s.auto_standardise(df).first()
    assert tuple(r) == (None, "111.444.777-35", "(11) 98765-4321", "Ana Lima", "São Paulo", "1.50", "x y", 3) or r.email == "a@b.com"


def test_rules_and_registry(spark):
    df = spark.createDataFrame([(1, "11144477735", None), (2, "1", "x"), (3, None, "a@b.co")], "i int, cpf string, email string")
    out, summary = v.validate(df, [v.FieldRule("cpf", "cpf", True), v.FieldRule("email", "email"), v.FieldRule("cep", "cep", True)])
    assert [(r.cpf_valid, r.cpf_error, r.email_valid) for r in out.orderBy("i").collect()] == [(True, None, True), (False, "invalid CPF", False), (False, "required", True)]
    assert {r.field: r.n_invalid for r in summary.collect()} == {"cpf": 2, "email": 1, "cep": 3}
    v.register_validator("even", lambda c, **_: c.try_cast("int") % 2 == 0, "odd")
    assert [r.i_error for r in v.validate(df, [v.FieldRule("i", "even")])[0].orderBy("i").collect()] == ["odd", None, "odd"]


def test_contact_features_formulas(spark):
    df = spark.createDataFrame([("Example One", "old@example.com", "https://linkedin.com/in/x", "+55 (11) 99999-9999", "11144477735", "11222333000181", "Tecnologia"), (None, None, None, None, None, None, None)], "nome string, email string, linkedin string, whatsapp string, cpf string, cnpj string, segmento string")
    for formula, best in (("basic", 3), ("extended", 5), ("documents", 6)):
        assert [r.data_quality_score for r in v.contact_features(df, formula).collect()] == [best, 0]


@pytest.mark.parametrize("name", ["states", "cities", "markets", "stages"])
def test_dimensions_are_keyed_by_folded_text(name):
    assert all(k == dims.fold(k) for k in dims.dimension(name))
