"""Deduplication, joins, upserts and set operations (W, J, K, S, U)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import dedup, joins, schema
from ..sources.folders import work_folder as folder
from ..sources.versions import read_version
from .base import AS_OF, LEADS_SQL, leads, query, table


@query("""
    select event_id, ts, user_id, event_type, value from
    (select *, row_number() over (partition by user_id order by ts desc, event_id) as n from events where user_id is not null) where n = 1
""")
def dedup_latest(spark, sf_dir):
    df = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return dedup.dedup_latest(df, "user_id", "ts", ["event_id"])


@query(f"""
    select id, cpf, email, data_cadastro from (select *, row_number() over (partition by email order by cast(telefone is not null as int) + cast(cargo is not null as int) + cast(cep is not null as int) desc, data_cadastro desc, id) as n
    from {LEADS_SQL} where email is not null) where n = 1 union all select id, cpf, email, data_cadastro from {LEADS_SQL} where email is null
""")
def dedup_complete(spark, sf_dir):
    df = leads(spark, sf_dir).select("id", "cpf", "email", "telefone", "cargo", "cep", "data_cadastro")
    return dedup.dedup_complete(df, "email", "data_cadastro", ["id"]).select("id", "cpf", "email", "data_cadastro")


@query("""
    select o_orderkey, o_custkey, o_totalprice, o_orderdate from
    (select *, row_number() over (partition by o_custkey order by 1e6 + cast(strftime(o_orderdate, '%Y%m%d') as double) * 10 + o_totalprice / 1e6 desc, o_orderkey) as n from orders) where n = 1
""")
def dedup_best(spark, sf_dir):
    df = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    return dedup.dedup_best(df, "o_custkey", "o_orderdate", "o_totalprice", ["o_orderkey"])


@query("""
    with s as (select s_suppkey, s_name, s_nationkey, s_acctbal, concat('name:', regexp_replace(lower(split_part(s_name, '#', 1)), '[^a-z0-9]', '', 'g'), '|', cast(s_nationkey as varchar)) as fingerprint, 4 + least(s_acctbal / 1e6, 100) as entity_score from supplier)
    select s_suppkey as id, fingerprint, round(entity_score, 6) as entity_score from (select *, row_number() over (partition by fingerprint order by entity_score desc, s_suppkey) as n from s) where n = 1
""")
def resolve_entities(spark, sf_dir):
    df = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.substring_index("s_name", "#", 1).alias("nome"), F.col("s_nationkey").cast("string").alias("empresa"), F.col("s_acctbal").alias("valor"))
    return dedup.resolve_entities(df, "contact", AS_OF, value="valor", tie=["id"]).select("id", "fingerprint", F.round("entity_score", 6).alias("entity_score"))


@query("""
    select l_orderkey, l_suppkey, l_linenumber, l_partkey from (select *, row_number() over (partition by l_orderkey, l_suppkey order by l_linenumber, l_partkey, l_quantity, l_extendedprice) as n from lineitem) where n = 1
""")
def dedup_group_best(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")
    return dedup.dedup_group_best(df, ["l_orderkey", "l_suppkey"], tie=["l_linenumber", "l_partkey", "l_quantity", "l_extendedprice"]).select("l_orderkey", "l_suppkey", "l_linenumber", "l_partkey")


@query("select o_custkey, o_orderstatus, max(o_orderkey) as o_orderkey from orders group by all")
def dedup_last(spark, sf_dir):
    return dedup.dedup_last(table(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus", "o_orderkey"), ["o_custkey", "o_orderstatus"], ["o_orderkey"])


@query("""
    select min(doc_id) as doc_id, md5(trim(lower(text))) as dedup_key from (select doc_id, coalesce(text, '') as text from documents) group by md5(trim(lower(text)))
""")
def dedup_hash(spark, sf_dir):
    return dedup.dedup_hash(table(spark, sf_dir, "documents").select("doc_id", "text"), ["text"], ["doc_id"], fold=False).select("doc_id", "dedup_key")


@query("select p_brand, p_type, count(*) as n from (select distinct p_brand, p_type, p_size from part) group by all")
def dedup_ignore_dates(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_brand", "p_type", "p_size", F.date_add(F.lit("2020-01-01").cast("date"), F.col("p_partkey").cast("int") % 1000).alias("seen_date"))
    return dedup.dedup_ignore_dates(p, "seen_date").groupBy("p_brand", "p_type").agg(F.count("*").alias("n"))


@query("select l_orderkey, min(l_linenumber) as l_linenumber from lineitem group by l_orderkey")
def dedup_exact_then_id(spark, sf_dir):
    return dedup.dedup_exact_then_id(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber"), "l_orderkey", ["l_linenumber"])


@query("""
    select user_id, event_id, file_name from (select user_id, event_id, strftime(ts, 'snap_%Y%m%d.json') as file_name, row_number() over (partition by user_id order by strftime(ts, 'snap_%Y%m%d.json'), event_id) as n from events where user_id is not null) where n = 1
""")
def merge_snapshots(spark, sf_dir):
    df = table(spark, sf_dir, "events").select("user_id", "event_id", F.concat(F.lit("snap_"), F.date_format("ts", "yyyyMMdd"), F.lit(".json")).alias("file_name"))
    return dedup.merge_snapshots(df, "user_id", "file_name", "event_id")


@query("""
    with e as (select event_type, event_id, strftime(ts, 'snap_%Y%m%d.json') as file_name from events)
    select e.event_type, e.event_id, e.file_name from e join (select event_type, max(file_name) as f from e group by 1) m on e.event_type = m.event_type and e.file_name = m.f
""")
def latest_snapshot(spark, sf_dir):
    df = table(spark, sf_dir, "events").select("event_type", "event_id", F.concat(F.lit("snap_"), F.date_format("ts", "yyyyMMdd"), F.lit(".json")).alias("file_name"))
    return dedup.latest_snapshot(df, "event_type")


@query(f"""
    with c as (select lower(email) as email, nome, 0 as f from {LEADS_SQL} union all select lower(concat('user', cast(s_suppkey * 3 as varchar), '@gmail.com')), s_name, 1 from supplier)
    select email, nome from (select *, row_number() over (partition by email order by f, nome) as n from c where email is not null) where n = 1 union all select email, nome from c where email is null
""")
def union_contacts(spark, sf_dir):
    ours = leads(spark, sf_dir).select("email", "nome")
    other = table(spark, sf_dir, "supplier").select(F.concat(F.lit("user"), (F.col("s_suppkey") * 3).cast("string"), F.lit("@gmail.com")).alias("mail"), F.col("s_name").alias("contact"))
    return dedup.union_contacts(ours, other, {"mail": "email", "contact": "nome"}).select("email", "nome")


@query("""
    with a as (select o_custkey as k from orders where o_orderdate < timestamp '1998-01-01' group by 1), b as (select o_custkey as k from orders where o_orderstatus = 'F' group by 1)
    select (select count(*) from a where k in (select k from b)) as matched, (select count(*) from a where k not in (select k from b)) as missing, (select count(*) from b where k not in (select k from a)) as extra
""")
def reconcile(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return joins.reconcile(o.filter("o_orderdate < timestamp '1998-01-01'"), o.filter("o_orderstatus = 'F'"), "o_custkey")[0]


@query("""
    with o as (select o_custkey, count(*) as n_contacts from orders where o_orderstatus = 'O' group by 1), v as (select o_custkey, count(*) as n_valuations, arg_max(o_totalprice, o_orderkey) as latest_valuation, max(o_orderkey) as latest_date from orders where o_orderstatus = 'F' group by 1),
    e as (select user_id, count(*) as n_payments, sum(cast(value as decimal(18, 2))) as total_paid from events where event_type = 'purchase' group by 1)
    select c_custkey as company_id, coalesce(n_contacts, 0) as n_contacts, coalesce(n_valuations, 0) as n_valuations, latest_valuation, latest_date, coalesce(n_payments, 0) as n_payments, cast(coalesce(total_paid, 0) as double) as total_paid
    from customer left join o on c_custkey = o.o_custkey left join v on c_custkey = v.o_custkey left join e on c_custkey = e.user_id
""")
def company_summary(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("company_id"), F.col("o_totalprice").alias("valuation"), F.col("o_orderkey").alias("date"), "o_orderstatus")
    e = table(spark, sf_dir, "events").filter("event_type = 'purchase'").select(F.col("user_id").alias("company_id"), F.col("value").cast("decimal(18,2)").alias("amount"))
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("company_id"))
    out = joins.company_summary(c, o.filter("o_orderstatus = 'O'"), o.filter("o_orderstatus = 'F'"), e)
    return out.withColumn("total_paid", F.col("total_paid").cast("double"))


@query("""
    select l_orderkey, l_linenumber, s_name as company_name, l_suppkey as company_id from lineitem join supplier on l_suppkey = s_suppkey
""")
def attach_company(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.concat(F.lit("Supplier#"), F.lpad(F.col("l_suppkey").cast("string"), 9, "0")).alias("company_name"))
    return joins.attach_company(lines, s.select(F.col("s_name").alias("company_name"), F.col("s_suppkey").alias("company_id")), "inner").select("l_orderkey", "l_linenumber", "company_name", "company_id")


@query(f"select id, case when id % 2 = 0 then 'ME' else 'N/A' end as porte_empresa from {LEADS_SQL}")
def enrich_registry(spark, sf_dir):
    df = leads(spark, sf_dir)
    registry = df.filter("id % 2 = 0").select("cnpj", F.lit("ME").alias("porte"))
    return joins.enrich_registry(df, registry).select("id", "porte_empresa")


@query("""
    select coalesce(t.c_custkey, s.c_custkey) as c_custkey, case when s.c_custkey is not null then s.c_name else t.c_name end as c_name, case when t.c_custkey is null then s.c_acctbal else t.c_acctbal end as c_acctbal
    from (select c_custkey, c_name, c_acctbal from customer where c_custkey % 3 <> 0) t full join (select c_custkey, upper(c_name) as c_name, c_acctbal + 1 as c_acctbal from customer where c_custkey % 2 = 0) s on t.c_custkey = s.c_custkey
""")
def upsert(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    new = c.filter("c_custkey % 2 = 0").select("c_custkey", F.upper("c_name").alias("c_name"), (F.col("c_acctbal") + 1).alias("c_acctbal"))
    return joins.upsert(c.filter("c_custkey % 3 <> 0"), new, "c_custkey", ["c_name"])


@query("""
    select coalesce(t.c_custkey, s.c_custkey) as c_custkey, coalesce(s.c_name, t.c_name) as c_name, coalesce(s.c_acctbal, t.c_acctbal) as c_acctbal
    from (select c_custkey, c_name, c_acctbal from customer where c_custkey % 3 <> 0) t full join (select c_custkey, case when c_custkey % 4 = 0 then null else upper(c_name) end as c_name, case when c_custkey % 5 = 0 then null else -c_acctbal end as c_acctbal from customer where c_custkey % 2 = 0) s on t.c_custkey = s.c_custkey
""")
def upsert_coalesce(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    new = c.filter("c_custkey % 2 = 0").select("c_custkey", F.when(F.col("c_custkey") % 4 != 0, F.upper("c_name")).alias("c_name"), F.when(F.col("c_custkey") % 5 != 0, -F.col("c_acctbal")).alias("c_acctbal"))
    return joins.upsert_coalesce(c.filter("c_custkey % 3 <> 0"), new, "c_custkey")


@query("""
    select coalesce(t.o_orderkey, s.o_orderkey) as o_orderkey, coalesce(s.o_orderstatus, t.o_orderstatus) as o_orderstatus, case when t.o_orderkey is null then s.o_totalprice else t.o_totalprice end as o_totalprice
    from (select o_orderkey, o_orderstatus, o_totalprice from orders where o_orderkey % 3 <> 0) t full join (select o_orderkey, lower(o_orderstatus) as o_orderstatus, -o_totalprice as o_totalprice from orders where o_orderkey % 5 = 0) s using (o_orderkey)
""")
def upserted_versions(spark, sf_dir):
    """K7 on a table in versions: two thirds of the orders, then a fifth of them again."""
    o, path = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice"), folder(spark, "upserted")
    joins.upsert_table(o.filter("o_orderkey % 3 <> 0"), path, "o_orderkey", part_rows=20_000)
    again = o.filter("o_orderkey % 5 = 0").select("o_orderkey", F.lower("o_orderstatus").alias("o_orderstatus"), (-F.col("o_totalprice")).alias("o_totalprice"))
    joins.upsert_table(again, path, "o_orderkey", ["o_orderstatus"], part_rows=20_000)
    return read_version(spark, path)


@query("""
    select c_custkey, case when c_custkey % 4 = 0 and c_custkey % 3 = 0 then null when c_custkey % 4 = 0 then c_name else upper(c_name) end as c_name, case when c_custkey % 3 = 0 then -c_acctbal when c_custkey % 5 = 0 then c_acctbal else -c_acctbal end as c_acctbal
    from customer
""")
def coalesced_versions(spark, sf_dir):
    """K8 on a table in versions: each customer comes twice but for a third that comes once; the batch that is sent again changes nothing."""
    c, path = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal"), folder(spark, "coalesced")
    joins.upsert_table_coalesce(c.filter("c_custkey % 3 <> 0"), path, "c_custkey", source="first", part_rows=500)
    fields = [F.when(F.col("c_custkey") % 4 != 0, F.upper("c_name")).alias("c_name"), F.when((F.col("c_custkey") % 5 != 0) | (F.col("c_custkey") % 3 == 0), -F.col("c_acctbal")).alias("c_acctbal")]
    joins.upsert_table_coalesce(c.select("c_custkey", *fields), path, "c_custkey", source="second", part_rows=500)
    joins.upsert_table_coalesce(c.select("c_custkey", F.lit("again").alias("c_name"), F.lit(0.0).alias("c_acctbal")), path, "c_custkey", source="second", part_rows=500)
    return read_version(spark, path)


@query("select distinct o_custkey, o_orderstatus from orders")
def insert_absent(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus", "o_orderkey")
    target = o.filter("o_orderkey % 2 = 0").select("o_custkey", "o_orderstatus").distinct()
    return joins.insert_absent(target, o.filter("o_orderkey % 2 = 1").select("o_custkey", "o_orderstatus"), ["o_custkey", "o_orderstatus"])


@query("select distinct l_partkey, l_suppkey from lineitem")
def link_tables(spark, sf_dir):
    pairs = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_linenumber")
    target = pairs.filter("l_linenumber = 1").select("l_partkey", "l_suppkey").distinct()
    return joins.link(target, pairs)


@query("select c_custkey, 'main' as origin, c_name from customer where c_custkey % 2 = 0 union all select c_custkey, 'fallback', c_name from customer where c_custkey % 2 = 1")
def prefer_source(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return joins.prefer_source(c.filter("c_custkey % 2 = 0").withColumn("origin", F.lit("main")), c.withColumn("origin", F.lit("fallback")), ["c_custkey"]).select("c_custkey", "origin", "c_name")


@query("select n_name as name, r_name as region, coalesce(n, 0) as n from nation join region on n_regionkey = r_regionkey left join (select c_nationkey, count(*) as n from customer where c_acctbal > 9000 group by 1) on c_nationkey = n_nationkey")
def complete_dim(spark, sf_dir):
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    dim = n.join(r, n.n_regionkey == r.r_regionkey).select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("name"), F.col("r_name").alias("region"))
    counts = table(spark, sf_dir, "customer").filter("c_acctbal > 9000").groupBy(F.col("c_nationkey").alias("k")).agg(F.count("*").alias("n"))
    return joins.complete_dim(counts, dim, "k").drop("k")


@query("select 'customer' as \"table\", count(*) as rows from customer union all select 'orders', count(*) from orders union all select 'lineitem', count(*) from lineitem")
def row_counts(spark, sf_dir):
    return joins.row_counts({t: table(spark, sf_dir, t) for t in ("customer", "orders", "lineitem")})


@query("select c_custkey as k, c_name as name, null as s_only, c_mktsegment as c_only from customer union all select s_suppkey, s_name, s_acctbal, null from supplier")
def union_tables(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("c_only"))
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("s_only"))
    return schema.union_tables([c, s]).select("k", "name", "s_only", "c_only")


@query("select distinct p_brand as brand, p_type as kind from part where p_type is not null")
def project_tables(spark, sf_dir):
    return schema.project_tables({"part": table(spark, sf_dir, "part")}, {"brands": ("part", {"p_brand": "brand", "p_type": "kind"}, "kind")})["brands"]


@query("""
    with k as (select distinct event_type as file, 'k' as "column" from events union select distinct event_type, concat('Col ', upper(substr(event_type, 1, 1))) from events where event_type in ('error', 'view', 'click')
               union select distinct 'error', 'col_e' from events)
    select "column", count(distinct file) as files, count(distinct file) = (select count(distinct file) from k) as in_all, case when "column" in ('Col E', 'col_e') then 2::bigint else 1::bigint end as n_variants from k group by "column"
""")
def column_presence(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_type", F.explode(F.json_object_keys("props")).alias("column")).select(F.col("event_type").alias("file"), "column")
    more = e.filter("file in ('error', 'view', 'click')").select("file", F.concat(F.lit("Col "), F.upper(F.substring("file", 1, 1))).alias("column"))
    return schema.column_presence(e.unionByName(more).unionByName(e.filter("file = 'error'").select("file", F.lit("col_e").alias("column"))).distinct())
