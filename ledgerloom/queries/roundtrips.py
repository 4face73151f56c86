"""Sources and sinks: tables written to the shared folder in one form and read back (S, K, Z)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import validate as v
from ..operators import aggregates, restructure, schema
from ..plans import steps
from ..sources import readers, sinks
from ..sources.folders import work_folder as folder
from .base import LEADS_SQL, leads, query, table


@query("select cast(c_custkey as varchar) as c_custkey, c_name, cast(c_nationkey as varchar) as c_nationkey, c_mktsegment from customer")
def csv_round_trip(spark, sf_dir):
    sinks.write_csv(table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment"), path := folder(spark, "csv"))
    return readers.read_delimited(spark, path)


@query("select cast(s_suppkey as varchar) as s_suppkey, s_name, 'a;b c' as note from supplier")
def quoted_csv_round_trip(spark, sf_dir):
    df = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", F.lit("a;b\nc").alias("note"))
    sinks.write_csv(df, path := folder(spark, "quoted"), quote_all=True)
    return readers.read_delimited(spark, path, types={"s_suppkey": "string"})


#: Text that both engines make: quotes, separators and line breaks around and inside of a document.
QUOTED = "concat('\"', replace(text, ' the ', ' \"the\";'), '\";', chr(10), lang, chr(13), chr(10), '\"\"', cast(doc_id as string))"


@query(f"select cast(doc_id as varchar) as doc_id, md5({QUOTED}) as text_md5, length({QUOTED}) as n_chars, lang from documents")
def csv_quoted_records(spark, sf_dir):
    """Records of several lines, written and read back."""
    docs = table(spark, sf_dir, "documents").selectExpr("doc_id", f"{QUOTED} as text", "lang")
    sinks.write_csv(docs, path := folder(spark, "quoted"), sep=",", quote_all=True, keep_breaks=True)
    return readers.read_delimited(spark, path).select("doc_id", F.md5("text").alias("text_md5"), F.length("text").cast("long").alias("n_chars"), "lang")


@query("select count(*) filter (where doc_id % 5 <> 0) as good, count(*) filter (where doc_id % 5 = 0) as bad from documents")
def tolerant_quoted_records(spark, sf_dir):
    """Of records of several lines those that fit, and those that don't."""
    docs = table(spark, sf_dir, "documents").selectExpr("case when doc_id % 5 = 0 then concat('no ', doc_id) else cast(doc_id as string) end as doc_id", f"{QUOTED} as text")
    sinks.write_csv(docs, path := folder(spark, "tolerant"), sep=",", keep_breaks=True)
    good, bad = readers.read_tolerant(spark, path, readers.identifier_schema(["doc_id", "text"], {"doc_id": "long"}))
    return good.agg(F.count("*").alias("good")).crossJoin(F.broadcast(bad.agg(F.count("*").alias("bad"))))  # one row each


@query("select cast(id as varchar) as id, nome from (select c_custkey as id, c_name as nome, null as valor from customer union all select s_suppkey, null, s_acctbal from supplier)")
def many_files(spark, sf_dir):
    sinks.write_csv(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("nome")), a := folder(spark, "a"), sep=",")
    sinks.write_csv(table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("valor")), b := folder(spark, "b"), sep="|")
    return readers.read_many(spark, [a, b]).select("id", "nome")


@query("select count(*) as rows, count(*) filter (where o_orderkey % 10 = 0) as missing from orders")
def file_statistics(spark, sf_dir):
    df = table(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 10 != 0, F.col("o_orderstatus")).alias("status"))
    sinks.write_parquet(df, path := folder(spark, "stats"))
    read = readers.read_parquet(spark, path).withColumn("file_name", F.col("_metadata.file_name"))
    return readers.file_stats(read).agg(F.sum("rows").alias("rows"), F.sum("missing").alias("missing"))


@query("select count(*) filter (where o_orderkey % 7 <> 0) as good, count(*) filter (where o_orderkey % 7 = 0) as bad from orders")
def tolerant_read(spark, sf_dir):
    lines = table(spark, sf_dir, "orders").select(F.concat_ws(",", F.col("o_orderkey").cast("string"), F.when(F.col("o_orderkey") % 7 == 0, "not a number").otherwise(F.col("o_custkey").cast("string"))).alias("value"))
    path = folder(spark, "lines")
    lines.write.text(path)
    kind = readers.identifier_schema(["o_orderkey", "o_custkey"], {"o_orderkey": "long", "o_custkey": "long"})
    good, bad = readers.read_tolerant(spark, path, kind, header=False)
    return good.agg(F.count("*").alias("good")).crossJoin(F.broadcast(bad.agg(F.count("*").alias("bad"))))  # one row each


@query("select user_id, event_type, round(value, 2) as value from events")
def json_round_trip(spark, sf_dir):
    sinks.write_json(table(spark, sf_dir, "events").select("user_id", "event_type", F.round("value", 2).alias("value")), path := folder(spark, "json"))
    return readers.read_json(spark, path, "user_id long, event_type string, value double")


@query("select (select count(*) from customer) as data_rows, 5::bigint as profile_rows, 3::bigint as statistics_rows")
def bundle(spark, sf_dir):
    sinks.export_bundle(table(spark, sf_dir, "customer"), path := folder(spark, "bundle"), "customer", "2024-06-01")
    counts = [spark.read.parquet(f"{path}/{part}").agg(F.count("*").alias(f"{part}_rows")) for part in ("data", "profile", "statistics")]
    return counts[0].crossJoin(F.broadcast(counts[1])).crossJoin(F.broadcast(counts[2]))  # one row each


@query("select c_custkey, case when c_custkey % 2 = 0 then c_name else null end as nome, case when c_custkey % 3 = 0 then c_mktsegment end as seg from customer where c_custkey % 5 <> 0 or c_custkey % 2 = 0 or c_custkey % 3 = 0")
def single_column(spark, sf_dir):
    k = F.col("c_custkey")
    parts = [k.cast("string"), F.when(k % 2 == 0, F.col("c_name")).otherwise(F.lit(" ")), F.when(k % 3 == 0, F.col("c_mktsegment")).otherwise(F.lit(""))]
    lines = table(spark, sf_dir, "customer").select(F.when((k % 5 == 0) & (k % 2 != 0) & (k % 3 != 0), k.cast("string")).otherwise(F.concat_ws(",", *parts)).alias("line"))
    out = restructure.explode_single_column(lines, "line", ["c_custkey", "nome", "seg"])
    return out.withColumn("c_custkey", F.col("c_custkey").cast("long"))


@query("select o_orderkey, l_linenumber, l_quantity from orders left join lineitem on o_orderkey = l_orderkey")
def exploded_records(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct("l_linenumber", "l_quantity")).alias("lines"))
    o = table(spark, sf_dir, "orders").select("o_orderkey")
    docs = o.join(lines, o.o_orderkey == lines.l_orderkey, "left").select("o_orderkey", "lines")
    return restructure.explode_records(docs, "lines", ["o_orderkey"])


@query("select doc_id, md5(trim(text)) as text_md5 from documents")
def template_tokens(spark, sf_dir):
    df = table(spark, sf_dir, "documents").select("doc_id", F.concat(F.col("text"), F.lit("{{field:abc-1}}")).alias("text"))
    return readers.strip_templates(df).select("doc_id", F.md5("text").alias("text_md5"))


@query("select count(*) as n, (select count(*) from orders) > 0 as some from orders")
def sampled_profile(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    part = readers.profile_sample(o, n=1000, above=1 << 60)
    return part.agg(F.count("*").alias("n"), (F.count("*") > 0).alias("some"))


@query("select l_orderkey, l_linenumber, cast(l_quantity as float) as l_quantity from lineitem")
def downcast(spark, sf_dir):
    return schema.downcast(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity"))


@query(f"select id, cast(id % 2 = 0 as boolean) as id_valid, case when id % 2 = 0 then null else 'odd' end as id_error from {LEADS_SQL}")
def own_validator(spark, sf_dir):
    v.register_validator("even", lambda c, **_: c % 2 == 0, "odd")
    return v.validate(leads(spark, sf_dir).select("id"), [v.FieldRule("id", "even")])[0]


@query("select o_orderstatus, count(*) as n from orders where o_totalprice > 100000 group by 1")
def saved_steps(spark, sf_dir):
    spec = [{"type": "filter", "config": {"condition": "o_totalprice > 100000"}}, {"type": "aggregate", "config": {"by": ["o_orderstatus"], "measures": {"n": "count(*)"}}}]
    steps.save_steps(spark, path := folder(spark, "steps"), "orders", spec)
    return steps.run_steps(table(spark, sf_dir, "orders"), steps.load_steps(spark, path, "orders"))


@query("select r_regionkey, r_name from region")
def registered_source(spark, sf_dir):
    table(spark, sf_dir, "region").write.orc(path := folder(spark, "orc"))
    return readers.read_any(spark, path, "orc")


@query("select o_orderkey, o_orderdate from orders where o_orderdate = timestamp '1998-01-01'")
def load_gate(spark, sf_dir):
    day = table(spark, sf_dir, "orders").filter("o_orderdate = timestamp '1998-01-01'").select("o_orderkey", "o_orderdate")
    return aggregates.assert_load(day, "o_orderkey", "o_orderdate", "1998-01-01")
