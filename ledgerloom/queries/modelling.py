"""Models and streams over the given tables (M, X, P9). SQL has no counterpart, but for the streams and steps."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import ml
from ..operators.aggregates import percentiles
from ..plans.steps import run_steps
from ..sources.folders import work_folder
from ..streaming import retention, streams
from .base import AS_OF, LEADS_SQL, leads, query, table
from .scores import RULES, SCORE_SQL

NUMBERS = ["c_acctbal", "n_orders", "spent", "days_since"]


def customers(spark, sf_dir):
    """Customers with their orders in numbers; label: whether they spent more than the middle one. The table is written once to
    the shared folder, since models read it many times; the middle is found without a task that holds the column."""
    o = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n_orders"), F.sum("o_totalprice").alias("spent"), F.datediff(F.lit(AS_OF).cast("date"), F.max("o_orderdate")).alias("days_since"))
    table(spark, sf_dir, "customer").join(o, "c_custkey", "left").fillna(0).write.parquet(path := work_folder(spark, "customers"))
    df = spark.read.parquet(path)
    middle = percentiles(df, {"spent": F.col("spent")}, [0.5]).agg(F.max(F.col("q")[0])).first()[0]
    return df.withColumn("label", (F.col("spent") > F.lit(middle)).cast("double"))


@query()
def lead_model(spark, sf_dir):
    df = leads(spark, sf_dir).withColumn("qualidade_lead", F.when(F.col("valor") > 4000, "Alta").otherwise("Baixa"))
    model, facts = ml.train_lead_model(df.select("id", "valor", "segmento", "cargo", "qualidade_lead"), "qualidade_lead", "id")
    return ml.predict(df, model, facts["numbers"], facts["texts"]).select("id", "qualidade_predita", F.round("confianca_predicao", 4).alias("confianca_predicao"))


@query()
def conversion_model(spark, sf_dir):
    df = customers(spark, sf_dir)
    model, _ = ml.train_conversion(df, "label", "c_custkey", ["c_acctbal", "n_orders", "days_since"])
    out = ml.analyse_leads(df, {"conversion": model}, ["c_acctbal", "n_orders", "days_since"])
    return out.select("c_custkey", F.round("conversion_score", 4).alias("conversion_score"), "conversion_band", "persona")


@query()
def ltv_model(spark, sf_dir):
    df = customers(spark, sf_dir)
    model, _ = ml.train_ltv(df, "spent", "c_custkey", ["c_acctbal", "n_orders", "days_since"], trees=100)
    return model.transform(ml.prepared(df, ["c_acctbal", "n_orders", "days_since"], [])).select("c_custkey", F.round("prediction", 2).alias("ltv"))


@query()
def churn_model(spark, sf_dir):
    df = customers(spark, sf_dir).withColumn("churned", (F.col("days_since") > 8700).cast("double"))
    model, facts = ml.train_churn(df, "churned", "c_custkey", ["c_acctbal", "n_orders", "spent"])
    out = ml.analyse_leads(df, {"churn": model}, ["c_acctbal", "n_orders", "spent"])
    return out.select("c_custkey", F.round("churn_score", 4).alias("churn_score"), "churn_band")


@query()
def segments(spark, sf_dir):
    return ml.segment(customers(spark, sf_dir).select("c_custkey", *NUMBERS), NUMBERS, 5)[1].select("segment", "n", "name")


@query()
def model_comparison(spark, sf_dir):
    df = customers(spark, sf_dir)
    name, model, _ = ml.compare_models(df, "label", "c_custkey", ["c_acctbal", "n_orders", "days_since"])
    return model.transform(ml.prepared(df, ["c_acctbal", "n_orders", "days_since"], [])).select("c_custkey", F.lit(name).alias("model"), "prediction")


@query()
def tuned_model(spark, sf_dir):
    df = customers(spark, sf_dir)
    model, _ = ml.tune(df, "label", ["c_acctbal", "n_orders", "days_since"])
    return model.transform(ml.prepared(df, ["c_acctbal", "n_orders", "days_since"], [])).select("c_custkey", "prediction")


@query()
def selected_features(spark, sf_dir):
    df = customers(spark, sf_dir)
    model, names, _ = ml.select_features(df, "label", "c_custkey", NUMBERS, 2)
    return model.transform(ml.prepared(df, NUMBERS, [])).select("c_custkey", F.lit(",".join(names)).alias("features"), "prediction")


@query()
def modelled_imputation(spark, sf_dir):
    df = customers(spark, sf_dir).select("c_custkey", "n_orders", "spent", F.when(F.col("c_custkey") % 10 != 0, F.col("c_acctbal")).alias("c_acctbal"))
    return ml.impute_model(df, "c_acctbal", ["n_orders", "spent"]).select("c_custkey", F.round("c_acctbal", 2).alias("c_acctbal"))


def drained(stream, name: str):
    """The rows that a stream over what is there gives, written to the folder that the cluster shares and read back."""
    path = work_folder(stream.sparkSession, name)
    stream.writeStream.format("parquet").option("checkpointLocation", f"{path}/checkpoint").outputMode("append").trigger(availableNow=True).start(f"{path}/out").awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{path}/out")


@query("select event_id, user_id, event_type from events")
def event_stream(spark, sf_dir):
    stream = streams.event_stream(spark, f"{sf_dir}/events.parquet*", events_schema(spark, sf_dir))
    return drained(stream.select("event_id", "user_id", "event_type"), "events")


#: Text that both engines read: the batch that an event comes in first (one of three, by day; a third of them one later).
BATCH = "least(2, (day(ts) - 1) // 10) + case when event_id % 3 = 0 then 1 else 0 end"


@query(f"""
    with own as (select event_id, cast(ts as timestamp) as ts, {BATCH} as batch from events where event_id is not null and ts is not null),
    came as (select *, event_id % 16 as slot from (select * from own union all select event_id, ts, batch + 1 from own where event_id % 7 = 0)),
    newest as (select slot, batch, max(max(ts)) over (partition by slot order by batch rows between unbounded preceding and 1 preceding) as before from came group by 1, 2),
    judged as (select c.*, coalesce(c.ts < n.before - interval 3 day, false) as late from came c join newest n on c.slot = n.slot and c.batch = n.batch),
    kept as (select event_id, slot, min(ts) as ts from judged where not late group by 1, 2),
    last as (select slot, max(ts) as ts from came group by 1)
    select kind, event_id from (select 'late' as kind, event_id from judged where late union all select 'kept', event_id from kept union all select 'expired', k.event_id from kept k join last l on k.slot = l.slot where k.ts < l.ts - interval 3 day)
""")
def retained_events(spark, sf_dir):
    """Events come in five batches, each a restart of the stream: a third one batch late, a seventh twice."""
    folder = work_folder(spark, "retained")
    e = table(spark, sf_dir, "events").filter("event_id is not null and ts is not null").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    own = e.withColumn("batch", F.expr(BATCH.replace("//", "div")))
    came = own.unionByName(own.filter("event_id % 7 = 0").withColumn("batch", F.col("batch") + 1))
    came.write.partitionBy("batch").parquet(f"{folder}/all")
    whole = spark.read.parquet(f"{folder}/all")
    with retention.rocksdb(spark):
        for batch in range(5):
            whole.filter(F.col("batch") == batch).drop("batch").write.mode("append").parquet(f"{folder}/in")
            stream = retention.retained(spark.readStream.schema(e.schema).parquet(f"{folder}/in"), "event_id", "ts", F.pmod("event_id", F.lit(16)), "3 days")
            stream.writeStream.format("parquet").option("checkpointLocation", f"{folder}/checkpoint").outputMode("append").trigger(availableNow=True).start(f"{folder}/out").awaitTermination()
    return spark.read.schema(retention.OUT).parquet(f"{folder}/out").select("kind", "event_id")


def events_schema(spark, sf_dir):
    return table(spark, sf_dir, "events").schema


@query(f"with s as (select id, cast({SCORE_SQL} as double) as score from {LEADS_SQL}) select id, score from s where score >= 70")
def score_stream(spark, sf_dir):
    """Leads are written to files and scored as a stream over them."""
    rows = leads(spark, sf_dir)
    rows.write.parquet(path := work_folder(spark, "leads"))
    stream = streams.score_stream(spark.readStream.schema(rows.schema).parquet(path), RULES, AS_OF, 70)
    return drained(stream.select("id", "score"), "scores")


@query("""
    with w as (select event_type as pipeline, time_bucket(interval '1 day', ts) as start, count(*) as n, avg(value) as mean_value from events group by 1, 2), b as (select pipeline, avg(mean_value) as mean, stddev_pop(mean_value) as std from w group by 1)
    select w.pipeline, start, n, round(mean_value, 6) as mean_value, case when abs(mean_value - mean) > 3 * std then 'critical' when abs(mean_value - mean) > 2.5 * std then 'high' else 'medium' end as severity from w join b on w.pipeline = b.pipeline where abs(mean_value - mean) > 2 * std and start < (select max(ts) from events) - interval '1 day'
""")
def monitor_stream(spark, sf_dir):
    """Windows of the stream of events against a baseline of the table. A window comes out when the watermark, which is at
    the newest event, has passed its end: those that the newest event is not in."""
    e = table(spark, sf_dir, "events")
    means = streams.windowed_metrics(e, "value", "event_type", "ts", "1 day")
    baseline = means.groupBy("pipeline").agg(F.avg("mean_value").alias("mean"), F.stddev_pop("mean_value").alias("std"))
    source = spark.readStream.schema(e.schema).parquet(f"{sf_dir}/events.parquet*").withColumn("ts", F.col("ts").cast("timestamp"))
    out = drained(streams.monitor_stream(source, baseline, "value", "event_type", "ts", "1 day", "0 seconds"), "alarms")
    return out.withColumn("mean_value", F.round("mean_value", 6))


@query("select event_id, user_id from (select event_id, user_id, row_number() over (partition by user_id order by ts desc, event_id) as n from events where user_id is not null) where n = 1")
def latest_stream(spark, sf_dir):
    folder = work_folder(spark, "latest")
    schema = events_schema(spark, sf_dir)
    stream = spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parquet*")
    streams.latest_stream(stream, "user_id", "ts", ["event_id"], f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    return streams.latest_table(spark, f"{folder}/out").select("event_id", "user_id")


STEPS_SPEC = [
    {"name": "check", "type": "validation", "config": {"validations": [{"field": "email", "validator": "email", "required": True}]}},
    {"name": "off", "type": "limit", "enabled": False, "config": {"n": 1}},
    {"name": "text", "type": "text_normalization", "config": {"fields": [{"field": "nome", "operations": ["squeeze", "upper"]}]}},
    {"name": "format", "type": "format_standardization", "config": {"fields": [{"field": "cep", "format": "cep"}]}},
    {"name": "features", "type": "feature_engineering", "config": {"features": [{"type": "conditional", "name": "porte", "condition": "valor > 1000", "then": "grande", "else": "pequena"}, {"type": "expression", "name": "dobro", "expression": "valor * 2"}]}},
    {"name": "kept", "type": "filter", "config": {"condition": "email_valid"}},
    {"name": "out", "type": "select", "config": {"columns": ["id", "nome", "cep", "porte", "dobro"]}},
]


@query(f"""
    select id, upper(trim(regexp_replace(nome, '\\s+', ' ', 'g'))) as nome, case when length(cep) = 8 then concat(substr(cep, 1, 5), '-', substr(cep, 6)) end as cep, case when valor > 1000 then 'grande' else 'pequena' end as porte, valor * 2 as dobro
    from {LEADS_SQL} where regexp_matches(lower(email), '^[a-z0-9._%+-]+@[a-z0-9.-]+\\.[a-z]{{2,}}$')
""")
def declared_steps(spark, sf_dir):
    return run_steps(leads(spark, sf_dir), STEPS_SPEC)
