"""Encodings of whole files, streams that don't pass through the driver, documents of bounded size."""

import datetime
import shutil

from pyspark.sql import functions as F

from ledgerloom.queries import documents, modelling
from ledgerloom.sources import readers


def test_accents_after_thousands_of_lines(spark, tmp_path):
    lines = ["id;nome", *(f"{i};Ana" for i in range(5000)), "5000;José Ção"]
    for encoding in ("utf-8", "iso-8859-1", "cp1252"):
        path = tmp_path / f"{encoding}.csv"
        path.write_bytes("\n".join(lines).encode(encoding))
        assert readers.read_delimited(spark, str(path)).filter("id = '5000'").first().nome == "José Ção"


def test_streamed_events_are_files(spark):
    sf = "/root/testdata/sf0.001"
    got = modelling.event_stream(spark, sf)
    assert got.inputFiles() and got.columns == ["event_id", "user_id", "event_type"]
    want = spark.read.parquet(f"{sf}/events.parquet").select(*got.columns)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_a_large_customer_has_several_documents(spark, tmp_path):
    n = 5000
    orders = spark.range(n).select(
        F.col("id").alias("o_orderkey"), F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id")).alias("o_custkey"),
        F.lit(datetime.date(1995, 3, 4)).alias("o_orderdate"), F.lit(2.5).alias("o_totalprice"), F.lit("F").alias("o_orderstatus"),
    )
    name = F.col("o_orderkey").cast("string")
    docs = documents.payment_documents(orders, F.array(F.struct(name, name)), 100).withColumn("size", F.size(F.json_object_keys("doc")))
    assert docs.agg(F.sum("size"), F.max("size") < 200).first() == (n, True) and docs.filter("o_custkey = 1").count() == 26  # 2501 orders
    orders.write.parquet(str(tmp_path / "orders.parquet"))
    assert documents.payments(spark, str(tmp_path)).agg(F.count_distinct("payment_id")).first()[0] == n
    shutil.rmtree(tmp_path)
