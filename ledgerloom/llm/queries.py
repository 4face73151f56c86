"""One query for each operator, over its whole table, and their SQL where it can be said in SQL."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import chat, mixing, periodic_runs, quality, resampling, sentencepieces, sharding, simhash, suffixes, token_counts, token_store, topk, url_filters
from .shared import new_folder

PIECES, BYTES, WORDS = "piece_bpe_32k.model", "byte_bpe_50k.json", "word_bpe_49k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.shard(table(spark, sf_dir, "documents"), 40)
    text = F.coalesce("text", F.lit(""))
    return rows.select(
        "doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), F.lit("key").alias("law"),
        F.col("shard").cast("int").alias("shard"), F.col("slot").cast("long").alias("slot"), sharding.shard_of(F.col("doc_id"), 41).cast("int").alias("grown_shard"),
    )


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), k=5, every=50)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.quality(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pieces_digest(sentencepieces.encode_pieces(docs, public_tokenizers.path(PIECES)))


def normalised_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 4 with a character map in the model (nmt_nfkc), which the given model lacks."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pieces_digest(sentencepieces.encode_pieces(docs, public_tokenizers.path(PIECES), rule="nmt_nfkc"))


def pieces_digest(encoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, the hashes of ids and decoded text, and the hash of the spans (two unsigned 32-bit integers an id)."""
    hashes = [F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"), F.sha2("spans", 256).alias("spans_sha256")]
    return encoded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), *hashes)


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts.count_tokens(docs, public_tokenizers.path(BYTES), budget=512)
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 512).alias("over_limit"))


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.filter_urls(table(spark, sf_dir, "pages").select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "fingerprint", "component_id")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text"), keep_text=False)
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = chat.link_quotes(table(spark, sf_dir, "conversations"))
    return linked.select("conv_id", "turn", "role", "own_text", "reply_to", "linked", "thread", "depth", "formatted")


def quoted_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 9 where the messages quote: each message of `conversations` first quotes the one two turns before it."""
    talk = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = talk.filter("conv_id is not null and turn is not null").groupBy("conv_id", (F.col("turn") + 2).alias("turn")).agg(F.min("text").alias("earlier"))
    marked = F.concat(F.lit("> "), F.replace(F.col("earlier"), F.lit("\n"), F.lit("\n> ")), F.lit("\n"))
    quoting = talk.join(said, ["conv_id", "turn"], "left").withColumn("text", F.concat(F.coalesce(marked, F.lit("")), F.col("text"))).drop("earlier")
    return chat.link_quotes(quoting).select("conv_id", "turn", "role", "own_text", "reply_to", "linked", "thread", "depth", "formatted")


def op10_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, path, vocabulary = table(spark, sf_dir, "documents"), new_folder(spark, "tokens"), public_tokenizers.path(WORDS)
    token_store.write_store(docs, path, vocabulary)
    return token_store.read_digests(spark, path, vocabulary, docs.schema["doc_id"].dataType).withColumnRenamed("doc", "doc_id")


def planted_period(doc_id: int | None, n: int) -> np.ndarray | None:
    """The numbers of the words that a tenth of the documents take: from some word on, one stretch again and again."""
    if doc_id is None or (h := zlib.crc32(str(doc_id).encode())) % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    i = np.arange(n)
    return np.where(i < a, i, a + (i - a) % p)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.runs_of_words(table(spark, sf_dir, "documents").select("doc_id", "text"), arrange=planted_period)
    first = F.array_max(F.transform("runs", lambda r: F.struct(r.length.alias("length"), (-r.start).alias("start"), (-r.period).alias("period"))))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start.cast("string"), r.length.cast("string"), r.period.cast("string")), F.lit("\n"))), "")
    return found.withColumn("first", first).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("first.start")).alias("start"), F.col("first.length").alias("length"), (-F.col("first.period")).alias("period"),
        F.expr("1000 * first.length div -first.period").alias("exponent_milli"), F.sha2(F.encode(listed, "UTF-8"), 256).alias("runs_sha256"), F.sha2(F.encode("collapsed", "UTF-8"), 256).alias("collapsed_sha256"),
    )


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = suffixes.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, target = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark").select("text")
    return resampling.resample(docs, target, words=(1, 1), buckets=10_000, percent=10, least=20, seed=2024)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_sharding, op2_topk, op3_quality, op4_sentencepiece, op5_token_counts, op6_url_filters, op7_simhash, op8_mixing, op9_chat, op10_token_store, op11_periodic_runs, op12_suffix_dedup, op13_resampling, quoted_chat, normalised_pieces)
}

_LIST = ", ".join(f"({i}, '{r.name}', '{r.verdict}', '{r.name.partition('/')[0]}', '/{r.name.partition('/')[2]}')" for i, r in enumerate(url_filters.LIST))


def _like(pattern: str) -> str:
    """A pattern of PATTERNS for DuckDB: || is the start or a dot of the host, * anything."""
    body = pattern.removeprefix("||").replace(".", "[.]").replace("*", ".*")
    return ("^([^/]*[.])?" if pattern.startswith("||") else "") + body


_BLOCKED = f"regexp_matches(host || path, '{'|'.join(_like(p.pattern) for p in url_filters.PATTERNS)}', 's')"

ORACLES: dict[str, str] = {
    "op2_topk": """
        with v as (select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as q
                   from embeddings where embedding is not null and vec_id is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
        s as (select a.vec_id as query_id, b.vec_id, cast(list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2])) as bigint) as score
              from v a, v b where a.vec_id % 50 = 0 and a.vec_id <> b.vec_id),
        r as (select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank, vec_id, score from s)
        select * from r where rank <= 5
    """,
    "op6_url_filters": f"""
        with cut as (select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest from pages),
        p as (select page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
                     regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from cut),
        p2 as (select page_id, coalesce(host, '') as host, coalesce(path, '') as path from p),
        rules(no, name, verdict, host, path) as (values {_LIST}),
        hit as (select host, path, arg_max(name, length(name) * 1000 - no) as rule, arg_max(verdict, length(name) * 1000 - no) as verdict
                from (select distinct p2.host, p2.path, r.name, r.verdict, r.no from p2, rules r
                      where (p2.host = r.host or p2.host like '%.' || r.host) and starts_with(p2.path, r.path)) group by host, path)
        select page_id, host, path, hit.rule, coalesce(hit.verdict, case when {_BLOCKED} then 'block' else 'allow' end) as verdict
        from p2 left join hit using (host, path)
    """,
    "op13_resampling": """
        with step as (select list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as t),
        cut as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as words from documents),
        aim as (select unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) as word from benchmark),
        uses as (select doc_id, word, count(*) as n from (select doc_id, unnest(words) as word from cut) group by all),
        hexed as (select word, hex(encode(word)) as h from (select distinct word from (select word from uses union all select word from aim))),
        crc as (select word, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(1, length(h) // 2 + 1), lambda i: cast('0x' || substr(h, cast(2 * i - 1 as bigint), 2) as bigint))),
                             lambda c, b: xor(c >> 8, step.t[(xor(c, b) & 255) + 1]))) % 10000 as bucket from hexed, step),
        big as (select bucket, sum(n) as s from uses join crc using (word) group by bucket),
        small as (select bucket, count(*) as t from aim join crc using (word) group by bucket),
        totals as (select (select coalesce(sum(s), 0) from big) as a, (select coalesce(sum(t), 0) from small) as b),
        gain as (select g.bucket, cast(floor(1000 * ln((coalesce(t, 0) + 1)::double * (a + 10000)::double / ((coalesce(s, 0) + 1)::double * (b + 10000)::double))) as bigint) as gain
                 from range(10000) g(bucket) left join big using (bucket) left join small using (bucket), totals),
        sums as (select doc_id, sum(n * gain) as total from uses join crc using (word) join gain using (bucket) group by doc_id),
        w as (select doc_id, len(words) as n_features, case when len(words) = 0 then 0 else cast(floor(coalesce(total, 0)::double / len(words)) as bigint) end as weight,
                     cast('0x' || substr(sha256('2024:' || doc_id), 1, 8) as bigint) as h from cut left join sums using (doc_id)),
        scored as (select doc_id, n_features, weight, weight + cast(floor(-1000 * ln(-ln((h + 0.5::double) / 4294967296.0::double))) as bigint) as score from w),
        placed as (select doc_id, row_number() over (order by score desc, doc_id) as rank from scored where n_features >= 20)
        select doc_id, n_features, weight, score, case when rank <= (select count(*) from placed) * 10 // 100 then rank end as rank from scored left join placed using (doc_id)
    """,
}
