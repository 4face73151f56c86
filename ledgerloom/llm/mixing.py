"""Mixing sources to target weights, by Pareto order sampling.

A source's target over its size says how many copies a document of it gets on average. Longer documents get fewer than
shorter ones: expected copies fall with the class of the length (of which there are at most about 60), up to the most
that a document may have, at the level at which expected words meet the source's target. The whole part of a document's
expected copies is certain; the rest is its inclusion probability, by which documents of a source are ranked: random
odds over inclusion odds, least first. The first in that order are taken, as many as bring the words nearest to what the
certain copies leave of the target. Where that cut falls is found from sums over bins of the order and then exactly
inside the one bin that holds it, so no source is sorted whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import Window as W

from .shared import column_after, free_name, staged, unclash

WEIGHTS = (5.0, 2.0, 1.0)
#: No document is taken more often than this.
MOST = 3
#: Expected copies fall with the length to this power, from one class of lengths (powers of two) to the next.
TEMPER = 0.25
#: Bins of the order of a source.
BINS = 4096
#: A table of sources up to this number of rows is broadcast.
BROADCAST_SOURCES = 100_000
#: Most sources: their targets are found in one task, from one row each.
MOST_SOURCES = 5_000_000
SEED = 97


def words_in(text: Column) -> Column:
    """Words between space and \\t to \\r; none in a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long"), F.lit(0).cast("long"))


def uniform(key: Column, text: Column, seed: int) -> Column:
    """A number inside (0, 1) for each document, the same in every run."""
    return (F.pmod(F.xxhash64(key, F.xxhash64(text), F.lit(seed)), F.lit(1 << 52)) + 0.5) / float(1 << 52)


def targets(sizes: DataFrame, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """sizes: (source, source_size). With target: sources in order of code points, null last, weigh `weights` in turn and
    share the sum of sizes; a target stops at `most` times its source, and the excess is shared by weight among the rest.

    That is a level: target = least(most * size, level * weight), with the level at which the targets fill the sum.
    """
    ordered = sizes.withColumn("place", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1)  # one row a source
    weight = F.array(*map(F.lit, map(float, weights)))[F.col("place") % len(weights)]
    full = ordered.withColumn("weight", weight).withColumn("cap", F.col("source_size") * float(most)).withColumn("full_at", F.col("cap") / F.col("weight"))
    by = W.orderBy("full_at", "place").rowsBetween(W.unboundedPreceding, -1)
    on = W.orderBy("full_at", "place").rowsBetween(W.currentRow, W.unboundedFollowing)
    level = (F.sum("source_size").over(W.partitionBy()).cast("double") - F.coalesce(F.sum("cap").over(by), F.lit(0.0))) / F.sum("weight").over(on)
    levels = full.withColumn("level", level)
    chosen = F.min(F.when(F.col("level") <= F.col("full_at"), F.struct("full_at", "place", "level"))).over(W.partitionBy())["level"]
    return levels.select("source", "source_size", F.coalesce(F.least("cap", chosen * F.col("weight")), F.col("cap")).alias("target"))


def length_class(size: Column) -> Column:
    """The power of two below a size, 0 for sizes under 2."""
    return F.floor(F.log2(F.greatest(size, F.lit(1)).cast("double")) + 1e-9).cast("int")


def expected(classes: DataFrame, shares: DataFrame, most: int, temper: float, small: bool) -> DataFrame:
    """Per source and length class: source_size, target, and the copies that a document is to get on average.

    copies = least(most, level * 2 ** (-temper * class)), with the level at which words times copies sum to the target.
    A class is full at the level most * 2 ** (temper * class), so classes fill in order.
    """
    hint = F.broadcast if small else (lambda x: x)
    rows = classes.join(hint(shares), classes["source"].eqNullSafe(shares["source"])).select(classes["source"], "class", "words", "source_size", "target")
    weight = F.pow(F.lit(2.0), -F.lit(temper) * F.col("class"))
    full = rows.withColumn("weight", weight).withColumn("full_at", F.lit(float(most)) / weight)
    by = W.partitionBy("source").orderBy("class").rowsBetween(W.unboundedPreceding, -1)  # at most about 60 rows a source
    on = W.partitionBy("source").orderBy("class").rowsBetween(W.currentRow, W.unboundedFollowing)
    open_words = F.sum(F.col("words") * F.col("weight")).over(on)
    level = (F.col("target") - F.coalesce(F.sum(F.col("words") * float(most)).over(by), F.lit(0.0))) / F.nullif(open_words, F.lit(0.0))
    levels = full.withColumn("level", F.when(open_words > 0, level).otherwise(F.lit(0.0)))
    chosen = F.min(F.when(F.col("level") <= F.col("full_at"), F.struct("class", "level"))).over(W.partitionBy("source"))["level"]
    copies = F.when(F.col("source_size") > 0, F.least(F.lit(float(most)), F.coalesce(chosen, F.lit(float("inf"))) * F.col("weight"))).otherwise(F.lit(0.0))
    return levels.select("source", "class", "words", "source_size", "target", copies.alias("expected"))


def place(u: Column, chance: Column) -> Column:
    """The Pareto value v, random odds u / (1 - u) over inclusion odds chance / (1 - chance), as v / (1 + v): in the same
    order, but between 0 and 1."""
    return u * (1 - chance) / (u * (1 - chance) + chance * (1 - u))


def plan(narrow: DataFrame, weights=WEIGHTS, most: int = MOST, bins: int = BINS, temper: float = TEMPER) -> DataFrame:
    """narrow: a stored table (source, size, u). Per source and length class its source_size, target, whole copies, chance
    of one more copy and the source's cut: documents whose place in the Pareto order is at most the cut get it."""
    classes = staged(narrow.groupBy("source", length_class(F.col("size")).alias("class")).agg(F.sum("size").alias("words")), "classes")
    sizes = staged(classes.groupBy("source").agg(F.sum("words").alias("source_size")), "sources")
    if (n := sizes.count()) > MOST_SOURCES:
        raise ValueError(f"{n} sources; at most {MOST_SOURCES} can be mixed")
    small = n <= BROADCAST_SOURCES // 60
    hint = F.broadcast if small else (lambda x: x)
    wanted = expected(classes, staged(targets(sizes, weights, most), "targets"), most, temper, n <= BROADCAST_SOURCES)
    whole = F.floor(F.col("expected") + 1e-9)  # a full class has no rest
    wanted = wanted.withColumn("whole", whole.cast("int")).withColumn("chance", F.greatest(F.col("expected") - whole, F.lit(0.0)))
    wanted = staged(wanted.withColumn("rest", F.col("target") - F.sum(F.col("whole") * F.col("words")).over(W.partitionBy("source"))), "wanted")
    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    drawn = narrow.withColumn("class", length_class(F.col("size"))).join(hint(wanted.filter("chance > 0").select(F.col("source").alias("s"), F.col("class").alias("c"), "chance", "rest")), F.col("source").eqNullSafe(F.col("s")) & (F.col("class") == F.col("c")))
    drawn = drawn.select("source", "size", "rest", place(F.col("u"), F.col("chance")).alias("place")).withColumn("bin", F.floor(F.col("place") * bins).cast("int"))
    binned = staged(drawn.groupBy("source", "bin").agg(F.sum("size").alias("words"), F.first("rest").alias("rest")), "bins")
    # at most `bins` rows a source
    running = binned.withColumn("sum", F.sum("words").over(W.partitionBy("source").orderBy("bin"))).filter(F.col("sum") >= F.col("rest"))
    edge = running.groupBy("source").agg(F.min(F.struct("bin", (F.col("sum") - F.col("words")).alias("before"))).alias("e")).select("source", "e.*")
    small_edge = F.broadcast if n <= BROADCAST_SOURCES else (lambda x: x)
    near = drawn.join(small_edge(edge), same(drawn, edge) & (drawn["bin"] == edge["bin"])).select(drawn["source"], "place", "size", "rest", "before")
    inside = near.groupBy("source", "place").agg(F.sum("size").alias("size"), F.first("rest").alias("rest"), F.first("before").alias("before"))
    upto = F.sum("size").over(W.partitionBy("source").orderBy("place"))
    taken = F.when(F.col("before") + upto - F.col("size") / 2 <= F.col("rest"), F.col("place"))
    # nothing of the bin is taken: the cut is where it begins; no bin reaches the rest: all are taken
    cut = inside.withColumn("taken", taken).groupBy("source").agg(F.coalesce(F.max("taken"), F.floor(F.min("place") * bins) / bins - 1e-12).alias("cut"))
    return wanted.join(small_edge(cut), same(wanted, cut), "left").select(wanted["source"], "class", "source_size", "target", "whole", "chance", F.coalesce("cut", F.lit(1.0)).alias("cut"))


OUT = ("size", "source_size", "target", "copies")
INSIDE = (*OUT, "mix_source", "mix_class", "u", "whole", "chance", "cut", "copy")


def sized(docs: DataFrame, key: str, text: str, seed: int) -> DataFrame:
    return docs.withColumn("size", words_in(F.col(f"`{text}`"))).withColumn("u", uniform(F.col(f"`{key}`"), F.col(f"`{text}`"), seed))


def decided(rows: DataFrame, narrow: DataFrame, source: str, weights, most: int, temper: float) -> DataFrame:
    """rows (with size and u): source_size, target and copies beside them."""
    shares = staged(plan(narrow, weights, most, temper=temper).withColumnsRenamed({"source": "mix_source", "class": "mix_class"}), "plan")
    hint = F.broadcast if shares.count() <= BROADCAST_SOURCES else (lambda x: x)
    out = rows.join(hint(shares), F.col(f"`{source}`").eqNullSafe(F.col("mix_source")) & (length_class(F.col("size")) == F.col("mix_class")))
    more = F.when((F.col("chance") > 0) & (place(F.col("u"), F.col("chance")) <= F.col("cut")), 1).otherwise(0)
    return out.withColumn("copies", (F.col("whole") + more).cast("int")).drop("u", "mix_source", "mix_class", "whole", "chance", "cut")


def mix(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", weights=WEIGHTS, most: int = MOST, seed: int = SEED, temper: float = TEMPER, keep_text: bool = True) -> DataFrame:
    """`docs` with size (words), source_size, target (of its source) and copies (0 to `most`: how often the mix takes it).
    Without keep_text the texts are read once, and left out.

    A null source is one source, the last. A null text has no words. Sources without words have target 0 and no copies.
    Rows that repeat both key and text are taken alike. Reruns agree, whatever the partitions. Columns of `docs` named
    like the new ones get an underscore before them; if the key, the source or the text is one of those, it is still the
    one that is read. An empty table stays empty. More than 5 million sources are an error.
    """
    docs, moved = unclash(docs, INSIDE)
    key, source, text = (column_after(moved, c) for c in (key, source, text))
    rows = sized(docs, key, text, seed)
    if keep_text:
        narrow = staged(rows.select(F.col(f"`{source}`").alias("source"), "size", "u"), "sizes")
    else:
        rows = staged(rows.drop(text), "sizes")
        narrow = rows.select(F.col(f"`{source}`").alias("source"), "size", "u")
    return decided(rows, narrow, source, weights, most, temper)


def take(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", **how) -> DataFrame:
    """The rows of the mix with the columns of `docs`, each as often as it is taken."""
    safe, moved = unclash(docs, INSIDE)
    names = {k: column_after(moved, c) for k, c in (("key", key), ("source", source), ("text", text))}
    copy = free_name(safe, "copy")
    out = mix(safe, **names, **how).filter("copies > 0").withColumn(copy, F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return out.select(*[F.col(f"`{c}`") for c in safe.columns]).withColumnsRenamed(moved)
