"""Chat formatting by quotation linking.

The quote levels of each message are parsed; quoted passages are normalised and hashed and joined to the messages of
the same conversation that first said them. That gives each message the one it replies to; threads and depths follow by
pointer doubling, and each message is put out without its quotes, in the order of replies.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql import Window as W

from .shared import column_after, staged, text_slices, unclash

QUOTE = re.compile(r"(?:[ \t]*>)+ ?")
#: A line that announces a quotation: in four languages, and the dashes of forwarded mail.
ANNOUNCED = re.compile(r"(?:On|Le|Am|El)\b.{0,200}(?:wrote|écrit|schrieb|escribió).{0,80}:\s*|-{2,}\s*(?:Original Message|Forwarded message)\s*-{2,}\s*", re.IGNORECASE)
#: Lines and paragraphs of fewer words don't link by themselves; whole passages do.
LEAST_WORDS = 3


def passage_hash(text: str) -> int:
    """Of the words in lower case, whatever blanks and line breaks stand between."""
    return xxhash.xxh64_intdigest(" ".join(text.lower().split()).encode(), 0) - (1 << 63)


def passages(lines: list[str]) -> list[int]:
    """Hashes of a passage, its paragraphs and its lines."""
    whole = "\n".join(lines)
    if not whole.strip():
        return []
    parts = [p for p in [*re.split(r"\n\s*\n", whole), *lines] if len(p.split()) >= LEAST_WORDS]
    return sorted({passage_hash(p) for p in [whole, *parts]})


def parse(text: str) -> tuple[str, list[tuple[int, int]], list[int]]:
    """The message without quotes and their announcements; (level, hash) of what it quotes; hashes of what it says itself."""
    runs: list[tuple[int, list[str]]] = []
    for line in text.split("\n"):
        mark = QUOTE.match(line)
        level = mark[0].count(">") if mark else 0
        if not runs or runs[-1][0] != level:
            runs.append((level, []))
        runs[-1][1].append(line[mark.end() :] if mark else line)
    own: list[str] = []
    quoted: set[tuple[int, int]] = set()
    for i, (level, lines) in enumerate(runs):
        if level:
            quoted.update((level, h) for h in passages(lines))
            continue
        if i + 1 < len(runs):
            last = max((k for k, x in enumerate(lines) if x.strip()), default=-1)
            if last >= 0 and ANNOUNCED.fullmatch(lines[last].strip()):
                lines = lines[:last]
        own += lines
    said = "\n".join(own).strip("\n") if any(level for level, _ in runs) else text
    return said, sorted(quoted), passages(said.split("\n"))


OUT = ("own_text", "quoted", "said")


def parsed(messages: DataFrame, text: str = "text") -> DataFrame:
    """`messages` with own_text, quoted (level and hash) and said (hashes). A null text says and quotes nothing."""
    schema = T.StructType([*messages.schema, *T._parse_datatype_string("own_text string, quoted array<struct<level:int,hash:long>>, said array<long>")])
    kind = pa.list_(pa.struct([("level", pa.int32()), ("hash", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches, text):
            found = [(None, [], []) if t is None else parse(t) for t in texts]
            columns = [pa.array([x[0] for x in found], pa.string()), pa.array([[{"level": a, "hash": b} for a, b in x[1]] for x in found], kind), pa.array([x[2] for x in found], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, *OUT])

    return messages.mapInArrow(run, schema)


def with_previous(places: DataFrame) -> DataFrame:
    """places: distinct (c, t). With previous: the greatest t of the same c before it, or null.

    Rows are dealt by ranges of (c, t), so that a conversation of any length is spread over tasks. Inside a range the row
    before is at hand; the first row of a conversation in a range follows its last row in the ranges before.
    """
    dealt = staged(places.repartitionByRange("c", "t").withColumn("range", F.spark_partition_id()), "ranges")
    inside = F.lag("t").over(W.partitionBy("c", "range").orderBy("t"))
    last = dealt.groupBy("c", "range").agg(F.max("t").alias("last"))
    carried = last.select("c", "range", F.lag("last").over(W.partitionBy("c").orderBy("range")).alias("carried"))  # a row a range at most
    return dealt.withColumn("inside", inside).join(carried.filter("carried is not null"), ["c", "range"], "left").select("c", "t", F.coalesce("inside", "carried").alias("previous"))


NEW = (*OUT, "reply_to", "linked", "thread", "depth", "formatted")


def escaped(text: Column) -> Column:
    """With a backslash before each backslash and inside each <| and |>."""
    for mark, safe in (("\\", "\\\\"), ("<|", "<\\|"), ("|>", "|\\>")):
        text = F.replace(text, F.lit(mark), F.lit(safe))
    return text


def link_quotes(messages: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", rounds: int = 64) -> DataFrame:
    """`messages` with own_text, reply_to (a turn), linked (by a quotation), thread (the turn it goes back to), depth (of
    replies) and formatted (role and own text), to be read in order of conversation, thread and turn.

    A message replies to the latest earlier one whose words it quotes at its outermost level; without such to the greatest
    turn before it, if there is one; else it begins a thread. Words count as said by the first message of the conversation
    that says them. Rows that repeat conversation and turn are one place in the order and share its links. Rows where
    either is null keep their own_text but have no links, thread or depth. Null roles are formatted as user, null texts
    stay null. In `formatted` a backslash, <| and |> of a text or role are escaped, so that none can pass for a marker. A
    text of any length is parsed whole; an empty table gives no rows. Columns of `messages` named like the new ones get an underscore before them.
    """
    messages, moved = unclash(messages, [*NEW, "c", "t"])
    conversation, turn, role, text = (column_after(moved, x) for x in (conversation, turn, role, text))
    rows = staged(parsed(messages, text).withColumn("c", F.col(f"`{conversation}`")).withColumn("t", F.col(f"`{turn}`").cast("long")), "messages")
    keyed = rows.filter("c is not null and t is not null")
    first = keyed.select("c", "t", F.explode("said").alias("hash")).groupBy("c", "hash").agg(F.min("t").alias("origin"))
    quotes = keyed.select("c", "t", F.explode("quoted").alias("q")).select("c", "t", "q.level", "q.hash").distinct()
    hits = quotes.join(first, ["c", "hash"]).filter("origin < t")
    links = hits.groupBy("c", "t").agg(F.max(F.struct(-F.col("level"), "origin"))["origin"].alias("origin"))
    places = keyed.select("c", "t").distinct()
    parents = with_previous(places).join(links, ["c", "t"], "left")
    # jump: an ancestor on the way to the thread's beginning; depth: replies passed on the way there; done: it is the beginning
    chain = parents.select("c", "t", F.coalesce("origin", "previous").alias("reply_to"), F.col("origin").isNotNull().alias("linked"))
    chain = chain.withColumns({"jump": F.coalesce("reply_to", "t"), "depth": F.when(F.col("reply_to").isNull(), 0).otherwise(1), "done": F.col("reply_to").isNull()})
    current, settled = staged(chain, "chain"), []
    for _ in range(rounds):  # only places that have not arrived go on
        settled.append(current.filter("done"))
        active = current.filter("not done")
        if active.isEmpty():
            break
        everyone = reduce(DataFrame.unionByName, [*settled, active])
        up = everyone.select("c", F.col("t").alias("jump"), F.col("jump").alias("further"), F.col("depth").alias("more"), F.col("done").alias("far"))
        arrived = F.col("far") | (F.col("further") == F.col("jump"))
        current = staged(active.join(up, ["c", "jump"]).select("c", "t", "reply_to", "linked", F.col("further").alias("jump"), (F.col("depth") + F.col("more")).alias("depth"), arrived.alias("done")), "chain")
    else:
        raise RuntimeError(f"threads did not settle in {rounds} rounds")
    chain = reduce(DataFrame.unionByName, settled).drop("done")
    out = rows.join(chain.withColumnRenamed("jump", "thread"), ["c", "t"], "left").drop("c", "t", "quoted", "said")
    who = escaped(F.coalesce(F.col(f"`{role}`"), F.lit("user")))
    return out.withColumn("linked", F.coalesce("linked", F.lit(False))).withColumn("formatted", F.concat(F.lit("<|"), who, F.lit("|>\n"), escaped(F.col("own_text")), F.lit("\n")))
