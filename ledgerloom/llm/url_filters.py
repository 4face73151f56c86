"""URL filters: pattern rules found by their rarest literal token.

Each rule is indexed under the one of its literal tokens that fewest URLs hold. The tokens of a URL fetch the rules
indexed under them, and only those run their regular expressions. All of it is DataFrame work, without Python.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .shared import column_after, staged, unclash

#: Rules up to this number are broadcast; beyond it they meet the URLs' tokens in a shuffled join.
BROADCAST_RULES = 20_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class UrlRule:
    """A rule: its name, allow or block, a pattern, and whether it is one of the list (then it goes before others).

    In a pattern, || in front is the start of a host or of one of its labels, | in front the start and | behind the end
    of the address (host and path), ^ a separator or the end, * anything; the rest is literal.
    """

    name: str
    verdict: str
    pattern: str
    listed: bool = False


def listed(verdict: str, *prefixes: str) -> list[UrlRule]:
    """Rules of a list: a host with all its subdomains, and the start of the path."""
    return [UrlRule(p, verdict, "||" + p, listed=True) for p in prefixes]


#: The list, and words that say gambling, adult, pharmacy, piracy, advertising and spam sites.
LIST = [*listed("allow", "org/"), *listed("block", "example.org/es/", "example.org/en/1"), *listed("allow", "com/fr/"), *listed("block", "com/de/")]
SITE_WORDS = (
    "casino", "casinos", "poker", "betting", "bets", "slots", "jackpot", "roulette", "lottery", "porn", "porno", "xxx", "adult", "sex", "escort", "hentai",
    "viagra", "cialis", "pills", "pharma", "steroids", "warez", "torrent", "torrents", "keygen", "cracks", "adserver", "ads", "adtrack", "popunder", "clickbait", "spam", "payday", "replica",
)
PATH_WORDS = ("casino", "porn", "xxx", "viagra", "cialis", "warez", "torrents", "keygen", "popunder", "adserver")
#: A word is a label of the host, or begins or ends one before a hyphen; or it is a whole step of the path.
PATTERNS = [UrlRule(p, "block", p) for p in (*(form.format(w) for w in SITE_WORDS for form in ("||{}.", "||{}-*.", "||*-{}.")), *(f"/{w}/" for w in PATH_WORDS))]
#: Rules of a list in Python; more of them come as a table.
LITERAL_RULES = 2000


def rule_regex(pattern: Column) -> Column:
    """The regular expression of a pattern, over addresses."""
    bare = F.regexp_replace(F.regexp_replace(pattern, r"^\|\|?", ""), r"\|$", "")
    escaped = F.regexp_replace(bare, r"([^A-Za-z0-9*^])", r"\\$1")
    body = F.replace(F.replace(escaped, F.lit("*"), F.lit(".*")), F.lit("^"), F.lit(r"(?:[^A-Za-z0-9_.%-]|\z)"))
    front = F.when(pattern.startswith("||"), r"^(?:[^/]*\.)?").when(pattern.startswith("|"), "^").otherwise("")
    return F.concat(F.lit("(?s)"), front, body, F.when(pattern.rlike(r"[^|]\|$"), r"\z").otherwise(""))


def rule_literals(pattern: Column) -> Column:
    """Literal tokens that a fitting address must hold whole: with an end, or a literal that is no letter or digit, on both sides."""
    closed = F.regexp_replace(F.when(pattern.startswith("|"), pattern).otherwise(F.concat(F.lit("*"), pattern)), r"([^|])$", "$1*")
    return F.array_distinct(F.regexp_extract_all(closed, F.lit(r"(?<![A-Za-z0-9*])([A-Za-z0-9]+)(?![A-Za-z0-9*])"), F.lit(1)))


def host_of(url: Column) -> Column:
    """From behind the first :// to /, ?, # or the end, with A-Z in lower case; empty if there is no ://."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """From behind the host to ?, # or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens_of(address: Column) -> Column:
    return F.array_distinct(F.filter(F.split(address, "[^A-Za-z0-9]+"), lambda t: t != ""))


def rule_table(spark: SparkSession, rules: list[UrlRule] | DataFrame) -> DataFrame:
    """One row per rule, with its regular expression and literal tokens. A table of rules has the columns name, verdict
    and pattern, and may have listed; rows that lack one of the three are no rules."""
    if isinstance(rules, list):
        if len(rules) > LITERAL_RULES:
            raise ValueError(f"a list of {len(rules)} rules; give more than {LITERAL_RULES} as a table")
        fields = "array<struct<name:string,verdict:string,pattern:string,listed:boolean>>"
        rules = spark.range(1).select(F.inline(F.array(*[F.struct(*map(F.lit, (r.name, r.verdict, r.pattern, r.listed))) for r in rules]).cast(fields)))
    in_list = F.coalesce(F.col("listed"), F.lit(False)) if "listed" in rules.columns else F.lit(False)
    named = rules.filter("name is not null and verdict is not null and pattern is not null").distinct()
    return named.select(F.col("name").alias("rule_name"), F.col("verdict").alias("rule_verdict"), in_list.alias("in_list"), F.col("pattern").alias("rule_pattern"), rule_regex(F.col("pattern")).alias("regex"), rule_literals(F.col("pattern")).alias("literals"))


def index_rules(rules: DataFrame, addresses: DataFrame, small: bool) -> DataFrame:
    """Each rule with the token that it is indexed under: the literal that fewest addresses hold, or null if it has none."""
    hint = F.broadcast if small else (lambda x: x)
    literals = rules.select("regex", F.explode("literals").alias("token"))
    seen = addresses.select(F.explode(tokens_of(F.col("address"))).alias("token")).join(hint(literals.select("token").distinct()), "token", "left_semi").groupBy("token").count()
    rarest = literals.join(seen, "token", "left").groupBy("regex").agg(F.min(F.struct(F.coalesce("count", F.lit(0)), "token"))["token"].alias("token"))
    return rules.join(rarest, "regex", "left").drop("literals")


OUT = ("host", "path", "rule", "verdict", "pattern")


def filter_urls(pages: DataFrame, url: str = "url", rules: list[UrlRule] | DataFrame | None = None, default: str = "allow") -> DataFrame:
    """`pages` with host, path, rule (the longest rule of the list that fits, else null), verdict (that rule's, else that
    of the first pattern that fits by code points, else `default`) and pattern (that one, if no rule of the list fits).

    Rules are a list or, in any number, a table (see rule_table). Null URLs and those without :// have an empty host and
    path, and get the default. Equal addresses are judged once, however many rows have them. Rules without any literal
    token are tried on every address; there may be 20,000 of them. Columns of `pages` named like the new ones get an
    underscore before them; if `url` is one of those, it is still the one that is read. URLs of any length are judged whole;
    an empty table gives no rows.
    """
    spark = pages.sparkSession
    pages, moved = unclash(pages, [*OUT, "address", "judged"])
    url = column_after(moved, url)
    named = pages.withColumn("host", host_of(F.col(f"`{url}`"))).withColumn("path", path_of(F.col(f"`{url}`"))).withColumn("address", F.concat("host", "path"))
    rules = staged(rule_table(spark, LIST + PATTERNS if rules is None else rules), "rules")
    small = rules.count() <= BROADCAST_RULES
    hint = F.broadcast if small else (lambda x: x)
    addresses = named.select("address").filter("address != ''").distinct()
    index = staged(index_rules(rules, addresses, small), "index")
    keyed, bare = index.filter("token is not null"), index.filter("token is null").drop("token")
    fitting = addresses.select("address", F.explode(tokens_of(F.col("address"))).alias("token")).join(hint(keyed), "token").filter("address rlike regex").drop("token")
    if n_bare := bare.count():
        if n_bare > BROADCAST_RULES:
            raise ValueError(f"{n_bare} rules have no literal token; at most {BROADCAST_RULES} may")
        fitting = fitting.unionByName(addresses.join(F.broadcast(bare), F.expr("address rlike regex")))
    # the list goes first and the longer of its rules, then the first pattern by code points
    size = F.when(F.col("in_list"), F.length("rule_name")).otherwise(0)
    listed_first = F.max(F.when(F.col("in_list"), F.struct(size.alias("size"), "rule_name", "rule_verdict"))).alias("listed")
    first_pattern = F.min(F.when(~F.col("in_list"), F.struct("rule_name", "rule_verdict"))).alias("other")
    judged = fitting.groupBy("address").agg(listed_first, first_pattern)
    judged = judged.select("address", F.struct("listed.rule_name", "listed.rule_verdict", F.col("other.rule_name").alias("pattern"), F.col("other.rule_verdict").alias("pattern_verdict")).alias("judged"))
    # rows without an address stay out of the join, which would send them all to one task
    none = F.lit(None).cast(judged.schema["judged"].dataType)
    out = named.filter("address != ''").join(judged, "address", "left").unionByName(named.filter("address = ''").withColumn("judged", none))
    return out.withColumns({
        "rule": F.col("judged.rule_name"),
        "verdict": F.coalesce("judged.rule_verdict", "judged.pattern_verdict", F.lit(default)),
        "pattern": F.when(F.col("judged.rule_name").isNull(), F.col("judged.pattern")),
    }).drop("address", "judged")
