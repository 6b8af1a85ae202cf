"""URL filters: pattern rules indexed by their rarest literal token. Built-in Spark functions only.

A rule is a glob over ``host + path``. ``*`` stands for any text, ``^`` for a separator, the start or the end, ``||`` at
the start for the start of a host or of one of its parents. Every rule is filed under one token
that its matches must hold; a url fetches only the rules filed under its own tokens, and only those run
their regular expression.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import materialize
from .names import apart

#: Rules fixed by the query's contract: verdict, host, path. The longest that fits wins.
HOST_RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
#: The method's own patterns, for urls that no host rule fits. An allowed pattern beats a blocked one.
PATTERNS = (
    ("block", "^casino^"), ("block", "^free-bets^"), ("block", "^cheap-pills^"), ("block", "^poker^"), ("block", "^xxx^"),
    ("block", "^adserver^"), ("block", "||ads.*/banner/"), ("block", "/wp-login.php^"), ("block", "/cgi-bin/*.exe^"),
    ("allow", "||*/anti-casino/"),
)
#: Rule tables up to so many rows are broadcast; larger ones are joined by a shuffle on the token.
BROADCAST_ROWS = 100_000

TOKEN = re.compile(r"[A-Za-z0-9]+")


@dataclass(frozen=True)
class Rule:
    id: int
    kind: str  # host or pattern
    verdict: str
    name: str | None  # as reported
    regex: str
    tokens: tuple[str, ...]
    length: int


def _quote(text: str) -> str:
    return re.sub(r"([^A-Za-z0-9/_])", r"\\\1", text)


def host_rule(number: int, verdict: str, host: str, path: str) -> Rule:
    """Fits a host, its subdomains, and every path that starts with ``path``."""
    whole = host.lower() + path
    found = [m for m in TOKEN.finditer(whole)]
    # The last token may be the beginning of a longer one in the url.
    tokens = tuple(m.group() for m in found if m.end() < len(whole))
    return Rule(number, "host", verdict, whole, rf"^(?:[^/]*\.)?{_quote(whole)}", tokens, len(whole))


def pattern_rule(number: int, verdict: str, glob: str) -> Rule:
    """A glob rule. Tokens count only where both neighbours are fixed, so that they are whole tokens of any match."""
    anchored = glob.startswith("||")
    body = glob[2:] if anchored else glob
    parts = ["(?:^|[^A-Za-z0-9]|$)" if c == "^" else ".*" if c == "*" else _quote(c) for c in body]
    tokens = []
    for m in TOKEN.finditer(body):
        left = m.start() > 0 and body[m.start() - 1] != "*" or m.start() == 0 and anchored
        right = m.end() < len(body) and body[m.end()] != "*"
        if left and right:
            tokens.append(m.group())
    start = r"^(?:[^/]*\.)?" if anchored else ""
    return Rule(number, "pattern", verdict, None, "(?s)" + start + "".join(parts), tuple(tokens), len(glob))


def rule_set(host_rules=HOST_RULES, patterns=PATTERNS) -> list[Rule]:
    rules = [host_rule(i, *r) for i, r in enumerate(host_rules)]
    return rules + [pattern_rule(len(rules) + i, *p) for i, p in enumerate(patterns)]


def host_of(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?``, ``#`` or end, A-Z lower-cased; empty if there is none."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rarest_tokens(spark: SparkSession, tokens: DataFrame, rules: list[Rule]) -> DataFrame:
    """(token, rule columns): each rule under its token that the fewest urls hold; under '' if it has none.

    Only tokens that some rule holds are counted, over all urls, with sums per task before the shuffle.
    """
    schema = "id int, kind string, verdict string, name string, regex string, length int, tokens array<string>"
    table = spark.createDataFrame([(r.id, r.kind, r.verdict, r.name, r.regex, r.length, list(r.tokens)) for r in rules], schema)
    wanted = table.select("id", F.explode("tokens").alias("token"))
    names = wanted.select("token").distinct()
    names = F.broadcast(names) if len(rules) <= BROADCAST_ROWS else names
    counts = tokens.join(names, "token").groupBy("token").agg(F.count(F.lit(1)).alias("urls"))
    rare = (
        wanted.join(counts, "token", "left")
        .groupBy("id").agg(F.min(F.struct(F.coalesce("urls", F.lit(0)), "token")).alias("least"))
        .select("id", F.col("least.token").alias("token"))
    )
    return table.drop("tokens").join(rare, "id", "left").withColumn("token", F.coalesce("token", F.lit("")))


def judge(pages: DataFrame, keep: list[str], url: str = "url", host_rules=HOST_RULES, patterns=PATTERNS) -> DataFrame:
    """Columns ``keep`` of every row plus ``_host, _path, _rule, _verdict``.

    Each row is judged by itself, so repeated urls get equal verdicts. A null url, or one without ``://``, has an empty host and path
    and meets only rules that an empty text meets. Without any fitting rule a url is allowed.
    """
    spark = pages.sparkSession
    rules = rule_set(host_rules, patterns)
    u = F.col(f"`{url}`")
    rows = pages.select(F.struct(*[F.col(f"`{k}`") for k in keep]).alias("_row"), host_of(u).alias("_host"), path_of(u).alias("_path"))
    rows = materialize(rows, "urls").withColumn("_at", F.concat("_host", "_path"))
    rows = rows.withColumn("_tokens", F.array_distinct(F.split("_at", "[^A-Za-z0-9]+")))
    index = materialize(rarest_tokens(spark, rows.select(F.explode("_tokens").alias("token")), rules), "rules")
    index = F.broadcast(index) if len(rules) <= BROADCAST_ROWS else index
    # One number per row, the same in a repeated task: a written table is always cut the same way.
    rows = rows.withColumn("_n", F.monotonically_increasing_id())
    asked = rows.withColumn("token", F.explode(F.array_union("_tokens", F.array(F.lit("")))))
    fits = F.expr("_at rlike regex")
    hit = F.when(F.col("id").isNotNull(), F.when(fits, F.struct(
        (F.col("kind") == "host").alias("host"), F.when(F.col("kind") == "host", F.col("length")).otherwise(0).alias("length"),
        (F.col("verdict") == "allow").alias("allow"), F.col("id"), F.col("name"), F.col("verdict"),
    )))
    best = (
        asked.join(index, "token", "left")
        .groupBy("_n", "_row", "_host", "_path").agg(F.max(hit).alias("_best"))
    )
    return best.select(
        *[F.col(f"_row.`{k}`").alias(k) for k in keep], "_host", "_path",
        F.col("_best.name").alias("_rule"), F.coalesce("_best.verdict", F.lit("allow")).alias("_verdict"),
    )


def allowed(pages: DataFrame, url: str = "url", **rules) -> DataFrame:
    """The rows whose url is allowed, columns unchanged, whatever their names."""
    return apart(pages, lambda p, url: judge(p, list(p.columns), url, **rules).filter("_verdict = 'allow'"), url=url)


def digest(pages: DataFrame) -> DataFrame:
    """The columns of query op1."""
    return judge(pages, ["page_id"]).select(
        "page_id", F.col("_host").alias("host"), F.col("_path").alias("path"), F.col("_rule").alias("rule"), F.col("_verdict").alias("verdict")
    )
