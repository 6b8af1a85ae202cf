"""Quality by weak supervision: rules vote or abstain, expectation-maximisation weighs them.

Everything is built-in Spark functions. The corpus is read once for its measures; the model then works on
vote patterns with their counts (at most 3 to the number of rules rows, whatever the corpus size).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialize
from .names import apart

#: Code points that separate words, and the symbols of the symbol rule (fixed by the query's contract).
WORD_GAP = r"[ \t-\r]+"
SYMBOLS = r"[#*$%&|<>]"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


@dataclass(frozen=True)
class Rule:
    """SQL conditions over the measures; a document that meets neither is abstained on."""

    name: str
    junk: str
    good: str


RULES = (
    Rule("length", "n_words < 50", "n_words >= 80"),
    Rule("repetition", "n_repeat_words > 0.45 * n_words", "n_repeat_words < 0.2 * n_words"),
    Rule("symbols", "n_symbols > 0.1 * n_words", "n_symbols <= 0.02 * n_words"),
    Rule("lines", "n_dup_lines > 0.4 * n_lines", "n_dup_lines <= 0.1 * n_lines"),
    Rule("word_length", "word_chars < 2 * n_words or word_chars > 15 * n_words",
         "word_chars between 3 * n_words and 12 * n_words"),
    Rule("letters", "n_letters < 0.82 * word_chars", "n_letters >= 0.9 * word_chars"),
    Rule("sentences", "n_ends * 100 < n_words", "n_ends * 40 >= n_words"),
)

ITERATIONS = 12
START_QUALITY = 0.8
#: What rules are believed to do before any text is seen: shares of junk, no and good votes on a document
#: of each class. This belief weighs as much as ``BELIEF`` times all documents, at every corpus size.
BELIEVED = {"good": (0.005, 0.195, 0.80), "junk": (0.40, 0.25, 0.35)}
BELIEF = 0.05
#: The share of good documents stays within these bounds.
LEAST, MOST = 0.5, 0.95


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` plus the measures of every whole text, in columns ``_q.*`` of one struct.

    A null text has no words and zero everywhere. Work is one sort of a text's window hashes, so a long
    text costs n log n. A word is repeated if it lies in a window of three words that occurs twice in the
    text: windows that occur once, in order of place, are matched against all windows in one fold.
    """
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    step = docs.withColumn("_q_words", F.array_remove(F.split(t, WORD_GAP), ""))
    step = step.withColumn("_q_lines", F.filter(F.split(t, "\n", -1), lambda x: x.rlike(r"[^ \t-\r]")))
    step = step.withColumn(
        "_q_windows",
        F.expr("slice(transform(_q_words, (w, i) -> xxhash64(w, get(_q_words, i + 1), get(_q_words, i + 2))), 1, greatest(0, size(_q_words) - 2))"),
    )
    step = step.withColumn("_q_sorted", F.sort_array("_q_windows"))
    step = step.withColumn(
        "_q_single",
        F.expr("filter(_q_sorted, (x, i) -> not (x <=> get(_q_sorted, i - 1)) and not (x <=> get(_q_sorted, i + 1)))"),
    )
    step = step.withColumn(
        "_q_once",
        F.expr("if(size(_q_single) = size(_q_windows), _q_windows, array_intersect(_q_windows, _q_single))"),
    )
    repeated = F.expr(
        """if(size(_q_once) = size(_q_windows), 0, aggregate(_q_windows,
             named_struct('i', 0, 'k', 0, 'last', -3, 'n', 0),
             (a, x) -> if(x <=> get(_q_once, a.k),
               named_struct('i', a.i + 1, 'k', a.k + 1, 'last', a.last, 'n', a.n),
               named_struct('i', a.i + 1, 'k', a.k, 'last', a.i, 'n', a.n + least(3, a.i - a.last))),
             a -> a.n))"""
    )
    joined = F.concat_ws("", "_q_words")

    def without(pattern: str) -> Column:
        return F.length(F.regexp_replace(joined, pattern, ""))

    step = step.withColumn(
        "_q",
        F.struct(
            F.size("_q_words").cast("bigint").alias("n_words"),
            F.length(joined).cast("bigint").alias("word_chars"),
            (F.length(joined) - without(SYMBOLS)).cast("bigint").alias("n_symbols"),
            (F.size("_q_lines") - F.size(F.array_distinct("_q_lines"))).cast("bigint").alias("n_dup_lines"),
            repeated.cast("bigint").alias("n_repeat_words"),
            F.size("_q_lines").cast("bigint").alias("n_lines"),
            without(r"[^\p{L}]+").cast("bigint").alias("n_letters"),
            (F.length(joined) - without(r"[.!?]")).cast("bigint").alias("n_ends"),
        ),
    )
    return step.select(*[F.col(f"`{c}`") for c in docs.columns], "_q")


def base_failed() -> Column:
    return (F.col("_q.n_words") < MIN_WORDS) | (
        F.lit(100) * F.col("_q.n_repeat_words") > F.lit(MAX_REPEAT_PERCENT) * F.col("_q.n_words")
    )


def _vote(rule: Rule) -> Column:
    names = "n_words word_chars n_symbols n_dup_lines n_repeat_words n_lines n_letters n_ends".split()
    sql = f"case when {rule.junk} then -1 when {rule.good} then 1 else 0 end"
    for name in names:
        sql = sql.replace(name, f"_q.{name}") if f"_q.{name}" not in sql else sql
    return F.expr(sql)


def votes(measured: DataFrame, rules=RULES) -> DataFrame:
    """Adds ``_v``: one vote per rule, 1 good, -1 junk, 0 none. A text without words gets none but for its length."""
    return measured.withColumn("_v", F.array(*[_vote(r).cast("int") for r in rules]))


def _score(model: list[tuple[float, float, float]], bias: float) -> Column:
    """Posterior probability of a good document: the prior's log odds plus those of every vote."""
    z = F.lit(bias)
    for i, (junk, none, good) in enumerate(model):
        v = F.get("_v", F.lit(i))
        z = z + F.when(v == -1, junk).when(v == 1, good).otherwise(none)
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def _log_odds(good: list, junk: list) -> tuple[float, float, float]:
    return tuple(math.log(g / sum(good)) - math.log(j / sum(junk)) for g, j in zip(good, junk))


def fit(patterns: DataFrame, n_rules: int) -> tuple[list[tuple[float, float, float]], float]:
    """Log odds of each rule's junk, missing and good vote, and of the prior, from vote patterns ``_v`` with counts ``n``.

    Expectation: the posterior of each pattern. Maximisation: how often each rule votes what in either class.
    Each round is one aggregate over the patterns and brings four sums per rule to the driver. Without rows, the beliefs hold.
    """
    model = [_log_odds(BELIEVED["good"], BELIEVED["junk"])] * n_rules
    bias = math.log(START_QUALITY / (1 - START_QUALITY))
    for _ in range(ITERATIONS):
        sums = [F.sum("n"), F.sum("_g")]
        for i in range(n_rules):
            for vote in (-1, 1):
                hit = F.get("_v", F.lit(i)) == vote
                sums += [F.sum(F.when(hit, F.col("_g")).otherwise(0.0)), F.sum(F.when(hit, F.col("n")).otherwise(0))]
        row = patterns.withColumn("_g", F.col("n") * _score(model, bias)).agg(*[s.alias(f"s{i}") for i, s in enumerate(sums)]).first()
        if not row[0]:
            break
        total, good = row[0], row[1]
        share = min(MOST, max(LEAST, good / total))
        bias = math.log(share / (1 - share))
        model = []
        for i in range(n_rules):
            g_junk, n_junk, g_good, n_good = row[2 + 4 * i:6 + 4 * i]
            in_good = [g_junk, good - g_junk - g_good, g_good]
            in_all = [n_junk, total - n_junk - n_good, n_good]
            model.append(_log_odds(
                [max(0.0, g) + BELIEF * total * b for g, b in zip(in_good, BELIEVED["good"])],
                [max(0.0, n - g) + BELIEF * total * b for n, g, b in zip(in_all, in_good, BELIEVED["junk"])],
            ))
    return model, bias


def judge(docs: DataFrame, text: str = "text", keep: list[str] | None = None, rules=RULES) -> DataFrame:
    """Columns ``keep`` of ``docs`` plus ``_q`` (measures), ``_good`` (posterior) and ``_kept``.

    The measured rows are written once, as both the model and its use read them. Rows are judged one by
    one, so repeated rows get the same verdict; an empty table gives an empty result.
    """
    keep = list(docs.columns) if keep is None else keep
    measured = measures(docs, text).select(*[F.col(f"`{c}`") for c in keep], "_q")
    table = materialize(votes(measured, rules), "quality")
    patterns = materialize(table.groupBy("_v").agg(F.count(F.lit(1)).alias("n")).coalesce(1), "votes")
    model, bias = fit(patterns, len(rules))
    good = _score(model, bias)
    return table.withColumn("_good", good).withColumn("_kept", ~base_failed() & (F.col("_good") >= 0.5)).drop("_v")


def digest(docs: DataFrame) -> DataFrame:
    """The columns of query op10, and the posterior."""
    return judge(docs.select("doc_id", "text"), keep=["doc_id"]).select(
        "doc_id",
        *[F.col(f"_q.{c}").alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        base_failed().alias("base_failed"),
        F.col("_kept").alias("kept"),
        F.round("_good", 6).alias("quality"),
    )


def filter_good(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, columns unchanged, whatever their names.

    Measures are taken twice, for the model and for its use: that costs no second copy of the texts.
    """
    return apart(docs, _filter_good, text=text)


def _filter_good(docs: DataFrame, text: str) -> DataFrame:
    voted = votes(measures(docs, text))
    model, bias = fit(materialize(voted.groupBy("_v").agg(F.count(F.lit(1)).alias("n")).coalesce(1), "votes"), len(RULES))
    good = ~base_failed() & (_score(model, bias) >= 0.5)
    # A filter would be pushed below the measures, and each would be taken once per mention; a generator is not.
    kept = voted.withColumn("_once", F.explode(F.when(good, F.array(F.lit(1))).otherwise(F.array().cast("array<int>"))))
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
