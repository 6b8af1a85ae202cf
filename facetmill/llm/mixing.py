"""Mixing sources to target weights by repetition rates. Built-in Spark functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..operators.joins import lookup_join
from ..session import materialize
from .names import apart

#: Source weights by code-point order of the source, repeating; null comes last.
WEIGHTS = (3, 1, 2)
#: Words the mix takes, as a share of all words; most repetitions of a source.
SHARE = 1.5
MOST_REPEATS = 2
SEED = "mix-1"
WORD_GAP = r"[ \t-\r]+"


def n_words(text: Column) -> Column:
    """Words of a whole text; zero for a null."""
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_GAP), "")).cast("bigint")


def source_key(source: Column) -> Column:
    """A join key that is never null: a null source is one source of its own, apart from every text."""
    return F.when(source.isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), source))


def targets(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST_REPEATS) -> DataFrame:
    """One row per source: ``_key, source_size, target``, from rows with ``_source`` and ``_size``.

    Words are summed per source before anything else moves, so a source with a third of all rows costs no
    more than any other. Weights fill up like water: in order of size per weight, a source is capped while
    the level that the remaining words would reach is above its cap; the rest share by weight.
    Sources without words get no target. The windows see one row per source.
    """
    per = sized.groupBy("_source").agg(F.sum("_size").alias("source_size"))
    order = Window.orderBy(F.col("_source").isNull(), F.col("_source"))
    place = F.row_number().over(order) - 1
    table = F.array(*[F.lit(w) for w in weights])
    per = per.withColumn("_rank", place).withColumn("_w", F.get(table, F.col("_rank") % len(weights)))
    per = per.withColumn("_cap", F.lit(most) * F.col("source_size"))
    every = Window.partitionBy()
    before = Window.orderBy(F.col("_cap") / F.col("_w"), "_rank").rowsBetween(Window.unboundedPreceding, -1)
    per = (
        per.withColumn("_all", F.least(F.lit(share) * F.sum("source_size").over(every), F.sum("_cap").over(every).cast("double")))
        .withColumn("_weights", F.sum("_w").over(every))
        .withColumn("_caps_before", F.coalesce(F.sum("_cap").over(before), F.lit(0)))
        .withColumn("_weights_before", F.coalesce(F.sum("_w").over(before), F.lit(0)))
    )
    full = (F.col("_all") - F.col("_caps_before")) * F.col("_w") >= F.col("_cap") * (F.col("_weights") - F.col("_weights_before"))
    per = per.withColumn("_full", full)
    rest = F.sum(F.when(~F.col("_full"), F.col("_w"))).over(every)
    left = F.col("_all") - F.coalesce(F.sum(F.when(F.col("_full"), F.col("_cap"))).over(every), F.lit(0))
    target = F.when(F.col("_full"), F.col("_cap").cast("double")).otherwise(
        F.least(F.col("_cap").cast("double"), left * F.col("_w") / rest)
    )
    return per.select(source_key(F.col("_source")).alias("_key"), "source_size", target.alias("target"))


def chance(doc_id: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) from the md5 of seed and id: the same in every run, task and engine."""
    code = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("null"))))
    return F.conv(F.substring(code, 1, 13), 16, 10).cast("bigint") / F.lit(float(2**52))


def copies(size: Column, source_size: Column, target: Column, doc_id: Column, seed: str = SEED) -> Column:
    """How often a document is emitted: floor(rate), and once more with the rate's fraction as probability."""
    rate = F.when(source_size > 0, target / source_size).otherwise(F.lit(0.0))
    whole = F.floor(rate)
    return (whole + F.when(chance(doc_id, seed) < rate - whole, 1).otherwise(0)).cast("bigint")


def plan(docs: DataFrame, keep: list[str], doc_id="doc_id", source="source", text="text", seed: str = SEED) -> DataFrame:
    """Columns ``keep`` of every row plus ``_size, source_size, target, _copies``.

    Rows are counted one by one: repeated rows with one id share their chance. Null sources form one source, null texts
    and texts without words have size zero and a rate like their source's. An empty table gives an empty plan.
    """
    c = [F.col(f"`{k}`") for k in keep]
    sized = docs.select(
        F.struct(*c).alias("_row"), F.col(f"`{doc_id}`").alias("_id"), F.col(f"`{source}`").alias("_source"),
        n_words(F.col(f"`{text}`")).alias("_size"), source_key(F.col(f"`{source}`")).alias("_key"),
    )
    if text not in keep:  # else words are counted twice, which costs less than a second copy of all texts
        sized = materialize(sized, "sizes")
    per = materialize(targets(sized), "targets")
    joined = lookup_join(sized, per, ["_key"], ["_id", "_size"])
    return joined.select(
        *[F.col(f"_row.`{k}`").alias(k) for k in keep], "_size", "source_size", "target",
        copies(F.col("_size"), F.col("source_size"), F.col("target"), F.col("_id"), seed).alias("_copies"),
    )


def mix(docs: DataFrame, doc_id="doc_id", source="source", text="text", seed: str = SEED) -> DataFrame:
    """The mix itself: every document as often as the plan says, columns unchanged, whatever their names."""
    return apart(docs, lambda d, **names: _mix(d, seed=seed, **names), doc_id=doc_id, source=source, text=text)


def _mix(docs: DataFrame, **names) -> DataFrame:
    planned = plan(docs, list(docs.columns), **names)
    times = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_copies")))
    return planned.filter("_copies > 0").withColumn("_copy", times).select(*[F.col(f"`{c}`") for c in docs.columns])


def digest(docs: DataFrame) -> DataFrame:
    """The columns of query op2."""
    return plan(docs, ["doc_id"]).select(
        "doc_id", F.col("_size").alias("size"), "source_size", "target", (F.col("_copies") * F.col("_size")).alias("taken")
    )
