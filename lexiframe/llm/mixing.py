"""Mixing sources to target weights by Pareto order sampling, in DataFrame functions only.

Every source gets a target in words. A document is due ``target / source
size`` copies. Documents have no weights of their own: within a source all
have equal inclusion odds. The whole part of the copies is certain. The
fraction p is drawn: with u uniform from a hash of the id, documents are ranked
by u / (1 - u) divided by p / (1 - p), and the sample is the head of that order
whose words fill what the whole copies leave of the target. As documents differ
in length, the head stops short by part of a document; a second head, of the
documents that still fit, and one closing document, the nearest in length, take
up the rest.

All of this is a few thresholds for each source, so documents themselves are
never shuffled or ordered. Thresholds come from sums over bins of the order;
only the rows of the one bin in which the head ends are ordered one by one.

Null texts have no words; null sources are one source, the last in order; null
ids hash as empty. Rows with equal ids and lengths are one unit: they share
their draw and are taken together, and the closing unit is the one whose words
in all are nearest. Ties of rank are broken by id as text, then by length. A
very long text is a large unit like any other. An empty table gives an empty
mix. Other columns are ignored by ``plan_mix`` and kept
by ``mix``; a column that has the name of one of ours is left as it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiframe.llm.common import WORD, cut

#: No document is taken more often than this.
MAX_COPIES = 3
#: Bins of the order in each source.
BINS = 1024
#: Plans of up to so many sources are broadcast; larger ones are joined by shuffling.
BROADCAST_SOURCES = 10_000
HASH_DIGITS = 13


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(id_value: Column, seed: str) -> Column:
    """In [0, 1), from the first 52 bits of a digest of the id and the seed."""
    digest = F.md5(F.concat(F.lit(seed), F.coalesce(id_value.cast("string"), F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, HASH_DIGITS), 16, 10).cast("double") / float(16**HASH_DIGITS)


def draws(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: str = "mix") -> DataFrame:
    """The rows of ``docs`` as one struct ``doc``, beside what the plan reads: source, size, u and id as text."""
    return docs.select(
        F.struct("*").alias("doc"),
        F.col(source_col).cast("string").alias("source"),
        words_in(F.col(text_col)).alias("size"),
        uniform(F.col(id_col), seed).alias("u"),
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("key"),
    )


def targets(sources: DataFrame, max_copies: int = MAX_COPIES) -> DataFrame:
    """``source, source_size, weight`` with ``target``: shares of all words by weight, held at ``max_copies`` times the source.

    The excess goes to the other sources by weight until none is above. With
    sources in order of size for their weight, the held ones come first, so the
    common level is known from running sums. The table has one row a source.
    """
    limit = F.lit(float(max_copies)) * F.col("source_size")
    everything = Window.partitionBy()
    order = Window.orderBy(limit / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum(limit).over(before), F.lit(0.0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    )
    ranked = sources.select("*", level.alias("_level"), F.row_number().over(order).alias("_at"))
    free = F.col("_level") <= limit / F.col("weight")
    shared = ranked.withColumn("_share", F.min_by(F.when(free, F.col("_level")), F.when(free, F.col("_at"))).over(everything))
    held = limit / F.col("weight") < F.col("_share")
    return shared.select("source", "source_size", "weight", F.when(held, limit).otherwise(F.col("weight") * F.col("_share")).alias("target"))


def cycling_weights(sources: DataFrame, cycle: int = 3) -> DataFrame:
    """Weights 1, 2, ... repeating over the sources by code point, null last."""
    at = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    return sources.withColumn("weight", (at - 1) % cycle + 1)


def pareto_rank(u: Column, p: Column) -> Column:
    """Random odds over inclusion odds; null where nothing is drawn."""
    return F.try_divide(u / (1 - u) * (1 - p), p)


def head_of(rows: DataFrame, plan: DataFrame, eligible: Column, gap: str, name: str) -> DataFrame:
    """``plan`` with ``name``: the last (rank, key) of the head of each source whose words don't exceed ``gap``, and the gap left.

    ``name`` is null where not even the first eligible row fits.
    """
    joined = rows.join(plan_side(plan), F.col("source").eqNullSafe(F.col("p_source"))).where(eligible & (F.col(gap) > 0))
    rank = F.col("rank")
    binned = joined.select("source", "size", "key", "rank", gap, F.floor(rank / (1 + rank) * BINS).cast("int").alias("bin"))
    sums = binned.groupBy("source", "bin").agg(F.sum("size").alias("words"), F.max(F.struct("rank", "key")).alias("top"), F.max(gap).alias(gap))
    upto = Window.partitionBy("source").orderBy("bin")
    running = sums.withColumn("before", F.sum("words").over(upto) - F.col("words"))
    whole = running.where(F.col("before") + F.col("words") <= F.col(gap))
    broken = running.where(F.col("before") + F.col("words") > F.col(gap)).groupBy("source").agg(F.min_by("bin", "bin").alias("b_bin"), F.min_by("before", "bin").alias("b_before"))
    edge = binned.join(broken.withColumnRenamed("source", "b_source"), F.col("source").eqNullSafe(F.col("b_source")) & (F.col("bin") == F.col("b_bin")))
    inside = edge.withColumn("_upto", F.col("b_before") + F.sum("size").over(Window.partitionBy("source").orderBy("rank", "key")))
    taken = whole.select("source", F.col("top").alias(name), (F.col("before") + F.col("words")).alias("_words")).unionByName(
        inside.where(F.col("_upto") <= F.col(gap)).select("source", F.struct("rank", "key").alias(name), F.col("_upto").alias("_words"))
    )
    best = taken.groupBy(F.col("source").alias("t_source")).agg(F.max(name).alias(name), F.max("_words").alias("_words"))
    out = plan.join(best, F.col("source").eqNullSafe(F.col("t_source")), "left")
    return out.withColumn(f"{name}_gap", F.col(gap) - F.coalesce(F.col("_words"), F.lit(0))).drop("t_source", "_words")


def plan_side(plan: DataFrame) -> DataFrame:
    return plan.withColumnRenamed("source", "p_source")


def sized(plan: DataFrame) -> DataFrame:
    """``plan`` marked for a broadcast if it is short."""
    return F.broadcast(plan) if plan.count() <= BROADCAST_SOURCES else plan


def within(rank: Column, key: Column, last: str) -> Column:
    return F.coalesce(F.struct(rank.alias("rank"), key.alias("key")) <= F.col(last), F.lit(False))


def copies(rank: Column, size: Column, key: Column) -> Column:
    """Copies of a document joined with its source's plan."""
    first = within(rank, key, "head")
    second = ~first & (size > 0) & (size <= F.col("head_gap")) & within(rank, key, "fill")
    closing = ~first & ~second & F.coalesce((size == F.col("last_size")) & (key == F.col("last_key")), F.lit(False))
    drawn = (F.col("fraction") > 0) & (first | second | closing)
    return F.col("whole_copies") + F.when(drawn, 1).otherwise(0)


def plan_mix(rows: DataFrame, max_copies: int = MAX_COPIES) -> DataFrame:
    """Targets and thresholds of every source, from the rows that ``draws`` returns."""
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    aimed = targets(cycling_weights(sources), max_copies)
    due = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    plan = aimed.withColumn("whole_copies", F.floor(due).cast("int")).withColumn("fraction", due - F.col("whole_copies"))
    plan = cut(plan.withColumn("gap", F.col("fraction") * F.col("source_size")))
    drawn = rows.join(sized(plan.select(F.col("source").alias("f_source"), "fraction")), F.col("source").eqNullSafe(F.col("f_source")))
    ordered = drawn.where("fraction > 0").select("source", "size", "key", pareto_rank(F.col("u"), F.col("fraction")).alias("rank"))
    plan = cut(head_of(ordered, plan, F.lit(True), "gap", "head"))
    left = ~within(F.col("rank"), F.col("key"), "head")
    plan = cut(head_of(ordered, plan, left & (F.col("size") > 0) & (F.col("size") <= F.col("head_gap")), "head_gap", "fill"))
    left_over = left & ~((F.col("size") <= F.col("head_gap")) & within(F.col("rank"), F.col("key"), "fill")) & (F.col("size") > 0)
    unit = ["source", "rank", "key", "size", "fill_gap"]
    units = ordered.join(sized(plan_side(plan)), F.col("source").eqNullSafe(F.col("p_source"))).where(left_over & (F.col("size") < 2 * F.col("fill_gap")))
    miss = F.abs(F.col("words") - F.col("fill_gap"))
    nearest = (
        units.groupBy(*unit).agg(F.sum("size").alias("words"))
        .where(miss < F.col("fill_gap"))
        .groupBy(F.col("source").alias("n_source"))
        .agg(F.min(F.struct(miss.alias("miss"), "rank", "key", "size")).alias("last"))
        .select("n_source", F.col("last.key").alias("last_key"), F.col("last.size").alias("last_size"))
    )
    return cut(plan.join(nearest, F.col("source").eqNullSafe(F.col("n_source")), "left").drop("n_source"))


def with_copies(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """The rows that ``draws`` returns with their source's plan and ``copies``."""
    joined = rows.join(sized(plan_side(plan)), F.col("source").eqNullSafe(F.col("p_source")))
    return joined.withColumn("copies", copies(pareto_rank(F.col("u"), F.col("fraction")), F.col("size"), F.col("key")))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of the mix, each as often as it is taken, with the columns of ``docs``."""
    rows = draws(docs, id_col, text_col, source_col)
    plan = plan_mix(cut(rows.drop("doc")))
    return with_copies(rows, plan).select("doc.*", F.explode(F.array_repeat(F.lit(1), F.col("copies"))).alias("_copy")).drop("_copy")
