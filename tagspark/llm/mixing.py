"""Mixing sources to target weights by entropy balancing.

Every word of the corpus gets a rate; the rates stay as close to one as the
targets allow (least relative entropy to the corpus) under one constraint per
source: its words times their rates are its target. The dual is convex and
smooth, with rates ``exp(lambda of the source)``; its gradient and curvature are
sums over documents, which are added up per source before the iterations
because documents of a source share the tilt. Newton steps then run for all
sources at once, one row each.

Rates become copies: every document is taken ``floor(rate)`` times, and the rest
of the target is filled by one more copy of documents in hash order. Where that
order is cut is found by counting words per hash bucket, twice, so only the
documents of one small bucket are ever ranked. What is left open there is filled
with smaller documents, first fit through the whole order: every round over the
documents that fit halves what is open, by sums over the same buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import cut_lineage
from .rows import content_hash, whole

WORD = r"[^\x20\x09-\x0D]+"
CAP = 3
WEIGHTS = (1, 2, 3)
STEPS = 40
#: When no source has more documents that fit what is open, they are folded in one row.
FOLD = 256
#: Hex digits of the order key that name a bucket, at either level.
DIGITS = 3


def size_in_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, cap: int = CAP, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``source, source_size, weight, target`` from one row per document.

    Weights repeat over the sources by code point, NULL last. Each source's
    target is the smaller of ``cap`` times its size and a level times its weight; the level
    that shares out all words is where passing the excess on ends. Sources are
    ordered in one task: one row per source, never per document.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    rank = (F.row_number().over(by_name) - 1) % len(weights)
    named = totals.withColumn("weight", F.array(*[F.lit(w) for w in weights])[rank])
    # By the level at which a source stops, those before it are full.
    filled = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").isNull(), "source")
    before = filled.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    left = F.sum("source_size").over(whole) - cap * F.coalesce(F.sum("source_size").over(before), F.lit(0))
    heavy = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    stated = named.select("source", "source_size", "weight", left.alias("left"), heavy.alias("heavy"))
    full = F.col("left") * F.col("weight") > cap * F.col("source_size") * F.col("heavy")
    level = F.max(F.when(~full, F.col("left") / F.col("heavy"))).over(whole)
    target = F.when(full, (cap * F.col("source_size")).cast("double")).otherwise(level * F.col("weight"))
    return stated.select("source", "source_size", "weight", F.coalesce(target, F.lit(0.0)).alias("target"))


def balance(targets: DataFrame, steps: int = STEPS) -> DataFrame:
    """Add ``rate``: the tilt ``exp(lambda)`` of each source's words.

    Newton on the dual ``size * exp(lambda) - target * lambda``; a step is held
    within one, which keeps the first ones from overshooting. Without words the rate is 0.
    """
    size, target = F.col("source_size").cast("double"), F.col("target")

    def newton(at: Column, _: Column) -> Column:
        mass = size * F.exp(at)
        return at - F.greatest(F.lit(-1.0), F.least(F.lit(1.0), (mass - target) / mass))

    tilt = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), F.lit(0.0), newton)
    return targets.withColumn("rate", F.when((size > 0) & (target > 0), F.round(F.exp(tilt), 9)).otherwise(F.lit(0.0)))


def _order(id_column: str) -> Column:
    return F.md5(F.coalesce(F.col(id_column).cast("string"), F.lit("")))


def _row_hash(text: str, source: str) -> Column:
    return F.xxhash64(F.col(text), F.col(source), F.col(source).isNull())


def _buckets(rows: DataFrame, keys: list[str], bucket: str) -> DataFrame:
    """Words of each bucket's predecessors. At most ``16 ** DIGITS`` rows per key."""
    sums = rows.groupBy(*keys, bucket).agg(F.sum("size").alias("words"))
    over = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    return sums.withColumn("before", F.coalesce(F.sum("words").over(over), F.lit(0)))


def mix(docs: DataFrame, id_column: str = "doc_id", text: str = "text", source: str = "source",
        cap: int = CAP, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``doc_id, size, source_size, target, copies, taken, row_hash`` of every row.

    ``taken`` is ``copies * size`` with at most ``cap`` copies. The words taken from a
    source never exceed its target, and fall short of it by less than one document. NULL and
    empty texts have size 0 and are taken as often as the floor of their source's rate;
    rows with a NULL source are a source of their own; repeated rows are ranked one
    after the other. Reruns agree: order keys are hashes of ids and sums are of whole numbers.
    """
    sizes = cut_lineage(docs.select(
        F.col(id_column).alias("doc_id"), F.col(source).alias("source"), size_in_words(F.col(text)).alias("size"),
        _row_hash(text, source).alias("row_hash"), _order(id_column).alias("h")))
    keys = ["s0", "s1"]
    key = [F.coalesce("source", F.lit("")).alias("s0"), F.col("source").isNull().alias("s1")]
    targets = balance(source_targets(sizes, cap, weights)).withColumn("floor", F.floor("rate")).select(
        *key, "source_size", "target", "floor", (F.col("target") - F.col("floor") * F.col("source_size")).alias("extra"))
    rows = sizes.select("doc_id", "size", "row_hash", "h", *key, F.substring("h", 1, DIGITS).alias("b1"),
                        F.substring("h", 1 + DIGITS, DIGITS).alias("b2"))
    # Whole buckets below the cut are taken; in the one that holds it the second digits decide.
    after = F.col("before") + F.col("words")
    first = cut_lineage(_buckets(rows, keys, "b1").join(targets, keys).withColumn("more", after <= F.col("extra")).withColumn(
        "cut", (F.col("before") < F.col("extra")) & (after > F.col("extra"))).drop("words"))
    whole = rows.join(first.where("NOT cut"), [*keys, "b1"])
    inside = rows.join(first.where("cut").drop("more"), [*keys, "b1"])
    second = _buckets(inside, [*keys, "b1"], "b2").select(*keys, "b1", "b2", F.col("before").alias("before2"))
    over = Window.partitionBy(*keys, "b1", "b2").orderBy("h", "size", "row_hash").rowsBetween(Window.unboundedPreceding, 0)
    reached = F.col("before") + F.col("before2") + F.sum("size").over(over)
    ranked = inside.join(second, [*keys, "b1", "b2"]).withColumn("more", reached <= F.col("extra"))
    columns = [*keys, "doc_id", "h", "size", "source_size", "target", "floor", "more", "row_hash", "extra"]
    marked = cut_lineage(whole.select(*columns).union(ranked.select(*columns)))
    filled = marked.join(_fill(marked, keys), [*keys, "h", "size", "row_hash"], "left")
    nth = F.row_number().over(Window.partitionBy(*keys, "h", "size", "row_hash", "more").orderBy("doc_id"))
    more = F.col("more") | (nth <= F.coalesce("fills", F.lit(0)))
    copies = F.least(F.col("floor") + more.cast("long"), F.lit(cap)).cast("long")
    return filled.withColumn("copies", copies).select(
        "doc_id", "size", F.col("source_size").cast("long").alias("source_size"), "target", "copies",
        (F.col("copies") * F.col("size")).cast("long").alias("taken"), "row_hash")


def _fill(marked: DataFrame, keys: list[str], fold: int = FOLD) -> DataFrame:
    """Documents behind the cut that fit into what it leaves open, first fit in hash order, all of them tried.

    While half of the gap is open, a document of at most half of it always fits. So the
    sums of those before it tell for every document whether the first fit comes to it with half
    the gap open, and the first that takes more than the rest of that half ends a round.
    """
    order = ["h", "size", "row_hash", "nth"]
    same = Window.partitionBy(*keys, "h", "size", "row_hash").orderBy("h")
    gaps = cut_lineage(marked.groupBy(*keys).agg((F.first("extra") - F.sum(F.when(F.col("more"), F.col("size")).otherwise(0))).alias("gap")))
    # Numbered before the join, whose shuffle by source would bring a source into one window task.
    rest = marked.where("NOT more AND size > 0").withColumn("nth", F.row_number().over(same)).join(gaps, keys).where("size <= gap")
    rest = cut_lineage(rest.select(*keys, *order, "gap", F.substring("h", 1, DIGITS).alias("b1"), F.substring("h", 1 + DIGITS, DIGITS).alias("b2")))
    taken = []
    while (rest.groupBy(*keys).count().agg(F.max("count").alias("n")).first()["n"] or 0) > fold:
        minor = F.when(F.col("size") * 2 <= F.col("gap"), F.col("size")).otherwise(0)
        sized = rest.withColumn("whole", F.col("size")).withColumn("size", minor)
        first = _buckets(sized, keys, "b1").select(*keys, "b1", F.col("before").alias("before1"))
        second = _buckets(sized, [*keys, "b1"], "b2").select(*keys, "b1", "b2", F.col("before").alias("before2"))
        within = Window.partitionBy(*keys, "b1", "b2").orderBy("h", "whole", "row_hash", "nth").rowsBetween(Window.unboundedPreceding, 0)
        before = second.join(first, [*keys, "b1"])
        ranked = sized.withColumn("inside", F.sum("size").over(within)).join(before, [*keys, "b1", "b2"])
        ranked = cut_lineage(ranked.withColumn("sum", F.col("before1") + F.col("before2") + F.col("inside")).select(
            *keys, "h", F.col("whole").alias("size"), "row_hash", "nth", "gap", "b1", "b2", "sum", (F.col("size") > 0).alias("minor")))
        ends = F.when(F.col("minor"), F.col("sum") * 2 > F.col("gap")).otherwise(F.col("sum") + F.col("size") <= F.col("gap"))
        end = ranked.where(ends).groupBy(*keys).agg(F.min(F.struct(*order, "sum", "minor")).alias("end"))
        # Without an end all minor documents are taken, and no other fits any more.
        ruled = ranked.join(end, keys, "left")
        at, here = F.col("end"), F.struct(*order)
        last = here == F.struct(*[at[c].alias(c) for c in order])
        ruled = cut_lineage(ruled.withColumn("took", F.when(at.isNull(), F.col("minor")).otherwise(
            last | (F.col("minor") & (F.col("sum") <= at["sum"])))).withColumn("gap", F.when(at.isNull(), 0).otherwise(
                F.col("gap") - at["sum"] - F.when(at["minor"], 0).otherwise(at["size"]))).withColumn(
            "later", ~F.col("took") & at.isNotNull() & (here > F.struct(*[at[c].alias(c) for c in order]))))
        taken.append(ruled.where("took").select(*keys, "h", "size", "row_hash"))
        rest = ruled.where("later AND size <= gap").select(*keys, *order, "gap", "b1", "b2")
    tried = rest.groupBy(*keys).agg(F.first("gap").alias("gap"), F.sort_array(F.collect_list(F.struct(*order))).alias("tried"))
    start = F.struct(F.col("gap").alias("gap"), F.array().cast("array<int>").alias("taken"))

    def step(state: Column, i: Column) -> Column:
        size = F.element_at(F.col("tried"), i)["size"]
        fit = size <= state["gap"]
        return F.struct((state["gap"] - F.when(fit, size).otherwise(0)).alias("gap"),
                        F.when(fit, F.concat(state["taken"], F.array(i))).otherwise(state["taken"]).alias("taken"))

    end = F.aggregate(F.sequence(F.lit(1), F.size("tried")), start, step)
    chosen = tried.select(*keys, "tried", F.explode(end["taken"]).alias("i")).select(
        *keys, F.element_at("tried", F.col("i")).alias("x")).select(*keys, "x.h", "x.size", "x.row_hash")
    for part in taken:
        chosen = chosen.union(part)
    return chosen.groupBy(*keys, "h", "size", "row_hash").agg(F.count("*").alias("fills"))


def repeat_rows(docs: DataFrame, id_column: str = "doc_id", text: str = "text", source: str = "source",
                cap: int = CAP, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Each row as often as the mix takes it, all columns kept.

    Identical rows share what they are taken together. Extra columns, their names and
    their types do not matter.
    """
    taken = mix(docs, id_column, text, source, cap, weights).groupBy("doc_id", "row_hash").agg(
        F.sum("copies").alias("copies"), F.count("*").alias("alike")).where("copies > 0").withColumnsRenamed({"doc_id": "taken_id", "row_hash": "taken_hash"})
    rows = docs.select(F.col(id_column).alias("id"), _row_hash(text, source).alias("hash"), content_hash(docs).alias("content"), whole(docs))
    rows = rows.join(taken, F.col("id").eqNullSafe(F.col("taken_id")) & (F.col("hash") == F.col("taken_hash")))
    nth = F.row_number().over(Window.partitionBy("id", "hash").orderBy("content"))
    each = F.floor(F.col("copies") / F.col("alike")) + (nth <= F.col("copies") % F.col("alike")).cast("long")
    rows = rows.withColumn("take", each).where("take > 0")
    return rows.select("row", F.explode(F.sequence(F.lit(1), F.col("take")))).select("row.*")
