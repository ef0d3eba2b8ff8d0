"""Exact, repeatable splits without sorting the table.

Rows are ordered by ``md5(seed|key)``. "The first k keys" becomes "keys up to
the k-th smallest hash", and that one is found by counting 65,536 hash buckets
and ranking inside a single bucket. The split itself is then a filter.
"""

from __future__ import annotations

import math
import operator
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.hashing import bucket, order_key
from ..session import cut_lineage
from .profile import long_rows

#: With so many labels there are no more combinations than may be broadcast.
PROVEN_LABELS = 12


def hash_cutoffs(keys: DataFrame, wanted: DataFrame) -> DataFrame:
    """``(stratum, k, cutoff)``: the k-th smallest hash of each stratum.

    ``keys`` has ``stratum`` and ``h`` (one row per key), ``wanted`` has
    ``stratum`` and ``k``; ranks below 1 are left out.
    """
    counts = keys.groupBy("stratum", bucket(F.col("h")).alias("b")).agg(F.count("*").alias("n"))
    upto = Window.partitionBy("stratum").orderBy("b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cumulated = counts.withColumn("cum", F.sum("n").over(upto))
    edges = (
        cumulated.join(wanted.where("k >= 1"), "stratum")
        .where((F.col("k") <= F.col("cum")) & (F.col("k") > F.col("cum") - F.col("n")))
        .select("stratum", "k", "b", (F.col("k") - (F.col("cum") - F.col("n"))).alias("inside"))
    )
    near = keys.withColumn("b", bucket(F.col("h"))).join(edges, ["stratum", "b"])
    rank = F.row_number().over(Window.partitionBy("stratum", "b", "k").orderBy("h"))
    return near.withColumn("r", rank).where("r = inside").select("stratum", "k", F.col("h").alias("cutoff"))


def nth_hash(keys: DataFrame, k: Column) -> Column:
    """Cutoff for the first ``k`` keys of an undivided table, as a scalar."""
    one = keys.select(F.lit(0).alias("stratum"), "h")
    wanted = keys.sparkSession.range(0, 1, 1, 1).select(F.lit(0).alias("stratum"), k.cast("bigint").alias("k"))
    return hash_cutoffs(one, wanted).select("cutoff").scalar()


def seeded_sample(df: DataFrame, row_id: str, n: int, seed: int = 42) -> DataFrame:
    """``n`` rows without replacement, the same ones in every run.

    The rows with the ``n`` smallest hashes; a table with fewer rows is taken
    whole.
    """
    keys = df.select(order_key(F.col(row_id), seed).alias("h"))
    cut = nth_hash(keys, F.lit(n))
    return df.where(order_key(F.col(row_id), seed) <= F.coalesce(cut, F.lit("g")))


def grouped_split(df: DataFrame, group: str, test_size: float = 0.2, seed: int = 42, fix: bool = False) -> DataFrame:
    """Add ``is_test``; all rows of a group fall on one side.

    Exactly ``int(n_groups * test_size)`` groups are test groups. ``fix`` finds
    the cutoff now (one text on the driver) instead of in every later job.
    """
    groups = df.select(group).distinct().select(order_key(F.coalesce(F.col(group).cast("string"), F.lit("\x00")), seed).alias("h"))
    k = groups.agg(F.floor(F.count("*") * test_size)).scalar()
    cut = nth_hash(groups, k)
    if fix:
        cut = F.lit(df.sparkSession.range(0, 1, 1, 1).select(cut.alias("cut")).first()["cut"]).cast("string")
    h = order_key(F.coalesce(F.col(group).cast("string"), F.lit("\x00")), seed)
    return df.withColumn("is_test", h <= F.coalesce(cut, F.lit("")))


def train_test(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return df.where("NOT is_test").drop("is_test"), df.where("is_test").drop("is_test")


def label_combination(labels: list[str]) -> Column:
    """Label flags as one text, e.g. ``0100``."""
    return F.concat(*[F.col(c).cast("string") for c in labels])


def _per_combination(table: DataFrame, labels: list[str]) -> DataFrame:
    """A table with one row per label combination, sent to every executor where
    the number of labels proves that it is small; otherwise the join shuffles."""
    return F.broadcast(table) if len(labels) <= PROVEN_LABELS else table


def _keys(df: DataFrame, labels: list[str], row_id: str, seed: int) -> DataFrame:
    return df.select(label_combination(labels).alias("stratum"), order_key(F.col(row_id), seed).alias("h"))


def stratified_quotas(keys: DataFrame, take: Column) -> DataFrame:
    """Rows to take per combination: the whole part of its share, then one
    more for the largest remainders until ``take`` (of the total) is met.

    One row per combination that occurs, so the window over all of them is small.
    """
    sizes = keys.groupBy("stratum").agg(F.count("*").alias("n"))
    everything = Window.partitionBy(F.lit(0))
    shares = sizes.select("stratum", "n", F.sum("n").over(everything).alias("total"))
    shares = shares.withColumn("take", take)
    exact = F.col("n") * F.col("take") / F.col("total")
    shares = shares.select("stratum", "n", "take", F.floor(exact).alias("base"),
                           F.round(exact - F.floor(exact), 9).alias("rest"))
    shares = shares.withColumn("left", F.col("take") - F.sum("base").over(everything))
    order = Window.partitionBy(F.lit(0)).orderBy(F.desc("rest"), "stratum")
    return shares.select("stratum", "n", (F.col("base") + (F.row_number().over(order) <= F.col("left")).cast("int")).alias("k"))


def stratified_sample(df: DataFrame, labels: list[str], row_id: str, n: int = 1000, seed: int = 42) -> DataFrame:
    """``n`` rows among those with a label, keeping the combination shares."""
    labelled = df.where(sum((F.col(c) for c in labels[1:]), F.col(labels[0])) > 0)
    keys = _keys(labelled, labels, row_id, seed)
    quotas = stratified_quotas(keys, F.least(F.lit(n).cast("bigint"), F.col("total"))).select("stratum", "k")
    cuts = hash_cutoffs(keys, quotas).select(F.col("stratum").alias("_stratum"), "cutoff")
    rows = labelled.withColumn("_combo", label_combination(labels))
    joined = rows.join(_per_combination(cuts, labels), F.col("_combo") == F.col("_stratum"))
    return joined.where(order_key(F.col(row_id), seed) <= F.col("cutoff")).drop("_combo", "_stratum", "cutoff")


def _whole_parts(n: Column, shares: list[float]) -> list[Column]:
    """How many of ``n`` rows are certain to go to the first side, the first two, and so on."""
    whole = [F.floor(F.round(n * s, 9)) for s in shares]
    return [sum(whole[1:i + 1], whole[0]) for i in range(len(whole))]


def _quotas(deficits: list[float], behind: list[float], m: int) -> list[int]:
    """``m`` rows dealt in proportion to what the sides lack; leftover units to
    the largest remainders, then to the side that lacks most rows altogether."""
    lack = [max(d, 0.0) for d in deficits]
    if sum(lack) == 0:
        lack = [1.0] * len(lack)
    exact = [m * d / sum(lack) for d in lack]
    out = [math.floor(round(x, 9)) for x in exact]
    order = sorted(range(len(out)), key=lambda j: (-round(exact[j] - out[j], 9), -round(behind[j], 9), j))
    for j in order[:m - sum(out)]:
        out[j] += 1
    return out


def _nth_hashes(keys: DataFrame, ranks: list[int]) -> dict[int, str]:
    """The ``k``-th smallest ``h`` for each ``k``: the driver sees one count per bucket, a bucket alone is ranked."""
    at = bucket(F.col("h"))
    edges: dict[tuple[int, int], int] = {}
    below = 0
    for b, n in sorted(keys.groupBy(at.alias("b")).agg(F.count("*")).collect()):
        edges |= {(b, k - below): k for k in ranks if below < k <= below + n}
        below += n
    if not edges:
        return {}
    nth = F.row_number().over(Window.partitionBy("b").orderBy("h"))
    near = keys.withColumn("b", at).where(F.col("b").isin([b for b, _ in edges])).withColumn("r", nth)
    hit = reduce(operator.or_, [(F.col("b") == b) & (F.col("r") == r) for b, r in edges])
    return {edges[row["b"], row["r"]]: row["h"] for row in near.where(hit).collect()}


def _settle(rest: DataFrame, unlabelled: DataFrame, n_labels: int, wanted: list[list[float]], shares: list[float]) -> list[tuple[int, list[str]]]:
    """Rounds ``(label, cutoffs)`` that give every row of ``rest`` and of ``unlabelled`` a side.

    ``rest`` has ``stratum`` (the flags, one set at least) and ``h``; ``unlabelled``
    has ``h``. ``wanted[l][j]`` is what label ``l`` still lacks on side ``j``, the
    last ``l`` standing for all rows. Each round takes the open label with the
    fewest open rows and cuts those, in hash order, in proportion to what the label
    lacks; rows without a label come last and settle the total.
    The driver holds one small table of labels and sides; there are at most as
    many rounds as labels, and one more.
    """
    everything = n_labels
    wanted = [list(w) for w in wanted]
    holds = [F.substring("stratum", i + 1, 1) == "1" for i in range(n_labels)] + [F.lit(True)]
    rounds: list[tuple[int, list[str]]] = []
    counts = list(rest.agg(*[F.count_if(h) for h in holds]).first())
    counts[everything] += unlabelled.count()
    while any(counts):
        taken = [label for label, _ in rounds]
        is_open = F.lit(True)
        for label in taken:
            is_open = is_open & ~holds[label]
        left = rest.where(is_open)
        label = min((i for i in range(n_labels + 1) if counts[i]), key=lambda i: (i == everything, counts[i], i))
        lacks = wanted[everything] if counts[label] == counts[everything] else wanted[label]
        quotas = _quotas(lacks, wanted[everything], counts[label])
        upto = [sum(quotas[:i + 1]) for i in range(len(quotas) - 1)]
        keys = unlabelled if label == everything else left.where(holds[label]).select("h")
        found = _nth_hashes(keys, sorted(set(upto)))
        cutoffs = [found.get(k, "") for k in upto]
        rounds.append((label, cutoffs))
        if label == everything:
            break
        side = _side_of(F.col("h"), cutoffs)
        got = left.where(holds[label]).agg(*[F.count_if(h & (side == j)) for h in holds for j in range(len(shares))]).first()
        for i in range(n_labels + 1):
            for j in range(len(shares)):
                wanted[i][j] -= got[i * len(shares) + j]
                counts[i] -= got[i * len(shares) + j]
    return rounds


def _side_of(h: Column, cutoffs: list[str]) -> Column:
    return sum(((h > F.lit(c)).cast("int") for c in cutoffs), F.lit(0))


def assign_sides(df: DataFrame, labels: list[str], row_id: str, shares: list[float], seed: int = 42, column: str = "side") -> DataFrame:
    """Add ``column``: the side (0, 1, …) of every row, so that each label has ``shares`` of its rows on each side.

    A combination of labels first gives every side the whole part of its share.
    The labelled rows left over, few where combinations are frequent and all of them where
    every row has its own, are settled label by label, the rarest first, against
    what each label lacks on each side; rows without labels come last and settle the
    totals, as far as they suffice. A side is the row's hash compared with
    cutoffs that are found by counting: no table is sorted, and ``df`` is read
    once more than the counting does. A label whose rows nearly all hold rarer labels
    is shared out with those and may drift as in a split by hash alone. Flags are 0 or 1; a row with a NULL flag
    counts as one without labels. Rows
    alike in id and labels share a side, NULL being an id too.
    """
    rows = df.withColumn("_combo", F.coalesce(label_combination(labels), F.lit("0" * len(labels))))
    name = F.coalesce(F.col(row_id).cast("string"), F.lit("\x00"))
    h, again = order_key(name, seed), order_key(name, seed + 1)
    keys = cut_lineage(rows.select(F.col("_combo").alias("stratum"), h.alias("h"), again.alias("again")))
    bare = F.col("stratum") == "0" * len(labels)
    labelled, unlabelled = keys.where(~bare), keys.where(bare).select(F.col("again").alias("h"))
    sizes = cut_lineage(labelled.groupBy("stratum").agg(F.count("*").alias("n")))
    steps = [F.struct(F.lit(j).alias("j"), k.alias("k")) for j, k in enumerate(_whole_parts(F.col("n"), shares))]
    wanted = sizes.select("stratum", F.inline(F.array(*steps)))
    cuts = hash_cutoffs(labelled, wanted.select("stratum", "k").distinct())
    cuts = wanted.join(cuts, ["stratum", "k"], "left").groupBy("stratum").agg(
        F.sort_array(F.collect_list(F.struct("j", F.coalesce("cutoff", F.lit("")).alias("cutoff"))))["cutoff"].alias("cuts"))
    cuts = cut_lineage(cuts)

    def first_side(h: Column) -> Column:
        side = F.size(F.filter("cuts", lambda c: c < h))
        return F.when(F.col("cuts").isNotNull() & (side < len(shares)), side)

    placed = labelled.join(_per_combination(cuts, labels), "stratum").withColumn("side", first_side(F.col("h")))
    holds = [F.substring("stratum", i + 1, 1) == "1" for i in range(len(labels))] + [F.lit(True)]
    sums = placed.agg(*[F.count_if(h) for h in holds], *[F.count_if(h & (F.col("side") == j)) for h in holds for j in range(len(shares))]).first()
    n, s = len(holds), len(shares)
    sums = [*sums]
    sums[n - 1] += unlabelled.count()
    lacking = [[sums[i] * share - sums[n + i * s + j] for j, share in enumerate(shares)] for i in range(n)]
    rest = placed.where("side IS NULL").select("stratum", F.col("again").alias("h"))
    # Fewer rows than sides are left per combination: with few labels they fit one partition for certain.
    rest = cut_lineage(rest.coalesce(1) if len(labels) <= PROVEN_LABELS else rest)
    rounds = _settle(rest, unlabelled, len(labels), lacking, shares)

    settled = F.lit(0)
    for label, cutoffs in reversed(rounds):
        here = F.substring("_combo", label + 1, 1) == "1" if label < len(labels) else F.lit(True)
        settled = F.when(here, _side_of(again, cutoffs)).otherwise(settled)
    table = cuts.withColumnRenamed("stratum", "_stratum")
    joined = rows.join(_per_combination(table, labels), F.col("_combo") == F.col("_stratum"), "left")
    side = F.coalesce(first_side(h), settled)
    return joined.withColumn(column, side.cast("int")).drop("_combo", "_stratum", "cuts")


def stratified_split(df: DataFrame, labels: list[str], row_id: str, test_size: float = 0.2, seed: int = 42) -> DataFrame:
    """Add ``is_test`` so that every label keeps its share on both sides."""
    sides = assign_sides(df, labels, row_id, [test_size, 1 - test_size], seed, "is_test")
    return sides.withColumn("is_test", F.col("is_test") == 0)


def stratified_folds(df: DataFrame, labels: list[str], row_id: str, folds: int = 3, seed: int = 42) -> DataFrame:
    """Add ``fold`` so that every label is spread evenly over the folds."""
    return assign_sides(df, labels, row_id, [1 / folds] * folds, seed, "fold")


def split_report(df: DataFrame, labels: list[str], flag: str = "is_test") -> DataFrame:
    """Share of each label on both sides and their difference, in percent."""
    test = F.col(flag)

    def share(c: str, side: Column) -> Column:
        return F.coalesce(F.avg(F.when(side, F.col(c) * 100.0)), F.lit(0.0))

    rows = [(c, {"train_pct": share(c, ~test), "test_pct": share(c, test),
                 "diff": F.abs(share(c, ~test) - share(c, test))}) for c in labels]
    return long_rows(rows, "label", df)
