"""Merkle dataset manifest by lag and lead windows.

Every row is a leaf; rows of one group form a tree in which up to ``FAN``
consecutive nodes hash to their parent, and the groups' subroots form a tree of
the same kind. A level is one set of window columns: ``lag`` and ``lead`` at
fixed offsets, masked by the node's slot in its run and by the length of that
run, give a node its siblings, and the first child of a run hashes the parent.

No window spans a group. Places are counted by range parts: a part numbers its
own rows and adds the rows of the parts before. Windows then cover chunks of
``FAN ** STEPS`` consecutive places, which is ``STEPS`` levels in one pass; the
chunks' top nodes are the leaves of the next pass, and paths come back down by a
join on the chunk, which shares the partitioning of the windows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import cut_lineage

FAN = 8
#: Levels worked out in one pass, and the places a window then covers.
STEPS = 3
CHUNK = FAN ** STEPS
#: Rows a range part holds on average once there are more than the session's shuffle partitions give.
PART_ROWS = 250_000


def digest(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of the parts one after the other."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """``-`` for NULL, else the byte count, a colon and the value as text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*columns: Column) -> Column:
    return digest(*[field(c) for c in columns])


def _tree_key(group: Column) -> Column:
    """A group's name that is never NULL and sorts NULL first, then by the bytes of the text."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit("-"))


def _placed(rows: DataFrame, order: list[str]) -> tuple[DataFrame, int]:
    """``rows`` with ``place`` (from 0, within ``tree``) and ``n`` (rows of the tree), and the largest ``n``.

    Rows alike in all of ``order`` are told apart by a number given before they
    are dealt out, so that a group of copies spreads over range parts too.
    """
    numbered = cut_lineage(rows.withColumn("tie", F.monotonically_increasing_id()))
    parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), numbered.count() // PART_ROWS)
    keys = ["tree", *order, "tie"]
    dealt = cut_lineage(numbered.repartitionByRange(parts, *keys).withColumn("part", F.spark_partition_id()))
    counts = dealt.groupBy("tree", "part").agg(F.count("*").alias("held"))
    before = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cut_lineage(counts.select(
        "tree", "part", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("before"),
        F.sum("held").over(Window.partitionBy("tree")).alias("n")))
    most = offsets.agg(F.max("n")).first()[0] or 0
    within = Window.partitionBy("tree", "part").orderBy(*order, "tie")
    placed = dealt.withColumn("nth", F.row_number().over(within)).join(offsets, ["tree", "part"])
    return placed.withColumn("place", F.col("before") + F.col("nth") - 1).drop("part", "nth", "before", "tie"), most


def _levels(nodes: DataFrame) -> DataFrame:
    """``STEPS`` levels over ``tree, place, n, digest``: adds ``chunk``, ``path`` and, on a chunk's first row, ``top``.

    ``path`` holds one ``struct<left, right>`` per level at which the tree still
    has several nodes: the digests of the siblings before and after, joined.
    """
    order = Window.partitionBy("tree", "chunk").orderBy("place")
    rows = nodes.withColumn("chunk", F.expr(f"place div {CHUNK}")).withColumn("d0", F.col("digest"))
    for level in range(STEPS):
        width = FAN ** level
        here = F.expr(f"place div {width}")
        left_of_level = F.expr(f"(n + {width - 1}) div {width}")
        slot = here % FAN
        run = F.least(F.lit(FAN), left_of_level - (here - slot))
        d = F.col(f"d{level}")
        before = [F.when(slot >= j, F.lag(d, j * width).over(order)) for j in range(FAN - 1, 0, -1)]
        after = [F.when(slot + j < run, F.lead(d, j * width).over(order)) for j in range(1, FAN)]
        is_node = d.isNotNull() & (left_of_level > 1)
        rows = rows.withColumns({
            f"left{level}": F.when(is_node, F.concat(*[F.coalesce(x, F.lit("")) for x in before])),
            f"right{level}": F.when(is_node, F.concat(*[F.coalesce(x, F.lit("")) for x in after]))})
        hashed = F.when(left_of_level > 1, digest(d, F.col(f"right{level}"))).otherwise(d)
        rows = rows.withColumn(f"d{level + 1}", F.when(d.isNotNull() & (slot == 0), hashed))
    # A node's row is the first of the rows below it: the last one seen is a row's ancestor.
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    steps = []
    for level in range(STEPS):
        pair = F.when(F.col(f"left{level}").isNotNull(), F.struct(
            F.col(f"left{level}").alias("left"), F.col(f"right{level}").alias("right")))
        steps.append(pair if level == 0 else F.last(pair, ignorenulls=True).over(so_far))
    path = F.filter(F.array(*steps), lambda s: s.isNotNull())
    return rows.withColumn("path", path).withColumn("top", F.col(f"d{STEPS}")).select(*nodes.columns, "chunk", "path", "top")


def _climb(nodes: DataFrame, most: int, above: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``nodes`` with ``path`` and the columns that ``above`` gives a tree.

    ``above`` takes ``tree, digest`` (the subroots) and returns ``tree, path`` and more.
    """
    local = _levels(nodes)
    tops = local.where("top IS NOT NULL").select(
        "tree", F.col("chunk").alias("place"), F.expr(f"(n + {CHUNK - 1}) div {CHUNK}").alias("n"), F.col("top").alias("digest"))
    tops = cut_lineage(tops)
    if most > CHUNK:
        over = _climb(tops, -(-most // CHUNK), above).drop("n", "digest")
    else:
        over = above(tops.select("tree", "digest")).withColumn("place", F.lit(0).cast("long"))
    over = over.withColumnsRenamed({"place": "chunk", "path": "path_above"})
    return local.drop("top").join(over, ["tree", "chunk"]).withColumn("path", F.concat("path", "path_above")).drop("path_above", "chunk")


def _root_of(subroots: DataFrame) -> DataFrame:
    """The tree over the groups: ``tree, subroot, path, root``."""
    nodes = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest")
    nodes, most = _placed(nodes, ["name"])
    ended = _climb(nodes, most, lambda top: top.select(
        "tree", F.col("digest").alias("root"), F.expr("CAST(array() AS array<struct<left: string, right: string>>)").alias("path")))
    return ended.select(F.col("name").alias("tree"), F.col("digest").alias("subroot"), "path", "root")


def manifest(docs: DataFrame, columns: list[str], group: str, id_column: str = "doc_id", carried: dict[str, Column] | None = None) -> DataFrame:
    """``doc_id, leaf, path, subroot, root`` and the carried columns, one row per input row.

    Leaves are digests of ``columns``. Within a group they ascend by id (NULL
    first, equal ids by leaf); groups ascend by name, NULL first, by bytes.
    ``path`` runs from the leaf's level to the root's. Rows alike in everything
    take neighbouring places, which of them takes which is open and makes no
    difference to the tree. NULL is a value of its own, as are empty texts; an
    empty table gives no rows. Columns of ``docs`` that are not named are not
    read; ``carried`` are further columns worked out in the same scan.
    """
    named = {f"c{i}": c for i, c in enumerate((carried or {}).values())}
    rows = docs.select(_tree_key(F.col(group)).alias("tree"), F.col(id_column).alias("id"),
                       leaf(*[F.col(c) for c in columns]).alias("digest"), *[c.alias(name) for name, c in named.items()])
    nodes, most = _placed(rows, ["id", "digest"])
    whole = _climb(nodes, most, _root_of)
    return whole.select(F.col("id").alias("doc_id"), F.col("digest").alias("leaf"), "path", "subroot", "root",
                        *[F.col(name).alias(given) for name, given in zip(named, carried or {})])


def proof_digest(path: Column) -> Column:
    """Digest of all siblings of a path in order."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def fold(leaf_digest: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf_digest, lambda h, s: digest(s["left"], h, s["right"]))


COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def verify_against_tampering(docs: DataFrame) -> DataFrame:
    """The manifest of ``documents``, each leaf checked against the root after some texts were tampered with.

    Tampering lower-cases A-Z where 3 divides the CRC-32 of the decimal id; a
    row without an id or text is left as it is.
    """
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    # Only leaves that tampering changes travel twice.
    tampered = F.when(hit & (lowered != F.col("text")), leaf(*[lowered if c == "text" else F.col(c) for c in COLUMNS]))
    rows = manifest(docs, COLUMNS, "lang", carried={"tampered": tampered})
    rows = rows.withColumn("folded_root", fold(F.coalesce("tampered", "leaf"), F.col("path")))
    return rows.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"),
                       "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
