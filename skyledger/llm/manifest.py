"""A Merkle manifest of a data set: a digest per row, a tree per group, and one tree over the groups' roots.

A digest is the lowercase hex SHA-256 of its inputs, one after the other. A
leaf's inputs are its columns, each ``-`` if null, else its UTF-8 bytes' number,
``:``, and its value. Within a tree every ``FAN`` consecutive nodes, the last run
fewer, become their digest, until one is left.

All levels of a block of ``FAN ** BLOCK_LEVELS`` nodes are windows over one sort:
the first row of a node holds its digest, so on level ``k`` the siblings stand at
fixed offsets, multiples of ``FAN ** k``. Lag and lead fetch them, masked by the
node's slot and the length of its run; the row that is first child hashes the
parent. The tops of the blocks are the nodes of the next round. So no window
holds more than a block, however many rows a group has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch

FAN = 2
# 4,096 nodes, which is as many rows as Spark's windows hold in memory.
BLOCK_LEVELS = 12
_ROWS = 1 << 33


def digest(*inputs: Column) -> Column:
    return F.sha2(F.concat(*inputs), 256)


def leaf_digest(*values: Column) -> Column:
    def entry(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return digest(*[entry(v) for v in values])


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and the siblings on its way up give."""
    return F.aggregate(proof, leaf, lambda node, s: digest(s["left"], node, s["right"]))


def sibling_digest(proof: Column) -> Column:
    """The digest of all siblings of a proof, from the leaf up, left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def placed(rows: DataFrame, order: Sequence[Column]) -> tuple[DataFrame, int]:
    """The rows with ``pos``, their place from 0 in their ``tree``, and ``n``, its size; and the largest size.

    Sorted over range partitions, whose sizes by tree are summed up apart: no tree is brought to one task. Rows that
    are alike in ``order`` are placed by chance; ``order`` should end with what tells rows apart, lest many equal rows
    meet in one partition.
    """
    spark, folder = rows.sparkSession, scratch(rows.sparkSession, "manifest-places")
    dealt = rows.repartitionByRange(F.col("tree"), *order).sortWithinPartitions("tree", *order)
    dealt.select("*", F.spark_partition_id().alias("_part"), (F.monotonically_increasing_id() % _ROWS).alias("_row")).write.parquet(folder)
    dealt = spark.read.parquet(folder)
    # A row for each tree of each partition.
    counts = dealt.groupBy("tree", "_part").agg(F.count("*").alias("_n"), F.min("_row").alias("_first"))
    tree = Window.partitionBy("tree")
    before = F.coalesce(F.sum("_n").over(tree.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = counts.select("tree", "_part", (before - F.col("_first")).alias("_shift"), F.sum("_n").over(tree).alias("n"))
    most = sizes.agg(F.coalesce(F.max("n"), F.lit(0)).alias("most")).first().most
    pos = (F.col("_row") + F.col("_shift")).alias("pos")
    return dealt.join(sizes, ["tree", "_part"]).select(*rows.columns, pos, "n"), most


def climbed(nodes: DataFrame, base: int, fan: int, levels: int) -> DataFrame:
    """Nodes of level ``base`` with ``own_proof``, their siblings on the next ``levels`` levels, and ``top``, on the
    first row of a block, the node of that block ``levels`` further up.

    ``n`` is the number of leaves. A level that has one node only is the last.
    """
    width = fan**levels
    rows = nodes.select("*", F.expr(f"pos div {width}").alias("block"), F.col("digest").alias("_node"))
    window = Window.partitionBy("tree", "block").orderBy("pos")
    for k in range(levels):
        step = fan**k
        index, below = F.expr(f"pos div {step}"), fan ** (base + k)
        slot, count = index % fan, F.expr(f"(n + {below - 1}) div {below}")
        run = F.least(F.lit(fan), count - (index - slot))
        left = [F.when(slot >= j, F.lag("_node", j * step).over(window)).otherwise("") for j in range(fan - 1, 0, -1)]
        right = [F.when(slot + j < run, F.lead("_node", j * step).over(window)).otherwise("") for j in range(1, fan)]
        grows = F.col("n") > below
        siblings = F.struct(F.concat(*left).alias("left"), F.concat(*right).alias("right"))
        rows = rows.withColumn(f"_s{k}", F.when(grows & (F.col("pos") % step == 0), siblings))
        parent = F.when(grows, digest(F.col("_node"), F.col(f"_s{k}.right"))).otherwise(F.col("_node"))
        rows = rows.withColumn("_node", F.when(F.col("pos") % (step * fan) == 0, parent))
    # The siblings of the nodes a row is under stand on the last first row up to it.
    so_far = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = [F.last(f"_s{k}", ignorenulls=True).over(so_far) for k in range(levels)]
    return rows.select(*nodes.columns, "block", F.array_compact(F.array(*found)).alias("own_proof"), F.col("_node").alias("top"))


def proofs(nodes: DataFrame, most: int, forest: bool = True, base: int = 0, fan: int = FAN, levels: int = BLOCK_LEVELS) -> DataFrame:
    """``tree, pos, n, digest`` and what else is there, with ``proof`` and ``root``; with ``forest`` on through
    ``subroot``, the root of the tree, to the root over all trees, which are in the order of their names.

    Nodes of level ``base``; the largest tree has ``most`` leaves. A round reads its nodes twice, once for the tops of
    its blocks and once for the proofs: cheaper than to keep every row's siblings.
    """
    spark = nodes.sparkSession
    up = climbed(nodes, base, fan, levels)
    own = F.col("own_proof")
    if most > fan ** (base + levels):
        folder = scratch(spark, "manifest-tops")
        first = up.filter(F.col("pos") % fan**levels == 0)
        first.select("tree", F.col("block").alias("pos"), "n", F.col("top").alias("digest")).write.parquet(folder)
        above = proofs(spark.read.parquet(folder), most, forest, base + levels, fan, levels)
        keys = [F.col("tree").alias("_tree"), F.col("pos").alias("_block")]
        found = [F.col(name) for name in above.columns if name in ("subroot", "root")]
        above = above.select(*keys, F.col("proof").alias("_proof"), *found)
        joined = up.join(above, (F.col("tree") == F.col("_tree")) & (F.col("block") == F.col("_block")))
        return joined.select(*nodes.columns, F.concat(own, "_proof").alias("proof"), *found)
    if not forest:
        first = F.first("top").over(Window.partitionBy("tree", "block").orderBy("pos"))
        return up.select(*nodes.columns, own.alias("proof"), first.alias("root"))
    # One block per tree: a tree's rows are few here.
    folder = scratch(spark, "manifest-subroots")
    up.filter("pos = 0").select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("top").alias("digest")).write.parquet(folder)
    trees, many = placed(spark.read.parquet(folder), [F.col("name")])
    over = proofs(trees, many, False, 0, fan, levels)
    over = over.select("name", F.col("digest").alias("subroot"), F.col("proof").alias("_proof"), "root")
    return up.join(over, F.col("tree") == F.col("name")).select(*nodes.columns, F.concat(own, "_proof").alias("proof"), "subroot", "root")


def manifest(
    docs: DataFrame,
    columns: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    group: str = "lang",
    order: str = "doc_id",
    extra: dict[str, Column] | None = None,
    fan: int = FAN,
    levels: int = BLOCK_LEVELS,
) -> DataFrame:
    """A row per row of ``docs``: ``order``, ``group``, the ``extra`` columns, ``leaf``, ``subroot``, ``root`` and
    ``proof``, the siblings on the way to the root as an array of ``left`` and ``right``.

    Groups go by the bytes of their names, null first; rows of a group by ``order``, null first. Repeated rows are
    leaves of their own; those alike in ``order`` go by their leaf. An empty text is a value of no bytes, a null none. A
    group of one row has its leaf as root, and so has a table of one row. No rows give no rows. Further columns of
    ``docs`` are ignored, whatever their names.
    """
    spark, folder = docs.sparkSession, scratch(docs.sparkSession, "manifest-leaves")
    # An empty name is no null.
    tree = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    leaf = leaf_digest(*[F.col(f"`{name}`") for name in columns])
    chosen = [F.col(order).alias("_order"), F.col(group).alias("_group"), tree.alias("tree"), leaf.alias("digest")]
    extra = extra or {}
    # Written with a number of its own, a row can be told from its copies in any later run.
    docs.select(*chosen, *[c.alias(f"_x_{name}") for name, c in extra.items()], F.monotonically_increasing_id().alias("_id")).write.parquet(folder)
    nodes, most = placed(spark.read.parquet(folder), [F.col("_order").asc_nulls_first(), F.col("digest"), F.col("_id")])
    found = proofs(nodes, most, True, 0, fan, levels)
    return found.select(
        F.col("_order").alias(order),
        F.col("_group").alias(group),
        *[F.col(f"_x_{name}").alias(name) for name in extra],
        F.col("digest").alias("leaf"),
        "subroot",
        "root",
        "proof",
    )


def document_manifest(docs: DataFrame, tamper_every: int = 7) -> DataFrame:
    """The manifest of ``documents``, and whether each row still has the root after some were tampered with: those whose
    id's crc32 ``tamper_every`` divides have one more in ``n_chars``, if it is not null. A null id is left alone."""
    docs = docs.select(*[F.col(n).cast(t).alias(n) for n, t in {"doc_id": "long", "source": "string", "lang": "string", "n_chars": "long", "text": "string"}.items()])
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % tamper_every == 0, F.lit(False))
    more = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("string")
    given = F.when(hit, leaf_digest(F.col("doc_id"), F.col("source"), F.col("lang"), more, F.col("text")))
    found = manifest(docs, extra={"given": given})
    again = folded(F.coalesce("given", "leaf"), F.col("proof"))
    out = found.select("doc_id", "leaf", "subroot", "root", sibling_digest(F.col("proof")).alias("proof_sha256"), again.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
