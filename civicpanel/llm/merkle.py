"""A Merkle tree over the rows of a dataset, by sibling-shift self-joins.

A leaf is the digest of a row's fields. Leaves are numbered within their group (the value
of one column, NULL among them) in the order of their ids; every run of ``arity``
consecutive nodes becomes one node of the next level until a group has one node, its
subroot. The subroots, in the order of their groups, are the leaves of one more tree, whose
last node is the root.

Numbering: leaves are range-partitioned by (group, id, digest) and written with their place
in the partition; a place in the group is the place in the partition plus the rows of the
group in earlier partitions. So one group or one id may hold most of the rows.

A level: every node knows where its siblings are, by XOR for ``arity`` 2 and by slot offsets
otherwise. Nodes of slot 0 are joined with the nodes at those indices, one equi-join for each
slot, all on the same key, so nodes are exchanged once per level. The joined row is the run;
its digest is the node of the next level. A group that has come to one node takes it along.

Proofs go down again: the path of a node is that of its parent with the siblings to its left
and to its right in front. Only the parents' paths are shuffled, an eighth of the rows.

Null values are fields like others (`-`), null ids come first. Rows with the same id are
ordered by their digest, equal rows by nothing as they are interchangeable. Columns other
than those of ``fields`` and their names change nothing. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civicpanel.llm.common import written

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ARITY = 8
#: Rows of a level in one file, at most about.
FILE_ROWS = 1 << 14
PATH = "array<struct<left: string, right: string>>"


def digest(*parts: Column) -> Column:
    """Lowercase hexadecimal SHA-256 of the parts, joined; digests count as text."""
    return F.sha2(F.concat(*parts) if len(parts) > 1 else parts[0], 256)


def field(value: Column) -> Column:
    """A value so that no two lists of values read the same: its length in bytes and itself."""
    text = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(values: Sequence[Column]) -> Column:
    return digest(*[field(v) for v in values])


def numbered(rows: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """Add ``i``, the place of each row in its group (from 0), and ``n``, the size of the group.

    Groups are not NULL. The partitions are written first, so that places never change.
    """
    spread = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    spread = spread.withColumn("at", F.monotonically_increasing_id())
    spread = written(spread.withColumn("part", F.shiftright("at", 33)), "numbered")
    parts = spread.groupBy(group, "part").agg(F.count(F.lit(1)).alias("there"), F.min("at").alias("first"))
    before = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        group, "part", "first",
        F.coalesce(F.sum("there").over(before), F.lit(0)).alias("before"),
        F.sum("there").over(Window.partitionBy(group)).alias("n"),
    )
    placed = spread.join(parts, [group, "part"])
    return placed.withColumn("i", F.col("at") - F.col("first") + F.col("before")).drop("at", "part", "first", "before")


def sibling(place: Column, shift: int, arity: int) -> Column:
    """Place of the sibling that is ``shift`` slots after slot 0 of a run."""
    return place.bitwiseXOR(F.lit(1)) if arity == 2 else place + F.lit(shift)


def parents(nodes: DataFrame, arity: int = ARITY) -> DataFrame:
    """The next level of nodes (branch, i, n, h), with ``below``: the digests of the run, or NULL for a lone node."""
    slot = F.col("i") % arity
    runs = nodes.where(slot == 0).withColumn("run", F.col("i"))
    for shift in range(1, arity):
        # The joined node's place is the sibling's place of slot 0; moved back, all joins have one key.
        back = sibling(F.col("i"), -shift, arity)
        there = nodes.where(slot == shift).select("branch", back.alias("run"), F.col("h").alias(f"h{shift}"))
        runs = runs.join(there, ["branch", "run"], "left")
    run = F.array_compact(F.array("h", *[f"h{s}" for s in range(1, arity)]))
    lone = F.col("n") == 1
    return runs.select(
        "branch",
        F.floor(F.col("i") / arity).cast("long").alias("i"),
        F.ceil(F.col("n") / arity).cast("long").alias("n"),
        F.when(lone, F.col("h")).otherwise(digest(F.array_join(run, ""))).alias("h"),
        F.when(~lone, run).alias("below"),
    )


def few_files(nodes: DataFrame, rows: int) -> DataFrame:
    """Nodes in files of about ``FILE_ROWS``; levels shrink, and so do their files."""
    return nodes.coalesce(max(1, -(-rows // FILE_ROWS)))


def climb(nodes: DataFrame, rows: int, arity: int = ARITY) -> list[DataFrame]:
    """``nodes`` and the levels above, written, until every branch has one node: its last."""
    levels = [written(few_files(nodes, rows), "level")]
    most = levels[0].agg(F.max("n")).first()[0] or 0
    while most > 1:
        above = parents(levels[-1].select("branch", "i", "n", "h"), arity)
        rows = levels[-1].where(F.col("i") % arity == 0).count()
        levels.append(written(few_files(above, rows), "level"))
        most = -(-most // arity)
    return levels


def with_path(nodes: DataFrame, above: DataFrame, arity: int = ARITY) -> DataFrame:
    """Nodes with their path, ``subroot`` and ``root``, from the level above that has them."""
    up = above.select("branch", F.col("i").alias("up"), F.col("below").alias("run"), F.col("path").alias("path_up"), "subroot", "root")
    slot = (F.col("i") % arity).cast("int")
    left = F.array_join(F.slice("run", F.lit(1), slot), "")
    right = F.array_join(F.slice("run", slot + 2, F.lit(arity)), "")
    step = F.array(F.struct(left.alias("left"), right.alias("right")))
    joined = nodes.withColumn("up", F.floor(F.col("i") / arity).cast("long")).join(up, ["branch", "up"])
    path = F.when(F.col("run").isNull(), F.col("path_up")).otherwise(F.concat(step, F.col("path_up")))
    return joined.withColumn("path", path).drop("up", "run", "path_up")


def descend(tables: list[DataFrame], tops: DataFrame, arity: int = ARITY) -> DataFrame:
    """The lowest of ``tables``, level by level, with paths; ``tops`` has those of each branch's last node."""
    found = tables[-1].join(tops, "branch")
    for nodes in tables[-2::-1]:
        found = with_path(nodes, found, arity)
    return found


def proof(path: Column) -> Column:
    """One text of all siblings, level by level, left to right."""
    return F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), "")


def folded(leaf: Column, path: Column) -> Column:
    """The root that follows from a leaf and the siblings of its path."""
    return F.aggregate(path, leaf, lambda node, step: digest(step["left"], node, step["right"]))


def merkle(
    rows: DataFrame, fields: Sequence[str] = FIELDS, key: str = "doc_id", group: str = "lang", arity: int = ARITY, keep: Sequence[str] = ()
) -> DataFrame:
    """(key, leaf, path, subroot, root) of every row, and the columns of ``keep``.

    ``path`` has for each level from the leaf to the root the siblings to the left and to
    the right, digests joined.
    """
    if arity < 2:
        raise ValueError(f"arity {arity} is less than two")
    named = {f"kept{i}": k for i, k in enumerate(keep)}
    leaves = rows.select(
        F.col(key).alias("key"), F.col(group).alias("group"), field(F.col(group)).alias("branch"),
        leaf_digest([F.col(f) for f in fields]).alias("h"), *[F.col(k).alias(n) for n, k in named.items()],
    )
    leaves = written(leaves, "leaves")  # the texts are read once; ranges are cut over digests
    tables = climb(numbered(leaves, "branch", ["key", "h"]), leaves.count(), arity)
    subroots = tables[-1].select("branch", F.col("h").alias("subroot"))
    groups = tables[0].where("i = 0").select("branch", "group").join(subroots, "branch")
    groups = groups.select(F.lit("").alias("branch"), F.col("branch").alias("member"), "group", F.col("subroot").alias("h"))
    upper = climb(numbered(groups, "branch", ["group"]), subroots.count(), arity)
    top = upper[-1].select("branch", F.col("h").alias("root"), F.lit("").alias("subroot"), F.array().cast(PATH).alias("path"))
    members = descend(upper, top, arity).select(F.col("member").alias("branch"), F.col("h").alias("subroot"), "root", "path")
    found = descend(tables, members, arity)
    return found.select(
        F.col("key").alias(key), F.col("h").alias("leaf"), "path", "subroot", "root", *[F.col(n).alias(k) for n, k in named.items()]
    )


def verified(rows: DataFrame, leaf: str, root: str = "root", path: str = "path") -> DataFrame:
    """Rows with ``proof_sha256``, the root that follows from the column ``leaf``, and whether it is the root."""
    again = rows.withColumn("proof_sha256", digest(proof(F.col(path)))).withColumn("folded_root", folded(F.col(leaf), F.col(path)))
    return again.withColumn("verified", F.col("folded_root") == F.col(root))
