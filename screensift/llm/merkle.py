"""Merkle manifest of a dataset, its levels built by sibling-shift self-joins (operator 11).

Every row is a leaf, the SHA-256 of its fields. Within a group the leaves are
numbered, and every level equijoins the nodes with the sibling indices that its
slot-zero nodes compute (index XOR slot in a binary tree, index + slot
otherwise); the slot-zero rows then emit the parents. The groups' subroots are
the leaves of one more tree of the same kind, whose top is the root.

Texts are read once, for the leaf digests. All that joins, sorts or shuffles
afterwards is digests: a level holds 1/fanout of the rows of the level below, and
the proofs go down the tree a run at a time, so a row's whole proof exists only
inside the expression that hashes it. Keys are (group, index), one row each:
a group with a third of all rows spreads like any other.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screensift.functions.prefix import default_buckets, global_rank, quantile_bucket
from screensift.llm.frames import materialise

FANOUT = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_PATH = "array<struct<left:string,right:string>>"


def digest(*inputs: Column) -> Column:
    """Lower-case hex SHA-256 of the inputs' UTF-8 bytes, one after the other."""
    return F.sha2(F.concat(*inputs), 256)


def field(value: Column) -> Column:
    """A value as it enters a leaf: ``-`` for NULL, else its UTF-8 byte count, ``:`` and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def group_key(group: Column) -> Column:
    """Groups as non-null strings in the order of the manifest: NULL first, then by UTF-8 bytes."""
    return F.coalesce(F.concat(F.lit("1"), group.cast("string")), F.lit("0"))


def _numbered(rows: DataFrame, partition_by: str, *order: str) -> DataFrame:
    """Adds ``idx`` (from 0, in ``order``) and ``n`` (rows of the group)."""
    keyed = rows.withColumn("place", F.struct(*order))
    rank = global_rank(keyed, [partition_by], F.col("place"), quantile_bucket(keyed, "place", default_buckets(keyed)))
    return rank.withColumn("idx", F.col("_idx").cast("bigint") - 1).withColumn("n", F.col("_n").cast("bigint")).drop("_idx", "_n", "place")


def _runs(nodes: DataFrame, fanout: int) -> DataFrame:
    """One level: (grp, idx, n, digest) of groups with several nodes -> (grp, idx, n, digests), a row for each parent.

    ``idx`` and ``n`` are the parent's index and the parents' count, ``digests`` the nodes of its run.
    """
    slot = F.col("slot")
    sibling = F.col("idx").bitwiseXOR(slot) if fanout == 2 else F.col("idx") + slot
    heads = nodes.where(F.col("idx") % fanout == 0).select(
        "grp", "idx", "n", F.explode(F.sequence(F.lit(0).cast("bigint"), F.least(F.lit(fanout), F.col("n") - F.col("idx")) - 1)).alias("slot"))
    wanted = heads.select("grp", sibling.alias("at"), "slot", F.expr(f"idx div {fanout}").alias("parent"), "n")
    met = wanted.join(nodes.select("grp", F.col("idx").alias("at"), "digest"), ["grp", "at"])
    run = met.groupBy("grp", "parent", "n").agg(F.sort_array(F.collect_list(F.struct("slot", "digest"))).alias("run"))
    return run.select("grp", F.col("parent").alias("idx"), F.expr(f"(n + {fanout - 1}) div {fanout}").alias("n"),
                      F.transform("run", lambda r: r["digest"]).alias("digests"))


class Tree:
    """Trees over the nodes (grp, idx, n, digest), one for each ``grp``; every level is a written table."""

    def __init__(self, nodes: DataFrame, fanout: int = FANOUT):
        if fanout < 2:
            raise ValueError("fanout must be at least 2")
        self.fanout, self.levels = fanout, []
        tops, most = [nodes.where("n = 1")], nodes.agg(F.max("n")).first()[0] or 0
        while most > 1:
            runs = materialise(_runs(nodes.where("n > 1"), fanout), f"merkle-level-{len(self.levels)}")
            self.levels.append(runs)
            nodes = runs.select("grp", "idx", "n", F.sha2(F.concat_ws("", "digests"), 256).alias("digest"))
            tops.append(nodes.where("n = 1"))
            most = -(-most // fanout)
        top = tops[0]
        for t in tops[1:]:
            top = top.unionByName(t.select(*top.columns))
        #: (grp, digest): the top of every tree.
        self.tops = top.select("grp", "digest")

    def paths(self, above_top: DataFrame) -> DataFrame:
        """(grp, path) of the tops -> (grp, idx, n, digests, path) of the lowest runs, ``path`` going on above the run."""
        spare = above_top.select("grp", F.lit(None).cast("bigint").alias("idx"), F.lit(None).cast("bigint").alias("n"),
                                 F.lit(None).cast("array<string>").alias("digests"), "path").where("false")
        path = None
        for runs in reversed(self.levels):
            out = runs.where("n = 1").join(above_top, "grp")
            if path is not None:
                inner = path.select("grp", F.posexplode("digests").alias("slot", "digest"), "idx", "digests", "path").select(
                    "grp", (F.col("idx") * self.fanout + F.col("slot")).alias("idx"), _step("slot").alias("path"))
                out = out.unionByName(runs.where("n > 1").join(inner, ["grp", "idx"]).select(*out.columns))
            path = out
        return spare if path is None else path


def _step(slot: str) -> Column:
    """The path of a node: its run's digests left and right of ``slot``, then the path above the run."""
    d, s = F.col("digests"), F.col(slot).cast("int")
    here = F.struct(F.concat_ws("", F.slice(d, F.lit(1), s)).alias("left"), F.concat_ws("", F.slice(d, s + 2, F.size(d))).alias("right"))
    return F.concat(F.array(here), F.col("path"))


def manifest(docs: DataFrame, id_col: str = "doc_id", group_col: str = "source", fields: Sequence[str] = FIELDS,
             presented: Mapping[str, Column] | None = None, fanout: int = FANOUT) -> DataFrame:
    """One row per input row: ``id_col``, leaf, subroot, root, proof_sha256, folded_root, verified.

    ``proof_sha256`` is the digest of the siblings from the leaf up to the root.
    ``presented`` gives the content to verify for some fields (default: the row
    itself): ``folded_root`` is recomputed from it along the proof, ``verified``
    says whether it is the root.

    NULL fields are ``-`` in a leaf, NULL groups are one group and come first,
    NULL ids come first in their group; rows of one id are ordered by their
    leaf, so repeated rows give one manifest in any order of the input. Empty
    texts are values like others, texts of any length are hashed whole. A lone
    leaf is its group's subroot, a lone group's subroot the root, whose proof is
    the digest of nothing. An empty table gives an empty result; further
    columns of the input are not read.
    """
    own = {c: F.col(f"`{c}`") for c in fields}
    leaf = digest(*[field(own[c]) for c in fields])
    shown = leaf
    if presented:
        shown = digest(*[field(presented.get(c, own[c])) for c in fields])
    leaves = docs.select(F.col(f"`{id_col}`").alias("id"), group_key(F.col(f"`{group_col}`")).alias("grp"),
                         leaf.alias("digest"), shown.alias("shown"))
    leaves = materialise(_numbered(materialise(leaves, "merkle-leaves"), "grp", "id", "digest"), "merkle-numbered")

    tree = Tree(leaves.select("grp", "idx", "n", "digest"), fanout)
    subroots = materialise(tree.tops, "merkle-subroots")
    upper_leaves = _numbered(subroots.select(F.lit("").alias("all"), F.col("grp").alias("name"), "digest"), "all", "name")
    upper_leaves = materialise(upper_leaves.withColumnRenamed("all", "grp"), "merkle-groups")
    upper = Tree(upper_leaves.select("grp", "idx", "n", "digest"), fanout)
    root = upper.tops.select(F.col("grp").alias("all"), F.col("digest").alias("root"))

    # the path from each subroot to the root, then of every lowest run of its tree
    nothing = F.array().cast(_PATH)
    ends = _attached(upper_leaves, upper.paths(upper.tops.select("grp", nothing.alias("path"))),
                     upper.tops.select("grp", nothing.alias("path")), fanout)
    ends = ends.join(root, F.col("grp") == F.col("all")).select(
        F.col("name").alias("grp"), F.col("digest").alias("subroot"), "root", "path")
    ends = materialise(ends, "merkle-ends")
    runs = tree.paths(ends.select("grp", "path"))
    runs = materialise(runs, "merkle-paths") if tree.levels else runs
    placed = _attached(leaves, runs, ends.select("grp", "path"), fanout).join(ends.select("grp", "subroot", "root"), "grp")

    proof = F.sha2(F.concat_ws("", F.transform("path", lambda p: F.concat(p["left"], p["right"]))), 256)
    fold = F.aggregate("path", F.col("shown"), lambda node, p: F.sha2(F.concat(p["left"], node, p["right"]), 256))
    return placed.select(
        F.col("id").alias(id_col), F.col("digest").alias("leaf"), "subroot", "root", proof.alias("proof_sha256"),
        fold.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


def _attached(leaves: DataFrame, runs: DataFrame, alone: DataFrame, fanout: int) -> DataFrame:
    """``leaves`` with their ``path``: through their run, or the group's own where they are alone."""
    several = leaves.where("n > 1").withColumn("run", F.expr(f"idx div {fanout}"))
    keyed = runs.select(F.col("grp"), F.col("idx").alias("run"), "digests", "path")
    joined = several.join(keyed, ["grp", "run"]).withColumn("slot", F.col("idx") % fanout)
    joined = joined.withColumn("path", _step("slot"))
    return joined.select(*leaves.columns, "path").unionByName(leaves.where("n = 1").join(alone, "grp").select(*leaves.columns, "path"))
