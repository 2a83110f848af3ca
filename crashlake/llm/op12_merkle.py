"""Merkle manifest of a dataset, with a proof for every row.

Leaves are digests of whole rows, in order of their id within each group
(language). Eight neighbours at a time become their digest until one is left,
the group's subroot; the subroots, in order of their groups, become the root in
the same way. A leaf's proof is the digests of its siblings on the way up;
folding the leaf with them must give the root.

Leaves are numbered by one range partitioning and the counts of its partitions.
Superblocks of 8^HEIGHT neighbouring leaves are reduced to a node each; the
tree above them, a few thousandth of the leaves, is built level by level with
grouped DataFrames, and each superblock is given its outer nodes from the top
down, a parent having at most eight children. Leaves and outer nodes are then
cogrouped by superblock, where the local reduction, the joining of the proof and
the folding are done together. No group holds more than 8^HEIGHT rows.

Null values have a sign of their own; a null id comes first in its group, as does a
null group; rows of one id are ordered by their digests, rows alike stand side
by side; very long values are digested whole; an empty table gives none; columns
of any other name are not looked at."""

from __future__ import annotations

import hashlib
import string
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crashlake.llm.common import numbered, stage

#: Children of a node, and levels below a superblock's node.
ARITY, HEIGHT = 8, 4
BLOCK = ARITY**HEIGHT
#: Part of the rows whose check value is divisible by it is tampered with in the trial of the manifest.
TAMPERED = 3


def digest(x: str) -> str:
    return hashlib.sha256(x.encode()).hexdigest()


def leaf(values: Sequence[Column]) -> Column:
    """Digest of a row: of each value ``-`` if null, else its UTF-8 bytes, a colon and the value."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def climb(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The levels of every tree (tree, idx, step: the siblings before and after, none at
    the top) and what remains of each (tree, digest). ``nodes``: tree, idx, n, digest."""
    levels = []
    most = nodes.agg(F.max("n")).first()[0] or 0
    while most > 1:
        run = F.sort_array(F.collect_list(F.struct("idx", "digest")))
        runs = nodes.groupBy("tree", F.floor(F.col("idx") / ARITY).alias("up"), "n").agg(run.alias("run"))
        runs = stage(runs, "nodes")
        texts = F.transform("run", lambda x: x["digest"])
        split = F.posexplode("run").alias("k", "x")
        children = runs.select("tree", "n", texts.alias("all"), split).select(
            "tree", F.col("x.idx").alias("idx"), F.when(F.col("n") > 1, F.array(F.struct(
                F.array_join(F.slice("all", 1, F.col("k")), "").alias("before"),
                F.array_join(F.slice("all", F.col("k") + 2, ARITY), "").alias("after")))).otherwise(F.array()).alias("step"))
        levels.append(children)
        up = F.when(F.col("n") > 1, F.sha2(F.array_join(texts, ""), 256)).otherwise(F.get(texts, F.lit(0)))
        nodes = runs.select("tree", F.col("up").alias("idx"), F.ceil(F.col("n") / ARITY).cast("long").alias("n"), up.alias("digest"))
        most = -(-most // ARITY)
    return levels, stage(nodes.select("tree", "digest"), "tops")


def descend(levels: list[DataFrame], tops: DataFrame) -> DataFrame:
    """tree, idx and the columns of ``tops`` (tree, path, ...) for every lowest node, the
    steps from it upwards put before ``path``."""
    rest = [c for c in tops.columns if c not in ("tree", "path")]
    found = tops.withColumn("idx", F.lit(0).cast("long"))
    for level in reversed(levels):
        above = found.select("tree", F.col("idx").alias("up"), "path", *rest)
        below = level.withColumn("up", F.floor(F.col("idx") / ARITY))
        found = below.join(above, ["tree", "up"]).select("tree", "idx", F.concat("step", "path").alias("path"), *rest)
    return found


def reduce_once(nodes: list[str]) -> tuple[list[tuple[str, str]], list[str]]:
    """(siblings before and after each node, the nodes of the next level)."""
    steps, up = [], []
    for i in range(0, len(nodes), ARITY):
        run = nodes[i:i + ARITY]
        steps += [("".join(run[:k]), "".join(run[k + 1:])) for k in range(len(run))]
        up.append(digest("".join(run)))
    return steps, up


def local_levels(nodes: list[str], n: int) -> Iterator[tuple[list[tuple[str, str]], list[str]]]:
    """:func:`reduce_once` from a superblock's leaves up to its node, or to the top of a tree of ``n`` leaves below it."""
    for _ in range(HEIGHT):
        if n == 1:
            return
        steps, nodes = reduce_once(nodes)
        n = -(-n // ARITY)
        yield steps, nodes


def block_node(rows: pd.DataFrame) -> pd.DataFrame:
    """The node of one superblock."""
    nodes, n = rows.sort_values("pos")["leaf"].tolist(), int(rows["n"].iloc[0])
    for _, nodes in local_levels(nodes, n):
        pass
    return pd.DataFrame({"tree": rows["tree"].iloc[:1], "idx": rows["block"].iloc[:1], "n": -(-n // BLOCK), "digest": nodes})


PROVEN = "id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string"


def prove_block(leaves: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
    """Rows of PROVEN for one superblock from its leaves and its one row of outer nodes."""
    leaves, top = leaves.sort_values("pos"), outer.iloc[0]
    nodes, levels = leaves["leaf"].tolist(), []
    for steps, nodes in local_levels(nodes, int(leaves["n"].iloc[0])):
        levels.append(steps)
    if nodes != [top["digest"]]:
        raise ValueError("a superblock's leaves do not give its node")
    above = [(x["before"], x["after"]) for x in top["path"]]
    outside = "".join(b + a for b, a in above)
    proofs, folded = [], []
    for i, (own, tried) in enumerate(zip(leaves["leaf"], leaves["tried"])):
        inside = [steps[i // ARITY**k] for k, steps in enumerate(levels)]
        proofs.append(digest("".join(b + a for b, a in inside) + outside))
        node = tried or own
        for b, a in inside + above:
            node = digest(b + node + a)
        folded.append(node)
    return pd.DataFrame({"id": leaves["id"], "leaf": leaves["leaf"], "subroot": top["subroot"], "root": top["root"], "proof_sha256": proofs, "folded_root": folded})


def tampered_text(doc_id: Column, text: Column) -> Column:
    """The text with A-Z lower-cased where TAMPERED divides the id's checksum, else null."""
    hit = F.crc32(doc_id.cast("string").cast("binary")) % TAMPERED == 0
    return F.when(hit, F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def manifest(docs: DataFrame, fields: Sequence[str], doc_id: str = "doc_id", group: str = "lang", changed: dict[str, Column] | None = None) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified for every row.

    A leaf covers ``fields``. ``changed`` gives, by field, the value that a row is
    tried with instead (null: as it is): its leaf is then recomputed and folded
    with the proof of the original, so ``verified`` tells whether that row is whole."""
    kind = docs.schema[doc_id].dataType
    tried = [F.coalesce(changed[f], F.col(f)) if f in (changed or {}) else F.col(f) for f in fields]
    differs = F.coalesce(*[c.isNotNull() for c in (changed or {}).values()], F.lit(False))
    rows = docs.select(F.col(doc_id).alias("id"), F.col(group).alias("group"), leaf([F.col(f) for f in fields]).alias("leaf"),
                       F.when(differs, leaf(tried)).alias("tried"), F.monotonically_increasing_id().alias("seq"))
    # seq, fixed by being written, parts runs of equal rows among the ranges
    rows = numbered(stage(rows, "leaves"), ["group"], ["id", "leaf", "seq"])
    rows = rows.select(F.col("id").cast("string").alias("id"), "leaf", "tried", "tree", "n", "pos", F.floor(F.col("pos") / BLOCK).alias("block"))
    blocks = rows.select("tree", "block", "n", "pos", "leaf").groupBy("tree", "block").applyInPandas(block_node, "tree bigint, idx bigint, n bigint, digest string")
    blocks = stage(blocks, "blocks")
    levels, subroots = climb(blocks)
    ordered = numbered(subroots.withColumnRenamed("tree", "group"), [], ["group"])
    over, root = climb(ordered.select(F.lit(0).cast("long").alias("tree"), F.col("pos").alias("idx"), "n", "digest"))
    no_step = F.array().cast("array<struct<before:string,after:string>>")
    over = descend(over, root.select("tree", no_step.alias("path"), F.col("digest").alias("root")))
    tops = ordered.join(over.select(F.col("idx").alias("pos"), "path", "root"), "pos").select(F.col("group").alias("tree"), "path", F.col("digest").alias("subroot"), "root")
    outer = descend(levels, stage(tops, "subroots")).join(blocks.select("tree", "idx", "digest"), ["tree", "idx"]).withColumnRenamed("idx", "block")
    proven = rows.groupBy("tree", "block").cogroup(outer.groupBy("tree", "block")).applyInPandas(prove_block, PROVEN)
    return proven.select(F.col("id").cast(kind).alias("doc_id"), *[c for c in proven.columns if c != "id"], (F.col("folded_root") == F.col("root")).alias("verified"))
