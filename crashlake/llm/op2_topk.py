"""Exact top-k inner products over an impact-ordered, score-at-a-time index.

Vectors are dealt into index blocks. In a block every dimension has a posting
list ordered by descending quantised impact (the component's magnitude, in
LEVELS steps). A query lowers an impact threshold round by round; in each
round every dimension adds the postings whose query weight times impact
reaches it. After a round, no vector's score is further from its accumulator
than E (quantisation of what was added, plus the best posting not yet added,
summed over the dimensions). So with A the k-th largest accumulator, only
vectors at A - 2E or above can be members: the query stops when that proves
few enough, and rescores them exactly. Nothing is left out by a cap.

Queries travel to the blocks in batches; each block answers its k best per
query, and a ranked window merges them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from crashlake.llm.common import stage

SCALE, LEVELS = 1024, 64
#: Vectors of an index block and queries of a batch, on average.
BLOCK_ROWS, BATCH_QUERIES = 4096, 256
#: A query stops once at most this share of its block can still be members.
FEW = 1 / 64


class ImpactIndex:
    """Posting lists of one block of integer vectors (rows of ``vectors``)."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        size = np.abs(vectors)
        self.step = max(1, -(-int(size.max(initial=0) + 1) // LEVELS))
        level = size // self.step
        order = np.argsort(-level, axis=0, kind="stable")
        self.docs = np.ascontiguousarray(order.T)
        self.level = np.ascontiguousarray(np.take_along_axis(level, order, axis=0).T)
        middle = np.where(level > 0, np.sign(vectors) * (level * self.step + self.step // 2), 0)
        self.impact = np.ascontiguousarray(np.take_along_axis(middle, order, axis=0).T)
        # postings of each dimension whose level is at least 0, 1, ...
        self.upto = (self.level[:, :, None] >= np.arange(LEVELS + 1)).sum(axis=1) if level.size else np.zeros((vectors.shape[1], LEVELS + 1), np.int64)

    def search(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the k best vectors but the query's own, ties to smaller ids."""
        n = len(self.ids)
        own = self.ids == query_id
        possible = np.flatnonzero(~own)
        dims = np.flatnonzero(query) if n else np.empty(0, np.int64)
        weight = np.abs(query[dims])
        docs, impact, level, upto = self.docs, self.impact, self.level[dims], self.upto[dims]
        at = np.zeros(len(dims), dtype=np.int64)
        sums = np.zeros(n, dtype=np.int64)
        threshold = int((weight * (level[:, 0] + 1)).max(initial=0)) if n else 0
        while threshold and len(possible) > k:
            threshold //= 4
            # levels from this one on add their middle; level 0 adds nothing
            least = np.clip(-(-threshold // weight), 1, LEVELS)
            to = upto[np.arange(len(dims)), least]
            for i in np.flatnonzero(to > at):
                d, a, b = dims[i], at[i], to[i]
                sums[docs[d, a:b]] += query[d] * impact[d, a:b]
            at = np.maximum(at, to)
            ahead = np.where(at < n, (level[np.arange(len(dims)), np.minimum(at, n - 1)] + 1) * self.step - 1, 0)
            error = int((weight * np.maximum(ahead, self.step // 2 + 1)).sum())
            score = sums[~own]
            kth = np.partition(score, len(score) - k)[len(score) - k]
            possible = np.flatnonzero(~own & (sums >= kth - 2 * error))
            if len(possible) <= max(4 * k, FEW * n):
                break
        exact = self.vectors[possible] @ query
        best = np.lexsort((self.ids[possible], -exact))[:k]
        return self.ids[possible[best]], exact[best]


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column, zero-padded to the longest."""
    size = np.diff(np.asarray(column.offsets))
    flat = np.asarray(column.flatten())
    out = np.zeros((len(column), int(size.max(initial=0))), dtype=np.int64)
    out[np.arange(out.shape[1])[None, :] < size[:, None]] = flat
    return out


def _wide(parts: list[np.ndarray], width: int = 0) -> np.ndarray:
    width = max([width, *(p.shape[1] for p in parts)])
    return np.concatenate([np.pad(p, ((0, 0), (0, width - p.shape[1]))) for p in parts]) if parts else np.zeros((0, width), np.int64)


def _searcher(k: int):
    def search(batches):
        block, ids, parts, index = None, [], [], None
        for batch in batches:
            cols = {f: batch.column(f) for f in ("block", "vec_id", "v", "q_ids", "q_vecs")}
            blocks = cols["block"].to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(blocks)) + 1).tolist(), len(blocks)]
            for a, b in zip(edges, edges[1:]):
                if a == b:
                    continue
                if blocks[a] != block:
                    block, ids, parts, index = blocks[a], [], [], None
                run = {f: c.slice(a, b - a) for f, c in cols.items()}
                real = run["vec_id"].is_valid()
                if (own := run["vec_id"].filter(real)) and len(own):
                    ids.append(own.to_numpy())
                    parts.append(_matrix(run["v"].filter(real)))
                asked = run["q_ids"].is_valid()
                for q_ids, q_vecs in zip(run["q_ids"].filter(asked), run["q_vecs"].filter(asked)):
                    if not ids:
                        continue
                    queries = _matrix(q_vecs.values)
                    if index is None or index.vectors.shape[1] < queries.shape[1]:
                        index = ImpactIndex(np.concatenate(ids), _wide(parts, queries.shape[1]))
                    queries = _wide([queries], index.vectors.shape[1])
                    found = [index.search(i, q, k) for i, q in zip(q_ids.values.to_numpy(), queries)]
                    yield pa.record_batch({
                        "query_id": np.repeat(q_ids.values.to_numpy(), [len(f[0]) for f in found]),
                        "vec_id": np.concatenate([f[0] for f in found]),
                        "score": np.concatenate([f[1] for f in found]),
                    })

    return search


def integer_vectors(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(vec_id, v): floor(scale * x) of every component; rows without an id, and
    vectors that are null or hold a null or non-finite component, are left out."""
    finite = F.forall(F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(F.col(vec_id).isNotNull() & F.coalesce(finite, F.lit(False))).select(
        F.col(vec_id).cast("bigint").alias("vec_id"), F.transform(F.col(vector), lambda x: F.floor(x.cast("double") * scale)).alias("v"))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows of ``vectors`` for each query
    by integer inner product, ties to the smaller vec_id, rows of the query's
    own id left out. Both inputs are (vec_id, v) of long arrays.

    Shorter vectors count as padded with zeros; repeated rows are each a
    candidate; of several query vectors under one id the smallest asks; fewer
    than k candidates give them all; empty inputs give no rows. Inner products
    must fit 63 bits."""
    vectors = stage(vectors, "vectors")
    queries = stage(queries.groupBy("vec_id").agg(F.min("v").alias("v")), "queries")
    n_blocks = max(1, -(-vectors.count() // BLOCK_ROWS))
    n_batches = max(1, -(-queries.count() // BATCH_QUERIES))
    batches = queries.groupBy(F.pmod(F.xxhash64("vec_id"), F.lit(n_batches)).alias("batch")).agg(
        F.collect_list(F.struct("vec_id", "v")).alias("q"))
    asked = batches.select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_blocks - 1).cast("long"))).alias("block"), F.lit(1).alias("kind"), F.lit(None).cast("long").alias("vec_id"),
        F.lit(None).cast("array<bigint>").alias("v"), F.col("q.vec_id").alias("q_ids"), F.col("q.v").alias("q_vecs"))
    held = vectors.select(
        F.pmod(F.monotonically_increasing_id(), F.lit(n_blocks)).cast("long").alias("block"), F.lit(0).alias("kind"), "vec_id", "v",
        F.lit(None).cast("array<bigint>").alias("q_ids"), F.lit(None).cast("array<array<bigint>>").alias("q_vecs"))
    found = held.unionByName(asked).repartition("block").sortWithinPartitions("block", "kind").mapInArrow(
        _searcher(k), "query_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
