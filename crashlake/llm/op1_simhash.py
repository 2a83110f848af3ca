"""SimHash near-duplicates: vertical bit planes, carry-save counters, linked components.

Fingerprint: A-Z lower-cased, words, shingles of ``shingle`` words (repeats
included, joined by one space; fewer words: the whole sequence), XXH64 with
seed 42 of each; a bit is 1 if set in over half of them; no word: zero.

Two fingerprints within ``RADIUS`` = 2 bits differ in at most two of their
eight bytes, so for one of the 28 choices of two bytes all others agree. Each
distinct fingerprint therefore enters 28 buckets, keyed by six bytes. Inside a
bucket only 16 bits can differ, so a bucket holds at most 65,536 distinct
fingerprints however many rows the input has: no bucket is cut or skipped.
There the 16 bits are stored as vertical planes and compared at every row
offset at once; each bucket emits a spanning forest of its links, not its pairs.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crashlake.llm.common import chunks, split_words, stage

SHINGLE, RADIUS, SEED = 3, 2, 42
#: Shifts of the two bytes that may differ in a bucket of each table.
FREE = [(8 * a, 8 * b) for a, b in combinations(range(8), 2)]
KEPT = [(1 << 64) - 1 - (0xFF << a) - (0xFF << b) for a, b in FREE]
#: Runs up to this length are compared together, longer ones each on its own.
SHORT_RUN = 64
#: Bytes of each plane (eight pairs a byte) that are compared and abandoned together.
BLOCK = 4096


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprints(text: pa.Array, shingle: int = SHINGLE) -> np.ndarray:
    """uint64 fingerprints of an Arrow array of texts."""
    out = np.zeros(len(text), dtype=np.uint64)
    for at, some in chunks(text):
        flat, sizes = split_words(pc.ascii_lower(some))
        if not len(flat):
            continue
        ends = np.cumsum(sizes)
        last = len(flat) - shingle + 1
        hashes = np.empty(0, dtype=np.uint64)
        digest = xxhash.xxh64_intdigest
        if last > 0:
            joined = pc.binary_join_element_wise(*[flat.slice(k, last) for k in range(shingle)], pa.scalar(" ", pa.large_string()))
            starts = np.arange(last)
            doc = np.searchsorted(ends, starts, "right")
            inside = starts + shingle <= ends[doc]  # a shingle never crosses two texts
            of = joined.filter(pa.array(inside)).cast(pa.large_binary()).to_pylist()
            hashes = np.fromiter((digest(x, SEED) for x in of), dtype=np.uint64, count=len(of))
        counts = np.maximum(sizes - shingle + 1, 0)
        first = np.concatenate([[0], np.cumsum(counts)])
        for i in np.flatnonzero(counts):
            bits = np.unpackbits(hashes[first[i]:first[i + 1]].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            major = 2 * bits.sum(axis=0, dtype=np.int64) > counts[i]
            out[at + i] = np.packbits(major, bitorder="little").view(np.uint64)[0]
        for i in np.flatnonzero((counts == 0) & (sizes > 0)):
            few = flat.slice(ends[i] - sizes[i], sizes[i]).to_pylist()
            out[at + i] = digest(" ".join(few).encode(), SEED)
    return out


def fingerprint(text: Column | str, shingle: int = SHINGLE) -> Column:
    """The fingerprint as a signed 64-bit column; a null or wordless text has 0."""

    @F.arrow_udf("bigint")
    def simhash64(batch: pa.Array) -> pa.Array:
        return pa.array(fingerprints(batch, shingle).view(np.int64))

    return simhash64(text)


def near(diff: np.ndarray, radius: int) -> np.ndarray:
    """Which of the pairs, given by the packed planes (planes x bytes) of their
    differences, differ in at most ``radius`` bits: a packed byte array.

    Plane by plane the differences are added to bitwise counters by carry-save
    addition; a block whose pairs all exceed the radius is left at once."""
    wide = (radius + 1).bit_length()
    out = np.zeros(diff.shape[1], dtype=np.uint8)
    for at in range(0, diff.shape[1], BLOCK):
        planes = diff[:, at:at + BLOCK]
        counters = [np.zeros(planes.shape[1], dtype=np.uint8) for _ in range(wide)]
        over = np.zeros(planes.shape[1], dtype=np.uint8)
        for seen, plane in enumerate(planes):
            carry = plane
            for k in range(wide):
                counters[k], carry = counters[k] ^ carry, counters[k] & carry
            over |= carry
            if seen >= radius:
                more, same = over, ~np.uint8(0)  # bitwise: counter > radius
                for k in reversed(range(wide)):
                    bit = np.uint8(255 if radius >> k & 1 else 0)
                    more = more | (same & counters[k] & ~bit)
                    same = same & ~(counters[k] ^ bit)
                over = more
                if (over == 255).all():
                    break
        out[at:at + BLOCK] = ~over
    return out


def _planes(values: np.ndarray) -> np.ndarray:
    """16 packed planes of uint16 values."""
    return np.packbits((values[None, :] >> np.arange(16, dtype=np.uint16)[:, None]) & 1, axis=1, bitorder="little")


def _long_run(free: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Linked positions of one long run: the planes, stored eight times at bit shifts 0-7, are laid against themselves at each offset."""
    n, left, right = len(free), [], []
    shifted = [_planes(free[r:]) for r in range(8)]
    for d in range(1, n):
        pairs = n - d
        size = (pairs + 7) // 8
        ok = near(shifted[0][:, :size] ^ shifted[d % 8][:, d // 8:d // 8 + size], radius)
        if ok.any():
            hit = np.flatnonzero(np.unpackbits(ok, bitorder="little")[:pairs])
            left.append(hit)
            right.append(hit + d)
    return (np.concatenate(left), np.concatenate(right)) if left else (np.empty(0, np.int64),) * 2


def _short_runs(free: np.ndarray, after: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Linked positions in many short runs; ``after``: rows of its run behind each row."""
    left, right = [], []
    for d in range(1, int(after.max(initial=0)) + 1):
        i = np.flatnonzero(after >= d)
        ok = np.unpackbits(near(_planes(free[i] ^ free[i + d]), radius), bitorder="little")[:len(i)].astype(bool)
        left.append(i[ok])
        right.append(i[ok] + d)
    return (np.concatenate(left), np.concatenate(right)) if left else (np.empty(0, np.int64),) * 2


def _forest(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Smallest position that each position reaches over the links."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def bucket_links(table: np.ndarray, fp: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprint, smallest reachable fingerprint) within buckets; rows sorted by table and key."""
    key = fp & np.array(KEPT, dtype=np.uint64)[table]
    cut = np.flatnonzero((key[1:] != key[:-1]) | (table[1:] != table[:-1])) + 1
    first, end = np.concatenate([[0], cut]), np.concatenate([cut, [len(fp)]])
    size = end - first
    if not len(fp) or size.max() < 2:
        return fp[:0], fp[:0]
    a, b = np.array(FREE, dtype=np.uint64).T
    free = ((fp >> a[table] & np.uint64(255)) | (fp >> b[table] & np.uint64(255)) << np.uint64(8)).astype(np.uint16)
    after = np.repeat(end, size) - 1 - np.arange(len(fp))
    short = np.repeat((size > 1) & (size <= SHORT_RUN), size)
    rows = np.flatnonzero(short)
    i, j = _short_runs(free[rows], after[rows], radius)
    left, right = [rows[i]], [rows[j]]
    for run in np.flatnonzero(size > SHORT_RUN):
        i, j = _long_run(free[first[run]:end[run]], radius)
        left.append(i + first[run])
        right.append(j + first[run])
    label = _forest(len(fp), np.concatenate(left), np.concatenate(right))
    moved = np.flatnonzero(label != np.arange(len(fp)))
    return fp[moved], fp[label[moved]]


def _linker(radius: int):
    def link(batches):
        table, fp = np.empty(0, np.int64), np.empty(0, np.uint64)
        for batch in batches:
            table = np.concatenate([table, batch.column("t").to_numpy(zero_copy_only=False).astype(np.int64)])
            fp = np.concatenate([fp, batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)])
            if not len(fp):
                continue
            key = fp & np.array(KEPT, dtype=np.uint64)[table]
            whole = len(fp) - int(np.argmax(((key != key[-1]) | (table != table[-1]))[::-1])) if (key != key[-1]).any() or (table != table[-1]).any() else 0
            src, dst = bucket_links(table[:whole], fp[:whole], radius)
            table, fp = table[whole:], fp[whole:]  # the last bucket may go on in the next batch
            yield pa.record_batch({"src": src.view(np.int64), "dst": dst.view(np.int64)})
        src, dst = bucket_links(table, fp, radius)
        yield pa.record_batch({"src": src.view(np.int64), "dst": dst.view(np.int64)})

    return link


def links(nodes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(src, dst) links of the distinct fingerprints in column ``fp``: every pair
    within the radius is connected over them."""
    if not 0 <= radius <= 2:
        raise ValueError("the 28 tables prove links of at most 2 differing bits")
    masks = F.array(*[F.lit(_signed(k)) for k in KEPT])
    put = nodes.select("fp", F.posexplode(masks).alias("t", "mask")).select(
        F.col("t").cast("tinyint").alias("t"), "fp", F.col("fp").bitwiseAND(F.col("mask")).alias("key"))
    held = put.repartition("t", "key").sortWithinPartitions("t", "key").select("t", "fp")
    return held.mapInArrow(_linker(radius), "src bigint, dst bigint").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node with a link; root: the smallest node it reaches.

    Alternating large-star and small-star steps over a shrinking edge table;
    each round is written to the shared checkpoint folder. A node with very
    many links meets its minimum through a partial aggregate and a join that
    adaptive execution can split, never in one group."""
    edges = stage(edges.select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).where("u <> v"), "links")
    state = None
    while True:
        size = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(size) == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = tuple(size)
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stage(large, "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(least.select("u", "m")).distinct())
        edges = stage(small, "small-star")


def classes(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(fp, first_id, component_id, class) for every distinct fingerprint of
    ``prints`` (id, fp): the smallest id that has it, the smallest id of its
    component, and the component's key (ids that repeat can lie in several)."""
    nodes = stage(prints.groupBy("fp").agg(F.min("id").alias("first_id")), "nodes")
    roots = components(links(nodes, radius))
    member = nodes.join(roots, nodes.fp == roots.node, "left").select(
        "fp", "first_id", "root", F.coalesce("root", "fp").alias("class"))
    lowest = member.groupBy("class").agg(F.min("first_id").alias("component_id"))
    return member.join(lowest, "class").select("fp", "first_id", "component_id", "class")


def simhash_groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row per row of ``docs``: doc_id, fp, component_id.

    Null or wordless texts have fingerprint 0 and are linked like any other;
    repeated rows and ids keep one row each; a null id is never a component_id
    unless its whole component has none; an empty table gives none."""
    prints = stage(docs.select(F.col(doc_id).alias("id"), fingerprint(F.col(text), shingle).alias("fp")), "fingerprints")
    return prints.join(classes(prints, radius), "fp").select(F.col("id").alias("doc_id"), "fp", "component_id")


def deduplicate(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` (all columns, whatever their names) less near copies:
    of each component the row with the smallest id stays; of rows that repeat
    its id and fingerprint one stays. A null id stays only where its whole
    component has no other."""
    rows = stage(docs.select(F.struct("*").alias("doc"), F.col(doc_id).alias("id"), fingerprint(F.col(text), shingle).alias("fp"),
                             F.monotonically_increasing_id().alias("row")), "documents")
    # of rows that repeat an id and a fingerprint the first, found on narrow columns and combined before the
    # shuffle; whole rows meet only their own number, so no group of copies comes together
    key = F.struct("id", "fp").alias("key")  # in a struct nulls are equal
    first = rows.groupBy("id", "fp").agg(F.min("row").alias("row")).select("row", key)
    keep = classes(rows.select("id", "fp"), radius).where(F.col("first_id").eqNullSafe(F.col("component_id"))).groupBy("class", "component_id").agg(F.min("fp").alias("kept_fp"))
    chosen = first.join(keep.select(F.struct(F.col("component_id").alias("id"), F.col("kept_fp").alias("fp")).alias("key")), "key", "left_semi").select("row")
    return rows.join(chosen, "row", "left_semi").select("doc.*")
