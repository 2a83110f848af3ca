import random
import string

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from crashlake.llm import op1_simhash as op
from tests.llm.helpers import documents, frame, word_list

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def plain_fingerprint(text):
    w = word_list((text or "").translate(LOWER))
    shingles = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(fps):
    """Smallest fingerprint that each one reaches over links of at most two bits."""
    root = {f: f for f in fps}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    order = sorted(fps)
    for i, a in enumerate(order):
        for b in order[i + 1:]:
            if (a ^ b).bit_count() <= 2:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {f: find(f) for f in fps}


def test_fingerprints_equal_the_plain_form():
    texts = [r[1] for r in documents()]
    got = op.fingerprints(pa.array(texts, pa.string()))
    assert got.tolist() == [plain_fingerprint(t) for t in texts]


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 5])
def test_carry_save_comparison(radius):
    rng = np.random.default_rng(radius)
    a, b = rng.integers(0, 1 << 16, size=(2, 5000)).astype(np.uint16)
    b[:2000] = a[:2000] ^ np.left_shift(1, rng.integers(0, 16, 2000)).astype(np.uint16) ^ np.left_shift(1, rng.integers(0, 16, 2000)).astype(np.uint16)
    got = np.unpackbits(op.near(op._planes(a ^ b), radius), bitorder="little")[:5000]
    assert got.tolist() == [int(int(x).bit_count() <= radius) for x in a ^ b]


def test_buckets_find_every_link_in_short_and_long_runs():
    rng = random.Random(3)
    fps = {rng.getrandbits(64) for _ in range(200)}
    for f in list(fps):
        for _ in range(rng.randint(0, 4)):
            fps.add(f ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) ^ (rng.getrandbits(1) << rng.randrange(64)))
    dense = rng.getrandbits(64)
    fps |= {dense ^ rng.getrandbits(16) for _ in range(300)}
    fps = np.array(sorted(fps), dtype=np.uint64)
    table, fp = np.repeat(np.arange(28), len(fps)), np.tile(fps, 28)
    order = np.lexsort((fp & np.array(op.KEPT, dtype=np.uint64)[table], table))
    src, dst = op.bucket_links(table[order], fp[order])
    root = {int(f): int(f) for f in fps}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for a, b in zip(src.tolist(), dst.tolist()):
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    assert {f: find(f) for f in root} == plain_components(root)


def test_groups_and_deduplication(spark):
    rows = documents()
    docs = frame(spark, rows)
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.fp % (1 << 64), r.component_id) for r in op.simhash_groups(docs).collect())
    prints = [(r[0], plain_fingerprint(r[1])) for r in rows]
    root = plain_components({f for _, f in prints})
    least = {}
    for i, f in prints:
        if i is not None:
            least[root[f]] = min(least.get(root[f], i), i)
    assert got == sorted((i if i is not None else -1, f, least.get(root[f])) for i, f in prints)
    kept = op.deduplicate(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == sorted(
        (least.get(c) is None, least.get(c) or 0) for c in set(root.values()))


def test_a_row_repeated_in_half_of_the_table(spark):
    rows = documents()
    rows += [rows[3]] * len(rows) + [(None, *rows[3][1:])] * 5
    docs = frame(spark, rows).repartition(4)
    kept = op.deduplicate(docs)
    prints = [(r[0], plain_fingerprint(r[1])) for r in rows]
    root = plain_components({f for _, f in prints})
    assert kept.count() == len(set(root.values()))
    # no exchange or sort holds whole rows by id and fingerprint: texts move by row number alone
    plan = kept._jdf.queryExecution().sparkPlan().toString()
    assert not [x for x in plan.splitlines() if "Aggregate" in x and "doc#" in x]
    assert [x for x in plan.splitlines() if "Join" in x and "LeftSemi" in x and "[row#" in x]


def test_long_chain_is_one_component(spark):
    fps, f = [], 0
    for k in range(30):
        fps.append((f,))
        f ^= 3 << (2 * k)
    edges = op.links(spark.createDataFrame(fps, "fp bigint"))
    assert {r.root for r in op.components(edges).collect()} == {min(x for x, in fps)}


def test_empty_table(spark):
    docs = frame(spark, [])
    assert op.simhash_groups(docs).count() == 0 and op.deduplicate(docs).count() == 0
