"""The manifest against a tree built in plain Python."""

import hashlib
import zlib

import pytest
from tests.llm.helpers import documents, frame
from pyspark import cloudpickle
from pyspark.sql import functions as F

from crashlake.llm import op12_merkle as mk

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def h(x):
    return hashlib.sha256(x.encode()).hexdigest()


def leaf(values):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes):
    levels = []
    while len(nodes) > 1:
        levels.append(nodes)
        nodes = [h("".join(nodes[i:i + 8])) for i in range(0, len(nodes), 8)]
    return levels, nodes[0]


def path(levels, i):
    out = []
    for nodes in levels:
        run = nodes[i // 8 * 8:i // 8 * 8 + 8]
        out.append(("".join(run[:i % 8]), "".join(run[i % 8 + 1:])))
        i //= 8
    return out


def plain(rows):
    """doc_id, leaf, subroot, root, proof, folded, verified for rows of FIELDS."""
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append((r, leaf(r)))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        groups[g].sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
        trees[g] = tree([x[1] for x in groups[g]])
    top, root = tree([trees[g][1] for g in order])
    out = []
    for k, g in enumerate(order):
        for i, (r, own) in enumerate(groups[g]):
            up = path(trees[g][0], i) + path(top, k)
            tried = r
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[4] is not None:
                tried = (*r[:4], "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r[4]))
            node = leaf(tried)
            for b, a in up:
                node = h(b + node + a)
            out.append((r[0], own, trees[g][1], root, h("".join(b + a for b, a in up)), node, node == root))
    return out


def key(row):
    return tuple((x is not None, x) for x in row)


def built(docs):
    changed = {"text": mk.tampered_text(F.col("doc_id"), F.col("text"))}
    return sorted((tuple(r) for r in mk.manifest(docs, FIELDS, changed=changed).collect()), key=key)


@pytest.mark.parametrize("height", [4, 1])
def test_manifest_of_odd_rows(spark, monkeypatch, height):
    """Superblocks above the whole table, and so small that most of the tree lies outside them."""
    monkeypatch.setattr(mk, "HEIGHT", height)
    monkeypatch.setattr(mk, "BLOCK", 8**height)
    cloudpickle.register_pickle_by_value(mk)  # the workers get these settings too
    rows = documents()
    rows += [(10**17 + k, f"Text {k}", "xx", "s", k, "", "", "", "", "") for k in range(130)]  # ids no double holds
    docs = frame(spark, rows)
    want = plain([(r[0], r[3], r[2], r[4], r[1]) for r in rows])
    try:
        assert built(docs) == sorted(want, key=key)
    finally:
        cloudpickle.unregister_pickle_by_value(mk)


def test_one_leaf_and_none(spark):
    rows = [(5, "A", None, None, None, "", "", "", "", "")]
    got = built(frame(spark, rows))
    assert got == plain([(5, None, None, None, "A")])
    assert got[0][1] == got[0][2] == got[0][3] and got[0][4] == h("")
    assert built(frame(spark, rows).where("false")) == []


def test_without_changes_every_row_is_whole(spark):
    docs = frame(spark, documents())
    assert {r.verified for r in mk.manifest(docs, FIELDS).select("verified").distinct().collect()} == {True}


def test_a_wrong_node_is_an_error():
    import pandas as pd
    leaves = pd.DataFrame({"pos": [0, 1], "leaf": [h("a"), h("b")], "tried": [None, None], "id": ["1", "2"], "n": [2, 2]})
    outer = pd.DataFrame({"digest": [h("x")], "path": [[]], "subroot": [""], "root": [""]})
    with pytest.raises(ValueError):
        mk.prove_block(leaves, outer)
