"""Collocations against plain counting, in dense and in sparse tiles."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from tests.llm.helpers import documents, frame

from crashlake.llm import op13_collocations as co


def plain(rows, least, longest, covered=50, best=2000):
    count, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in range(1, longest + 1):
                count[lang].update(tuple(w[i:i + m]) for i in range(len(w) - m + 1))
    out = []
    for lang, f in count.items():
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        gone = {p[i:i + m] for p, a in found.items() for m in range(2, len(p)) for i in range(len(p) - m + 1) if 100 * a >= covered * f[p[i:i + m]]}
        scored = []
        for p, a in found.items():
            if p not in gone:
                score, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(scored)[:best], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def mined(docs, **options):
    return sorted(tuple(r) for r in co.collocations(docs, **options).collect())


def texts(seed, n=60, words=14):
    """A few words in many orders, with piece ends, capitals and tabs; one hot language."""
    rng = random.Random(seed)
    stock = [f"w{i}" for i in range(words)] + ["É", "日本", "."]
    rows = []
    for i in range(n):
        text = "".join(rng.choice(stock[:rng.randint(2, len(stock))]) + rng.choice([" ", " ", " ", "  ", "\t", ", ", "\n", "\x0b", "! ", "\xa0", "\x1c"]) for _ in range(rng.randint(0, 300)))
        rows.append((i, text.upper() if i % 7 == 0 else text, rng.choice(["en", "en", "fr", None, "und"]), "s", 0, "", "", "", "", ""))
    return rows


@pytest.mark.parametrize("dense, tile, busy", [(1 << 16, 1024, 4), (1, 1024, 4), (4, 4, 1), (10**9, 4, 2)])
def test_small_vocabularies(spark, monkeypatch, dense, tile, busy):
    """Dense and sparse tiles, and so small ones that there are many; the functions travel with these settings."""
    from pyspark import cloudpickle as pickle
    for name, value in (("DENSE", dense), ("TILE", tile), ("CELLS", tile * tile), ("BUSY", busy), ("PIECE", 5), ("SLICE_BYTES", 2000), ("BAND", 2), ("AT_ONCE", 3)):
        monkeypatch.setattr(co, name, value)
    pickle.register_pickle_by_value(co)
    try:
        rows = texts(dense % 97)
        got = mined(frame(spark, rows), least=4, longest=4)
    finally:
        pickle.unregister_pickle_by_value(co)
    assert got == plain([(r[1], r[2]) for r in rows], 4, 4)
    assert len(got) > 100


def test_odd_rows(spark):
    rows = documents(n=60) + texts(11, 40)
    got = mined(frame(spark, rows))
    assert got == plain([(r[1], r[2]) for r in rows], 10, 3)
    assert mined(frame(spark, rows), best=3) == [r for r in got if r[1] <= 3]


def test_a_language_without_frequent_words(spark):
    rows = texts(12, 30) + [(900, "each word of it once", "it", "s", 0, "", "", "", "", "")]
    assert mined(frame(spark, rows)) == [r for r in plain([(r[1], r[2]) for r in rows], 10, 3)]


def test_no_rows_and_no_words(spark):
    docs = frame(spark, documents())
    assert mined(docs.where("false")) == []
    assert mined(docs.where("text is null or text = ''")) == []


def test_score_beyond_64_bits(spark):
    rows = [(10**13, 10**13 + 7, 10**14, 1), (10, 10, 10, 2)]
    from pyspark.sql import functions as F
    got = spark.createDataFrame(rows, "a bigint, l bigint, r bigint, k int").select(co._score(F.col("a"), F.col("l"), F.col("r"))).collect()
    assert [r[0] for r in got] == [10**6 * a * a // (x * y) for a, x, y, _ in rows]


def test_add_up_in_both_forms(monkeypatch):
    rng = np.random.default_rng(1)
    tile, cell, n = rng.integers(0, 5, 4000) ** 2, rng.integers(0, 300, 4000), rng.integers(1, 9, 4000)
    want = Counter()
    for t, c, k in zip(tile, cell, n):
        want[int(t), int(c)] += int(k)
    for dense in (1, 700, 10**9):
        monkeypatch.setattr(co, "DENSE", dense)
        got = co.add_up(cell, n, tile)
        assert [(int(t), int(c), int(k)) for t, c, k in zip(*got)] == [(*key, k) for key, k in sorted(want.items())]
