import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from crashlake.llm import op5_packing, op8_mixing, op9_sharding
from tests.llm.helpers import documents, frame, sentence, word_list

PATH = public_tokenizers.path("word_bpe_49k.json")
DEFINITION = open(PATH, encoding="utf-8").read()
TOKENIZER = Tokenizer.from_file(PATH)


def plain_ids(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=40), st.text(alphabet="aZé'sß.,!?%$*#&<|>\u0301\u0338 \n\t1²İſ日", max_size=30)), min_size=1, max_size=4))
def test_ids_equal_the_tokenizers(texts):
    ids, sizes = op5_packing.word_ids(pa.array(texts, pa.string()), DEFINITION)
    want = [plain_ids(t) for t in texts]
    assert sizes.tolist() == [len(w) for w in want] and ids.tolist() == [x for w in want for x in w]


def test_first_fit_equals_the_plain_scan():
    rng = random.Random(1)
    lengths = sorted((rng.choice([1, 5, 60, 100, rng.randint(1, 100)]) for _ in range(400)), reverse=True)
    where, offset = op5_packing.first_fit(lengths, 100)
    room = []
    for size, w, o in zip(lengths, where, offset):
        at = next((k for k, r in enumerate(room) if r >= size), len(room))
        if at == len(room):
            room.append(100)
        assert (w, o) == (at, 100 - room[at])
        room[at] -= size


@pytest.mark.parametrize("group", [op5_packing.GROUP_PIECES, 16])
def test_packing_round_trip(spark, monkeypatch, group):
    monkeypatch.setattr(op5_packing, "GROUP_PIECES", group)
    rows = documents()
    got = op5_packing.pack(frame(spark, rows), PATH).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r.doc_id].append((r.start, r.length, r.ids_crc32, r.doc_tokens))
        sequences[r.sequence_id].append((r.offset, r.length))
    want = defaultdict(list)
    for r in rows:
        ids = np.array(plain_ids(r[1]) + [1], dtype="<u4")
        want[r[0]] += [(s, min(2048, len(ids) - s), zlib.crc32(ids[s:s + 2048].tobytes()), len(ids)) for s in range(0, len(ids), 2048)]
    assert {k: sorted(v) for k, v in pieces.items()} == {k: sorted(v) for k, v in want.items()}
    for runs in sequences.values():
        at = 0
        for offset, length in sorted(runs):
            assert offset == at
            at += length
        assert at <= 2048


def test_empty_tables(spark):
    docs = frame(spark, [])
    assert op5_packing.pack(docs, PATH).count() == 0
    assert op8_mixing.mix(docs).count() == 0 and op8_mixing.mixed(docs).columns == docs.columns
    assert op9_sharding.shard_by_bytes(docs).count() == 0


def plain_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    stopped, left = {}, 1.5 * sum(sizes.values())
    while True:  # reshare the excess until none is above
        free = [s for s in names if s not in stopped]
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        above = [s for s in free if share[s] >= 2 * sizes[s]]
        if not above:
            return stopped | share
        for s in above:
            stopped[s] = 2.0 * sizes[s]
            left -= 2 * sizes[s]


def test_mix_against_a_plain_sort(spark):
    rows = documents(n=400)
    docs = frame(spark, rows)
    got = op8_mixing.mix(docs).collect()
    sizes, ids = defaultdict(int), defaultdict(lambda: defaultdict(int))
    for r in rows:
        n = len(word_list(r[1]))
        sizes[r[3]] += n
        h = int(hashlib.md5(("" if r[0] is None else str(r[0])).encode()).hexdigest()[:15], 16)
        ids[r[3]][h] += n
    want = plain_targets(sizes)
    taken = defaultdict(int)
    for r in got:
        source = r.doc.source
        assert r.size == len(word_list(r.doc.text)) and r.source_size == sizes[source] and 0 <= r.copies <= 2
        assert r.target == pytest.approx(want[source], rel=1e-9)
        taken[source] += r.size * r.copies
    assert len(got) == len(rows)
    for source, target in want.items():
        assert abs(taken[source] - target) <= max(ids[source].values()) / 2 + 1e-6
        whole = int(target // sizes[source])
        extra, best = target - whole * sizes[source], 0
        upto = [0]
        for h in sorted(ids[source]):
            upto.append(upto[-1] + ids[source][h])
        best = min(upto, key=lambda x: (abs(x - extra), x))
        assert abs(taken[source] - whole * sizes[source] - extra) == pytest.approx(abs(best - extra), abs=1e-6)
    again = op8_mixing.mix(docs.repartition(7)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    assert op8_mixing.mixed(docs).count() == sum(r.copies for r in got)


@pytest.mark.parametrize("same_text", [True, False])
@pytest.mark.parametrize("hot", [None, 7])
def test_mix_splits_the_rows_of_one_id(spark, hot, same_text):
    rng = random.Random(3)
    rows = [(1000 + i, sentence(rng, 40 + i % 9), "en", s, 0, "", "", "", "", "") for i in range(60) for s in ("a", "b", None)]
    text = sentence(rng, 50)
    rows += [(hot, text if same_text else sentence(rng, rng.randint(30, 60)), "en", s, 0, "", "", "", "", "") for _ in range(400) for s in ("a", "b", None)]
    docs = frame(spark, rows)
    got = op8_mixing.mix(docs).collect()
    taken, target = defaultdict(int), {}
    for r in got:
        taken[r.doc.source] += r.size * r.copies
        target[r.doc.source] = r.target
    assert len(got) == len(rows)
    assert all(abs(taken[s] - target[s]) <= 30 for s in target)  # half the longest row
    again = op8_mixing.mix(docs.repartition(7)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_mix_of_sources_without_words(spark):
    rows = [(1, None, "en", "a", 0, "", "", "", "", ""), (2, " ", "en", "b", 0, "", "", "", "", "")]
    assert {(r.size, r.target, r.copies) for r in op8_mixing.mix(frame(spark, rows)).collect()} == {(0, 0.0, 0)}


def test_shards(spark):
    rows = documents(n=300)
    got = op9_sharding.shard_by_bytes(frame(spark, rows)).collect()
    want = sorted((str(r[0]), len((r[1] or "").encode()) + 8, zlib.crc32((r[1] or "").encode())) for r in rows)
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in got) == want
    slots, sizes = defaultdict(list), defaultdict(int)
    for r in got:
        slots[r.shard].append((r.slot, r.text_crc32))
        sizes[r.shard] += r.size
    assert all(sorted(s for s, _ in x) == list(range(len(x))) for x in slots.values()) and set(slots) <= set(range(24))
    order = [c for k in sorted(slots) for _, c in sorted(slots[k])]
    assert order == sorted(order)  # contiguous in one global order
    total, largest = sum(sizes.values()), max(r.size for r in got)
    assert all(abs(sizes.get(k, 0) - total / 24) <= largest for k in range(24))


def test_shards_of_equal_rows(spark):
    rows = [(1, "same text", "en", "a", 0, "", "", "", "", "")] * 240
    got = op9_sharding.shard_by_bytes(frame(spark, rows)).groupBy("shard").count().collect()
    assert sorted(r["count"] for r in got) == [10] * 24


def plain_shards(texts, shards):
    """Sorted (checksum, size) -> shard: prefix sums, equal targets, cuts moved out of small groups."""
    rows = sorted((zlib.crc32(t.encode()), len(t.encode()) + 8) for t in texts)
    starts = [0]
    for _, size in rows:
        starts.append(starts[-1] + size)
    total, cuts = starts[-1], []
    for k in range(1, shards):
        cut = total * k / shards
        for key in set(rows):
            a, b = starts[rows.index(key)], starts[rows.index(key) + rows.count(key)]
            if a < cut < b and (b - a) * shards * op9_sharding.WIDEST <= total:
                cut = a if cut - a <= b - cut else b
        cuts.append(cut)
    return sorted((*row, sum(at + row[1] / 2 >= c for c in cuts)) for row, at in zip(rows, starts))


def test_shards_against_plain_cuts(spark):
    rng = random.Random(7)
    texts = [sentence(rng, rng.randint(1, 30)) for _ in range(150)]
    texts += [t for t in texts for _ in range(rng.choice([0, 0, 1, 3]))] + ["x" * 900] * 30  # a group of over a shard
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for shards in (1, 2, 3, 5):
        got = op9_sharding.shard_by_bytes(docs, shards=shards).collect()
        assert sorted((r.text_crc32, r.size, r.shard) for r in got) == plain_shards(texts, shards)


def test_packing_refuses_other_tokenizers(spark):
    with pytest.raises(ValueError, match="lower-cases"):
        op5_packing.pack(frame(spark, documents()), public_tokenizers.path("byte_bpe_50k.json"))
