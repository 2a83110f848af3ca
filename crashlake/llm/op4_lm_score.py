"""Cross-entropy difference of matched n-gram models.

The target model learns from the rows of given ids, the background model from all
rows. Both are interpolated word-bigram models over one shared vocabulary,
all lower-cased words that occur. Background counts are scaled to the target's
number of words, so both are smoothed alike. A document's score is the mean
over its words of target loss minus background loss: lower is closer to the
target. The texts are dealt into two halves by a hash of the whole text, and a
document is scored by the models of the half it is not in: no text, and no
exact copy of it, is scored by counts it gave itself.

Texts are cut into slices of one half each. A slice sends each distinct word and
pair of words of its texts once, as a 64-bit key with its counts, to the bucket
of that key's leading bits; the number of buckets follows the size of the
texts, so that one holds a bounded share. A bucket adds up what it got and
answers each slice with the counts of its keys in the other half, in the order
asked. With the answers the slice scores its texts in place. No key travels more
often than once a slice, so none is hot. Numbers travel as differences and by
compressed byte planes.

A null or wordless text has 0 words and null losses. Repeated rows count, and are
scored, each; a very long text is a slice of its own; without target rows the target is
smoothing alone; an empty table gives none; columns of any other name are not looked at."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crashlake.llm.common import chunks, split_words, stage, unstage

#: Weight of the smoothing distribution, bytes of text in a slice, and of all texts for each bucket.
PRIOR, SLICE_BYTES, BUCKET_BYTES = 4.0, 4 << 20, 6 << 20
#: Stands before a text's first word; no word's key but by a chance of 1 in 2^63.
START = np.uint64(0)
#: Losses are summed in whole 1/FINE, so that sums do not depend on their order.
FINE = 1 << 20
#: A slice: ids and words of its texts, its words' keys and each place's word.
SLICE = "half int, ids array<string>, sizes array<int>, keys binary, places binary"
ASKED = "bucket int, slice bigint, half int, keys binary, counts binary"
ASKED_TYPES = pa.schema([("bucket", pa.int32()), ("slice", pa.int64()), ("half", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])
ANSWERS = "owner bigint, bucket int, width int, counts binary, used array<bigint>"
SCORES = "doc_id string, n_words bigint, target_loss double, background_loss double"
SCORE_TYPES = pa.schema([("doc_id", pa.string()), ("n_words", pa.int64()), ("target_loss", pa.float64()), ("background_loss", pa.float64())])


def planes(values: np.ndarray) -> bytes:
    """The first bytes of all values, then the second ones, and so on, compressed."""
    data = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1).T.tobytes() if len(values) else b""
    return zstandard.compress(data, 1)


def unplaned(data: bytes, kind, columns: int = 1) -> np.ndarray:
    """The values, in rows of ``columns`` if there are several."""
    size = np.dtype(kind).itemsize * columns
    values = np.ascontiguousarray(np.frombuffer(zstandard.decompress(data), np.uint8).reshape(size, -1).T).view(kind)
    return values if columns > 1 else values.reshape(-1)


def _slice(half: int, rows: list[pa.RecordBatch]) -> pa.RecordBatch:
    """A row of SLICE."""
    some = pa.Table.from_batches(rows)
    flat, sizes = split_words(pc.ascii_lower(some.column("text").combine_chunks()))
    coded = flat.dictionary_encode()
    keys = np.fromiter((xxhash.xxh64_intdigest(w) for w in coded.dictionary.cast(pa.large_binary()).to_pylist()), np.uint64, len(coded.dictionary))
    places = np.asarray(coded.indices).astype(np.int32)
    order = np.argsort(-np.bincount(places, minlength=len(keys)), kind="stable")  # small numbers for frequent words
    rank = np.empty(len(keys), np.int32)
    rank[order] = np.arange(len(keys), dtype=np.int32)
    return pa.record_batch({"half": pa.array([half], pa.int32()), "ids": pa.array([some.column("id").to_pylist()], pa.list_(pa.string())), "sizes": pa.array([sizes], pa.list_(pa.int32())),
                            "keys": pa.array([planes(keys[order])], pa.binary()), "places": pa.array([planes(rank[places])], pa.binary())})


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of SLICE, of about SLICE_BYTES of one half's texts each, also from several batches."""
    waiting: dict[int, tuple[list[pa.RecordBatch], int]] = {0: ([], 0), 1: ([], 0)}
    for batch in (whole.slice(at, 512) for whole in batches for at in range(0, whole.num_rows, 512)):
        for half in (0, 1):
            own = batch.filter(pc.equal(batch.column("half"), half))
            own = own.set_column(own.schema.get_field_index("text"), "text", own.column("text").cast(pa.large_string()))
            for at, text in chunks(own.column("text"), SLICE_BYTES // 4):
                rows, size = waiting[half]
                rows, size = [*rows, own.slice(at, len(text))], size + text.nbytes
                if size < SLICE_BYTES:
                    waiting[half] = rows, size
                else:
                    waiting[half] = [], 0
                    yield _slice(half, rows)
                    pa.default_memory_pool().release_unused()
    for half, (rows, _) in waiting.items():
        if rows:
            yield _slice(half, rows)


class Texts:
    """A slice: the size of each text, where those with words begin, its distinct keys in order, and the number of each place's word and pair among them.

    A key is 63 bits of a hash, and a last one for pairs."""

    def __init__(self, row: dict):
        self.sizes = np.array(row["sizes"], dtype=np.int64)
        words = unplaned(row["keys"], np.uint64)[unplaned(row["places"], np.int32)]
        self.first = (np.cumsum(self.sizes) - self.sizes)[self.sizes > 0]
        pairs = np.concatenate([[START], words[:-1]])[:len(words)]
        pairs[self.first] = START
        pairs = (pairs * np.uint64(0x9E3779B97F4A7C15)) ^ (words * np.uint64(0xC2B2AE3D27D4EB4F) + (pairs >> np.uint64(29)))
        pairs *= np.uint64(0x165667B19E3779F9)
        pairs ^= pairs >> np.uint64(32)
        self.keys, numbers = np.unique(np.concatenate([words & ~np.uint64(1), pairs | np.uint64(1)]), return_inverse=True)
        self.word, self.pair = numbers[:len(words)], numbers[len(words):]


def _binary(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.binary())


def _ask(buckets: int):
    """Rows of ASKED: a slice's distinct keys by bucket, with their words in the background and in its ``members`` (pos)."""
    def run(key, slices: pa.Table, members: pa.Table) -> pa.Table:
        if not slices.num_rows:
            return ASKED_TYPES.empty_table()
        row = slices.to_pylist()[0]
        texts = Texts(row)
        member = np.zeros(len(texts.sizes), bool)
        member[members.column("pos").to_numpy()] = True
        counts = np.zeros((len(texts.keys), 2), np.int32)
        for c, chosen in enumerate((np.ones(len(texts.word), bool), np.repeat(member, texts.sizes))):
            for numbers in (texts.word, texts.pair):
                counts[:, c] += np.bincount(numbers[chosen], minlength=len(texts.keys)).astype(np.int32)
        bucket = ((texts.keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)
        own, starts = np.unique(bucket, return_index=True)
        cuts = list(zip(starts, [*starts[1:], len(bucket)]))
        keys = [planes(np.diff(texts.keys[a:b], prepend=np.uint64(0))) for a, b in cuts]
        return pa.table([pa.array(own, pa.int32()), pa.array([row["slice"]] * len(own), pa.int64()), pa.array([row["half"]] * len(own), pa.int32()),
                         _binary(keys), _binary([planes(counts[a:b]) for a, b in cuts])], schema=ASKED_TYPES)
    return run


def _answer(asked: pa.Table) -> pa.Table:
    """Rows of ANSWERS of one bucket: to each slice the counts of its keys in the other half;
    and to none, the background's words of either half."""
    keys = [np.cumsum(unplaned(b, np.uint64), dtype=np.uint64) for b in asked.column("keys").to_pylist()]
    counts = [unplaned(b, np.int32, 2) for b in asked.column("counts").to_pylist()]
    halves = asked.column("half").to_numpy()
    known, numbers = np.unique(np.concatenate(keys), return_inverse=True)
    sums = np.zeros((2, len(known), 2), np.int64)
    ends = np.cumsum([len(k) for k in keys])
    own = [numbers[e - len(k):e] for k, e in zip(keys, ends)]
    for half, number, count in zip(halves, own, counts):
        sums[half, number] += count  # a slice's keys are distinct
    used = [int(((known & np.uint64(1) == 0) & (sums[h, :, 0] > 0)).sum()) for h in (0, 1)]
    told = [sums[1 - half, number] for half, number in zip(halves, own)]
    width = np.array([4 if t.max() < 2**31 else 8 for t in told], np.int32)
    told = [planes(t.astype(np.int32 if w == 4 else np.int64)) for t, w in zip(told, width)]
    answers = pa.table({"owner": asked.column("slice"), "bucket": asked.column("bucket"), "width": width, "counts": _binary(told)})
    return pa.concat_tables([answers, pa.table({"used": pa.array([used], pa.list_(pa.int64()))})], promote_options="default").select(["owner", "bucket", "width", "counts", "used"])


def _losses(totals: np.ndarray, starts: np.ndarray, used: np.ndarray):
    """Scores the texts of a slice by what it was answered. ``totals`` and ``starts``: words, and
    texts with words, by half and kind; ``used``: words of the background by half."""
    def run(key, slices: pa.Table, answers: pa.Table) -> pa.Table:
        if not slices.num_rows:
            return SCORE_TYPES.empty_table()
        row = slices.to_pylist()[0]
        texts, other = Texts(row), 1 - row["half"]
        told = [np.zeros((0, 2), np.int64)]
        for answer in answers.sort_by("bucket").to_pylist():
            told.append(unplaned(answer["counts"], np.int32 if answer["width"] == 4 else np.int64, 2))
        counts = np.concatenate(told)
        if len(counts) != len(texts.keys):
            raise ValueError("a slice got other answers than it asked for")
        some, means = texts.sizes > 0, []
        for k in range(2):
            total = float(totals[other, k])
            scale = (float(totals[other, 1]) or total) / total if total else 0.0  # matched sizes
            single = counts[texts.word, k].astype(float)
            before = np.concatenate([[0.0], single[:-1]])[:len(single)]
            before[texts.first] = starts[other, k]
            smooth = (scale * single + 1) / (scale * total + max(1, int(used[other])) + 1)
            loss = -np.log((scale * counts[texts.pair, k] + PRIOR * smooth) / (scale * before + PRIOR))
            mean = np.full(len(texts.sizes), np.nan)
            if some.any():
                mean[some] = np.add.reduceat(np.round(FINE * loss).astype(np.int64), texts.first) / (texts.sizes[some] * float(FINE))
            means.append(pa.array(mean, pa.float64(), mask=~some))
        return pa.table([pa.array(row["ids"], pa.string()), pa.array(texts.sizes, pa.int64()), means[1], means[0]], schema=SCORE_TYPES)
    return run


def score(docs: DataFrame, target: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n_words, target_loss, background_loss, score of each row of ``docs``. The rows
    whose id is in ``target`` (``doc_id``) are what the target model learns from."""
    body = F.col(text).cast("string")
    half = F.coalesce(F.xxhash64(body).bitwiseAND(F.lit(1)), F.lit(0)).cast("int")
    rows = docs.select(F.col(doc_id).cast("string").alias("id"), half.alias("half"), body.alias("text"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    slices = stage(rows.mapInArrow(_slices, SLICE).withColumn("slice", F.monotonically_increasing_id()), "slices")
    # only ids meet the target's
    texts = slices.select(F.col("slice").alias("owner"), "half", F.posexplode(F.arrays_zip("ids", "sizes")).alias("pos", "x"))
    texts = texts.select("owner", "half", "pos", F.col("x.ids").alias("id"), F.col("x.sizes").alias("size"))
    members = stage(texts.join(target.select(F.col(doc_id).cast("string").alias("id")), "id", "left_semi").drop("id"), "members")
    totals, starts = np.zeros((2, 2), np.int64), np.zeros((2, 2), np.int64)
    for k, some in enumerate((texts, members)):
        for r in some.groupBy("half").agg(F.sum("size").alias("words"), F.count(F.when(F.col("size") > 0, 1)).alias("texts")).collect():
            totals[r.half, k], starts[r.half, k] = r.words, r.texts
    asked = slices.groupBy("slice").cogroup(members.select("owner", "pos").groupBy("owner")).applyInArrow(_ask(max(1, -(-size // BUCKET_BYTES))), ASKED)
    answers = stage(asked.groupBy("bucket").applyInArrow(_answer, ANSWERS), "answers")
    used = np.array(answers.where("used is not null").agg(*[F.coalesce(F.sum(F.get("used", F.lit(h))), F.lit(0)) for h in (0, 1)]).first())
    told = answers.where("used is null").select("owner", "bucket", "width", "counts")
    scored = slices.groupBy("slice").cogroup(told.groupBy("owner")).applyInArrow(_losses(totals, starts, used), SCORES)
    scored = stage(scored, "scores")
    unstage(slices, answers, members)
    kind = docs.schema[doc_id].dataType
    return scored.select(F.col("doc_id").cast(kind).alias("doc_id"), "n_words", "target_loss", "background_loss", (F.col("target_loss") - F.col("background_loss")).alias("score"))
