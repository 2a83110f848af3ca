"""Quality by nearest neighbours in a latent-semantic space.

A text becomes hashed counts of its form - runs of like characters (lower case,
upper case, digits, blanks, each sign by itself, by the Unicode category of
every code point) in 2-, 3- and 5-grams, words repeating the word one or two
before, and how often - and of its lower-cased words. Square-root counts times
inverse document frequency, each half scaled to length one and words weighing
WORD_WEIGHT, are projected on the leading singular directions of a bounded
sample of labelled rows. Every document is compared with all labelled vectors,
in blocks of exact cosine products; its nearest ones vote with their similarity.
The vote counts by how much of the text the latent space holds at all, so that
text of familiar form but of words or signs never seen scores lower.

Counts, directions and vectors are rounded to fixed steps, so that products are
exact sums of whole numbers: a score does not depend on how batches are cut, and
of neighbours equally near the one of the smaller id votes."""

from __future__ import annotations

import functools
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crashlake.llm.common import chunks, split_words

#: Hash classes of forms and of words, latent directions, labelled rows of each class at most, voting neighbours, and the power of a similarity in the vote.
FORMS, WORDS, DIRECTIONS, SAMPLE, NEIGHBOURS, POWER = 1024, 1024, 48, 1024, 15, 4
FEATURES = FORMS + WORDS
#: Weight of the words beside the forms, and the held share of a text that halves its vote.
WORD_WEIGHT, UNHELD = 0.5, 0.1
#: Steps of weighted counts and directions, and of latent vectors: sums of products stay below 2^53.
STEP, FINE = 2.0**16, 2.0**20
#: Texts compared with the labelled vectors at once.
BLOCK = 512
_OTHER = 6


@functools.cache
def _kinds() -> np.ndarray:
    """Kind of each code point by its Unicode category: 1 a letter not upper case or a mark on it, 2 upper case, 3 digit, 4 blank, 5 line end, else its own."""
    def kind(c: str) -> int:
        if c.isalpha():
            return 2 if c.isupper() else 1
        return 5 if c == "\n" else 4 if c.isspace() else 3 if c.isdigit() else 1 if unicodedata.category(c)[0] == "M" else _OTHER + ord(c)
    return np.fromiter((kind(chr(c)) for c in range(0x110000)), dtype=np.uint32, count=0x110000)


def counts(text: pa.Array) -> np.ndarray:
    """texts x FEATURES counts."""
    texts = [t or "" for t in text.to_pylist()]
    size = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    code = np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32)
    kind = _kinds()[code]
    doc = np.repeat(np.arange(len(texts)), size)
    turn = np.concatenate([[True], (kind[1:] != kind[:-1]) | (doc[1:] != doc[:-1])]) if len(kind) else np.empty(0, bool)
    kind, doc = kind[turn], doc[turn]
    out = np.zeros(len(texts) * FORMS, dtype=np.int64)
    for n, salt in ((2, 0x85EBCA77), (3, 0x9E3779B1), (5, 0xC2B2AE3D)):
        if len(kind) < n:
            continue
        last = len(kind) - n + 1
        h = np.full(last, salt, dtype=np.uint32)
        for k in range(n):
            h = (h ^ kind[k:k + last]) * np.uint32(0x01000193)
        h ^= h >> np.uint32(15)
        same = doc[:last] == doc[n - 1:]
        out += np.bincount(doc[:last][same] * FORMS + (h[same] % np.uint32(FORMS - 8)).astype(np.int64), minlength=len(out))
    flat, words = split_words(pc.ascii_lower(text))
    out = np.hstack([out.reshape(-1, FORMS), np.zeros((len(texts), WORDS), dtype=np.int64)])
    if len(flat):
        coded = flat.dictionary_encode()
        codes = np.asarray(coded.indices)
        of = np.repeat(np.arange(len(texts)), words)
        for back in (1, 2):  # the last eight classes of forms: words that repeat, and words in all
            same = (codes[back:] == codes[:-back]) & (of[back:] == of[:-back])
            out[:, FORMS - back] = np.bincount(of[back:][same], minlength=len(texts)) * 8
        out[:, FORMS - 3] = words
        place = np.fromiter((xxhash.xxh32_intdigest(w) % WORDS for w in coded.dictionary.to_pylist()), dtype=np.int64, count=len(coded.dictionary))
        out[:, FORMS:] = np.bincount(of * WORDS + place[codes], minlength=len(texts) * WORDS).reshape(-1, WORDS)
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


class Neighbours:
    """Latent vectors of the labelled rows and their labels."""

    def __init__(self, rows: np.ndarray, labels: np.ndarray, shares: dict[int, float]):
        self.idf = np.log((1 + len(rows)) / (1 + (rows > 0).sum(axis=0))) + 1
        weighted = self.weigh(rows)
        # right singular vectors of the sample by its FEATURES x FEATURES products
        value, vector = np.linalg.eigh(weighted.T @ weighted)
        keep = np.argsort(-value, kind="stable")[:DIRECTIONS]
        vector = vector[:, keep] * np.sign(vector[np.abs(vector[:, keep]).argmax(axis=0), keep])
        self.project = np.round(vector * STEP) / STEP
        self.vectors = np.ascontiguousarray(self._latent(weighted)[0].T)
        # a label counts by its share of all labelled rows, not of the balanced sample
        self.labels = labels
        taken = {y: max(1, int((labels == y).sum())) for y in (0, 1)}
        self.weight = np.array([shares.get(int(y), 0.0) / taken[int(y)] for y in labels])
        self.weight = self.weight / self.weight.max(initial=1e-12)

    def weigh(self, rows: np.ndarray) -> np.ndarray:
        halves = []
        for some, weight in ((slice(0, FORMS), 1.0), (slice(FORMS, FEATURES), WORD_WEIGHT)):
            share = rows[:, some] / np.maximum(rows[:, some].sum(axis=1, keepdims=True), 1)
            halves.append(_unit(np.sqrt(share) * self.idf[some]) * weight)
        return np.round(np.hstack(halves) / np.hypot(1.0, WORD_WEIGHT) * STEP) / STEP

    def _latent(self, weighted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Latent vectors of length one, and the share of each text that they hold."""
        at = weighted @ self.project
        return np.round(_unit(at) * FINE) / FINE, np.clip((at * at).sum(axis=1), 0.0, 1.0)

    def _vote(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Similarity-weighted share of label 1 among each text's nearest
        neighbours, and the share of the text that the latent space holds."""
        out, held = np.zeros(len(rows)), np.zeros(len(rows))
        k, n = min(NEIGHBOURS, len(self.labels)), len(self.labels)
        for at in range(0, len(rows) if k else 0, BLOCK):
            latent, held[at:at + BLOCK] = self._latent(self.weigh(rows[at:at + BLOCK]))
            near = latent @ self.vectors
            # whole numbers, all different: similarity first, then the smaller id
            order = near * FINE * FINE * n - np.arange(n)
            best = np.argpartition(-order, k - 1, axis=1)[:, :k]
            best = np.take_along_axis(best, np.argsort(-np.take_along_axis(order, best, axis=1), axis=1), axis=1)
            vote = np.maximum(np.take_along_axis(near, best, axis=1), 0) ** POWER * self.weight[best]
            total = vote.sum(axis=1)
            out[at:at + BLOCK] = np.where(total > 0, (vote * self.labels[best]).sum(axis=1) / np.maximum(total, 1e-300), 0.0)
        return np.clip(np.where(rows.sum(axis=1) > 0, out, 0.0), 0.0, 1.0), held

    def score(self, rows: np.ndarray) -> np.ndarray:
        """The neighbours' vote alone."""
        return self._vote(rows)[0]

    def quality(self, rows: np.ndarray) -> np.ndarray:
        """The vote, less where the latent space holds little of the text."""
        vote, held = self._vote(rows)
        return vote * held / (held + UNHELD)


def train(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "quality") -> Neighbours:
    """Fit on a bounded sample: of each label the SAMPLE rows with the smallest
    hashed ids. ``labels`` holds the rows that may be learned from; rows of
    other labels than 0 and 1, or of no id, teach nothing; of several labels or
    texts of one id the smallest counts."""
    known = labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("y")).where("id is not null and y in (0, 1)").groupBy("id").agg(F.min("y").alias("y"))
    present = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    total = {int(y): n for y, n in known.groupBy("y").count().collect()}
    order = F.xxhash64("id")
    picked = known.where("y = 0").orderBy(order, "id").limit(SAMPLE).union(known.where("y = 1").orderBy(order, "id").limit(SAMPLE))
    feature = F.arrow_udf(_features, "binary")
    # at most 2 * SAMPLE ids are broadcast
    sample = present.join(F.broadcast(picked), "id").groupBy("id").agg(F.min("text").alias("text"), F.first("y").alias("y"))
    got = sample.select("id", "y", feature("text").alias("f")).orderBy("id").collect()
    rows = np.frombuffer(b"".join(r["f"] for r in got), dtype="<i4").astype(np.int64).reshape(-1, FEATURES)
    n = max(1, sum(total.values()))
    return Neighbours(rows, np.array([r["y"] for r in got], dtype=np.int64), {y: c / n for y, c in total.items()})


def _features(batch: pa.Array) -> pa.Array:
    return pa.array([row.astype("<i4").tobytes() for _, some in chunks(batch) for row in counts(some)], pa.binary())


def quality(text: Column | str, model: Neighbours, spark) -> Column:
    """Score from 0 to 1 of a whole text; a null or empty text scores 0, as does
    every text when there are no labels."""
    shared = spark.sparkContext.broadcast(model)  # at most 2 * SAMPLE vectors of DIRECTIONS numbers

    @F.arrow_udf("double")
    def neighbour_vote(batch: pa.Array) -> pa.Array:
        parts = [shared.value.quality(counts(some)) for _, some in chunks(batch)]
        return pa.array(np.concatenate(parts) if parts else np.empty(0), pa.float64())

    return neighbour_vote(text)
