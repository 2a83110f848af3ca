"""Language identification by error-correcting output codes.

Each language has a codeword of +1/-1 bits. One binary classifier per bit
weighs hashed character n-grams (naive Bayes log-odds of the languages whose
bit is +1 against the others; every language counts alike, however many rows
it has). Decoding adds, for each language, the logistic loss of the bits'
margins against its codeword and takes the least; a close runner-up, or a
bit pattern far from every codeword, flags the row as ambiguous."""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crashlake.llm.common import chunks

#: Hash classes of the n-grams (two and three characters), smoothing, and the n-grams that count as full evidence.
FEATURES, SMOOTH, EVIDENCE = 1 << 14, 0.5, 64
#: A lead in probability below this is ambiguous.
LEAD = 0.2
GRAMS = 1 << 17


@functools.cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hash class of each n-gram, each text's number of n-grams); lower case,
    letters only, every other run of characters counts as one blank."""
    low = [f" {t.lower()} " for t in texts]
    size = np.fromiter(map(len, low), dtype=np.int64, count=len(low))
    code = np.frombuffer("".join(low).encode("utf-32-le"), dtype=np.uint32)
    letter = _letters()[code]
    code = np.where(letter, code, np.uint32(32))
    doc = np.repeat(np.arange(len(low)), size)
    keep = letter | np.concatenate([[True], letter[:-1] | (doc[1:] != doc[:-1])]) if len(code) else letter
    code, doc, letter = code[keep], doc[keep], letter[keep]
    a, b, c = code[:-2], code[1:-1], code[2:]
    two = (code[:-1] * np.uint32(0x9E3779B1) + code[1:] * np.uint32(0x85EBCA77)) if len(code) > 1 else code[:0]
    ok2 = (doc[:-1] == doc[1:]) & (letter[:-1] | letter[1:])
    three = (a * np.uint32(0xC2B2AE3D) + b * np.uint32(0x27D4EB2F) + c * np.uint32(0x165667B1)) * np.uint32(0x9E3779B1) if len(code) > 2 else code[:0]
    ok3 = (doc[:-2] == doc[2:]) & letter[1:-1]
    h = np.concatenate([two[ok2], three[ok3]])
    of = np.concatenate([doc[:-1][ok2], doc[:-2][ok3]])
    order = np.argsort(of, kind="stable")
    h ^= h >> np.uint32(15)
    return (h[order] & np.uint32(FEATURES - 1)).astype(np.int64), np.bincount(of, minlength=len(low))


def codewords(n: int) -> np.ndarray:
    """n rows of +1/-1: the exhaustive code up to seven languages, else the widest of a hundred seeded random codes of 15 log2 n bits."""
    if n <= 1:
        return np.ones((n, 1))
    if n <= 7:
        bits = np.arange(2 ** (n - 1) - 1) + 2 ** (n - 1)
        return np.stack([np.where(bits >> (n - 1 - k) & 1, 1.0, -1.0) for k in range(n)])
    rng, best, far = np.random.default_rng(7), None, -1
    for _ in range(100):
        code = rng.choice([-1.0, 1.0], size=(n, math.ceil(15 * math.log2(n))))
        apart = int(((code.shape[1] - code @ code.T) / 2 + code.shape[1] * np.eye(n)).min())
        if apart > far and (np.abs(code.sum(axis=0)) < n).all():
            best, far = code, apart
    return best


class CodeModel:
    """Languages, their codewords and the bit classifiers' weights (features x bits)."""

    def __init__(self, langs: list[str], counts: np.ndarray):
        self.langs, self.code = langs, codewords(len(langs))
        share = (counts + SMOOTH) / (counts.sum(axis=1, keepdims=True) + SMOOTH * FEATURES)
        with np.errstate(divide="ignore", invalid="ignore"):
            plus = np.maximum(self.code, 0).T @ share / np.maximum(self.code, 0).sum(axis=0)[:, None]
            minus = np.maximum(-self.code, 0).T @ share / np.maximum(-self.code, 0).sum(axis=0)[:, None]
            self.weights = np.nan_to_num(np.log(plus) - np.log(minus), posinf=0.0, neginf=0.0).T.copy() if langs else np.zeros((FEATURES, 1))

    def margins(self, h: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Mean log-odds of each text's n-grams per bit, times its evidence."""
        out = np.zeros((len(size), self.weights.shape[1]))
        ends = np.cumsum(size)
        for at in range(0, len(h), GRAMS):
            to = min(at + GRAMS, len(h))
            first, last = np.searchsorted(ends, [at, to - 1], "right")
            some = np.arange(first, last + 1)
            some = some[size[some] > 0]
            starts = np.maximum(ends[some] - size[some], at) - at
            out[some] += np.add.reduceat(self.weights[h[at:to]], starts, axis=0)
        return out / np.maximum(size, 1)[:, None] * np.minimum(size, EVIDENCE)[:, None]

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(language, score, ambiguous) of each text."""
        h, size = grams(texts)
        if not self.langs:
            return ["und"] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        margin = self.margins(h, size)
        loss = np.logaddexp(0, -margin[:, None, :] * self.code[None]).sum(axis=2)
        prob = np.exp(loss.min(axis=1, keepdims=True) - loss)
        prob /= prob.sum(axis=1, keepdims=True)
        best = loss.argmin(axis=1)
        top = np.sort(prob, axis=1)
        wrong = (np.sign(margin) != self.code[best]).sum(axis=1)
        unsure = (wrong * 4 > self.code.shape[1]) | (top[:, -1] - (top[:, -2] if len(self.langs) > 1 else 0) < LEAD)
        none = size == 0
        return [("und" if z else self.langs[i]) for i, z in zip(best, none)], np.where(none, 0.0, top[:, -1]), unsure | none


def _counter(index: dict[str, int]):
    def count(batches):
        sums = np.zeros(len(index) * FEATURES, dtype=np.int64)
        for batch in batches:
            lang = batch.column("lang").to_pylist()
            for at, some in chunks(batch.column("text")):
                h, size = grams([t or "" for t in some.to_pylist()])
                of = np.fromiter((index[x] for x in lang[at:at + len(some)]), dtype=np.int64, count=len(some))
                sums += np.bincount(np.repeat(of, size) * FEATURES + h, minlength=len(sums))
        at = np.flatnonzero(sums)
        yield pa.record_batch({"lang": at // FEATURES, "feature": at % FEATURES, "n": sums[at]})

    return count


def train(labelled: DataFrame, text: str = "text", lang: str = "lang") -> CodeModel:
    """Fit on every row with a language: exact n-gram counts per language, summed
    in Spark; the driver gets languages x FEATURES numbers, however many rows."""
    rows = labelled.select(F.col(text).alias("text"), F.col(lang).alias("lang")).where("lang is not null")
    langs = sorted(r[0] for r in rows.select("lang").distinct().collect())
    counts = np.zeros((len(langs), FEATURES))
    if langs:
        sums = rows.mapInArrow(_counter({x: i for i, x in enumerate(langs)}), "lang bigint, feature bigint, n bigint")
        got = sums.groupBy("lang", "feature").agg(F.sum("n").alias("n")).toPandas()
        counts[got["lang"], got["feature"]] = got["n"]
    return CodeModel(langs, counts)


def language(text: Column | str, model: CodeModel, spark) -> Column:
    """struct(lang, score, ambiguous) of a text, read whole; ``und`` with score 0
    where it is null or has no letter, or where nothing was learned."""
    shared = spark.sparkContext.broadcast(model)  # languages x bits and FEATURES x bits numbers

    @F.arrow_udf("struct<lang:string,score:double,ambiguous:boolean>")
    def language_code(batch: pa.Array) -> pa.Array:
        langs, scores, unsure = [], [], []
        for _, some in chunks(batch):
            got = shared.value.predict([t or "" for t in some.to_pylist()])
            for out, part in zip((langs, scores, unsure), got):
                out.extend(part)
        return pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(unsure, pa.bool_())], ["lang", "score", "ambiguous"])

    return language_code(text)
