"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

A text, normalised by the library, is cut where no piece of the vocabulary can
reach across (before a word's space sign, and between characters that no chain of
neighbours within pieces links, such as a letter and a full stop), and each part is encoded by a
score-ordered agenda: all adjacent pairs of symbols that form a piece lie in a
heap, the best one (ties: the leftmost) is merged, and the pairs it forms with its
neighbours join the agenda, until none is left. Symbols that are no piece
become their UTF-8 bytes. In each Arrow batch the ids of all parts worked out there are
compared with those of the sentencepiece library, and a difference is an error;
the ids are decoded by the library.

A worker remembers the ids of the parts it met; what it remembers is bounded, and
so is the text worked on at once. A null text is empty, an empty one has the end id
alone and decodes to an empty text; very long texts and parts are encoded whole;
equal rows get equal results; an empty table gives none; the result is one
column, so names in the input cannot clash with it."""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Iterable
from heapq import heapify, heappop, heappush
from itertools import chain
from operator import add

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from crashlake.llm.common import chunks

#: The library's sign for a space; parts that a worker remembers, at most twice over, and their longest.
SPACE, KNOWN, KNOWN_LENGTH = "▁", 1 << 19, 48


def agenda(symbols: list[str], cost: Callable[[str], float | None]) -> list[str]:
    """``symbols`` after all merges. ``cost``: of a merged symbol, None if it is no
    piece; the least goes first, ties from the left."""
    n = len(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    pairs: list[str | None] = [*map(add, symbols, symbols[1:]), None]  # by their left symbol, None: no piece
    waiting = [(value, i, pairs[i]) for i, value in enumerate(map(cost, pairs[:-1])) if value is not None]
    heapify(waiting)
    while waiting:
        _, left, merged = heappop(waiting)
        if pairs[left] != merged:
            continue  # one of the two was merged elsewhere meanwhile
        right = after[left]
        symbols[left], symbols[right] = merged, ""
        pairs[left] = pairs[right] = None
        after[left] = following = after[right]
        if following < n:
            before[following] = left
            pair = merged + symbols[following]
            value = cost(pair)
            if value is not None:
                pairs[left] = pair
                heappush(waiting, (value, left, pair))
        leading = before[left]
        if leading >= 0:
            pair = symbols[leading] + merged
            value = cost(pair)
            if value is None:
                pairs[leading] = None
            else:
                pairs[leading] = pair
                heappush(waiting, (value, leading, pair))
    return [s for s in symbols if s]


def linked(pieces: Iterable[str]) -> list[set[str]]:
    """The characters with neighbours within the pieces, in one set if a chain of neighbours links them; larger sets first."""
    sets: dict[str, set[str]] = {}
    for piece in pieces:
        for a, b in zip(piece, piece[1:]):
            one, other = sorted((sets.setdefault(a, {a}), sets.setdefault(b, {b})), key=len)
            if one is not other:
                other |= one
                sets.update(dict.fromkeys(one, other))
    return sorted({id(x): x for x in sets.values()}.values(), key=len, reverse=True)


class Encoder(dict):
    """Ids (32-bit, as bytes) by part of a normalised text, worked out as they are asked for."""

    def __init__(self, proto: bytes):
        super().__init__()
        self.library = sp = sentencepiece.SentencePieceProcessor(model_proto=proto)
        n = sp.get_piece_size()
        special = {i for i in range(n) if sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i)}
        self.ids = {sp.id_to_piece(i): i for i in range(n) if i not in special}
        self.costs = {p: -sp.get_score(i) for p, i in self.ids.items()}
        self.bytes = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if not all(map(sp.is_byte, self.bytes)) or any(map(sp.is_unused, range(n))):
            raise ValueError("only vocabularies with byte fallback and without unused pieces are encoded")
        if [sp.normalize(x) for x in ("a", "a b", SPACE)] != [SPACE + "a", f"{SPACE}a{SPACE}b", 2 * SPACE]:
            raise ValueError("only vocabularies that put a space before a text and keep all others are encoded")
        # a space sign behind another character begins a new part, unless a piece holds both; so does a character linked to none before it
        across = any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.ids)
        runs = [f"[{re.escape(''.join(sorted(x)))}]+" for x in linked(p.lstrip(SPACE) for p in self.ids)]
        self.parts = re.compile("(?s).+" if across else f"(?s){SPACE}*(?:{'|'.join([*runs, '.'])})")
        # a character that no piece holds is put before parts without a space sign: the library's own sign then lies apart from them
        held = set(chain.from_iterable(self.ids))
        self.apart = next(c for c in map(chr, range(0xD800)) if c not in held and sp.normalize(c) == SPACE + c)
        self.before = sp.encode(self.apart)
        self.older: dict[str, bytes] = {}
        self.fresh: dict[str, list[int]] = {}

    def __missing__(self, part: str) -> bytes:
        ids = self.older.get(part)
        if ids is None:
            symbols = agenda(list(part), self.costs.get)
            found = [*map(self.ids.get, symbols)]
            if None in found:
                found = [x for s, i in zip(symbols, found) for x in ([self.bytes[b] for b in s.encode()] if i is None else [i])]
            if part[0] == SPACE:
                self.fresh[part[1:]] = found  # the library puts it there itself (but before no empty text)
            else:
                self.fresh[self.apart + part] = self.before + found
            ids = array("i", found).tobytes()
        if len(part) <= KNOWN_LENGTH:
            if len(self) >= KNOWN:  # parts not met since the last time are forgotten
                self.older = dict(self)
                self.clear()
            self[part] = ids
        return ids

    def coded(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts, each with the end id."""
        end = array("i", [self.library.eos_id()]).tobytes()
        coded = [b"".join([*map(self.__getitem__, self.parts.findall(t)), end]) for t in self.library.normalize(texts)]
        self.check()
        return coded

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [array("i", ids).tolist() for ids in self.coded(texts)]

    def check(self) -> None:
        """Compares the parts worked out since the last time with the library."""
        fresh, self.fresh = self.fresh, {}
        alone = [self.library.piece_to_id(SPACE)]
        if fresh.pop("", alone) != alone or self.library.encode([*fresh], num_threads=1) != [*fresh.values()]:
            raise ValueError("the sentencepiece library gives other ids: no merge-type vocabulary, or one with user-defined pieces")


#: The encoder of the last model that this worker used.
_encoders: dict[bytes, Encoder] = {}


def encode_decode(text: Column | str, model: str, spark: SparkSession) -> Column:
    """struct(ids, text): a text's ids with the end id, and what they decode to.
    ``model``: path of a sentencepiece model that the driver can read."""
    with open(model, "rb") as file:
        proto = spark.sparkContext.broadcast(file.read())  # as large as the vocabulary

    @F.arrow_udf("struct<ids:array<int>,text:string>")
    def pieces(batch: pa.Array) -> pa.Array:
        encoder = _encoders.get(proto.value)
        if encoder is None:
            _encoders.clear()
            encoder = _encoders[proto.value] = Encoder(proto.value)
        ids, sizes, decoded = [np.empty(0, np.int32)], [np.zeros(1, np.int32)], [pa.array([], pa.string())]
        for _, some in chunks(batch):
            texts = pc.fill_null(some, "").to_pylist()
            coded = encoder.coded(texts)
            ids.append(np.frombuffer(b"".join(coded), np.int32))
            sizes.append(np.fromiter(map(len, coded), np.int32, len(coded)) // 4)
            decoded.append(pa.array(encoder.library.decode([array("i", x).tolist() for x in coded], num_threads=1), pa.string()))
        offsets = np.cumsum(np.concatenate(sizes), dtype=np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(ids)))
        return pa.StructArray.from_arrays([lists, pa.concat_arrays(decoded)], ["ids", "text"])

    return pieces(text)
