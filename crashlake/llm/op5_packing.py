"""Packing of tokenised documents by first-fit decreasing.

A document's ids are cut into runs of at most ``length``; the pieces are dealt
into randomised groups of about GROUP_PIECES and each group is packed by
itself: pieces in descending length, each into the first sequence with room,
found in a tournament tree of the sequences' free room."""

from __future__ import annotations

import functools
import json
import os
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crashlake.llm.common import chunks, split_words, stage

#: Ids of a sequence, the id behind each document, pieces of a group on average, words
#: remembered by a worker, and words encoded in one call, and bytes of text taken at once.
LENGTH, END, GROUP_PIECES, REMEMBERED, TOGETHER, TEXT_BYTES = 2048, 1, 8192, 400_000, 32, 4 << 20
LETTERS = re.compile("[a-zß-öø-ÿ]+")


def check_definition(definition: str) -> None:
    """Raise unless the tokenizer lower-cases, drops white space and marks word ends:
    for others the ids of a text are not those of its words."""
    known = json.loads(definition)

    def steps(part: str, inner: str) -> list[dict]:
        step = known.get(part) or {}
        return step.get(inner, [step])

    cuts = steps("pre_tokenizer", "pretokenizers")
    lower = any(s.get("type") == "Lowercase" for s in steps("normalizer", "normalizers"))
    dropped = any(s.get("type") == "Split" and s.get("behavior") == "Removed" for s in cuts) and not any(s.get("add_prefix_space") for s in cuts)
    if not (lower and dropped and (known.get("model") or {}).get("end_of_word_suffix") == "</w>"):
        raise ValueError("packing needs a tokenizer that lower-cases, drops white space and ends words with </w>")


@functools.lru_cache(maxsize=2)
def _tokenizer(definition: str):
    """The tokenizer, which of its ids end a word, and the ids of the words seen so far."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(definition)
    ends = np.zeros(tokenizer.get_vocab_size(), dtype=bool)
    ends[[i for token, i in tokenizer.get_vocab().items() if token.endswith("</w>")]] = True
    return tokenizer, ends, {}


def _learn(tokenizer, ends: np.ndarray, known: dict[str, bytes], new: list[str]) -> None:
    """Encode the new words. Words of letters are one pretoken each: several go
    into one call, and the ids that end a word part them again."""
    plain = [w for w in new if LETTERS.fullmatch(w)]
    found = tokenizer.encode_batch_fast([" ".join(plain[k:k + TOGETHER]) for k in range(0, len(plain), TOGETHER)], add_special_tokens=False)
    ids = np.array([i for e in found for i in e.ids], dtype=np.uint32)
    cuts = np.concatenate([[0], np.flatnonzero(ends[ids]) + 1]).tolist()
    if len(cuts) == len(plain) + 1:
        whole = ids.tobytes()
        known.update(zip(plain, [whole[4 * a:4 * b] for a, b in zip(cuts, cuts[1:])]))
    rest = [w for w in new if w not in known]
    for w, e in zip(rest, tokenizer.encode_batch_fast(rest, add_special_tokens=False)):
        known[w] = np.array(e.ids, dtype=np.uint32).tobytes()


def word_ids(text: pa.Array, definition: str) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts, each text's number of ids), without special tokens.

    For tokenizers that drop white space and lower-case: blanks then separate
    pretokens, as does a letter before one of ``.,;:!?%$*#&``, so each distinct
    word is encoded once and its ids are gathered."""
    tokenizer, ends, known = _tokenizer(definition)
    spread = pc.replace_substring_regex(pc.ascii_lower(text), r"([a-zß-öø-ÿ])([.,;:!?%$*#&])", r"\1 \2")
    flat, sizes = split_words(spread)
    if not len(flat):
        return np.empty(0, np.uint32), np.zeros(len(text), np.int64)
    coded = flat.dictionary_encode()
    distinct = coded.dictionary.to_pylist()
    if len(known) > REMEMBERED:
        known.clear()
    _learn(tokenizer, ends, known, [w for w in distinct if w not in known])
    parts = [known[w] for w in distinct]
    ids = np.frombuffer(b"".join(parts), dtype=np.uint32)
    size = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)) // 4
    first = np.cumsum(size) - size
    word = np.asarray(coded.indices)
    each = size[word]
    last = np.cumsum(each)
    at = np.repeat(first[word] - (last - each), each) + np.arange(last[-1])
    of = np.repeat(np.arange(len(sizes)), sizes)
    return ids[at], np.bincount(of, weights=each, minlength=len(sizes)).astype(np.int64)


def pieces(text: Column | str, definition: str, length: int = LENGTH) -> Column:
    """struct(doc_tokens, pieces: array of (start, length, ids_crc32)) of a whole text; a null text is empty."""

    @F.arrow_udf("struct<doc_tokens:bigint,pieces:array<struct<start:bigint,length:bigint,ids_crc32:bigint>>>")
    def tokenised(batch: pa.Array) -> pa.Array:
        tokens, counts, starts, lengths, sums = [], [0], [], [], []
        end = np.array([END], dtype=np.uint32).tobytes()
        for _, some in chunks(batch, TEXT_BYTES):
            ids, sizes = word_ids(some, definition)
            whole, to = ids.tobytes(), 0
            for n in sizes.tolist():
                own = memoryview(whole)[4 * to:4 * (to + n)]
                to += n
                tokens.append(n + 1)
                for start in range(0, n + 1, length):
                    run = own[4 * start:4 * (start + length)]
                    size = min(length, n + 1 - start)
                    crc = zlib.crc32(run)
                    starts.append(start)
                    lengths.append(size)
                    sums.append(zlib.crc32(end, crc) if 4 * size > len(run) else crc)
                counts.append(len(starts))
        flat = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (starts, lengths, sums)], ["start", "length", "ids_crc32"])
        return pa.StructArray.from_arrays([pa.array(tokens, pa.int64()), pa.ListArray.from_arrays(pa.array(counts, pa.int32()), flat)], ["doc_tokens", "pieces"])

    return tokenised(text)


def first_fit(lengths: list[int], room: int) -> tuple[list[int], list[int]]:
    """(sequence, offset) of each length, taken in the given order: the first
    sequence with enough room, by a tournament tree whose nodes hold the most
    room below them."""
    leaves = 1
    while leaves < len(lengths):
        leaves *= 2
    tree = [room] * (2 * leaves)
    where, offset = [], []
    for size in lengths:
        node = 1
        while node < leaves:
            node *= 2
            if tree[node] < size:
                node += 1
        where.append(node - leaves)
        offset.append(room - tree[node])
        tree[node] -= size
        while node > 1:
            node //= 2
            best = max(tree[2 * node], tree[2 * node + 1])
            if tree[node] == best:
                break
            tree[node] = best
    return where, offset


def _packer(length: int):
    def pack(batches):
        """Rows sorted by group and descending length; one group is held at a time."""
        held, group = [], None

        def done():
            rows = pa.Table.from_batches(held)
            where, offset = first_fit(rows.column("length").to_pylist(), length)
            ids = pa.array(np.array(where, dtype=np.int64) + (group << 32))
            out = rows.append_column("sequence_id", ids).append_column("offset", pa.array(offset, pa.int64()))
            return out.drop_columns(["group"]).to_batches()

        for batch in batches:
            groups = batch.column("group").to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(groups)) + 1).tolist(), len(groups)]
            for a, b in zip(edges, edges[1:]):
                if a == b:
                    continue
                if held and groups[a] != group:
                    yield from done()
                    held = []
                group = int(groups[a])
                held.append(batch.slice(a, b - a))
        if held:
            yield from done()

    return pack


def pack(docs: DataFrame, tokenizer: str, text: str = "text", doc_id: str = "doc_id", length: int = LENGTH) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset of every
    piece. ``tokenizer``: path of the tokenizer's file, read on the driver; it must
    lower-case, drop white space and mark word ends, any other is an error.

    Null and empty texts have the closing id alone; repeated rows are packed
    each for itself; an empty table gives none. A group is as large as chance
    makes it around GROUP_PIECES, so no piece is left out and memory is bounded."""
    with open(tokenizer, encoding="utf-8") as f:
        shared = f.read()
    check_definition(shared)
    cut = docs.select(F.col(doc_id).alias("doc_id"), pieces(F.col(text), shared, length).alias("t"))
    rows = stage(cut.select("doc_id", F.col("t.doc_tokens").alias("doc_tokens"), F.inline("t.pieces")), "pieces")
    groups = max(1, round(rows.count() / GROUP_PIECES))
    dealt = rows.withColumn("group", F.pmod(F.xxhash64(F.lit(LENGTH), F.monotonically_increasing_id()), F.lit(groups)).cast("bigint"))
    ordered = dealt.repartition("group").sortWithinPartitions("group", F.desc("length"), "doc_id", "start")
    return ordered.mapInArrow(_packer(length), "doc_id bigint, doc_tokens bigint, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint")
