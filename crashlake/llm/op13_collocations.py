"""Phrase collocations by direct-address tiles of frequency-ranked pairs.

Texts are cut into slices of one language; a slice is its words as local codes, with
breaks between pieces. Words are counted in Spark; those too rare to be part of a
candidate become breaks, the others are numbered by falling frequency, so that
most pairs of neighbours lie in a few tiles of TILE x TILE numbers. Each slice counts its
pairs tile by tile: in a dense array that the pair addresses directly where a
tile holds many, as sorted (cell, count) lists where it holds few. The tiles are
shuffled and added up in the same two forms. Frequent pairs are numbered by
falling frequency in turn, the slices learn the numbers of the pairs they hold,
and pairs of a phrase and the word behind it are counted in the same way, level by level.

Every word and pair travels once for a slice, however often it occurs, and a slice
is bounded. The busiest tiles are dealt out in narrow bands of rows, and to be added up
first in as many parts as the square root of the slices, so that no key is hot. No group that is held at
once grows with the corpus. All counts are exact.

Null texts are empty; a null language is ``und``, together with rows that say
so; very long texts lie in a slice of their own; repeated rows count each; equal
scores are ordered by count and phrase; an empty table gives none; columns of any
other name are not looked at."""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from crashlake.llm.common import chunks, numbered, split_words, stage, unstage

#: Fewest occurrences of a candidate, most words, share (percent) of a phrase's
#: occurrences within a longer one from which it is dropped, phrases returned.
LEAST, LONGEST, COVERED, BEST = 10, 3, 50, 2000
#: Numbers along a tile's side, its cells, entries from which it is counted densely,
#: cells in a row of the tables, bytes of text in a slice, tiles a side that
#: are dealt out in bands, and rows of cells in a band.
TILE = 1024
CELLS = TILE * TILE
DENSE, PIECE, SLICE_BYTES, BUSY, BAND = CELLS // 16, 256, 4 << 20, 4, 2
#: Rows of texts, or of tile pieces, worked on at once.
AT_ONCE = 512
#: Ends a piece; no word holds it.
BREAK = "."
SCALE = 1_000_000

SLICE = "lang string, words array<string>, counts array<bigint>, codes binary"
#: A slice as numbers (words not null), or a piece of its counts in a tile.
CODED = "slice bigint, lang string, n bigint, words binary, heads binary, tile bigint, band int, cells binary, counts binary"
CODED_TYPES = pa.schema([("slice", pa.int64()), ("lang", pa.string()), ("n", pa.int64()), ("words", pa.binary()), ("heads", pa.binary()),
                         ("tile", pa.int64()), ("band", pa.int32()), ("cells", pa.binary()), ("counts", pa.binary())])
PIECES = "slice bigint, lang string, tile bigint, band int, cells binary, counts binary"
FOUND = "lang string, first bigint, last bigint, a bigint"
LEARNT = "owner bigint, tile bigint, cells binary, ids binary"


def _slice(lang: str, texts: pa.Array) -> Iterator[pa.RecordBatch]:
    """A row of SLICE: its distinct words, their counts, and each place's word (-1: a break)."""
    pieces = pc.replace_substring_regex(pc.ascii_lower(pc.fill_null(texts, "")), r"[.,;:!?\x0A-\x0D]+", f" {BREAK} ")
    pieces = pc.binary_join_element_wise(pa.scalar(BREAK, pieces.type), pieces, pa.scalar(" ", pieces.type))
    coded = split_words(pieces)[0].dictionary_encode()
    place, words = np.asarray(coded.indices).astype(np.int32), coded.dictionary
    real = np.asarray(pc.not_equal(words, BREAK))
    if not real.any():
        return
    renumbered = np.where(real, np.cumsum(real) - 1, -1).astype(np.int32)
    counts = np.bincount(place, minlength=len(words))[real]
    yield pa.record_batch({"lang": pa.array([lang], pa.string()), "words": pa.array([words.filter(pa.array(real)).cast(pa.string())], pa.list_(pa.string())),
                           "counts": pa.array([counts], pa.list_(pa.int64())), "codes": pa.array([renumbered[place].tobytes()], pa.binary())})


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of SLICE, of about SLICE_BYTES of one language's texts each, also from several batches."""
    waiting: dict[str, tuple[list[pa.Array], int]] = {}
    for batch in (whole.slice(at, AT_ONCE) for whole in batches for at in range(0, whole.num_rows, AT_ONCE)):
        langs = batch.column("lang").dictionary_encode()
        codes = np.asarray(langs.indices)
        for k, lang in enumerate(langs.dictionary.to_pylist()):
            for _, some in chunks(batch.column("text").filter(pa.array(codes == k)), SLICE_BYTES // 8):
                texts, size = waiting.pop(lang, ([], 0))
                texts, size = [*texts, some], size + some.nbytes
                if size < SLICE_BYTES and len(waiting) < 64:
                    waiting[lang] = texts, size
                else:
                    yield from _slice(lang, pa.concat_arrays(texts))
                    pa.default_memory_pool().release_unused()
    for lang, (texts, _) in waiting.items():
        yield from _slice(lang, pa.concat_arrays(texts))


def _packed(numbers: np.ndarray) -> bytes:
    """In 32 bits each where they fit."""
    return numbers.astype(np.int32 if not len(numbers) or numbers.max() < 2**31 else np.int64).tobytes()


def _unpacked(slices: pa.Table, row: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(words, heads) of a row of CODED; no heads are those of single words, the words themselves."""
    n, words, heads = (slices.column(c)[row].as_py() for c in ("n", "words", "heads"))
    of = lambda x: np.frombuffer(x, np.int32 if len(x) == 4 * n else np.int64).astype(np.int64)
    words = of(words)
    return words, words if heads is None else of(heads)


def _numbers(slices: pa.Table, found: pa.Table) -> pa.Table:
    """Rows of CODED from a slice and the (code, id) of its frequent words: its numbers, and its counts of pairs."""
    codes = np.frombuffer(slices.column("codes")[0].as_py(), dtype=np.int32)
    ids = np.zeros(int(codes.max()) + 2, dtype=np.int64)  # the last for code -1
    ids[found.column("code").to_numpy()] = found.column("id").to_numpy()
    words = ids[codes]
    own = {"slice": slices.column("slice"), "lang": slices.column("lang"), "n": pa.array([len(codes)], pa.int64()), "words": pa.array([_packed(words)], pa.binary())}
    return _coded(pa.table(own), _counted(slices, words, words, 2))


def _coded(*tables: pa.Table) -> pa.Table:
    """The tables as rows of CODED."""
    return pa.concat_tables([CODED_TYPES.empty_table(), *tables], promote_options="default").select(CODED_TYPES.names)


def _pairs(heads: np.ndarray, words: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, phrase, word behind it) of the phrases of ``level`` words whose parts are frequent."""
    n = max(0, len(words) - level + 1)
    left, right, inner = heads[:n], words[level - 1:], heads[1:n + 1]
    at = np.flatnonzero((left > 0) & (right > 0) & (inner > 0))
    return at, left[at] - 1, right[at] - 1


def _address(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(tile, cell) of pairs of numbers."""
    return (left // TILE) << 32 | right // TILE, (left % TILE) * TILE + right % TILE


def add_up(cells: np.ndarray, counts: np.ndarray | None, tiles: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(tile, cell, count) in order, each pair once: tiles of DENSE entries or more in
    a dense array, all others as one sorted list."""
    order = np.argsort(tiles, kind="stable")
    tiles, cells = tiles[order], cells[order]
    counts = None if counts is None else counts[order]
    begin = np.flatnonzero(np.concatenate([np.ones(min(1, len(tiles)), bool), tiles[1:] != tiles[:-1]]))
    sizes = np.diff(np.append(begin, len(tiles)))
    number = np.repeat(np.arange(len(begin)), sizes)
    busy = sizes >= DENSE
    sparse = ~busy[number]
    keys = number[sparse] * CELLS + cells[sparse]
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1]]))
    if counts is None:
        n = np.diff(np.append(first, len(keys)))
    else:
        n = np.add.reduceat(counts[sparse][order], first) if len(first) else counts[:0]
    found = [(keys[first] // CELLS, keys[first] % CELLS, n)]
    for k in np.flatnonzero(busy):
        own = slice(begin[k], begin[k] + sizes[k])
        full = np.bincount(cells[own], None, CELLS) if counts is None else _filled(cells[own], counts[own])
        hit = np.flatnonzero(full)
        found.append((np.full(len(hit), k), hit, full[hit]))
    number, cell, n = map(np.concatenate, zip(*found))
    order = np.argsort(number, kind="stable")
    return tiles[begin][number[order]], cell[order], n[order]


def _filled(cells: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums by cell, exact (bincount's weighted sums are floating)."""
    full = np.zeros(CELLS, np.int64)
    np.add.at(full, cells, counts)
    return full


def _binary(values: np.ndarray, starts: np.ndarray) -> pa.Array:
    """One binary value from each start to the next."""
    offsets = np.append(starts, len(values)).astype(np.int32) * values.itemsize
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def _values(column: pa.Array, kind) -> tuple[np.ndarray, np.ndarray]:
    """(all numbers of a binary column (null: none), how many each row has)."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(column), 0)) // np.dtype(kind).itemsize
    return np.frombuffer(b"".join(x for x in column.to_pylist() if x), dtype=kind), sizes.astype(np.int64)


def _banded(tile: np.ndarray, cell: np.ndarray) -> np.ndarray:
    """Band of each pair: -1 outside the busiest tiles."""
    busy = ((tile >> 32) < BUSY) & ((tile & 0xFFFFFFFF) < BUSY)
    return np.where(busy, cell // (TILE * BAND), -1)


def _pieces(lang: str, owner: int, tile: np.ndarray, cell: np.ndarray, n: np.ndarray) -> pa.Table:
    """Rows of PIECES from the ordered counts of one language and slice (or part)."""
    band = _banded(tile, cell)
    begin = np.flatnonzero(np.concatenate([np.ones(min(1, len(tile)), bool), (tile[1:] != tile[:-1]) | (band[1:] != band[:-1])]))
    within = np.arange(len(tile)) - np.repeat(begin, np.diff(np.append(begin, len(tile))))
    starts = np.flatnonzero(within % PIECE == 0)
    return pa.table({
        "slice": np.full(len(starts), owner), "lang": pa.array([lang] * len(starts), pa.string()), "tile": tile[starts], "band": band[starts].astype(np.int32),
        "cells": _binary(cell.astype(np.uint32), starts), "counts": _binary(n.astype(np.int64), starts)})


def _counted(slices: pa.Table, heads: np.ndarray, words: np.ndarray, level: int) -> pa.Table:
    """A slice's rows of PIECES at ``level``."""
    _, left, right = _pairs(heads, words, level)
    tile, cell = _address(left, right)
    return _pieces(slices.column("lang")[0].as_py(), slices.column("slice")[0].as_py(), *add_up(cell, None, tile))


class _Runs:
    """Numbers the runs of equal (lang, tile, band, part) over the batches of a task; the
    last one of a batch is number 0 of the next."""

    def __init__(self):
        self.key, self.keys = None, []

    def of(self, batch: pa.RecordBatch) -> np.ndarray:
        columns = [batch.column("lang").dictionary_encode(), *(batch.column(c) for c in ("tile", "band", "part"))]
        codes = np.stack([np.asarray(columns[0].indices), *(c.to_numpy() for c in columns[1:])])
        langs = columns[0].dictionary.to_pylist()
        changes = np.flatnonzero(np.concatenate([[True], (codes[:, 1:] != codes[:, :-1]).any(axis=0)]))
        keys = [(langs[codes[0, c]], *map(int, codes[1:, c])) for c in changes]
        number = np.repeat(np.arange(len(changes)), np.diff(np.append(changes, batch.num_rows)))
        follows = keys[0] == self.key
        self.keys = keys if follows else [self.key, *keys]
        self.key = keys[-1]
        return number if follows else number + 1


def _sums(keys: list, number: np.ndarray, cell: np.ndarray, n: np.ndarray, least: int | None) -> pa.Table:
    """Rows of FOUND of at least ``least``, or of PIECES, from the ordered sums of several runs."""
    langs, tiles, bands, parts = zip(*[key or ("", 0, 0, 0) for key in keys])
    if least is None:
        begin = np.flatnonzero(np.concatenate([np.ones(min(1, len(number)), bool), number[1:] != number[:-1]]))
        within = np.arange(len(number)) - np.repeat(begin, np.diff(np.append(begin, len(number))))
        starts = np.flatnonzero(within % PIECE == 0)
        of = pa.array(number[starts])
        return pa.table({"slice": pa.array(parts, pa.int64()).take(of), "lang": pa.array(langs, pa.string()).take(of), "tile": pa.array(tiles, pa.int64()).take(of),
                         "band": pa.array(bands, pa.int32()).take(of), "cells": _binary(cell.astype(np.uint32), starts), "counts": _binary(n, starts)})
    some = n >= least
    number, cell, n = number[some], cell[some], n[some]
    tile = np.array(tiles, np.int64)[number]
    return pa.table({"lang": pa.array(langs, pa.string()).take(pa.array(number)), "first": (tile >> 32) * TILE + cell // TILE + 1,
                     "last": (tile & 0xFFFFFFFF) * TILE + cell % TILE + 1, "a": n})


def _add(least: int | None):
    """Sums of pieces sorted by (lang, tile, band, part): rows of FOUND of at least
    ``least``, or, if None, pieces again, one set for each part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs, cells, sums = _Runs(), np.empty(0, np.int64), np.empty(0, np.int64)
        for whole in batches:
            for at in range(0, whole.num_rows, AT_ONCE):
                batch = whole.slice(at, AT_ONCE)
                number = runs.of(batch)
                cell, sizes = _values(batch.column("cells"), np.uint32)
                n, _ = _values(batch.column("counts"), np.int64)
                number = np.concatenate([np.zeros(len(cells), np.int64), np.repeat(number, sizes)])
                number, cell, n = add_up(np.concatenate([cells, cell.astype(np.int64)]), np.concatenate([sums, n]), number)
                done = np.searchsorted(number, len(runs.keys) - 1)  # the last run may go on
                yield from _sums(runs.keys, number[:done], cell[:done], n[:done], least).to_batches(max_chunksize=10 * AT_ONCE)
                cells, sums = cell[done:], n[done:]
        if len(cells):
            yield from _sums([runs.key], np.zeros(len(cells), np.int64), cells, sums, least).to_batches(max_chunksize=10 * AT_ONCE)
    return run


def _learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of LEARNT: which cells of each piece are frequent, and their numbers. Sorted
    by (lang, tile, band, part, cell): the frequent cells of a key come in order, pieces, of cell null, last."""
    runs, cells, ids = _Runs(), np.empty(0, np.int64), np.empty(0, np.int64)
    for whole in batches:
        for at in range(0, whole.num_rows, AT_ONCE):
            batch = whole.slice(at, AT_ONCE)
            number = runs.of(batch)
            if runs.keys[0] is None:
                cells, ids = cells[:0], ids[:0]
            known = np.asarray(pc.is_valid(batch.column("cell")))
            new = batch.filter(pa.array(known))
            of = np.concatenate([np.zeros(len(cells), np.int64), number[known]])
            cells = np.concatenate([cells, new.column("cell").to_numpy().astype(np.int64)])
            ids = np.concatenate([ids, new.column("id").to_numpy()])
            pieces = batch.filter(pa.array(~known))
            cell, sizes = _values(pieces.column("cells"), np.uint32)
            row = np.repeat(np.arange(pieces.num_rows), sizes)
            have, want = of * CELLS + cells, number[~known][row] * CELLS + cell
            if len(have) and len(want):
                place = np.minimum(np.searchsorted(have, want), len(have) - 1)
                hit = np.flatnonzero(have[place] == want)
                if len(hit):
                    rows, starts = np.unique(row[hit], return_index=True)
                    yield pa.record_batch({
                        "owner": pieces.column("slice").take(pa.array(rows)), "tile": pieces.column("tile").take(pa.array(rows)),
                        "cells": _binary(cell[hit], starts), "ids": _binary(ids[place[hit]], starts)})
            last = of == len(runs.keys) - 1
            cells, ids = cells[last], ids[last]


def _heads(level: int, last: bool):
    """The slice's counts of the next level, from the numbers of its frequent phrases of
    ``level`` words; and, unless that is the last, those numbers as its heads."""
    def run(slices: pa.Table, learnt: pa.Table) -> pa.Table:
        words, heads = _unpacked(slices)
        at, left, right = _pairs(heads, words, level)
        tile, cell = _address(left, right)
        own = learnt.combine_chunks()
        cells, sizes = _values(own.column("cells").combine_chunks(), np.uint32)
        ids, _ = _values(own.column("ids").combine_chunks(), np.int64)
        tiles, of = np.unique(np.concatenate([np.repeat(own.column("tile").to_numpy(), sizes), tile]), return_inverse=True)
        have, want = of[:len(cells)] * CELLS + cells, of[len(cells):] * CELLS + cell
        order = np.argsort(have)
        place = order[np.minimum(np.searchsorted(have, want, sorter=order), len(have) - 1)]
        found = np.zeros(len(words), np.int64)
        hit = have[place] == want
        found[at[hit]] = ids[place[hit]]
        counted = _counted(slices, found, words, level + 1)
        if last:
            return _coded(counted)
        return _coded(slices.set_column(slices.column_names.index("heads"), "heads", pa.array([_packed(found)], pa.binary())), counted)
    return run


KEY = ["lang", "tile", "band", "part"]


def _dealt(rows: DataFrame, *order: str) -> DataFrame:
    return rows.repartition(*KEY).sortWithinPartitions(*KEY, *order)


def _frequent(pieces: DataFrame, least: int) -> DataFrame:
    """Rows of FOUND: the pairs of at least ``least`` occurrences."""
    none, columns = F.lit(0).alias("part"), ["lang", "tile", "band", "cells", "counts"]
    parts = _dealt(pieces.where("band >= 0").select(*columns, "part")).mapInArrow(_add(None), PIECES)
    rows = pieces.where("band < 0").select(*columns, none).union(parts.select(*columns, none))
    return _dealt(rows).mapInArrow(_add(least), FOUND)


def _learnt(pieces: DataFrame, found: DataFrame) -> DataFrame:
    """Rows of LEARNT: what each slice's pieces hold of ``found`` (lang, first, last, id)."""
    tile = F.shiftleft(F.floor((F.col("first") - 1) / TILE), 32) + F.floor((F.col("last") - 1) / TILE)
    cell = (((F.col("first") - 1) % TILE) * TILE + (F.col("last") - 1) % TILE).cast("int")
    busy = (F.col("first") <= BUSY * TILE) & (F.col("last") <= BUSY * TILE)
    cells = found.select("lang", tile.alias("tile"), cell.alias("cell"), F.col("id"), busy.alias("busy"))
    cells = cells.withColumn("band", F.when(F.col("busy"), F.floor(F.col("cell") / (TILE * BAND))).otherwise(-1).cast("int"))
    told = cells.select("lang", "tile", "band", F.lit(0).alias("part"), "cell", "id")
    rows = told.unionByName(pieces.select("lang", "tile", "band", F.lit(0).alias("part"), "slice", "cells"), allowMissingColumns=True)
    rows = rows.withColumn("last", F.coalesce("cell", F.lit(CELLS)))
    return _dealt(rows, "last").mapInArrow(_learn, LEARNT)


def _by_slice(slices: DataFrame, known: DataFrame, join) -> DataFrame:
    """Rows of CODED: ``join`` of each slice and what is known of it (owner, ...), which is bounded
    by the slice; one of which nothing is known has no candidate left."""
    def run(key, one: pa.Table, own: pa.Table) -> pa.Table:
        return join(one, own) if one.num_rows and own.num_rows else _coded()
    return slices.groupBy("slice").cogroup(known.groupBy("owner")).applyInArrow(run, CODED)


def _ranked(found: DataFrame, *order: str) -> DataFrame:
    """``found`` with ``id``, numbered from 1 in each language by falling frequency."""
    rows = numbered(found.withColumn("rare", -F.col("a")), ["lang"], ["rare", *order])
    return rows.withColumn("id", F.col("pos") + 1).drop("rare", "tree", "n", "pos")


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(SCALE * a * a / (left * right)) in whole numbers of 38 digits."""
    wide = [x.cast("decimal(15,0)") for x in (a, left, right)]
    over = F.lit(SCALE).cast("decimal(7,0)") * wide[0] * wide[0]
    return F.call_function("div", over, wide[1] * wide[2])


def phrases(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, longest: int = LONGEST) -> tuple[list[DataFrame], DataFrame]:
    """The frequent phrases by length, from single words on (lang, id, phrase, words (ids), a),
    and the number of words of each language (lang, n)."""
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).cast("string").alias("text"))
    slices = stage(rows.mapInArrow(_slices, SLICE).withColumn("slice", F.monotonically_increasing_id()), "slices")
    totals = stage(slices.groupBy("lang").agg(F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda x, y: x + y)).alias("n")), "totals")
    each = slices.select("lang", F.inline(F.arrays_zip("words", "counts"))).groupBy(F.col("lang"), F.col("words").alias("phrase")).agg(F.sum("counts").alias("a"))
    single = stage(_ranked(each.where(F.col("a") >= least), "phrase"), "words")
    places = slices.select("slice", "lang", F.posexplode("words").alias("code", "phrase")).join(single.select("lang", "phrase", "id"), ["lang", "phrase"]).select(F.col("slice").alias("owner"), "code", "id")
    ways = max(1, isqrt(slices.count()))
    part = F.when(F.col("band") >= 0, F.pmod(F.xxhash64("slice"), F.lit(ways))).otherwise(0).cast("int").alias("part")
    coded = stage(_by_slice(slices.select("slice", "lang", "codes"), places, _numbers), "coded")
    unstage(slices)
    word = single.select("lang", F.col("id").alias("last"), F.col("phrase").alias("__word"))
    levels = [single.withColumn("words", F.array("id"))]
    for level in range(2, longest + 1):
        pieces = coded.where("tile is not null").select("slice", "lang", "tile", "band", "cells", "counts", part)
        found = stage(_ranked(_frequent(pieces, least), "first", "last"), "frequent")
        shorter = levels[-1].select("lang", F.col("id").alias("first"), F.col("phrase").alias("__phrase"), F.col("words").alias("__words"))
        named = found.join(shorter, ["lang", "first"]).join(word, ["lang", "last"])
        levels.append(stage(named.select("lang", "id", F.concat_ws(" ", "__phrase", "__word").alias("phrase"), F.concat("__words", F.array("last")).alias("words"), "a"), "phrases"))
        before = coded
        if level < longest:
            numbers = coded.where("words is not null").select("slice", "lang", "n", "words", "heads")
            coded = stage(_by_slice(numbers, _learnt(pieces, found), _heads(level, level + 1 == longest)), "coded")
        unstage(before)
    return levels, totals


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, longest: int = LONGEST, covered: int = COVERED, best: int = BEST) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the ``best`` phrases of each language."""
    levels, totals = phrases(docs, text, lang, least, longest)
    every = levels[0].select("lang", "words", "a")
    for level in levels[1:]:
        every = every.union(level.select("lang", "words", "a"))
    found = levels[1].withColumn("size", F.lit(2))
    for size, level in enumerate(levels[2:], 3):
        found = found.union(level.withColumn("size", F.lit(size)))
    cuts = found.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.withColumn("head", F.slice("words", 1, F.col("k"))).withColumn("tail", F.slice("words", F.col("k") + 1, F.col("size")))
    cuts = cuts.join(every.select("lang", F.col("words").alias("head"), F.col("a").alias("l")), ["lang", "head"])
    cuts = cuts.join(every.select("lang", F.col("words").alias("tail"), F.col("a").alias("r")), ["lang", "tail"])
    cuts = cuts.withColumn("score", _score(F.col("a"), F.col("l"), F.col("r")))
    least_cut = cuts.groupBy("lang", "size", "id").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    scored = found.join(least_cut, ["lang", "size", "id"]).select("lang", "words", "phrase", "a", "cut.l", "cut.r", "cut.score")
    inner = found.where("size > 2").select("lang", "a", F.explode(F.flatten(F.transform(F.sequence(F.lit(2), F.col("size") - 1), lambda m: F.transform(
        F.sequence(F.lit(1), F.col("size") - m + 1), lambda i: F.slice("words", i, m))))).alias("words"))
    within = inner.groupBy("lang", "words").agg(F.max("a").alias("longer"))
    left = scored.join(within, ["lang", "words"], "left").where(F.coalesce(100 * F.col("longer") < covered * F.col("a"), F.lit(True)))
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    top = left.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= best)
    return top.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
