"""Operators must not depend on how a batch is cut, nor on a batch that is itself a slice."""

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest

from crashlake.llm import common, op1_simhash, op5_packing, op10_quality
from tests.llm.helpers import documents, word_list

DEFINITION = open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8").read()


def texts():
    return pa.array([r[1] for r in documents()], pa.string())


@pytest.mark.parametrize("rows,size", [(1, 1 << 20), (7, 1 << 20), (2000, 700), (2000, 4 << 20)])
@pytest.mark.parametrize("form", ["whole", "slice", "chunked"])
def test_cuts_change_nothing(monkeypatch, rows, size, form):
    whole = texts()
    given = {"whole": whole, "slice": pa.concat_arrays([pa.array(["é other text"]), whole]).slice(1), "chunked": pa.chunked_array([whole.slice(0, 9), whole.slice(9)])}[form]

    def results(batch):
        parts = [some for _, some in common.chunks(batch)]
        flat = [w for p in parts for w in common.split_words(p)[0].to_pylist()]
        ids = [op5_packing.word_ids(p, DEFINITION) for p in parts]
        return (flat, op1_simhash.fingerprints(batch).tolist(), np.concatenate([i[0] for i in ids]).tolist(), np.concatenate([i[1] for i in ids]).tolist(),
                np.concatenate([op10_quality.counts(p) for p in parts]).tolist())

    want = results(whole)
    assert want[0] == [w for t in whole.to_pylist() for w in word_list(t)]
    monkeypatch.setattr(common, "CHUNK_ROWS", rows)
    monkeypatch.setattr(common, "CHUNK_BYTES", size)
    assert results(given) == want
