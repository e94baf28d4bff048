"""Encoding holds a bounded amount beside a batch, and gives the same tokens in any slices."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from mergeloom.functions import ragged

MERGES = [(104, 101), (256, 32), (97, 97), (108, 108)]


@pytest.mark.parametrize("slice_bytes", [1, 10, 5000, 1 << 20])
def test_slices_of_chunk_lists(slice_bytes):
    table, specials = ragged.MergeRanks(MERGES), {"hello": 999}
    rows = [["he", " he he", "aa", "aaaa"], None, [], ["x" * 3000, "hello"], ["", "z"]] * 20
    got = []
    for first, tokens in ragged.encode_lists(pa.array(rows, pa.list_(pa.string())), table, specials, slice_bytes):
        assert first == len(got)
        got += tokens.to_pylist()
    alone = lambda chunk: ragged.encode_strings(pa.array([chunk], pa.string()), table, specials)[0].tolist()
    assert got == [[t for chunk in row or [] for t in alone(chunk)] for row in rows]


def test_encoding_holds_little_beside_a_batch():
    words = [f"word{i:05}" for i in range(2000)]
    rows = pa.array([words[i % 100 :][:1500] for i in range(1000)], pa.list_(pa.string()))
    table, n = ragged.MergeRanks(MERGES), 0
    tracemalloc.start()
    for _, tokens in ragged.encode_lists(rows, table, {}):
        n += len(tokens.values)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # 13 million bytes of text. Dealing all tokens out at once held 32 bytes for each of them.
    assert n > 12_000_000 and peak < 5 * n
