"""What a task holds beside its input, by the allocations that Python and NumPy make."""

import tracemalloc

import numpy as np
import pyarrow as pa

from mergeloom.llm import language_id, packing
from mergeloom.llm.blocks import NOT_SPACE, words
from mergeloom.llm.encoding import Encoder, tokenizer_path


def peak(work):
    pa.array([1])  # PyArrow's own imports don't count
    tracemalloc.start()
    try:
        result = work()
        return result, tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_pieces_of_a_stream_share_its_memory():
    encoder = Encoder.cached(tokenizer_path())
    rng = np.random.default_rng(3)
    documents = [rng.integers(300, 50_000, 500).astype(np.int32) for _ in range(2000)]
    want = b"".join(d.tobytes() for d in documents)
    before = pa.total_allocated_bytes()
    batch, _ = packing._pieces(list(range(2000)), documents, encoder, 0)
    assert pa.total_allocated_bytes() - before < len(want) / 2
    assert b"".join(batch.column(7).to_pylist()) == want and not documents


def test_words_are_hashed_some_at_a_time():
    text = pa.array(["ordinary words of a text " * 40_000])
    _, most = peak(lambda: words(text, NOT_SPACE))
    assert most < 12 * len(text[0].as_py())


def test_ngrams_are_counted_some_at_a_time():
    texts = pa.array(["some words of a language " * 100] * 1000)
    batch = pa.RecordBatch.from_arrays([pa.array(["xx"] * 1000), texts], ["lang", "text"])
    _, most = peak(lambda: list(language_id._counted(iter([batch]))))
    assert most < 30 << 20
