"""Small plain-Python models of the expected behaviour, for differential tests."""

from collections import Counter
from itertools import accumulate

import regex

# The published split patterns under test, as `regex` writes them.
GPT2 = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
GPT4 = r"""'(?i:[sdmt]|ll|ve|re)|[^\r\n\p{L}\p{N}]?+\p{L}+|\p{N}{1,3}| ?[^\s\p{L}\p{N}]++[\r\n]*|\s*[\r\n]|\s+(?!\S)|\s+"""

ADVERSARIAL = [
    "",
    " ",
    "a\r\nb\r\n\r\n  c",
    "x y\u0085z　w",
    "ſ's 'LL we'Re I'm",
    "²½ 1234567 ٣٤٥",
    "😀👍🏽 flags 🇩🇪!",
    "nul\x00byte\x00",
    "zero​width",
    "run   of spaces  \n\n  before newline \n",
    "aaaaaaaaaaaaaaaaaaaaa",
    "\U0010ffff end ﷐ ￿",
    "tabs\t\tand\x0bvt",
    "ünïcödé ñ 漢字かな",
]


def pretokenize(text, pattern=GPT4):
    return regex.findall(pattern, text)


def places(rows):
    """(pair, row, index) of all adjacent pairs."""
    return [((r[i], r[i + 1]), n, i) for n, r in enumerate(rows) for i in range(len(r) - 1)]


def pair_table(rows):
    """Pair counts, in order of first place."""
    found = places(rows)
    first = {pair: (n, i) for pair, n, i in reversed(found)}
    counts = Counter(pair for pair, _, _ in found)
    return {pair: counts[pair] for pair in sorted(counts, key=first.__getitem__)}


def join_pair(row, pair, new):
    """Merging is substitution on a string with one character per token."""
    return [ord(c) for c in "".join(map(chr, row)).replace(chr(pair[0]) + chr(pair[1]), chr(new))]


def train(text, n, pattern=GPT4):
    """By definition: the best pair has the highest count, then the earliest first place."""
    state, merges, counts = [list(c.encode()) for c in pretokenize(text, pattern)], [], []
    while len(merges) < n:
        ranked = sorted(pair_table(state).items(), key=lambda item: -item[1])  # stable: ties stay in order of place
        (pair, count), *_ = ranked
        state = [join_pair(r, pair, 256 + len(merges)) for r in state]
        merges.append(pair)
        counts.append(count)
    return merges, counts


def encode(text, merges, pattern=GPT4):
    """A merge only ever makes pairs of later rank, so applying all merges in rank order encodes."""
    out = []
    for chunk in pretokenize(text, pattern):
        row = list(chunk.encode())
        for k, pair in enumerate(merges):
            row = join_pair(row, pair, 256 + k)
        out.extend(row)
    return out


def pack(docs, size):
    """Shards of the concatenated stream."""
    stream = [t for d in docs for t in d]
    return [stream[i : i + size] for i in range(0, len(stream), size)]


def quota(sizes, train_target, test_target):
    """From totals: train is all that starts below its target, test what then starts below its own."""
    starts = [0, *accumulate(sizes)]
    n_train = sum(s < train_target for s in starts[:-1])
    base = starts[n_train]
    n_test = sum(s - base < test_target for s in starts[n_train:-1])
    if not n_train:
        n_test = max(n_test, min(1, len(sizes)))  # one document is always looked at
    return ["train"] * n_train + ["test"] * n_test


def serve(lengths, bt, world, rank):
    """(shard, start) of the batches one rank is served in one pass: the first one in each shard, and
    those after which a whole stride and one token more are left."""
    stride = bt * world
    later = lambda n: range(bt * rank + stride, n - stride, stride)
    return [(shard, start) for shard, n in enumerate(lengths) for start in (bt * rank, *later(n))]
