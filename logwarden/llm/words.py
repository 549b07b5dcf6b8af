"""Words of whole texts as 64-bit numbers, batch by batch."""

from __future__ import annotations

import ctypes
import functools
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Bytes of text that are held as words at a time.
BATCH_BYTES = 4_000_000

_kept: list[Callable] = []


def kept_by_worker(make: Callable) -> Callable:
    """Keeps the last result in its Python worker, from task to task, until ``free_worker``."""
    cached = functools.lru_cache(maxsize=1)(make)
    _kept.append(cached)
    return cached


def free_worker(keep: Callable | None = None) -> None:
    """Frees what operators keep in this worker, but for ``keep``, at the start of a task that needs the room."""
    others = [cached for cached in _kept if cached is not keep]
    if any(cached.cache_info().currsize for cached in others):
        for cached in others:
            cached.cache_clear()
        gc.collect()
    _give_back()


def _give_back() -> None:
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:  # glibc keeps what freed arrays have left
        trim(0)


def leaves_room(task: Callable) -> Callable:
    """A function over a task's batches that gives back, when they end, what freed arrays have left in the worker.

    Workers of an operator's last stage idle beside those of the next one, which may be others.
    """

    @functools.wraps(task)
    def run(batches: Iterator) -> Iterator:
        yield from task(batches)
        _give_back()

    return run


def leaves_room_by_group(task: Callable) -> Callable:
    """As ``leaves_room``, for a function of one group or of a pair of groups."""

    def one(group):
        try:
            return task(group)
        finally:
            _give_back()

    def pair(left, right):
        try:
            return task(left, right)
        finally:
            _give_back()

    return functools.wraps(task)(pair if task.__code__.co_argcount == 2 else one)


def text_slices(texts: pa.Array, most: int = BATCH_BYTES) -> Iterator[pa.Array]:
    """The array in slices of about ``most`` bytes; nulls become empty texts."""
    if texts.offset:  # Arrow 23 mixes up the bytes of a slice that is cast and then lower-cased
        texts = texts.take(pa.array(np.arange(len(texts))))
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
    ends, at = np.cumsum(sizes), 0
    while at < len(texts):
        upto = max(at + 1, int(np.searchsorted(ends, ends[at] - sizes[at] + most)))
        yield texts.slice(at, upto - at)
        at = upto


def mixed(x: np.ndarray) -> np.ndarray:
    """A well spread 64-bit number for each 64-bit number."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_numbers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, A-Z lower-cased, and where each text's words start (and end)."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    coded = lists.flatten().dictionary_encode()
    words = coded.dictionary.to_pylist()
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), "uint64", len(words))
    empty = np.fromiter((not w for w in words), bool, len(words))
    indices = coded.indices.to_numpy(zero_copy_only=False)
    is_word = ~empty[indices]
    offsets = lists.offsets.to_numpy()
    upto = np.concatenate([[0], np.cumsum(is_word)])
    return hashes[indices[is_word]], upto[offsets - offsets[0]]


def shingle_numbers(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of the ``size`` words from each place on; shorter by ``size - 1``."""
    n = max(0, len(words) - size + 1)
    out = np.full(n, size, "uint64")
    for i in range(size):
        out = out * np.uint64(0x9E3779B97F4A7C15) + words[i : i + n]
    return mixed(out)
