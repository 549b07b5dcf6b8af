"""Removal of passages that repeat across documents, by suffix arrays.

Texts are compared as bytes. A repeat of ``length`` bytes is found where it is an
interval of a suffix array: starting from the interval of all suffixes, intervals are
extended backward, byte by byte, on the Burrows-Wheeler transform. Each round of this
breadth-first search yields the common prefixes that are one byte longer; the search
stops at ``length``, so longer common prefixes are never told apart.

No single suffix array holds all texts. Each window of ``length`` bytes belongs to
the gram of smallest hash inside it (its anchor), and neighbouring windows with the same
anchor form one stretch of text. Equal windows have equal anchors, so stretches are
dealt to suffix arrays by anchor and no repeat is lost:

1. Texts are packed into compressed blocks, which are stored.
2. Anchors are dealt to buckets; those of one document only take no further part.
3. Stretches of shared anchors are cut from the blocks, folded if equal, and dealt to
   shards. An anchor shared by many blocks is split by the longer grams
   inside its windows, so frequent words do not meet in one shard.
4. Each shard finds its repeats and returns the bytes that are to be removed.
5. Blocks and removals meet once more, which gives the remaining texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage_bucketed
from .words import mixed

_LAST = 2**63 - 1  # the place of null ids: behind all others
_END = 255  # never part of UTF-8
_BLOCK = "block long, ids binary, missing binary, ends binary, size long, text binary"
_ANCHORS = "bucket long, block long, numbers binary"
_SHARED = "block long, bucket long, numbers binary, crowded binary"
_PIECES = (
    "shard long, block long, content binary, sizes binary, anchor binary, owner binary, "
    "order binary, document binary, start binary, removed binary"
)
_REMOVED = "block long, removed binary"
_RUN = np.dtype([("document", "<u4"), ("start", "<u4"), ("end", "<u4")])


@dataclass(frozen=True)
class SuffixDedupConfig:
    """``gram`` at most ``length``. Sizes are of one task's unit of work; none changes the result.

    ``crowd``: blocks from which on an anchor is split by its windows' longer grams.
    """

    length: int = 50
    gram: int = 24
    block_bytes: int = 4_000_000
    slice_bytes: int = 1_000_000
    bucket_anchors: int = 2_000_000
    shard_bytes: int = 4_000_000
    crowd: int = 1000

    def __post_init__(self):
        if not 1 <= self.gram <= self.length <= 10_000:
            raise ValueError("1 <= gram <= length <= 10000")

    @property
    def long_gram(self) -> int:
        return (self.gram + 2 * self.length) // 3


def remove_repeats(docs: DataFrame, cfg: SuffixDedupConfig | None = None, texts: bool = True) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): what remains of its text.

    Returns doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256 and, with
    ``texts``, kept (binary, the remaining bytes). Every byte covered by a string of
    ``cfg.length`` bytes that also starts in a document with a smaller doc_id is removed; strings
    are judged on the input. Rows that share a doc_id remove nothing from each other; null ids
    count as larger than all others. Null and empty texts, and texts shorter than
    ``cfg.length``, stay as they are. An empty table gives no rows; other columns
    play no part. A long text is worked on in slices; the whole row is in memory only as bytes.
    """
    cfg = cfg or SuffixDedupConfig()
    # in buckets: what is found comes to the texts, which are not shuffled
    blocks = stage_bucketed(_packed(docs, cfg), "suffix-blocks", "block")
    size = blocks.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    per_anchor = max(1.0, (cfg.length - cfg.gram + 2) / 2)
    buckets = max(1, round(size / per_anchor / cfg.bucket_anchors))
    shards = max(1, round(size / cfg.shard_bytes))

    shared = (
        _anchors(blocks, buckets, cfg)
        .groupBy("bucket")
        .applyInPandas(lambda rows: _shared_numbers(rows, cfg.crowd), _SHARED)
    )
    pieces = blocks.groupBy("block").cogroup(shared.groupBy("block")).applyInPandas(
        lambda block, found: _cut(block, found, buckets, shards, cfg), _PIECES
    )
    removed = pieces.groupBy("shard").applyInPandas(lambda rows: _repeats(rows, cfg.length), _REMOVED)
    return blocks.groupBy("block").cogroup(removed.groupBy("block")).applyInPandas(
        lambda block, found: _remaining(block, found, texts),
        "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
        + ", kept binary" * texts,
    )


def _compressed(data) -> bytes:
    return pa.compress(pa.py_buffer(data), codec="zstd", asbytes=True)


def _read(data: bytes, size: int) -> bytes:
    return pa.decompress(data, decompressed_size=size, codec="zstd", asbytes=True) if size else b""


def _packed(docs: DataFrame, cfg: SuffixDedupConfig) -> DataFrame:
    """Whole texts in blocks of about ``block_bytes``; a longer text has a block of its own."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids, texts, size = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py() or b""
                if texts and size + len(text) > cfg.block_bytes:
                    yield _block(number, ids, texts)
                    number, ids, texts, size = number + 1, [], [], 0
                ids.append(doc_id)
                texts.append(text)
                size += len(text)
        if texts:
            yield _block(number, ids, texts)

    # binary as it is in the text: no decoding, so also for bytes that are no UTF-8
    return docs.select(
        F.col("doc_id").cast("long"), F.col("text").cast("binary")
    ).mapInArrow(pack, _BLOCK)


def _block(number: int, ids: list, texts: list[bytes]) -> pa.RecordBatch:
    ends = np.cumsum([len(t) for t in texts], dtype="<i8")
    order = np.array([_LAST if i is None else i for i in ids], "<i8")
    missing = np.array([i is None for i in ids], "u1")
    row = (number, order.tobytes(), missing.tobytes(), ends.tobytes(), int(ends[-1]), _compressed(b"".join(texts)))
    types = [pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays(
        [pa.array([v], t) for v, t in zip(row, types, strict=True)], names=[c.split()[0] for c in _BLOCK.split(", ")]
    )


# -- anchors ---------------------------------------------------------------------------


def _gram_hashes(text: np.ndarray, gram: int) -> np.ndarray:
    """A hash of the ``gram`` bytes from each place on; shorter by ``gram - 1``."""
    n = len(text) - gram + 1
    out = np.full(n, gram, "u8")
    for at in range(0, gram - 7, 8):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + _eight(text[at : at + n + 7]))
    rest = gram % 8
    if rest:  # the last eight bytes, or fewer if there are no eight
        if gram >= 8:
            return mixed(out * np.uint64(0x9E3779B97F4A7C15) + _eight(text[gram - 8 : gram - 1 + n]))
        for at in range(gram):
            out = out * np.uint64(0x9E3779B97F4A7C15) + text[at : at + n]
        return mixed(out)
    return out


def _eight(text: np.ndarray) -> np.ndarray:
    """Eight bytes from each place on as a number; shorter by 7."""
    n = len(text) - 7
    text = np.ascontiguousarray(text)
    out = np.empty(n, "<u8")
    for shift in range(min(8, n)):
        whole = (len(text) - shift) // 8
        out[shift::8] = text[shift : shift + 8 * whole].view("<u8")[: len(out[shift::8])]
    return out


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of the ``width`` values from each place on; shorter by ``width - 1``."""
    out, span = values, 1
    while span < width:
        step = min(span, width - span)
        out, span = np.minimum(out[: len(out) - step], out[step:]), span + step
    return out


def stretches(text: np.ndarray, ends: np.ndarray, length: int, gram: int, slice_bytes: int) -> Iterator[tuple]:
    """(anchor, start, windows) of runs of windows with one anchor inside one document, slice by slice.

    ``ends`` are the documents' ends in ``text``. A run has at most four times as many windows
    as there are grams in one, so long runs of one anchor are cut.
    """
    width = length - gram + 1
    most = 4 * width
    for at in range(0, len(text) - length + 1, slice_bytes):
        part = text[at : at + slice_bytes + length - 1]
        least = _least(_gram_hashes(part, gram), width)
        n = len(least)
        starts = np.ones(n, bool)
        starts[1:] = least[1:] != least[:-1]
        inner = ends[(ends > at) & (ends < at + n + length)] - at
        starts[inner[inner < n]] = True
        # windows that reach over a document's end
        over = np.zeros(n + 1, "i4")
        np.add.at(over, np.clip(inner - length + 1, 0, n), 1)
        np.add.at(over, np.clip(inner, 0, n), -1)
        valid = np.cumsum(over[:n]) == 0
        starts[1:] |= valid[1:] != valid[:-1]
        first = np.flatnonzero(starts)
        count = np.diff(np.append(first, n))
        first, count = first[valid[first]], count[valid[first]]
        if len(count) and count.max() > most:
            cuts = -(-count // most)
            again = np.repeat(np.arange(len(first)), cuts)
            nth = np.arange(len(again)) - np.repeat(np.cumsum(cuts) - cuts, cuts)
            first, count = first[again] + nth * most, np.minimum(most, count[again] - nth * most)
        yield least[first], first + at, count


_NUMBER_BITS = np.uint64(24)


def _bucket(anchors: np.ndarray, buckets: int) -> np.ndarray:
    return (anchors & np.uint64((1 << 24) - 1)) % np.uint64(buckets)


def _forty(numbers: np.ndarray) -> bytes:
    """Numbers below 2^40 in five bytes each."""
    low, high = numbers.astype("<u4"), (numbers >> np.uint64(32)).astype("u1")
    return low.tobytes() + high.tobytes()


def _from_forty(data: bytes) -> np.ndarray:
    n = len(data) // 5
    low, high = np.frombuffer(data, "<u4", n), np.frombuffer(data, "u1", n, 4 * n)
    return low.astype("u8") | high.astype("u8") << np.uint64(32)


def _open(row) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A block's text, its documents' ends and their places by id."""
    text = np.frombuffer(_read(row["text"], row["size"]), "u1")
    return text, np.frombuffer(row["ends"], "<i8"), np.frombuffer(row["ids"], "<i8")


def _anchors(blocks: DataFrame, buckets: int, cfg: SuffixDedupConfig) -> DataFrame:
    """Each block's distinct anchors by bucket: 40 bits, the lowest tells if two documents hold it.

    Different anchors that share bucket and number only pass for shared.
    """

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.to_dict("records"):
                text, ends, ids = _open(row)
                anchors, where = [], []
                for anchor, first, _ in stretches(text, ends, cfg.length, cfg.gram, cfg.slice_bytes):
                    anchors.append(anchor)
                    where.append(first)
                if not anchors:
                    continue
                anchors = np.concatenate(anchors)
                order = ids[np.searchsorted(ends, np.concatenate(where), "right")]
                number = anchors >> _NUMBER_BITS & ~np.uint64(1)
                key = _bucket(anchors, buckets) << np.uint64(40) | number
                by = np.argsort(key, kind="stable")
                key, order = key[by], order[by]
                heads = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
                several = np.minimum.reduceat(order, heads) != np.maximum.reduceat(order, heads)
                key = key[heads] | several.astype("u8")
                bucket = key >> np.uint64(40)
                edges = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
                number = key & np.uint64((1 << 40) - 1)
                yield pd.DataFrame({
                    "bucket": bucket[edges].astype("int64"), "block": row["block"],
                    "numbers": [_forty(part) for part in np.split(number, edges[1:])],
                })

    return blocks.select("block", "ids", "ends", "size", "text").mapInPandas(find, _ANCHORS)


def _shared_numbers(rows: pd.DataFrame, crowd: int) -> pd.DataFrame:
    """For each block of a bucket, its numbers that two documents hold, and of these the crowded ones."""
    parts = [_from_forty(data) for data in rows["numbers"]]
    numbers = np.concatenate(parts)
    source = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    several = (numbers & np.uint64(1)).astype(bool)
    numbers &= ~np.uint64(1)
    by = np.argsort(numbers, kind="stable")
    numbers, source, several = numbers[by], source[by], several[by]
    heads = np.flatnonzero(np.append(True, numbers[1:] != numbers[:-1]))
    count = np.diff(np.append(heads, len(numbers)))
    shared = np.repeat((count > 1) | np.logical_or.reduceat(several, heads), count)
    crowded = np.repeat(count >= crowd, count)
    numbers, source, crowded = numbers[shared], source[shared], crowded[shared]
    by = np.argsort(source, kind="stable")
    cuts = np.searchsorted(source[by], np.arange(1, len(parts)))
    kept = np.split(numbers[by], cuts)
    busy = [n[c] for n, c in zip(kept, np.split(crowded[by], cuts), strict=True)]
    out = pd.DataFrame({
        "block": rows["block"].to_numpy(), "bucket": rows["bucket"].to_numpy(),
        "numbers": [_forty(k) for k in kept], "crowded": [_forty(b) for b in busy],
    })
    return out[[len(k) > 0 for k in kept]]


# -- stretches of shared anchors ---------------------------------------------------------


def _keys(found: pd.DataFrame, column: str) -> np.ndarray:
    parts = [
        _from_forty(data) | np.uint64(bucket) << np.uint64(40)
        for bucket, data in zip(found["bucket"], found[column], strict=True)
    ]
    return np.sort(np.concatenate(parts)) if parts else np.zeros(0, "u8")


def _among(keys: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(keys), bool)
    return known[np.minimum(np.searchsorted(known, keys), len(known) - 1)] == keys


def _cut(block: pd.DataFrame, found: pd.DataFrame, buckets: int, shards: int, cfg: SuffixDedupConfig) -> pd.DataFrame:
    """The block's stretches of shared anchors, by shard.

    Equal stretches go once, with all their places in the block's first document that
    holds them (by doc_id). In the block's later documents they are removed here.
    """
    if not len(block) or not len(found):
        return pd.DataFrame([], columns=[c.split()[0] for c in _PIECES.split(", ")])
    row = block.iloc[0]
    text, ends, ids = _open(row)
    shared, crowded = _keys(found, "numbers"), _keys(found, "crowded")
    parts = []
    for anchor, first, count in stretches(text, ends, cfg.length, cfg.gram, cfg.slice_bytes):
        key = _bucket(anchor, buckets) << np.uint64(40) | (anchor >> _NUMBER_BITS & ~np.uint64(1))
        kept = _among(key, shared)
        anchor, first, count, key = anchor[kept], first[kept], count[kept], key[kept]
        busy = _among(key, crowded)
        parts.append((anchor[~busy], first[~busy], count[~busy]))
        for start, windows in zip(first[busy].tolist(), count[busy].tolist(), strict=True):
            part = text[start : start + windows + cfg.length - 1]
            for finer, at, n in stretches(part, ends[:0], cfg.length, cfg.long_gram, cfg.slice_bytes):
                parts.append((finer, at + start, n))
    anchor, first, count = (np.concatenate(column) for column in zip(*parts, strict=True))
    shard = (mixed(anchor) % np.uint64(shards)).astype("i8")

    data, extra = text.tobytes(), cfg.length - 1
    owners: dict[bytes, int] = {}
    owner = np.fromiter(
        (
            owners.setdefault(data[s : s + n + extra], len(owners))
            for s, n in zip(first.tolist(), count.tolist(), strict=True)
        ),
        "i8", len(first),
    )
    contents = list(owners)
    mark = np.empty(len(contents), "<u4")
    mark[owner] = anchor >> np.uint64(32)
    document = np.searchsorted(ends, first, "right")
    order = ids[document]
    earliest = np.full(len(contents), _LAST)
    np.minimum.at(earliest, owner, order)
    goes = order == earliest[owner]
    begin = ends - np.diff(ends, prepend=0)
    start = first - begin[document]

    own = np.empty(int((~goes).sum()), _RUN)
    own["document"], own["start"] = document[~goes], start[~goes]
    own["end"] = start[~goes] + count[~goes] + extra
    out = []
    if len(own):
        runs = _compressed(_merged(own).tobytes())
        out.append((int(row["block"]) % shards, row["block"], *[None] * 7, runs))
    by = np.flatnonzero(goes)
    by = by[np.lexsort((owner[by], shard[by]))]
    for chosen in np.split(by, np.flatnonzero(np.diff(shard[by])) + 1):
        if not len(chosen):
            continue
        which, local = np.unique(owner[chosen], return_inverse=True)
        texts = [contents[i] for i in which.tolist()]
        out.append((
            int(shard[chosen[0]]), row["block"], _compressed(b"".join(texts)),
            np.array([len(t) for t in texts], "<u2").tobytes(), mark[which].tobytes(), local.astype("<u4").tobytes(),
            order[chosen].astype("<i8").tobytes(), document[chosen].astype("<u4").tobytes(),
            start[chosen].astype("<u4").tobytes(), None,
        ))
    return pd.DataFrame(out, columns=[c.split()[0] for c in _PIECES.split(", ")])


def _merged(runs: np.ndarray) -> np.ndarray:
    """Runs joined where they overlap or touch, by document and start."""
    if not len(runs):
        return runs
    runs = runs[np.lexsort((runs["start"], runs["document"]))]
    # ends rise within a document, and a document's runs lie behind those of the one before
    base = runs["document"].astype("i8") << 33
    upto = np.maximum.accumulate(base + runs["end"])
    starts = np.append(True, base[1:] + runs["start"][1:] > upto[:-1])
    heads = np.flatnonzero(starts)
    out = runs[heads]
    out["end"] = upto[np.append(heads[1:], len(runs)) - 1] - base[heads]
    return out


# -- suffix arrays -----------------------------------------------------------------------


_KEY = 5  # bytes that the first sort compares


def _rising(key: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The places of the keys (below 2 ** bits) in rising order, and the sorted keys."""
    places = max(1, (len(key) - 1).bit_length())
    if bits + places > 64:
        by = np.argsort(key)
        return by, key[by]
    # key and place in one number: sorting numbers is several times faster than sorting places
    both = key << np.uint64(places) | np.arange(len(key), dtype="u8")
    both.sort()
    return (both & np.uint64((1 << places) - 1)).astype("i4"), both >> np.uint64(places)


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Where a row differs from the one before; the first always does."""
    out = np.zeros(len(columns[0]), bool)
    out[:1] = True
    for column in columns:
        out[1:] |= column[1:] != column[:-1]
    return out


def _several(head: np.ndarray) -> np.ndarray:
    """The rows that share their group, which starts at ``head``, with others."""
    return ~(head & np.append(head[1:], True)[: len(head)])


def _left(text: np.ndarray) -> np.ndarray:
    """Bytes from each place to the end of its stretch."""
    ends = np.flatnonzero(text == _END)
    return np.repeat(ends, np.diff(ends, prepend=-1)) - np.arange(len(text))


def suffix_array(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the suffixes of ``text`` in order, and where their first ``_KEY`` bytes change.

    By prefix doubling, of the groups that are still undecided only. The byte 255 ends a
    stretch: it is larger than all others, and of two the earlier is the smaller.
    ``text`` must end with one.
    """
    n = len(text)
    left = _left(text)
    padded = np.append(text, np.zeros(_KEY, "u1"))
    key = np.zeros(n, "u8")
    for at in range(_KEY):
        key = key << np.uint64(8) | padded[at : at + n]
    near = np.flatnonzero(left < _KEY - 1)
    beyond = (8 * (_KEY - 1 - left[near])).astype("u8")
    key[near] = key[near] >> beyond << beyond
    order, key = _rising(key, 8 * _KEY)
    head = first = _changes(key)
    bits, depth = max(1, (n - 1).bit_length()), _KEY
    slots, rank = np.arange(n, dtype="i4"), np.empty(n, "i4")
    rank[order] = np.maximum.accumulate(np.where(head, slots, 0))
    while True:
        open_ = _several(head)
        slots = slots[open_]
        if not len(slots):
            return order, first
        group = (np.cumsum(head[open_]) - 1).astype("u8")
        at = order[slots]
        # a group that has met its end is ordered by place; in a group all have or none
        then = np.where(left[at] < depth, at, rank[np.minimum(at + depth, n - 1)])
        by, pair = _rising(group << np.uint64(bits) | then.astype("u8"), bits + int(group[-1]).bit_length())
        at = at[by]
        order[slots] = at
        head = _changes(pair)
        rank[at] = slots[np.maximum.accumulate(np.where(head, np.arange(len(slots)), 0))]
        depth *= 2


def common_prefixes(text: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``text`` where strings of ``length`` bytes start that occur again, and their groups.

    Places of one string follow each other and share a group number. Strings do not
    hold the byte 255. Intervals of two suffixes and more are extended backward, all
    of one length at a time: the bytes before an interval's suffixes split it into the
    intervals of the strings longer by one, where the last-to-first mapping leads. The
    first intervals are those of the suffix array's own first sort.
    """
    order, head = suffix_array(text)
    before = text[order - 1]  # the transform; the first suffix is preceded by the last byte
    to = np.empty(len(text), "i4")
    to[np.argsort(before, kind="stable")] = np.arange(len(text), dtype="i4")
    depth = _KEY if length >= _KEY else 0
    if not depth:
        head = np.arange(len(text)) == 0
    slots = np.flatnonzero(_several(head) & (_left(text)[order] >= depth)).astype("i4")
    group = np.cumsum(head, dtype="i4")[slots]
    for _ in range(length - depth):
        byte = before[slots]
        by = np.argsort(byte, kind="stable")
        byte = byte[by]
        inside = int(np.searchsorted(byte, _END))
        by, byte = by[:inside], byte[:inside]
        slots, group = to[slots[by]], group[by]
        head = _changes(group, byte)
        several = _several(head)
        slots, group = slots[several], np.cumsum(head[several], dtype="i4")
        if not len(slots):
            break
    return order[slots], group


def _repeats(rows: pd.DataFrame, length: int) -> pd.DataFrame:
    """By block, the runs of bytes to remove that a shard's stretches show."""
    extra = length - 1
    index: dict[bytes, int] = {}
    mark, owner, order, document, start, block = [], [], [], [], [], []
    out = [
        (b, r) for b, r in zip(rows["block"], rows["removed"], strict=True) if r is not None
    ]
    full = rows[rows["content"].notna()]
    for number, row in zip(full["block"], full.to_dict("records"), strict=True):
        sizes = np.frombuffer(row["sizes"], "<u2").astype("i8")
        ends = np.cumsum(sizes)
        data = _read(row["content"], int(ends[-1]))
        known = np.fromiter(
            (index.setdefault(data[e - s : e], len(index)) for s, e in zip(sizes.tolist(), ends.tolist(), strict=True)),
            "i8", len(sizes),
        )
        mark.append((known, np.frombuffer(row["anchor"], "<u4")))
        owner.append(known[np.frombuffer(row["owner"], "<u4")])
        order.append(np.frombuffer(row["order"], "<i8"))
        document.append(np.frombuffer(row["document"], "<u4"))
        start.append(np.frombuffer(row["start"], "<u4"))
        block.append(np.full(len(owner[-1]), number))
    if owner:
        owner, order, document, start, block = map(np.concatenate, (owner, order, document, start, block))
        marks = np.empty(len(index), "u4")
        for known, values in mark:
            marks[known] = values
        # a stretch that is alone with its anchor has no string in common with others: they stand behind
        found, counts = np.unique(marks, return_counts=True)
        alone = counts[np.searchsorted(found, marks)] == 1
        contents = list(index)
        index.clear()
        by = np.argsort(alone, kind="stable")
        place_of = np.empty(len(by), "i8")
        place_of[by] = np.arange(len(by))
        owner = place_of[owner]
        contents = [contents[i] for i in by.tolist()]
        sizes = np.fromiter(map(len, contents), "i8", len(contents))
        several = int((~alone).sum())
        begins = np.cumsum(sizes + 1) - sizes - 1
        first = np.full(len(sizes), _LAST)
        np.minimum.at(first, owner, order)
        first = np.repeat(first, sizes + 1)  # for each window the smallest id that holds it
        if several:
            text = np.frombuffer(b"\xff".join([*contents[:several], b""]), "u1")
            del contents
            place, group = common_prefixes(text, length)
            if len(place):
                heads = np.flatnonzero(_changes(group))
                least = np.minimum.reduceat(first[place], heads)
                first[place] = np.repeat(least, np.diff(np.append(heads, len(place))))
        windows = (sizes - extra)[owner]
        nth = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
        again = first[np.repeat(begins[owner], windows) + nth] < np.repeat(order, windows)
        which = np.repeat(np.arange(len(owner)), windows)[again]
        runs = np.empty(len(which), _RUN)
        runs["document"], runs["start"] = document[which], start[which] + nth[again]
        runs["end"] = runs["start"] + length
        block = block[which]
        by = np.argsort(block, kind="stable")
        runs, block = runs[by], block[by]
        for part in np.split(np.arange(len(runs)), np.flatnonzero(np.diff(block)) + 1):
            if len(part):
                out.append((int(block[part[0]]), _compressed(_merged(runs[part]).tobytes())))
    return pd.DataFrame(out, columns=["block", "removed"])


# -- what remains ------------------------------------------------------------------------


def _remaining(block: pd.DataFrame, removed: pd.DataFrame, texts: bool) -> pd.DataFrame:
    """A row for each of the block's documents."""
    row = block.iloc[0]
    text, ends, ids = _open(row)
    parts = [
        np.frombuffer(pa.CompressedInputStream(pa.BufferReader(r), "zstd").read(), _RUN)
        for r in removed["removed"]
    ]
    runs = _merged(np.concatenate(parts)) if parts else np.empty(0, _RUN)
    edges = np.searchsorted(runs["document"], np.arange(len(ends) + 1))
    missing = np.frombuffer(row["missing"], "u1")
    data, out, begin = text.tobytes(), [], 0
    for i, end in enumerate(ends.tolist()):
        mine = runs[edges[i] : edges[i + 1]]
        kept, at = [], begin
        for start, upto in zip(mine["start"].tolist(), mine["end"].tolist(), strict=True):
            kept.append(data[at : begin + start])
            at = begin + upto
        kept.append(data[at:end])
        kept = b"".join(kept)
        out.append((
            None if missing[i] else int(ids[i]), end - begin, end - begin - len(kept), len(mine),
            hashlib.sha256(kept).hexdigest(), *([kept] if texts else []),
        ))
        begin = end
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
    return pd.DataFrame(out, columns=names[: 5 + texts]).astype({"doc_id": "Int64"})
