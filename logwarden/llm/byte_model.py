"""Held-out scores of whole texts under a byte model that grows with the trusted texts.

An interpolated modified Kneser-Ney model of order 5 over bytes. Counts of five and four
bytes are tables that grow with the trusted texts and never leave the executors. They
are hashed by the three bytes in the middle, so a five-gram, its context, the four-gram
it backs off to and that one's context share a shard. Orders three and below are a table of
fixed size over folded bytes, which is broadcast.

Documents fall into two folds by the hash of their ids, and each is scored by the model
of the other fold's trusted documents. So no document is judged by its own counts, and
trusted and other documents are judged alike.

Texts are packed into compressed blocks of one fold. A block asks for each of its distinct
five-grams once; it is answered with their bits, and its texts' bits are summed up where it lies.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage, stage_bucketed
from .words import free_worker, leaves_room, leaves_room_by_group, mixed

ORDER = 5
SYMBOLS = 128
TRIGRAMS = SYMBOLS**3
#: Bytes of text in a block, those worked on at a time, and those whose five-grams share a shard.
BLOCK_BYTES = 8_000_000
SLICE_BYTES = 2_000_000
SHARD_BYTES = 32_000_000
#: Blocks whose requests to a shard are answered in one group; a shard's model goes to each group.
ASKING_BLOCKS = 256

_BLOCK = "block long, fold int, ids binary, missing binary, langs array<string>, trusted binary, ends binary, size long, text binary"
_ASKED = "shard int, part int, fold int, block long, keys binary, counts binary, n int"
_COUNTED = "shard int, part int, fold int, keys binary, counts binary, n int"
_ANSWER = "block long, shard int, bits binary"
_SCORE = "doc_id long, lang string, trusted boolean, n_grams long, bits double"


def symbol_table() -> np.ndarray:
    """The class of each byte: letters and signs keep their own, digits share one."""
    table = np.zeros(256, "uint8")
    table[[9, 10, 11, 12, 13]] = 1
    table[list(b"0123456789")] = 2
    rest = [b for b in range(32, 127) if not 48 <= b <= 57]
    table[rest] = np.arange(3, 3 + len(rest))
    high = np.arange(128, 256)
    table[high] = 3 + len(rest) + high % (SYMBOLS - 3 - len(rest))
    return table


def discounts(counted: list[int]) -> np.ndarray:
    """What modified Kneser-Ney takes off counts of 0, 1, 2 and 3 or more, from how many are 1 to 4."""
    n1, n2, n3, n4 = (max(1, int(n)) for n in counted)
    y = n1 / (n1 + 2 * n2)
    found = [0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return np.array([min(max(d, 0.05 * k), 0.95 * k) for k, d in enumerate(found)])


def _ones_to_fours(counts: np.ndarray) -> list[int]:
    return [int((counts == k).sum()) for k in (1, 2, 3, 4)]


def _interpolated(counts: np.ndarray, lower: np.ndarray) -> np.ndarray:
    """Probabilities by context (rows) from discounted counts and the lower order."""
    total = counts.sum(axis=-1, keepdims=True)
    discount = discounts(_ones_to_fours(counts))[np.minimum(counts, 3)]
    with np.errstate(invalid="ignore", divide="ignore"):
        own = np.where(total > 0, (counts - discount) / total, 0)
        rest = np.where(total > 0, discount.sum(axis=-1, keepdims=True) / total, 1)
    return own + rest * lower


def trigram_model(grams: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The probability of each three classes' last byte, for all TRIGRAMS."""
    counts = np.zeros(TRIGRAMS, "int64")
    counts[grams] = n
    counts = counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS)
    before = (counts > 0).sum(axis=0)  # in how many contexts each pair follows
    single = (before > 0).sum(axis=0)
    sizes = np.maximum(np.bincount(symbol_table(), minlength=SYMBOLS), 1)  # bytes of a class are alike
    p1 = _interpolated(single, np.full(SYMBOLS, 1 / SYMBOLS))
    p2 = _interpolated(before, p1[None, :])
    return (_interpolated(counts, p2[None, :, :]) / sizes).astype("float32").ravel()


# -- blocks --------------------------------------------------------------------------


def _packed(docs: DataFrame) -> DataFrame:
    """Whole texts of one fold in blocks of about BLOCK_BYTES; a longer text has a block of its own."""

    @leaves_room
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free_worker()
        number = TaskContext.get().partitionId() << 32
        held: list[list[tuple]] = [[], []]
        sizes = [0, 0]
        for batch in batches:
            ids, langs, trusted, folds = (batch.column(i).to_pylist() for i in range(4))
            for *about, fold, text in zip(ids, langs, trusted, folds, batch.column(4), strict=True):
                text = text.as_py() or b""
                if held[fold] and sizes[fold] + len(text) > BLOCK_BYTES:
                    yield _block(number, fold, held[fold])
                    number, held[fold], sizes[fold] = number + 1, [], 0
                held[fold].append((*about, text))
                sizes[fold] += len(text)
        for fold, rows in enumerate(held):
            if rows:
                yield _block(number, fold, rows)
                number += 1

    return docs.mapInArrow(pack, _BLOCK)


def _block(number: int, fold: int, rows: list[tuple]) -> pa.RecordBatch:
    ids, langs, trusted, texts = zip(*rows, strict=True)
    ends = np.cumsum([len(t) for t in texts], dtype="<i8")
    row = (
        number, fold, np.array([i or 0 for i in ids], "<i8").tobytes(),
        np.array([i is None for i in ids], "u1").tobytes(), list(langs), np.array(trusted, "u1").tobytes(),
        ends.tobytes(), int(ends[-1]), pa.Codec("zstd", compression_level=9).compress(b"".join(texts), asbytes=True),
    )
    types = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.string()), pa.binary(), pa.binary(),
             pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays(
        [pa.array([v], t) for v, t in zip(row, types, strict=True)], names=[c.split()[0] for c in _BLOCK.split(", ")]
    )


def _zip(data: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(data).tobytes(), codec="zstd", asbytes=True)


def _unzip(data: bytes, kind: str, n: int) -> np.ndarray:
    size = n * np.dtype(kind).itemsize
    return np.frombuffer(pa.decompress(data, size, codec="zstd", asbytes=True) if size else b"", kind)


def _pack_keys(keys: np.ndarray) -> bytes:
    """Rising five-grams: their differences, byte by byte."""
    return _zip(np.diff(keys, prepend=np.uint64(0)).astype("<u8").view("u1").reshape(-1, 8).T)


def _keys(data: bytes, n: int) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(_unzip(data, "u1", 8 * n).reshape(8, n).T).view("<u8").ravel(), dtype="u8")


def _slices(row) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Where in a block's text five-grams inside one document start, and the five-grams, slice by slice."""
    data = pa.decompress(row["text"], row["size"], codec="zstd", asbytes=True) if row["size"] else b""
    text, ends = np.frombuffer(data, "u1"), np.frombuffer(row["ends"], "<i8")
    for at in range(0, len(text) - ORDER + 1, SLICE_BYTES):
        part = text[at : at + SLICE_BYTES + ORDER - 1]
        n = len(part) - ORDER + 1
        grams = np.zeros(n, "u8")
        for i in range(ORDER):
            grams = grams << np.uint64(8) | part[i : i + n]
        inside = np.ones(n, bool)
        near = ends[(ends > at) & (ends < at + n + ORDER)] - at
        for back in range(1, ORDER):
            over = near - back
            inside[over[(over >= 0) & (over < n)]] = False
        yield np.flatnonzero(inside) + at, grams[inside]


def _trusted_places(row, places: np.ndarray) -> np.ndarray:
    ends = np.frombuffer(row["ends"], "<i8")
    return np.frombuffer(row["trusted"], "u1")[np.searchsorted(ends, places, "right")]


def _heads(keys: np.ndarray) -> np.ndarray:
    """Where a rising key differs from the one before."""
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    return np.flatnonzero(new)


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, rising, and the sums of their counts."""
    by = np.argsort(keys, kind="stable")
    keys, counts = keys[by], counts[by]
    heads = _heads(keys)
    return keys[heads], np.add.reduceat(counts, heads) if len(heads) else counts[:0]


def _block_grams(row) -> tuple[np.ndarray, np.ndarray]:
    """A block's distinct five-grams, rising, and how often trusted documents hold each."""
    keys, counts = [np.zeros(0, "u8")], [np.zeros(0, "i8")]
    for places, grams in _slices(row):
        both = grams << np.uint64(1) | _trusted_places(row, places)
        both.sort()
        grams = both >> np.uint64(1)
        heads = _heads(grams)
        if len(heads):
            keys.append(grams[heads])
            counts.append(np.add.reduceat((both & np.uint64(1)).astype("i8"), heads))
    return _summed(np.concatenate(keys), np.concatenate(counts))


def _shard_of(grams: np.ndarray, shards: int) -> np.ndarray:
    """By the three bytes in the middle, in which a gram agrees with all that it is computed from."""
    return (mixed(grams >> np.uint64(8) & np.uint64(0xFFFFFF)) % np.uint64(shards)).astype("i8")


def _by_shard(grams: np.ndarray, shards: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each shard and the places of its grams, rising."""
    shard = _shard_of(grams, shards)
    by = np.argsort(shard, kind="stable")
    for chosen in np.split(by, np.flatnonzero(np.diff(shard[by])) + 1):
        if len(chosen):
            yield int(shard[chosen[0]]), chosen


def _asked(blocks: DataFrame, shards: int, parts: int) -> DataFrame:
    @leaves_room
    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        free_worker()
        for batch in batches:
            for row in batch.to_dict("records"):
                keys, counts = _block_grams(row)
                rows = [
                    (shard, int(row["block"] ^ row["block"] >> 32) % parts, row["fold"], row["block"],
                     _pack_keys(keys[chosen]), _zip(counts[chosen].astype("<i8")), len(chosen))
                    for shard, chosen in _by_shard(keys, shards)
                ]
                if rows:
                    yield pd.DataFrame(rows, columns=[c.split()[0] for c in _ASKED.split(", ")])

    return blocks.select("block", "fold", "trusted", "ends", "size", "text").mapInPandas(ask, _ASKED)


# -- the model --------------------------------------------------------------------------


@leaves_room_by_group
def _merge(rows: pd.DataFrame) -> pd.DataFrame:
    """The counts of one shard and fold (and part) as one row; grams without counts go."""
    keys = [_keys(k, n) for k, n in zip(rows["keys"], rows["n"], strict=True)]
    counts = [_unzip(c, "<i8", n) for c, n in zip(rows["counts"], rows["n"], strict=True)]
    seen = [c > 0 for c in counts]
    keys, counts = _summed(
        np.concatenate([k[s] for k, s in zip(keys, seen, strict=True)]),
        np.concatenate([c[s] for c, s in zip(counts, seen, strict=True)]),
    )
    about = [int(rows[c].iloc[0]) for c in ("shard", "part", "fold")]
    out = [(*about, _pack_keys(keys), _zip(counts), len(keys))] if len(keys) else []
    return pd.DataFrame(out, columns=[c.split()[0] for c in _COUNTED.split(", ")])


def _four_grams(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The last four bytes of five-grams, distinct and rising, and in how many five-grams each is."""
    return _summed(keys & np.uint64(0xFFFFFFFF), np.ones(len(keys), "i8"))


def _kinds(rows: pd.DataFrame) -> pd.DataFrame:
    """How many five-grams and four-grams of a shard are counted one to four times."""
    out = []
    for row in rows.to_dict("records"):
        _, continued = _four_grams(_keys(row["keys"], row["n"]))
        out.append((row["fold"], *_ones_to_fours(_unzip(row["counts"], "<i8", row["n"])), *_ones_to_fours(continued)))
    return pd.DataFrame(out, columns=["fold", *[f"n{i}" for i in range(8)]])


class _Level:
    """Discounted counts of one order and what their contexts leave to the lower one."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, discount: np.ndarray):
        self.keys, self.counts, self.discount = keys, counts, discount
        self.contexts, self.totals = _summed(keys >> np.uint64(8), counts)
        self.rest = _summed(keys >> np.uint64(8), discount[np.minimum(counts, 3)])[1]

    def probability(self, grams: np.ndarray, lower: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return lower
        at = np.minimum(np.searchsorted(self.keys, grams), len(self.keys) - 1)
        counts = np.where(self.keys[at] == grams, self.counts[at], 0)
        context = grams >> np.uint64(8)
        of = np.minimum(np.searchsorted(self.contexts, context), len(self.contexts) - 1)
        own = (counts - self.discount[np.minimum(counts, 3)] + self.rest[of] * lower) / self.totals[of]
        return np.where(self.contexts[of] == context, own, lower)


def _bits(grams: np.ndarray, keys: np.ndarray, counts: np.ndarray, by: np.ndarray, base: np.ndarray) -> np.ndarray:
    """Bits of the last byte of each five-gram; ``by`` are the discounts of both orders."""
    p3 = base[_classes(grams)].astype("f8")
    p4 = _Level(*_four_grams(keys), by[1]).probability(grams & np.uint64(0xFFFFFFFF), p3)
    return -np.log2(_Level(keys, counts, by[0]).probability(grams, p4))


def _classes(grams: np.ndarray) -> np.ndarray:
    """The code of the last three bytes' classes."""
    table = symbol_table().astype("i8")
    one, two, three = (table[(grams >> np.uint64(s) & np.uint64(255)).astype("i8")] for s in (16, 8, 0))
    return (one * SYMBOLS + two) * SYMBOLS + three


def trigram_counts(model: DataFrame) -> DataFrame:
    """``(fold, gram, n)``: how often three classes follow each other, at most 2 * TRIGRAMS rows."""

    @leaves_room
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((2, TRIGRAMS), "i8")
        for batch in batches:
            for row in batch.to_dict("records"):
                counts = _unzip(row["counts"], "<i8", row["n"])
                np.add.at(total[row["fold"]], _classes(_keys(row["keys"], row["n"])), counts)
        fold, gram = np.nonzero(total)
        yield pd.DataFrame({"fold": fold.astype("i4"), "gram": gram, "n": total[fold, gram]})

    counted = model.select("fold", "keys", "counts", "n").mapInPandas(count, "fold int, gram long, n long")
    return counted.groupBy("fold", "gram").agg(F.sum("n").alias("n"))


# -- scores ------------------------------------------------------------------------------


def score(docs: DataFrame) -> DataFrame:
    """doc_id, lang, trusted, n_grams and bits of each row of ``docs`` (doc_id, lang, text, trusted).

    ``bits`` are those of all bytes behind the first four, under the model of the other fold's
    trusted documents. Null texts are empty; texts of fewer than five bytes have no grams. Null
    ids share a fold; repeated rows are scored each. Without trusted documents in the other
    fold all bytes are alike. An empty table gives no rows.
    """
    spark = docs.sparkSession
    fold = F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(2)).cast("int")
    # in buckets: the answers come to the texts
    blocks = stage_bucketed(_packed(docs.select(
        F.col("doc_id").cast("long"), F.col("lang").cast("string"), F.col("trusted"), fold,
        F.col("text").cast("binary"),
    )), "quality-blocks", "block")
    shape = blocks.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("size"), F.count("*").alias("n")).first()
    shards, parts = max(1, -(-shape.size // SHARD_BYTES)), max(1, -(-shape.n // ASKING_BLOCKS))

    asked = stage(_asked(blocks, shards, parts), "quality-asked")
    keys = ["shard", "part", "fold"]
    # a gram that is in every block is summed within parts first
    merged = asked.select(*keys, "keys", "counts", "n").groupBy(*keys).applyInPandas(_merge, _COUNTED)
    model = stage(merged.groupBy("shard", "fold").applyInPandas(_merge, _COUNTED), "quality-model")
    base = np.zeros((2, TRIGRAMS), "f4")
    counted = trigram_counts(model).toPandas()  # at most 2 * TRIGRAMS rows
    for f in (0, 1):
        of = counted[counted["fold"] == f]
        base[f] = trigram_model(of["gram"].to_numpy("int64"), of["n"].to_numpy("int64"))
    shared = spark.sparkContext.broadcast(base)
    names = [f"n{i}" for i in range(8)]
    kinds = model.mapInPandas(
        leaves_room(lambda batches: map(_kinds, batches)), "fold int, " + ", ".join(f"{n} long" for n in names)
    ).groupBy("fold").agg(*[F.sum(n).alias(n) for n in names]).collect()  # two rows
    by = np.array([[discounts([0] * 4)] * 2] * 2)
    for row in kinds:
        by[row.fold] = [discounts([row[n] for n in names[:4]]), discounts([row[n] for n in names[4:]])]

    @leaves_room_by_group
    def answer(requests: pd.DataFrame, models: pd.DataFrame) -> pd.DataFrame:
        of = {row["fold"]: row for row in models.to_dict("records")}
        out = []
        for fold, some in requests.groupby("fold"):
            row = of.get(1 - fold)  # judged by the other fold
            known = (_keys(row["keys"], row["n"]), _unzip(row["counts"], "<i8", row["n"])) if row else (
                np.zeros(0, "u8"), np.zeros(0, "i8"))
            grams = [_keys(k, n) for k, n in zip(some["keys"], some["n"], strict=True)]
            bits = _bits(np.concatenate(grams), *known, by[1 - fold], shared.value[1 - fold]).astype("<f2")
            cuts = np.cumsum([len(g) for g in grams])[:-1]
            for block, shard, part in zip(some["block"], some["shard"], np.split(bits, cuts), strict=True):
                out.append((block, shard, _zip(part)))
        return pd.DataFrame(out, columns=[c.split()[0] for c in _ANSWER.split(", ")])

    requests = asked.select("shard", "part", "fold", "block", "keys", "n").groupBy("shard", "part")
    every_part = F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part")
    models = model.select("shard", every_part, "fold", "keys", "counts", "n").groupBy("shard", "part")
    answers = requests.cogroup(models).applyInPandas(answer, _ANSWER)
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(
        leaves_room_by_group(lambda block, found: _sums(block, found, shards)), _SCORE
    )


def _sums(block: pd.DataFrame, answers: pd.DataFrame, shards: int) -> pd.DataFrame:
    """A row for each of the block's documents: its grams and their bits."""
    row = block.iloc[0]
    keys, _ = _block_grams(row)
    bits = np.zeros(len(keys), "f4")
    found = dict(zip(answers["shard"], answers["bits"], strict=True))
    for shard, chosen in _by_shard(keys, shards):
        bits[chosen] = _unzip(found[shard], "<f2", len(chosen))
    ends, ids = np.frombuffer(row["ends"], "<i8"), np.frombuffer(row["ids"], "<i8")
    n, total = np.zeros(len(ends), "i8"), np.zeros(len(ends))
    for places, grams in _slices(row):
        document = np.searchsorted(ends, places, "right")
        n += np.bincount(document, minlength=len(ends))
        total += np.bincount(document, bits[np.searchsorted(keys, grams)], minlength=len(ends))
    missing = np.frombuffer(row["missing"], "u1").astype(bool)
    return pd.DataFrame({
        "doc_id": pd.array(ids, "Int64").copy() if not missing.any() else pd.array(
            [None if m else int(i) for i, m in zip(ids, missing, strict=True)], "Int64"),
        "lang": list(row["langs"]), "trusted": np.frombuffer(row["trusted"], "u1").astype(bool),
        "n_grams": n, "bits": total,
    })
