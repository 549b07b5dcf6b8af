"""Best-fit packing of tokenized documents by swap-based local search."""

from __future__ import annotations

import math
import os
import unicodedata
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .words import free_worker, kept_by_worker, text_slices

SEQUENCE_TOKENS = 2048
#: Pieces that one task packs.
SHARD_PIECES = 8192
#: Distinct words whose ids a Python worker remembers; beyond, it forgets all and goes on.
WORDS_KEPT = 1_200_000
#: Bytes of text that are tokenized at a time.
BATCH_BYTES = 4_000_000

_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
_PIECE_NAMES = ["doc_id", "piece", "start", "length", "ids_crc32"]
_PIECE_TYPES = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordIds:
    """Token ids of whole texts, looked up word by word.

    White space ends every token of this kind of tokenizer, and capitals count as
    small letters, so a text's ids are those of its words in a row. A batch is split and its
    distinct words are numbered by Arrow; only words not met before are tokenized. A
    word of letters before a comma or full stop takes the ids of both parts.
    Texts with the beginning of a control token are tokenized as they are.
    """

    def __init__(self, tokenizer_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {"": 0}
        self.ids = array("I")
        self.starts = array("q", [0])
        self.counts = array("q", [0])

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        for some in text_slices(texts, BATCH_BYTES):
            yield from self._encode_some(some)

    def _encode_some(self, texts: pa.Array) -> Iterator[np.ndarray]:
        control = pc.match_substring(texts, "<|").to_numpy(zero_copy_only=False)
        plain = pc.ascii_lower(pc.if_else(pa.array(control), "", texts))
        lists = pc.ascii_split_whitespace(plain)
        coded = lists.flatten().dictionary_encode()
        numbers = self._numbers(coded.dictionary.to_pylist())
        words = numbers[coded.indices.to_numpy(zero_copy_only=False)]
        counts = np.frombuffer(self.counts, "int64")[words]
        upto = np.concatenate([[0], np.cumsum(counts)])
        shift = np.frombuffer(self.starts, "int64")[words] - upto[:-1]
        ids = np.frombuffer(self.ids, "uint32")[np.repeat(shift, counts) + np.arange(upto[-1])]
        offsets = lists.offsets.to_numpy()
        bounds = upto[offsets - offsets[0]]
        for i, is_control in enumerate(control):
            if is_control:
                found = self.tokenizer.encode(texts[i].as_py(), add_special_tokens=False)
                yield np.asarray(found.ids, "uint32")
            else:
                yield ids[bounds[i] : bounds[i + 1]]

    def _numbers(self, words: list[str]) -> np.ndarray:
        if len(self.known) > WORDS_KEPT:
            self.forget()
        known = self.known
        found = list(map(known.get, words))
        if None not in found:
            return np.array(found, "int64")
        new = [w for w, number in zip(words, found, strict=True) if number is None]
        stems = dict.fromkeys(w[:-1] if _ends_in_stop(w) else w for w in new)
        stops = dict.fromkeys(w[-1] for w in new if _ends_in_stop(w))
        fresh = [w for w in {**stems, **stops} if w not in known]
        for at in range(0, len(fresh), 4096):
            self._tokenize(fresh[at : at + 4096])
        for word in new:
            if word not in known:
                stem, stop = known[word[:-1]], known[word[-1]]
                self._add(word, self._ids(stem) + self._ids(stop))
        return np.fromiter(map(known.__getitem__, words), "int64", len(words))

    def _tokenize(self, words: list[str]) -> None:
        found = self.tokenizer.encode(" ".join(words), add_special_tokens=False)
        ids = array("I", found.ids)
        starts = np.fromiter((o[0] for o in found.offsets), "int64", len(ids))
        ends = np.cumsum(np.fromiter(map(len, words), "int64", len(words)) + 1)
        at = 0
        for word, upto in zip(words, np.searchsorted(starts, ends).tolist(), strict=True):
            self._add(word, ids[at:upto])
            at = upto

    def _ids(self, number: int) -> array:
        start = self.starts[number]
        return self.ids[start : start + self.counts[number]]

    def _add(self, word: str, ids: array) -> None:
        self.known[word] = len(self.starts)
        self.starts.append(len(self.ids))
        self.counts.append(len(ids))
        self.ids.extend(ids)


def _ends_in_stop(word: str) -> bool:
    """Letters before a comma or full stop that are still letters as the tokenizer normalises them."""
    stem = word[:-1]
    if word[-1:] not in (",", ".") or not stem.isalpha():
        return False
    return stem.isascii() or unicodedata.normalize("NFC", stem).lower().isalpha()


@kept_by_worker
def _word_ids(tokenizer_path: str) -> WordIds:
    """One for each Python worker: words stay known from task to task."""
    return WordIds(tokenizer_path)


def token_pieces(docs: DataFrame, tokenizer_path: str, most: int, end_id: int = 0) -> DataFrame:
    """Each document's ids and ``end_id`` in pieces of ``most`` ids; the last may be shorter."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free_worker(keep=_word_ids)
        words, end = _word_ids(tokenizer_path), np.array([end_id], "<u4")
        for batch in batches:
            rows = []
            texts = words.encode(batch.column("text"))
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), texts, strict=True):
                ids = np.append(ids, end).astype("<u4", copy=False)
                for piece, at in enumerate(range(0, len(ids), most)):
                    part = ids[at : at + most]
                    rows.append((doc_id, piece, at, len(part), zlib.crc32(part)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), _PIECE_TYPES, strict=True)]
                if rows else [pa.array([], t) for t in _PIECE_TYPES],
                names=_PIECE_NAMES,
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, _PIECE)


class _Bins:
    """Bins of pieces, with an index of what an underfull bin can take in.

    ``reach[t][n]``: the (bin, pieces it gives) that can receive up to ``t`` tokens for
    the ``n`` tokens of none, one or two of its pieces.
    """

    def __init__(self, lengths: list[int], most: int, tries: float):
        self.most, self.lengths, self.tries = most, lengths, tries
        self.bins: list[list[int]] = []
        self.fill: list[int] = []
        self.reach: dict[int, dict[int, dict]] = {}
        self.mask = 0
        self.fewest = -(-sum(lengths) // most)

    def best_fit(self) -> None:
        """Longest first, each into the fullest bin that takes it."""
        rooms: dict[int, list[int]] = {}
        mask = 0
        for piece in sorted(range(len(self.lengths)), key=lambda i: (-self.lengths[i], i)):
            n = self.lengths[piece]
            fits = mask >> n
            if fits:
                room = n + (fits & -fits).bit_length() - 1
                b = rooms[room].pop()
                if not rooms[room]:
                    mask &= ~(1 << room)
            else:
                room, b = self.most, len(self.bins)
                self.bins.append([])
                self.fill.append(0)
            self.bins[b].append(piece)
            self.fill[b] += n
            rooms.setdefault(room - n, []).append(b)
            mask |= 1 << (room - n)

    def offers(self, b: int) -> set[tuple[int, int, tuple[int, ...]]]:
        room, by_length = self.most - self.fill[b], {}
        for piece in self.bins[b]:
            by_length.setdefault(self.lengths[piece], []).append(piece)
        out = {(room, 0, ())}
        short = sorted(by_length)
        for i, n in enumerate(short):
            out.add((room + n, n, (by_length[n][0],)))
            for m in short[i:]:
                if m > n or len(by_length[n]) > 1:
                    out.add((room + n + m, n + m, (by_length[n][0], by_length[m][-1])))
        return out

    def list_bin(self, b: int) -> None:
        for reach, back, given in self.offers(b):
            self.reach.setdefault(reach, {}).setdefault(back, {})[b, given] = None
            self.mask |= 1 << reach

    def unlist_bin(self, b: int) -> None:
        for reach, back, given in self.offers(b):
            backs = self.reach[reach]
            del backs[back][b, given]
            if not backs[back]:
                del backs[back]
                if not backs:
                    self.mask &= ~(1 << reach)

    def receiver(self, donor: int, amount: int, most_given: int = 2):
        """The exchange that leaves least room in another bin when it receives ``amount`` for
        ``most_given`` pieces or fewer."""
        self.tries -= 1
        reach = amount
        # a bin that reaches further is emptier after it has given back than the donor: squared fill would not grow
        limit = self.most + amount - self.fill[donor]
        while fits := self.mask >> reach:
            reach += (fits & -fits).bit_length() - 1
            if reach >= limit:
                return None
            for back, found in self.reach[reach].items():
                if back < amount:
                    for b, given in found:
                        if b != donor and len(given) <= most_given:
                            return b, given
            reach += 1
        return None

    def exchange(self, donor: int, sent: tuple[int, ...], b: int, given: tuple[int, ...]) -> None:
        for x in (donor, b):
            self.unlist_bin(x)
        for x, out, into in ((donor, sent, given), (b, given, sent)):
            self.bins[x] = [p for p in self.bins[x] if p not in out] + list(into)
            self.fill[x] = sum(self.lengths[p] for p in self.bins[x])
        for x in (donor, b):
            if 0 < self.fill[x] < self.most:
                self.list_bin(x)

    def used(self) -> int:
        return sum(1 for n in self.fill if n)

    def search(self) -> None:
        """Exchange while squared fill grows: donors are the emptiest bins, in turn.

        Ends when no bin can give, or no packing could have fewer bins.
        """
        if self.used() == self.fewest:
            return
        under = [b for b, n in enumerate(self.fill) if 0 < n < self.most]
        for b in under:
            self.list_bin(b)
        changed = True
        while changed and self.tries > 0 and self.used() > self.fewest:
            changed = False
            for donor in sorted(under, key=self.fill.__getitem__):
                while 0 < self.fill[donor] < self.most and self.tries > 0 and self._give(donor):
                    changed = True
            under = [b for b in under if 0 < self.fill[b] < self.most]

    def _give(self, donor: int) -> bool:
        own: dict[int, int] = {}
        for piece in self.bins[donor]:
            own.setdefault(self.lengths[piece], piece)
        for n in sorted(own, reverse=True):
            if found := self.receiver(donor, n):
                self.exchange(donor, (own[n],), *found)
                return True
        by = sorted(self.bins[donor], key=self.lengths.__getitem__)
        for i, p in enumerate(by[:-1]):
            for q in by[i + 1 :]:
                if self.tries <= 0:
                    return False
                if found := self.receiver(donor, self.lengths[p] + self.lengths[q], 1):
                    self.exchange(donor, (p, q), *found)
                    return True
        return False


def pack_lengths(lengths: list[int], most: int) -> list[list[int]]:
    """Bins of indexes of ``lengths``, each of at most ``most`` in all."""
    packed = _Bins(lengths, most, math.inf)
    packed.best_fit()
    packed.search()
    return [b for b in packed.bins if b]


def pack(
    docs: DataFrame, tokenizer_path: str | None = None, most: int = SEQUENCE_TOKENS,
    shard_pieces: int = SHARD_PIECES,
) -> DataFrame:
    """Packs all documents into sequences of at most ``most`` tokens.

    Returns per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.
    Tokenized pieces are dealt by hash to shards of about ``shard_pieces``; each
    is packed best fit and improved by exchanges. The pieces of underfull sequences of all
    shards are then dealt to fewer shards and packed again, until one shard holds
    them or a round saves no sequence. Null and empty texts are one token;
    repeated rows are packed each; null ids are kept; an empty table gives no rows.
    """
    path = tokenizer_path or default_tokenizer()
    left = stage(token_pieces(docs, path, most), "pack-pieces")
    done, before, turn = [], None, 0
    while True:
        size = left.count()
        shards = max(1, -(-size // shard_pieces))
        packed = stage(_pack_shards(left, shards, most, turn), "pack-round")
        if shards == 1:
            return _union([*done, packed])
        under = packed.filter(F.col("_fill") < most)
        bins = under.filter("offset = 0").count()
        if not bins or (before is not None and bins >= before):
            return _union([*done, packed])
        done.append(packed.filter(F.col("_fill") == most))
        left, before, turn = under.select(*left.columns), bins, turn + 1


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.drop("_fill")


def _pack_shards(pieces: DataFrame, shards: int, most: int, turn: int) -> DataFrame:
    def packed(group: pd.DataFrame) -> pd.DataFrame:
        first = (turn << 48) + (int(group["_shard"].iloc[0]) << 20)
        group = group.drop(columns="_shard").sort_values(
            ["length", "doc_id", "piece", "ids_crc32"], ignore_index=True
        )
        lengths = group["length"].tolist()
        sequence, offset, fill = (np.zeros(len(group), "int64") for _ in range(3))
        for n, members in enumerate(pack_lengths(lengths, most)):
            at = 0
            for i in members:
                sequence[i], offset[i] = first + n, at
                at += lengths[i]
            fill[members] = at
        return group.assign(sequence_id=sequence, offset=offset, _fill=fill)

    shard = F.pmod(F.xxhash64(F.lit(turn), *pieces.columns), F.lit(shards))
    # a task for each shard: pieces are few bytes, and packing them is the work
    return pieces.withColumn("_shard", shard).repartition(shards, "_shard").groupBy("_shard").applyInPandas(
        packed, f"{_PIECE}, sequence_id long, offset long, _fill long"
    )
