"""Fill-in-the-middle documents, assembled by a secondary sort.

A text is cut into units (lines), two cuts make prefix, middle and suffix, and chunks
of units are emitted as pieces, keyed by document and place in the output. One shuffle by
document with a sort by place (``repartition`` and ``sortWithinPartitions``, the DataFrame
form of ``repartitionAndSortWithinPartitions``) brings them in order, and a task
reads them as a stream: no document is ever put together in memory to be checked. The
output is parsed back in the same way, and its pieces are sorted once more, in place
of a second shuffle inside their partition, by where they stood in the text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: Markers in the order of the output, each with the place of its part in the text.
LAYOUTS = {
    "plain": (),
    "psm": ((PREFIX, 0), (SUFFIX, 2), (MIDDLE, 1)),
    "spm": ((SUFFIX, 2), (PREFIX, 0), (MIDDLE, 1)),
}
_KEY = ["doc_id", "_text", "_row"]
_BATCH_BYTES = 4_000_000


@dataclass(frozen=True)
class FillMiddleConfig:
    """``rate`` percent of the documents are rearranged, ``spm`` percent of these suffix first."""

    seed: int = 7
    rate: int = 100
    spm: int = 50
    piece_bytes: int = 8192


def choice(doc_id: int | None, units: int, cfg: FillMiddleConfig) -> tuple[int, int, bool, str]:
    """Units before the middle and before the suffix, whether the id is to be rearranged, and how."""
    digest = hashlib.sha256(f"{cfg.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in range(0, 32, 8))
    one, two = sorted((h1 % (units + 1), h2 % (units + 1)))
    return one, two, h3 % 100 < cfg.rate, "spm" if h4 % 100 < cfg.spm else "psm"


def _points(data: np.ndarray) -> int:
    """Code points of UTF-8 bytes."""
    return int(((data & 0xC0) != 0x80).sum())


def _chunks(start: int, stop: int, breaks: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """``start`` to ``stop`` in chunks of whole units up to ``most`` bytes; longer units are cut."""
    while stop - start > most:
        at = int(np.searchsorted(breaks, start + most, "right"))
        upto = int(breaks[at - 1]) if at and breaks[at - 1] > start else start + most
        yield start, upto
        start = upto
    yield start, stop


def _pieces_of(doc_id, text: bytes, cfg: FillMiddleConfig):
    """n, form, prefix and middle code points, and an iterator of the output's pieces."""
    data = np.frombuffer(text, "u1")
    breaks = np.flatnonzero(data == 10) + 1
    n = len(breaks) + bool(len(text) and not text.endswith(b"\n"))
    one, two, asked, form = choice(doc_id, n, cfg)
    if not text or not asked or PREFIX in text or SUFFIX in text or MIDDLE in text:
        return n, "plain", None, None, (text[a:b] for a, b in _chunks(0, len(text), breaks, cfg.piece_bytes))
    offsets = [0 if not units else len(text) if units == n else int(breaks[units - 1]) for units in (0, one, two, n)]

    def pieces():
        for marker, part in LAYOUTS[form]:
            for a, b in _chunks(offsets[part], offsets[part + 1], breaks, cfg.piece_bytes):
                yield marker + text[a:b]
                marker = b""

    return n, form, _points(data[: offsets[1]]), _points(data[offsets[1] : offsets[2]]), pieces()


_PIECE = [
    ("doc_id", pa.int64(), "long"), ("_text", pa.int64(), "long"), ("_row", pa.int64(), "long"),
    ("n", pa.int64(), "long"), ("form", pa.string(), "string"), ("prefix_chars", pa.int64(), "long"),
    ("middle_chars", pa.int64(), "long"), ("place", pa.int64(), "long"), ("piece", pa.binary(), "binary"),
]
_PARSED = [*_PIECE[:7], ("part", pa.int64(), "long"), *_PIECE[7:]]


def _schema(fields) -> str:
    return ", ".join(f"{name} {kind}" for name, _, kind in fields)


def _batches(rows: Iterator[tuple], fields) -> Iterator[pa.RecordBatch]:
    """Rows whose last column is bytes in batches of a few megabytes."""
    held, size = [], 0

    def batch():
        columns = zip(*held, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, (_, t, _) in zip(columns, fields, strict=True)], names=[f[0] for f in fields]
        )

    for row in rows:
        held.append(row)
        size += 200 + len(row[-1])
        if size > _BATCH_BYTES:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


def pieces(docs: DataFrame, cfg: FillMiddleConfig | None = None) -> DataFrame:
    """The output of each row of ``docs`` (doc_id, text) as pieces, in output order in each partition.

    Returns doc_id, _text and _row (which tell rows with one doc_id apart), n (units), form,
    prefix_chars, middle_chars (null if plain), place (from 0) and piece (binary). All
    pieces of a row are in one partition, one after another; a text of any length is read and
    written in pieces of about ``cfg.piece_bytes``. Null texts are empty, a null doc_id counts
    as an id without digits; an empty text gives one empty piece. Rows that repeat give their
    pieces each. Other columns are dropped; an empty table gives none.
    """
    cfg = cfg or FillMiddleConfig()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                keys = zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True)
                for key, text in zip(keys, batch.column(3), strict=True):
                    *about, parts = _pieces_of(key[0], text.as_py() or b"", cfg)
                    for place, piece in enumerate(parts):
                        yield *key, *about, place, piece

        yield from _batches(rows(), _PIECE)

    rows = docs.select(
        F.col("doc_id").cast("long"), F.xxhash64("text").alias("_text"),
        F.monotonically_increasing_id().alias("_row"), F.col("text").cast("binary"),
    )
    # dealt by id and text alone, which a task that is run again cannot change
    return rows.mapInArrow(cut, _schema(_PIECE)).repartition("doc_id", "_text").sortWithinPartitions(*_KEY, "place")


def _documents(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple]:
    """(starts, row) of rows whose first ``width`` columns are those of one document."""
    last = None
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            yield row[:3] != last, row
            last = row[:3]


class _Parser:
    """Parts of an output that comes in pieces; holds back what may be the start of a marker."""

    def __init__(self, form: str):
        self.layout, self.at, self.held = LAYOUTS[form], 0, b""
        self.part = 0 if form == "plain" else -1

    def feed(self, data: bytes, last: bool = False) -> Iterator[tuple[int, bytes]]:
        data = self.held + data
        while self.at < len(self.layout):
            marker, part = self.layout[self.at]
            found = data.find(marker)
            if found < 0:
                break
            if found:
                yield self.part, data[:found]
            data, self.part, self.at = data[found + len(marker) :], part, self.at + 1
        keep = 0 if last or self.at == len(self.layout) else min(len(data), len(PREFIX) - 1)
        self.held = data[len(data) - keep :]
        if len(data) > keep:
            yield self.part, data[: len(data) - keep]


#: Place of the row that closes a document, behind all its parts.
_CLOSE = 9


def restored(ordered: DataFrame) -> DataFrame:
    """The pieces of each text again, in text order in each partition, from ``pieces``.

    Reads outputs and forms only. Columns as of ``pieces``, with part (0 prefix or plain text,
    1 middle, 2 suffix) before place. Behind each document one row of part 9 has the hex
    SHA-256 of the output as its piece.
    """

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            held = None
            for starts, row in _documents(batches, 3):
                if starts:
                    if held:
                        yield from close(*held)
                    held = (row[:7], _Parser(row[4]), hashlib.sha256(), [0])
                about, parser, digest, place = held
                digest.update(row[-1])
                for part, data in parser.feed(row[-1]):
                    yield *about, part, place[0], data
                    place[0] += 1
            if held:
                yield from close(*held)

        def close(about, parser, digest, place):
            for part, data in parser.feed(b"", last=True):
                yield *about, part, place[0], data
                place[0] += 1
            yield *about, _CLOSE, place[0], digest.hexdigest().encode()

        yield from _batches(rows(), _PARSED)

    # documents stay in their partition, so the sort needs no shuffle
    return ordered.mapInArrow(parse, _schema(_PARSED)).sortWithinPartitions(*_KEY, "part", "place")


def digests(docs: DataFrame, cfg: FillMiddleConfig | None = None) -> DataFrame:
    """One row per row of ``docs``: digests of the output and of the text rebuilt from it.

    Returns doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256.
    """
    fields = [_PIECE[0], *_PIECE[3:7], ("output_sha256", pa.string(), "string"), ("restored_sha256", pa.string(), "string")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            digest = None
            for starts, row in _documents(batches, 3):
                if starts:
                    digest = hashlib.sha256()
                if row[7] == _CLOSE:
                    yield row[0], *row[3:7], row[-1].decode(), digest.hexdigest()
                else:
                    digest.update(row[-1])

        yield from _batches(rows(), fields)

    return restored(pieces(docs, cfg)).mapInArrow(read, _schema(fields))


def texts(docs: DataFrame, cfg: FillMiddleConfig | None = None) -> DataFrame:
    """doc_id, form and output (the whole text) of each row of ``docs``."""
    fields = [_PIECE[0], _PIECE[4], ("output", pa.string(), "string")]

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            about, parts = None, []
            for starts, row in _documents(batches, 3):
                if starts:
                    if about:
                        yield *about, b"".join(parts)
                    about, parts = (row[0], row[4]), []
                parts.append(row[-1])
            if about:
                yield *about, b"".join(parts)

        yield from _batches(rows(), fields)

    return pieces(docs, cfg).mapInArrow(join, _schema(fields))
