"""Lempel-Ziv phrase fingerprints of documents.

A text is parsed into dictionary phrases: each is the shortest stretch that is not a
phrase yet. Documents that compress alike share phrases, so the likeness of the phrase
sets, estimated from the smallest phrase hashes, stands for compression distance.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ranking import rank_within
from ..session import stage
from .words import mixed

#: Smallest hashes that a fingerprint keeps.
SIGNATURE = 64
#: Bytes of text that a task of the neighbour query sorts, about.
RANGE_BYTES = 32_000_000

_ODD = 0x9E3779B97F4A7C15
_INVERSE = pow(_ODD, -1, 2**64)


def _parse(text: str, start: int, stop: int, seen: set[str], ends: list[int]) -> int:
    """Adds the phrases of ``text[start:stop]`` to ``seen`` and ``ends``; returns where the rest starts."""
    add, note = seen.add, ends.append
    for end in range(start + 1, stop + 1):
        phrase = text[start:end]
        if phrase not in seen:
            add(phrase)
            note(end)
            start = end
    return start


def phrase_ends(text: str) -> list[int]:
    """Where each phrase of the text ends; the last may repeat an earlier one."""
    ends: list[int] = []
    if _parse(text, 0, len(text), set(), ends) < len(text):
        ends.append(len(text))
    return ends


class Parsed:
    """A parsed text that can be parsed again with another last quarter.

    Both parses share the phrases of the first three quarters.
    """

    def __init__(self, text: str):
        self.text, self.keep = text, len(text) - len(text) // 4
        self._seen: set[str] = set()
        self.ends: list[int] = []
        self._start = _parse(text, 0, self.keep, self._seen, self.ends)
        self._kept = len(self.ends)
        rest = _parse(text, self._start, len(text), self._seen, self.ends)
        start = self._start
        for end in self.ends[self._kept :]:
            self._seen.discard(text[start:end])
            start = end
        if rest < len(text):
            self.ends.append(len(text))

    def edited(self, following: str) -> tuple[str, list[int]]:
        """The edited text and its phrases' ends; to be called once."""
        text = self.text[: self.keep] + following[: len(self.text) - self.keep]
        ends = self.ends[: self._kept]
        if _parse(text, self._start, len(text), self._seen, ends) < len(text):
            ends.append(len(text))
        return text, ends


def phrase_hashes(text: str, ends: list[int]) -> np.ndarray:
    """A 32-bit hash of each phrase, from prefix sums."""
    if not text:
        return np.zeros(0, "uint32")
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype("uint64") + np.uint64(1)
    sums = np.zeros(len(points) + 1, "uint64")
    np.cumsum(points * _powers(len(points), _ODD), out=sums[1:])
    to = np.array(ends)
    at = np.zeros(len(to), "int64")
    at[1:] = to[:-1]
    own = (sums[to] - sums[at]) * _powers(len(points), _INVERSE)[at]
    return (mixed(own + (to - at).astype("uint64")) >> np.uint64(32)).astype("uint32")


_known_powers: dict[int, np.ndarray] = {}


def _powers(n: int, base: int) -> np.ndarray:
    """The powers of ``base`` modulo 2^64, from 0 on."""
    known = _known_powers.get(base)
    if known is None or len(known) < n:
        size = max(n, 1 << 14)
        steps = np.full(size, base, "uint64")
        steps[0] = 1
        known = _known_powers[base] = np.cumprod(steps)
    return known[:n]


def signature(text: str, ends: list[int], size: int = SIGNATURE) -> np.ndarray:
    """The ``size`` smallest distinct phrase hashes, rising."""
    return np.unique(phrase_hashes(text, ends))[:size]


def fingerprint(text: str, size: int = SIGNATURE) -> np.ndarray:
    return signature(text, phrase_ends(text), size)


def likeness(a: np.ndarray, b: np.ndarray, size: int = SIGNATURE) -> float:
    """Estimated Jaccard similarity of two phrase sets: 1 if both are empty."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = np.concatenate([a, b])
    both.sort()
    again = both[1:] == both[:-1]
    place = 1 + np.cumsum(~again)  # among the distinct hashes of the union
    return int((again & (place <= size)).sum()) / min(size, int(place[-1]))


def as_text(signature: np.ndarray) -> str:
    return signature.astype(">u4").tobytes().hex()


def from_text(text: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(text), ">u4").astype("uint32")


def fingerprints(docs: DataFrame, size: int = SIGNATURE) -> DataFrame:
    """doc_id and fingerprint (hex) of each whole text; null texts are empty."""

    @F.pandas_udf("string")
    def marked(texts: pd.Series) -> pd.Series:
        return pd.Series([as_text(fingerprint(t or "", size)) for t in texts], dtype=object)

    return docs.select("doc_id", marked("text").alias("fingerprint"))


_ROW = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def compare_with_edits(docs: DataFrame, size: int = SIGNATURE, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): fingerprints of its text and its edited text.

    The next document is the next by doc_id, after the last the first; null ids come first
    and equal ids are ordered by text. Ids alone are ranked to cut them into ranges of
    about ``range_bytes`` of text; one id per range is broadcast (25 MB at 100 TB). Texts
    go to their range, and the first of each range also to the range before, so
    each is read next to its successor without one global order. Null texts are empty.
    A single document is its own successor; an empty table gives none.
    """
    spark = docs.sparkSession
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63)).cast("long"))
    rows = docs.select(
        key.alias("key"), F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")
    )
    ids = stage(rows.select("key", F.octet_length("text").alias("bytes")), "ids")
    shape = ids.agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes")).first()
    if not shape.n:
        return spark.createDataFrame([], _ROW)
    ranges = max(1, -(-(shape.bytes + 16 * shape.n) // range_bytes))
    each = -(-shape.n // ranges)
    firsts = rank_within(ids.select("key"), [], [F.col("key")], "_rank").filter(
        (F.col("_rank") - 1) % each == 0
    ).select("key").distinct()
    firsts = np.sort(firsts.toPandas()["key"].to_numpy("int64"))
    shared, n = spark.sparkContext.broadcast(firsts), len(firsts)

    @F.pandas_udf("range int, leads boolean")
    def place(keys: pd.Series) -> pd.DataFrame:
        keys = keys.to_numpy("int64")
        found = np.searchsorted(shared.value, keys, "right") - 1
        return pd.DataFrame({"range": found.astype("int32"), "leads": shared.value[found] == keys})

    before = F.pmod(F.col("at.range") - 1, F.lit(n))
    both = rows.withColumn("at", place("key")).select("key", "doc_id", "text", F.explode(F.array_compact(F.array(
        F.struct(F.col("at.range").alias("range"), F.lit(0).alias("ahead")),
        F.when(F.col("at.leads"), F.struct(before.alias("range"), F.lit(1).alias("ahead"))),
    ))).alias("to"))
    ordered = (
        both.select("to.range", "to.ahead", "key", "doc_id", "text")
        .repartition("range")
        .sortWithinPartitions("range", "ahead", "key", "text")
    )

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None  # range, doc_id, parsed text, signature of the row whose successor comes next
        for batch in batches:
            out = []
            ids = batch["doc_id"].astype("object").where(batch["doc_id"].notna(), None)
            for where, ahead, doc_id, text in zip(
                batch["range"], batch["ahead"], ids, batch["text"], strict=True
            ):
                starts = held is None or held[0] != where
                if starts and ahead:  # a further row with the id of the next range's first
                    continue
                parsed = Parsed(text)
                own = signature(text, parsed.ends, size)
                if not starts:
                    out.append(_compared(*held[1:], text, own, size))
                held = None if ahead else (where, doc_id, parsed, own)
            if out:
                yield pd.DataFrame(out, columns=[c.split()[0] for c in _ROW.split(", ")]).astype(
                    {"doc_id": "Int64"}
                )

    return ordered.select("range", "ahead", "doc_id", "text").mapInPandas(compare, _ROW)


def _compared(doc_id, parsed, own, following, next_mark, size) -> tuple:
    edited, ends = parsed.edited(following)
    mark = signature(edited, ends, size)
    return (
        doc_id, len(parsed.text), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
        as_text(own), as_text(mark), likeness(own, mark, size), likeness(own, next_mark, size),
    )
