"""Near-duplicate documents by SetSketch registers.

A register holds the smallest of exponentially distributed hashes of a document's
shingles, as a whole power of a base slightly above 1, cut to 16 bits. Registers of a union
are the larger registers of its parts. Bands of registers find candidates, the
likelihood of all registers and both set sizes discards distant ones, and
links are confirmed on full sets of words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import stage
from .components import components
from .sized import sized
from .words import free_worker, leaves_room, mixed, shingle_numbers, text_slices, word_numbers

_SKETCH = "doc_id long, n_shingles long, set_key binary, sketch binary"


@dataclass(frozen=True)
class NearDedupConfig:
    """Links hold from ``percent`` similarity on, over shingles of ``shingle`` words.

    With 32 bands of 4 registers a pair of similarity 0.8 shares no band with
    probability 5e-8. ``margin`` is five standard errors of the estimate.
    """

    shingle: int = 5
    percent: int = 80
    registers: int = 128
    band_registers: int = 4
    base: float = 1.001
    rate: float = 20.0
    margin: float = 0.18


def registers(elements: np.ndarray, owner: np.ndarray, sets: int, cfg: NearDedupConfig) -> np.ndarray:
    """``sets`` rows of registers (uint16) for distinct ``elements`` of the sets ``owner``.

    Every element sends points in growing distance to random registers, until it is
    beyond the set's largest minimum; together that is as if each
    register took the minimum over all elements.
    """
    m = cfg.registers
    least = np.full(sets * m, np.inf)
    alive, at, step = np.arange(len(elements)), np.zeros(len(elements)), 0
    while len(alive):
        points = max(1, min(64, 65_536 // len(alive)))
        order = np.arange(step + 1, step + points + 1, dtype="uint64") * np.uint64(0x9E3779B97F4A7C15)
        h = mixed(elements[alive][:, None] + order)
        place = ((h >> np.uint64(32)) * np.uint64(m) >> np.uint64(32)).astype("int64")
        uniform = ((mixed(h) >> np.uint64(11)).astype("float64") + 0.5) * 2.0**-53
        far = at[alive][:, None] - np.cumsum(np.log(uniform), axis=1)
        np.minimum.at(least, (owner[alive][:, None] * m + place).ravel(), far.ravel())
        limit = least.reshape(sets, m).max(axis=1)
        at[alive] = far[:, -1]
        alive = alive[far[:, -1] < limit[owner[alive]]]
        step += points
    least = least.reshape(sets, m) / (m * cfg.rate)
    with np.errstate(divide="ignore"):
        values = np.floor(1 - np.log(least) / np.log(cfg.base))
    return np.clip(values, 0, 65_535).astype("uint16")


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union."""
    return np.maximum(a, b)


def similarity(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, base: float) -> np.ndarray:
    """The likeliest Jaccard similarity for rows of registers and the sets' sizes."""
    more = (a > b).sum(axis=1)
    less = (a < b).sum(axis=1)
    same = a.shape[1] - more - less
    u, v = n_a / (n_a + n_b), n_b / (n_a + n_b)

    def chance(x):
        return -np.log1p(-np.clip(x, 1e-12, 1) * (base - 1) / base) / np.log(base)

    def likelihood(j):
        up, down = chance(u - v * j), chance(v - u * j)
        return more * np.log(up) + less * np.log(down) + same * np.log(np.clip(1 - up - down, 1e-12, 1))

    low, high = np.zeros(len(a)), np.minimum(u / v, v / u)
    for _ in range(40):  # the likelihood has one top
        first, second = low + (high - low) / 3, high - (high - low) / 3
        rising = likelihood(first) < likelihood(second)
        low, high = np.where(rising, first, low), np.where(rising, high, second)
    return (low + high) / 2


def sketches(docs: DataFrame, cfg: NearDedupConfig) -> DataFrame:
    """One row per document: the size of its shingle set, a 128-bit key of the set, registers."""

    @leaves_room
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free_worker()
        for batch in batches:
            ids, at = batch.column("doc_id"), 0
            for texts in text_slices(batch.column("text")):
                sets = [*_shingle_sets(texts, cfg.shingle)]
                sizes = np.array([len(s) for s in sets], "int64")
                elements = np.concatenate(sets) if sets else np.zeros(0, "uint64")
                owner = np.repeat(np.arange(len(sets)), sizes)
                found = registers(elements, owner, len(sets), cfg)
                yield pa.RecordBatch.from_arrays([
                    ids.slice(at, len(texts)), pa.array(sizes),
                    pa.array([xxhash.xxh128_digest(s) for s in sets], pa.binary()),
                    pa.array([r.tobytes() for r in found], pa.binary()),
                ], names=["doc_id", "n_shingles", "set_key", "sketch"])
                at += len(texts)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(sketch, _SKETCH)


def _shingle_sets(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    words, starts = word_numbers(texts)
    all_shingles = shingle_numbers(words, size)
    for start, end in zip(starts[:-1], starts[1:], strict=True):
        n = end - start
        if n >= size:
            yield np.unique(all_shingles[start : end - size + 1])
        elif n:
            yield shingle_numbers(words[start:end], n)
        else:
            yield np.zeros(0, "uint64")


def _true_links(pairs: DataFrame, cfg: NearDedupConfig) -> DataFrame:
    """The (a, b) whose full sets of word shingles are similar enough."""

    def shingles(text: str) -> set:
        words = text.encode().lower().split()  # bytes: lower-cases A-Z, splits at ASCII white space
        if len(words) < cfg.shingle:
            return {tuple(words)} if words else set()
        return set(zip(*(words[i:] for i in range(cfg.shingle)), strict=False))

    @leaves_room
    def confirm(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, first = None, set()
        for batch in batches:
            linked = []
            for text_a, text_b in zip(batch["text_a"], batch["text_b"], strict=True):
                if text_a is not last:
                    first = first if text_a == last else shingles(text_a)
                    last = text_a
                second = shingles(text_b)
                both = len(first & second)
                linked.append(100 * both >= cfg.percent * (len(first) + len(second) - both) > 0)
            yield batch.loc[linked, ["a", "b"]]

    return pairs.mapInPandas(confirm, "a long, b long")


def _likely(pairs: DataFrame, cfg: NearDedupConfig) -> DataFrame:
    """The (a, b) whose registers do not rule out a link."""

    @leaves_room
    def weigh(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            a, b = (
                np.frombuffer(b"".join(batch[c]), "uint16").reshape(-1, cfg.registers)
                for c in ("sketch_a", "sketch_b")
            )
            sizes = batch["n_a"].to_numpy("float64"), batch["n_b"].to_numpy("float64")
            near = similarity(a, b, *sizes, cfg.base) >= cfg.percent / 100 - cfg.margin
            yield batch.loc[near, ["a", "b"]]

    return pairs.mapInPandas(weigh, "a long, b long")


def _confirmed(pairs: DataFrame, classes: DataFrame, docs: DataFrame, cfg: NearDedupConfig) -> DataFrame:
    """The (a, b) that are links."""

    def side(name: str) -> DataFrame:
        return classes.select(
            F.col("rep").alias(name), F.col("n").alias(f"n_{name}"), F.col("sketch").alias(f"sketch_{name}")
        )

    alike = 100 * F.least("n_a", "n_b") >= cfg.percent * F.greatest("n_a", "n_b")
    sized = pairs.join(side("b"), "b").join(side("a"), "a").filter(alike)
    near = stage(_likely(sized, cfg), "near-pairs")
    return stage(_true_links(_with_texts(near, docs), cfg).distinct(), "near-links")


def _with_texts(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """(a, b, text_a, text_b) for pairs of doc_ids."""
    wanted = pairs.select(F.col("a").alias("_wanted")).union(pairs.select("b")).distinct()
    wanted = sized(stage(wanted, "wanted"))
    texts = docs.select(F.col("doc_id").cast("long").alias("_id"), "text").join(
        wanted, F.col("_id") == F.col("_wanted"), "left_semi"
    )
    texts = stage(texts, "near-texts")
    with_b = pairs.join(texts.select(F.col("_id").alias("b"), F.col("text").alias("text_b")), "b")
    return with_b.join(texts.select(F.col("_id").alias("a"), F.col("text").alias("text_a")), "a")


def _beside_hub(pairs: DataFrame, cfg: NearDedupConfig) -> DataFrame:
    """What each b has beside its hub a: rows (a, b, shared, shingle).

    A row with a null shingle, and one for each shingle of b that a lacks; ``shared`` is the number
    of shingles that both have.
    """

    @leaves_room
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for texts in text_slices(batch.column("text_b")):
                some = batch.slice(at, len(texts))
                at += len(texts)
                hubs = (s for t in text_slices(some.column("text_a")) for s in _shingle_sets(t, cfg.shingle))
                other = [
                    np.setdiff1d(b, a, assume_unique=True)
                    for a, b in zip(hubs, _shingle_sets(texts, cfg.shingle), strict=True)
                ]
                sizes = np.array([len(x) for x in other])
                shared = some.column("n_b").to_numpy() - sizes
                rows = np.repeat(np.arange(len(other)), sizes)
                every = np.concatenate([np.arange(len(other)), rows])
                yield pa.RecordBatch.from_arrays([
                    some.column("a").take(pa.array(every)), some.column("b").take(pa.array(every)),
                    pa.array(shared[every]),
                    pa.concat_arrays([
                        pa.nulls(len(other), pa.int64()),
                        pa.array(np.concatenate([*other, np.zeros(0, "uint64")]).view("int64")),
                    ]),
                ], names=["a", "b", "shared", "shingle"])

    return pairs.select("a", "b", "n_b", "text_a", "text_b").mapInArrow(
        compare, "a long, b long, shared long, shingle long"
    )


def near_duplicates(docs: DataFrame, cfg: NearDedupConfig | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Documents with equal sets are one class. Classes that share a band of registers are in
    one bucket, and links are searched there without comparing all pairs, see
    ``_linked_roots``. Links join classes into components; component_id is the
    smallest doc_id reachable, kept marks that document.

    Null and empty texts, and texts of white space, have no shingles and are linked
    with nothing; a text of fewer words than a shingle has is one shingle. Rows
    that share a doc_id are one document for links. A null doc_id takes no part: its
    component_id is null and it is kept. Other columns are not read. An empty table gives none.
    """
    cfg = cfg or NearDedupConfig()
    docs = docs.select("doc_id", "text")
    sketched = stage(sketches(docs, cfg), "sketches")
    classes = stage(
        sketched.filter("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("set_key").agg(
            F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"),
            F.first("sketch").alias("sketch"),
        ), "classes",
    )
    width = 2 * cfg.band_registers
    bands = classes.select("rep", "n", F.explode(F.array(*[
        F.xxhash64(F.lit(i), F.substring("sketch", i * width + 1, width))
        for i in range(cfg.registers // cfg.band_registers)
    ])).alias("bucket"))
    shared = bands.groupBy("bucket").agg(F.count("*").alias("_count")).filter("_count > 1")
    members = stage(bands.select("bucket", "rep", "n").join(shared, "bucket", "left_semi"), "members")
    roots = _linked_roots(members, classes, docs, cfg)

    named = classes.select(F.col("set_key").alias("_key"), "rep")
    if roots is not None:
        named = named.join(
            roots.withColumnsRenamed({"node": "_node", "root": "_root"}), F.col("rep") == F.col("_node"), "left"
        ).select("_key", F.coalesce("_root", "rep").alias("rep"))
    found = sketched.select("doc_id", "n_shingles", "set_key").join(
        named, F.col("set_key") == F.col("_key"), "left"
    )
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("rep", "doc_id"))
    return found.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )


def _linked_roots(members, classes, docs, cfg) -> DataFrame | None:
    """``(node, root)`` of the classes that have links; None if there are none.

    ``members`` has (bucket, rep, n). First all members of a bucket are held against its hub,
    the member that shares most buckets with others. Members that stay apart form a
    group with their hub. Let C be the hub's shingles and those that half of the group
    has besides. Members x and y share at most min(|x and C|, |y and C|) shingles
    of C. As p percent similarity means |x and y| >= p / (100 + p) (|x| + |y|),
    linked members either are both that close to C, or share enough shingles outside C.
    So all members are held against the one closest to C, and then just the pairs of either
    kind that are still apart. In a group of copies with changes of their own there
    are few of these, so work grows with the group and not with its square; no
    member of a bucket is left out.
    """
    search = _Search(classes, docs, cfg)
    sizes = members.groupBy("bucket").agg(F.count("*").alias("_size"))
    degree = members.join(sizes, "bucket").groupBy("rep").agg(F.sum("_size").alias("_degree"))
    hubs = members.join(degree, "rep").groupBy("bucket").agg(
        F.max(F.struct("_degree", (-F.col("rep")).alias("_rep"))).alias("_top")
    ).select("bucket", (-F.col("_top._rep")).alias("hub"))
    beside = stage(members.join(hubs, "bucket").filter("rep != hub"), "beside")
    search.test(beside.select(F.col("hub").alias("a"), F.col("rep").alias("b")))
    apart = _in_parts(search.rooted(beside), beside)
    group = stage(apart.select("hub", "rep", "n").distinct(), "groups")
    if group.isEmpty():
        return search.roots

    found = _beside_hub(_with_texts(group.select(F.col("hub").alias("a"), F.col("rep").alias("b")), docs).join(
        group.select(F.col("rep").alias("b"), F.col("n").alias("n_b")).distinct(), "b"
    ), cfg)
    found = stage(found.withColumnsRenamed({"a": "hub", "b": "rep"}), "beside-hubs")
    other = found.filter("shingle IS NOT NULL").select("hub", "rep", "shingle")
    counts = other.groupBy("hub", "shingle").agg(F.count("*").alias("_count")).filter("_count > 1")
    half = counts.join(group.groupBy("hub").agg(F.count("*").alias("_size")), "hub")
    half = stage(half.select("hub", "shingle", F.col("_count").alias("count"), (2 * F.col("_count") >= F.col("_size")).alias("common")), "counts")
    other = stage(other.join(half, ["hub", "shingle"]), "shared-shingles")
    common = other.filter("common").groupBy("hub", "rep").agg(F.count("*").alias("_common"))
    close = found.filter("shingle IS NULL").select("hub", "rep", "shared").join(group, ["hub", "rep"])
    close = close.join(common, ["hub", "rep"], "left").select(
        "hub", "rep", "n", (F.col("shared") + F.coalesce("_common", F.lit(0))).alias("in_c")
    )
    close = stage(close, "close")

    centre = close.groupBy("hub").agg(
        F.max(F.struct((2 * F.col("in_c") - F.col("n")).alias("_near"), (-F.col("rep")).alias("_rep"))).alias("_top")
    ).select("hub", (-F.col("_top._rep")).alias("centre"))
    search.test(close.join(centre, "hub").filter("rep != centre").select(
        F.col("centre").alias("a"), F.col("rep").alias("b")
    ))
    close = stage(search.rooted(close), "close-roots")
    search.test(_sharing(other.filter("NOT common"), close, cfg).unionByName(_both_close(close, cfg)))
    return search.roots


class _Search:
    """Tests pairs of classes once and keeps the links and the roots that follow from them."""

    def __init__(self, classes, docs, cfg):
        self.classes, self.docs, self.cfg = classes, docs, cfg
        self.links = self.tested = self.roots = None

    def rooted(self, rows: DataFrame) -> DataFrame:
        """``rows`` (rep) with the root of their component so far."""
        if self.roots is None:
            return rows.withColumn("root", F.col("rep"))
        ends = self.roots.withColumnsRenamed({"node": "_node", "root": "_root"})
        return rows.join(ends, F.col("rep") == F.col("_node"), "left").select(
            *rows.columns, F.coalesce("_root", "rep").alias("root")
        )

    def test(self, pairs: DataFrame) -> None:
        """Confirms links among the (a, b) that are of like size, untested and still apart."""
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        if self.tested is not None:
            pairs = pairs.join(self.tested, ["a", "b"], "left_anti")
        if self.roots is not None:
            for side in ("a", "b"):
                ends = self.roots.withColumnsRenamed({"node": "_node", "root": f"_root_{side}"})
                pairs = pairs.join(ends, F.col(side) == F.col("_node"), "left").drop("_node")
            pairs = pairs.filter(F.coalesce("_root_a", "a") != F.coalesce("_root_b", "b")).select("a", "b")
        pairs = stage(pairs, "pairs")
        if pairs.isEmpty():
            return
        self.tested = pairs if self.tested is None else self.tested.unionByName(pairs)
        found = _confirmed(pairs, self.classes, self.docs, self.cfg)
        if not found.isEmpty():
            self.links = found if self.links is None else self.links.unionByName(found)
            self.roots = components(self.links)


def _sharing(other: DataFrame, close: DataFrame, cfg: NearDedupConfig) -> DataFrame:
    """Pairs (a, b) still apart that may share enough shingles outside their group's C.

    A member needs at least so many of them as the smallest partner asks for, so of its
    list, rarest first, the last ``needed`` - 1 can be left out: two lists that share
    enough also meet in what is left of both.
    """
    least = close.groupBy("hub").agg(F.min("n").alias("_least"))
    needed = F.ceil(cfg.percent * (F.col("n") + F.col("_least")) / (100 + cfg.percent)) - F.col("in_c")
    known = close.join(least, "hub").select("hub", "rep", "root", F.greatest(F.lit(1), needed).alias("_needed"))
    rows = other.join(known, ["hub", "rep"])
    own = W.partitionBy("hub", "rep")
    rows = rows.withColumn("_place", F.row_number().over(own.orderBy("count", "shingle")))
    rows = rows.withColumn("_length", F.count("*").over(own)).filter("_place <= _length - _needed + 1")
    rows = stage(rows.select("hub", "shingle", "rep", "root"), "rare-shingles")
    y = rows.select(*[F.col(c).alias(f"y_{c}") for c in rows.columns])
    both = rows.join(y, (F.col("hub") == F.col("y_hub")) & (F.col("shingle") == F.col("y_shingle")) & (
        F.col("rep") < F.col("y_rep")) & (F.col("root") != F.col("y_root")))
    return both.select(F.col("rep").alias("a"), F.col("y_rep").alias("b"))


def _both_close(close: DataFrame, cfg: NearDedupConfig) -> DataFrame:
    """Pairs (a, b) still apart whose shared shingles may all lie in their group's C."""
    room = F.floor((100 + cfg.percent) * F.col("in_c") / cfg.percent) - F.col("n")
    own = close.select("hub", "rep", "n", "root", room.alias("room"))
    # the largest component of a group need not look for others: they look for it
    largest = own.groupBy("hub", "root").agg(F.count("*").alias("_size")).groupBy("hub").agg(
        F.max(F.struct("_size", "root")).alias("_top")
    ).select("hub", F.col("_top.root").alias("_largest"))
    sizes = own.groupBy("hub").agg(F.min("n").alias("_least"), F.max("n").alias("_most"))
    seek = own.join(largest, "hub").filter("root != _largest").join(sizes, "hub").select(
        F.col("hub").alias("_hub"), F.col("rep").alias("y"), F.col("n").alias("y_n"), F.col("root").alias("y_root"),
        F.greatest("_least", F.ceil(cfg.percent * F.col("n") / 100)).alias("low"),
        F.least("_most", "room").alias("high"),
    ).filter("low <= high")
    seek = seek.select("_hub", "y", "y_n", "y_root", F.explode(F.sequence("low", "high")).alias("x_n"))
    same = (F.col("hub") == F.col("_hub")) & (F.col("n") == F.col("x_n"))
    both = own.join(seek, same & (F.col("room") >= F.col("y_n")) & (F.col("root") != F.col("y_root")))
    return both.select(F.col("rep").alias("a"), F.col("y").alias("b"))


def _in_parts(rooted: DataFrame, members: DataFrame) -> DataFrame:
    """The members of buckets that hold several roots."""
    several = rooted.groupBy("bucket").agg(F.min("root").alias("_low"), F.max("root").alias("_high"))
    return members.join(several.filter("_low != _high"), "bucket", "left_semi")


def deduplicate(docs: DataFrame, cfg: NearDedupConfig | None = None) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the document with the smallest id.

    Of rows that share a doc_id one stays; rows without a doc_id all stay.
    """
    found = near_duplicates(docs, cfg).filter("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.min("kept").alias("_kept"), F.count("*").alias("_rows")
    )
    found = found.filter("NOT _kept OR _rows > 1").withColumnRenamed("doc_id", "_id")
    found = stage(found, "not-as-they-are")
    same = F.col("doc_id") == F.col("_id")
    stay = docs.join(sized(found), same, "left_anti")
    often = found.filter("_kept")
    if not often.isEmpty():
        stay = stay.unionByName(docs.join(sized(often), same, "left_semi").dropDuplicates(["doc_id"]))
    return stay
