"""Mixing sources to target weights by systematic sampling.

A source's documents are ordered by size and each is expected ``target / size of
the source`` times. The prefix sums of these expected copies, moved by one offset per
source, cross an integer once per copy. All sums are whole numbers of 2^-24
copies, so reruns agree and a document is never taken above the most copies. As
neighbours have like sizes, the words taken differ from the target by little
more than the largest document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ranking import rank_within
from ..session import stage
from .sized import sized

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
WORD = r"[^\x20\x09-\x0D]+"
_UNIT = 1 << 24


def word_count(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_copies: int = MOST_COPIES
) -> DataFrame:
    """``(source, weight, source_size, target)`` for rows of ``(source, size)``.

    Sources in code point order, null last, weigh ``weights``, repeating, and share
    all words. A target stops at ``most_copies`` times its source's size; the excess
    goes to the others by weight until no target is above. Each turn of the loop
    is one aggregation of the sources, which brings two numbers to the driver.
    """
    per_source = stage(
        sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sources"
    )
    place = rank_within(
        per_source, [], [F.col("source").isNull(), F.col("source")], "_place"
    )
    weight = F.element_at(
        F.array(*[F.lit(w) for w in weights]), ((F.col("_place") - 1) % len(weights) + 1).cast("int")
    )
    ranked = stage(place.select("source", "source_size", weight.alias("weight")), "mix-weights")
    most = F.col("source_size") * most_copies
    total = ranked.agg(F.sum("source_size").alias("n")).first().n or 0
    level, full = 0.0, -1
    while True:
        at_most = (F.lit(level) * F.col("weight") >= most) if full >= 0 else F.lit(False)
        row = ranked.agg(
            F.sum(at_most.cast("int")).alias("full"),
            F.coalesce(F.sum(F.when(at_most, most)), F.lit(0)).alias("given"),
            F.coalesce(F.sum(F.when(~at_most, F.col("weight"))), F.lit(0)).alias("weight"),
        ).first()
        if (row.full or 0) == full or not row.weight:
            break
        full, level = row.full, (total - row.given) / row.weight
    return ranked.select(
        "source", "weight", "source_size",
        F.least(most.cast("double"), F.lit(level) * F.col("weight")).alias("target"),
    )


def copies(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_copies: int = MOST_COPIES, seed: int = 1
) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, source_size, target, copies.

    ``docs`` has ``doc_id``, ``source`` and ``text``. Null and empty texts have size
    0 and are sampled like others of their source; a source without words has
    target 0 and is not taken. Null sources form one source. Repeated rows are
    documents of their own. An empty table gives none.
    """
    sizes = stage(
        docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "mix-sizes"
    )
    targets = source_targets(sizes, weights, most_copies).select(
        F.col("source").alias("_source"), "source_size", "target",
        F.conv(
            F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce("source", F.lit("\0")))), 1, 6),
            16, 10,
        ).cast("long").alias("_offset"),
        F.when(
            F.col("source_size") > 0,
            F.floor(F.col("target") / F.col("source_size") * _UNIT),
        ).otherwise(0).cast("long").alias("_step"),
    )
    ranked = rank_within(sizes, ["source"], [F.col("size"), F.col("doc_id")], "_rank")
    upto = F.col("_rank") * F.col("_step") + F.col("_offset")
    crossed = F.shiftright(upto, 24) - F.shiftright(upto - F.col("_step"), 24)
    return ranked.join(targets, F.col("source").eqNullSafe(F.col("_source"))).select(
        "doc_id", "source", "size", "source_size", "target", crossed.alias("copies")
    )


def mix(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, each as often as ``copies`` takes it.

    Rows that share a doc_id share its copies evenly.
    """
    taken = copies(docs, **options).groupBy("doc_id").agg(
        F.sum("copies").alias("_copies"), F.count("*").alias("_rows")
    )
    taken = stage(taken.withColumnRenamed("doc_id", "_taken_id").filter("_copies > 0"), "mix-taken")
    once = taken.filter("_rows = 1")
    chosen = docs.join(sized(once), F.col("doc_id").eqNullSafe(F.col("_taken_id")))
    emitted = chosen.select(*docs.columns, "_copies")
    often = taken.filter("_rows > 1")
    if not often.isEmpty():
        rows = docs.join(often, F.col("doc_id").eqNullSafe(F.col("_taken_id")))
        upto = "_place * _copies div _rows - (_place - 1) * _copies div _rows"
        emitted = emitted.unionByName(
            rank_within(rows, ["doc_id"], [F.xxhash64("text")], "_place").select(
                *docs.columns, F.expr(upto).alias("_copies")
            )
        ).filter("_copies > 0")
    again = F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies")))
    return emitted.select(*docs.columns, again.alias("_copy")).drop("_copy")
