"""Quality by the perplexity of an interpolated modified Kneser-Ney model of bytes.

The model (``byte_model``) is trained on trusted documents in two folds, and each document is
scored by the fold it is not part of. A language's threshold is a quantile of the
scores of its own trusted documents.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .byte_model import score
from .sized import BROADCAST_ROWS, sized


@dataclass(frozen=True)
class QualityConfig:
    """A language's threshold is the ``quantile`` of its trusted documents' scores.

    A document's mean is drawn to its language's as by ``prior`` further n-grams, as
    few n-grams say little. Languages with fewer than ``least_trusted`` trusted
    documents use the threshold of all. Up to ``broadcast_ids`` trusted and
    rejected ids are broadcast; more are joined by a shuffle.
    """

    quantile: float = 0.99
    prior: int = 100
    least_trusted: int = 50
    broadcast_ids: int = BROADCAST_ROWS


def trusted_ids(labels: DataFrame) -> DataFrame:
    """The distinct doc_ids that labels call good."""
    return labels.filter("quality = 1 AND doc_id IS NOT NULL").select(
        F.col("doc_id").cast("long").alias("_trusted_id")
    ).distinct()


def classify(docs: DataFrame, labels: DataFrame, cfg: QualityConfig | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, lang, n_grams, perplexity (of a byte), threshold, kept.

    ``docs`` has doc_id, lang, text; ``labels`` has doc_id and quality. The model is
    trained on all documents whose label is 1. A document is kept up to its
    language's threshold. Null texts are empty; texts of fewer than five bytes have no
    n-grams and their language's mean perplexity, so they are kept. Null languages
    are a language; repeated rows are judged each; without trusted documents all
    is kept. An empty table gives none.
    """
    cfg = cfg or QualityConfig()
    ids = sized(stage(trusted_ids(labels), "trusted"), cfg.broadcast_ids)
    marked = docs.select("doc_id", "lang", "text").join(ids, F.col("doc_id") == F.col("_trusted_id"), "left")
    scored = stage(
        score(marked.select("doc_id", "lang", "text", F.col("_trusted_id").isNotNull().alias("trusted"))), "scores"
    )
    by_lang = scored.filter("trusted").groupBy("lang").agg(
        F.sum("bits").alias("bits"), F.sum("n_grams").alias("n"), F.count("*").alias("docs")
    )
    every = by_lang.agg(F.sum("bits").alias("bits"), F.sum("n").alias("n")).first()
    mean_of_all = every.bits / every.n if every.n else 0.0
    means = scored.select("lang").distinct().join(
        by_lang.withColumnRenamed("lang", "_lang"), F.col("lang").eqNullSafe(F.col("_lang")), "left"
    ).select(
        F.col("lang").alias("_lang"), F.coalesce(F.col("docs") >= cfg.least_trusted, F.lit(False)).alias("_own"),
        F.coalesce(F.when(F.col("n") > 0, F.col("bits") / F.col("n")), F.lit(mean_of_all)).alias("_mean"),
    )
    same_lang = F.col("lang").eqNullSafe(F.col("_lang"))
    mean = F.round((F.col("bits") + cfg.prior * F.col("_mean")) / (F.col("n_grams") + cfg.prior), 4)
    judged = scored.join(stage(means, "means"), same_lang).select(
        "doc_id", "lang", "trusted", "n_grams", "_own", mean.alias("_bits")
    )
    good = stage(judged.filter("trusted").select("lang", "_own", "_bits"), "trusted-scores")
    at = F.percentile("_bits", F.lit(cfg.quantile))
    of_all = good.agg(at.alias("t")).first().t
    own = good.filter("_own").groupBy("lang").agg(at.alias("_limit")).withColumnRenamed("lang", "_lang")
    limit = F.coalesce("_limit", F.lit(of_all).cast("double"))
    return judged.join(stage(own, "thresholds"), same_lang, "left").select(
        "doc_id", "lang", "n_grams", F.pow(F.lit(2.0), "_bits").alias("perplexity"),
        F.pow(F.lit(2.0), limit).alias("threshold"),
        F.coalesce(F.col("_bits") <= limit, F.lit(True)).alias("kept"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, cfg: QualityConfig | None = None) -> DataFrame:
    """The rows of ``docs`` that are kept; rows without a doc_id stay."""
    cfg = cfg or QualityConfig()
    bad = classify(docs, labels, cfg).filter("NOT kept AND doc_id IS NOT NULL").select(
        F.col("doc_id").alias("_bad_id")
    ).distinct()
    bad = sized(stage(bad, "rejected"), cfg.broadcast_ids)
    return docs.join(bad, F.col("doc_id") == F.col("_bad_id"), "left_anti")
