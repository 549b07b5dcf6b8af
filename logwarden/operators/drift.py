"""Population drift between two training sets, and the promotion policy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import FEATURE_COLUMNS, DetectorConfig
from ..functions.quantiles import percentile_arrays, percentiles_by, unpivot
from ..session import stage

_EPS = 1e-9
SCORE_COLUMNS = ("if_score", "lof_score", "fused_score")


def bin_edges(old: DataFrame, buckets: int = 10) -> DataFrame:
    """``(name, edges)``: de-duplicated quantile edges of the old sample."""
    probs = [i / buckets for i in range(buckets + 1)]
    return percentile_arrays(old, probs).select("name", F.array_distinct("values").alias("edges"))


def histogram(long: DataFrame, edges: DataFrame, open_ended: bool = False) -> DataFrame:
    """``(name, bin, cnt)``: half-open bins, the last one closed.

    Values outside the edges are dropped, or go to the outer bins when
    ``open_ended``. ``edges`` has one row per column name, so it is broadcast.
    """
    x, edge = F.col("x"), F.col("edges")
    last = F.size(edge) - 1
    joined = long.join(F.broadcast(edges), "name").filter(last >= 1)
    if not open_ended:
        joined = joined.filter((x >= F.element_at(edge, 1)) & (x <= F.element_at(edge, -1)))
    passed = F.size(F.filter(edge, lambda e: e <= x))
    slot = F.least(F.greatest(passed, F.lit(1)), last)
    return joined.groupBy("name", slot.alias("bin")).agg(F.count("*").alias("cnt"))


def bin_counts(
    old: DataFrame, new: DataFrame, columns, buckets: int = 10, open_ended: bool = False
) -> DataFrame:
    """``(name, bin, old, new)``: both samples over the old one's bins, empty bins as 0."""
    old_long, new_long = unpivot(old, columns), unpivot(new, columns)
    # one short row per column name: pinned, so all three uses share one evaluation
    pinned = [(r.name, r.edges) for r in bin_edges(old_long, buckets).collect()]
    edges = old.sparkSession.createDataFrame(pinned, "name string, edges array<double>")
    return _filled(old_long, new_long, edges, open_ended)


def _filled(old_long: DataFrame, new_long: DataFrame, edges: DataFrame, open_ended: bool = False) -> DataFrame:
    counts = edges.filter(F.size("edges") >= 3).select(
        "name", F.explode(F.sequence(F.lit(1), F.size("edges") - 1)).alias("bin")
    )
    for side, long in (("old", old_long), ("new", new_long)):
        side_counts = histogram(long, edges, open_ended).withColumnRenamed("cnt", side)
        counts = counts.join(side_counts, ["name", "bin"], "left")
    return counts.fillna(0, ["old", "new"])


def psi_kl(
    old: DataFrame, new: DataFrame, columns, buckets: int = 10, open_ended: bool = False
) -> DataFrame:
    """``(name, psi, kl)`` for each column; fewer than three edges give 0."""
    measured = _measured(bin_counts(old, new, columns, buckets, open_ended))
    names = old.sparkSession.createDataFrame([(c,) for c in columns], "name string")
    return names.join(F.broadcast(measured), "name", "left").fillna(0.0, ["psi", "kl"])


def psi_kl_by(old: DataFrame, new: DataFrame, columns, key: str, buckets: int = 10) -> DataFrame:
    """``(key, name, psi, kl)``: ``psi_kl`` of each key's samples, which have to be of bounded size."""
    probs = [i / buckets for i in range(buckets + 1)]
    found = percentiles_by(old, key, {c: probs for c in columns})
    each = [F.struct(F.lit(c).alias("column"), F.array_distinct(c).alias("edges")) for c in columns]
    edges = found.select(key, F.inline(F.array(*each)))
    edges = stage(edges.select(key, "column", F.concat_ws("|", key, "column").alias("name"), "edges"), "edges")

    def long(side: DataFrame) -> DataFrame:
        return unpivot(side, columns, [key]).select(F.concat_ws("|", key, "name").alias("name"), "x")

    measured = _measured(_filled(long(old), long(new), edges.select("name", "edges")))
    rows = edges.select(key, "name", "column").join(measured, "name", "left").fillna(0.0, ["psi", "kl"])
    return rows.select(key, F.col("column").alias("name"), "psi", "kl")


def _measured(filled: DataFrame) -> DataFrame:
    totals = filled.groupBy("name").agg(
        F.sum("old").alias("old_total"),
        F.sum("new").alias("new_total"),
        F.collect_list(F.struct("old", "new")).alias("bins"),
    )

    def share(count: Column, total: str) -> Column:
        return F.when(count == 0, F.lit(_EPS)).otherwise(count / F.greatest(F.col(total), F.lit(1)))

    shares = totals.select(
        "name",
        F.transform(
            "bins",
            lambda b: F.struct(
                share(b["old"], "old_total").alias("e"), share(b["new"], "new_total").alias("a")
            ),
        ).alias("bins"),
    )

    def total_of(term) -> Column:
        return F.aggregate("bins", F.lit(0.0), lambda acc, b: acc + term(b["e"], b["a"]))

    return shares.select(
        "name",
        total_of(lambda e, a: (a - e) * F.log(a / e)).alias("psi"),
        total_of(lambda e, a: a * F.log(a / e)).alias("kl"),
    )


def feature_drift(old: DataFrame, new: DataFrame, cfg: DetectorConfig) -> DataFrame:
    """``(feature, psi, kl)`` for the model inputs."""
    return psi_kl(old, new, FEATURE_COLUMNS, cfg.drift_buckets).withColumnRenamed("name", "feature")


def feature_drift_summary(per_feature: DataFrame, cfg: DetectorConfig, keys: tuple[str, ...] = ()) -> DataFrame:
    mean_psi = F.avg("psi")
    return per_feature.groupBy(*keys).agg(
        mean_psi.alias("aggregate_psi"),
        F.avg("kl").alias("aggregate_kl"),
        F.least(mean_psi / cfg.psi_cap, F.lit(1.0)).alias("feature_norm"),
    )


def score_drift(old: DataFrame, new: DataFrame, cfg: DetectorConfig) -> DataFrame:
    """One row: PSI of the three training scores and its normalised mean."""
    return score_drift_summary(psi_kl(old, new, SCORE_COLUMNS, cfg.drift_buckets), cfg)


def score_drift_summary(psi: DataFrame, cfg: DetectorConfig, keys: tuple[str, ...] = ()) -> DataFrame:

    def of(name: str) -> Column:
        return F.max(F.when(F.col("name") == name, F.col("psi")))

    return psi.groupBy(*keys).agg(
        F.round(of("if_score"), 4).alias("if_psi"),
        F.round(of("lof_score"), 4).alias("lof_psi"),
        F.round(of("fused_score"), 4).alias("fused_psi"),
        F.least(F.avg("psi") / cfg.psi_cap, F.lit(1.0)).alias("score_norm"),
    )


def threshold_drift(pair: DataFrame) -> DataFrame:
    """One row with old and new thresholds -> relative changes."""

    def change(kind: str) -> Column:
        old, new = F.col(f"old_{kind}_threshold"), F.col(f"new_{kind}_threshold")
        return F.abs(new - old) / F.greatest(F.abs(old), F.lit(_EPS))

    fused, catastrophic = change("fused"), change("catastrophic")
    return pair.select(
        "*",
        F.round(fused, 4).alias("fused_rel_change"),
        F.round(catastrophic, 4).alias("catastrophic_rel_change"),
        F.least((fused + catastrophic) / 2.0, F.lit(1.0)).alias("threshold_norm"),
    )


def combine_drift(
    feature: DataFrame, score: DataFrame, threshold: DataFrame, cfg: DetectorConfig, key: str | None = None
) -> DataFrame:
    """One row (for each key) with the drift score and whether a reviewer must approve."""
    if key:
        joined = feature.join(score, key).join(threshold, key)
    else:
        # each input is one row, so an equality on a constant joins them
        one = F.lit(1).alias("one")
        joined = (
            feature.select("*", one)
            .join(score.select("*", one), "one")
            .join(threshold.select("*", one), "one")
            .drop("one")
        )
    total = (
        cfg.weight_feature * F.col("feature_norm")
        + cfg.weight_score * F.col("score_norm")
        + cfg.weight_threshold * F.col("threshold_norm")
    )
    return joined.withColumn("drift_score", F.round(total, 4)).withColumns(
        {
            "requires_approval": F.col("drift_score") > cfg.drift_threshold,
            "approval_threshold": F.lit(cfg.drift_threshold),
        }
    )


def promotion_decision(
    candidates: DataFrame, decisions: DataFrame, mode: str, cfg: DetectorConfig
) -> DataFrame:
    """``promote``, ``reject`` or ``pending`` for each candidate.

    ``candidates``: ``(model_id, has_active, drift_score, requires_approval)``;
    ``decisions``: ``(model_id, status, at)``, the latest one counts, used by mode
    ``table``. Mode ``auto`` promotes everything; ``safe`` rejects extreme drift.
    """
    latest = decisions.groupBy("model_id").agg(
        F.upper(F.max_by("status", "at")).alias("analyst_status")
    )
    joined = candidates.join(latest, "model_id", "left")
    within = ~F.col("has_active") | ~F.col("requires_approval")
    if mode == "auto":
        reviewed = F.lit("promote")
    elif mode == "safe":
        reviewed = F.when(F.col("drift_score") <= cfg.drift_reject_above, "promote").otherwise("reject")
    elif mode == "table":
        reviewed = (
            F.when(F.col("analyst_status") == "APPROVED", "promote")
            .when(F.col("analyst_status") == "REJECTED", "reject")
            .otherwise("pending")
        )
    else:
        raise ValueError(f"unknown promotion mode {mode!r}")
    return joined.withColumn("decision", F.when(within, "promote").otherwise(reviewed))
