"""DuckDB SQL for the registered queries.

Each statement is one WITH chain over shared building blocks, cut down to the
blocks it needs. Doubles are rounded to six digits on both sides.
"""

from __future__ import annotations

import re

from ..config import FEATURE_COLUMNS, DetectorConfig
from ..operators.features import WINDOW_COLUMNS

ALERT_PCT, CATASTROPHIC_PCT, SLICE_HOURS = 0.95, 0.99, 12


def entropy(s: str, ch: str = "ch") -> str:
    share = f"((length({s}) - length(replace({s}, {ch}, ''))) / length({s}))"
    return (
        f"CASE WHEN {s} = '' THEN 0.0 ELSE list_sum(list_transform(list_distinct("
        f"string_split({s}, '')), lambda {ch}: -{share} * log2({share}))) END"
    )


def non_alnum(s: str) -> str:
    return (
        f"CASE WHEN length({s}) < 8 THEN 0.0 ELSE "
        f"length(regexp_replace({s}, '[A-Za-z0-9]', '', 'g')) / length({s}) END"
    )


def transition(s: str) -> str:
    runs = f"regexp_replace(regexp_replace({s}, '[A-Za-z0-9]+', 'a', 'g'), '[^A-Za-z0-9]+', '_', 'g')"
    return f"CASE WHEN length({s}) < 2 THEN 0.0 ELSE (length({runs}) - 1) / (length({s}) - 1) END"


def percents(s: str) -> str:
    return f"(length({s}) - length(replace({s}, '%', '')))"


_PARAM_VALUES = (
    "list_filter(list_transform(string_split(query_dec, '&'), lambda x: CASE WHEN instr(x, '=') > 0 "
    "THEN substring(x, instr(x, '=') + 1) ELSE x END), lambda v: v <> '')"
)
_MEASURES = {
    "qlen": ("q_len", 1.0),
    "entropy": ("token_entropy", 0.5),
    "non_alnum": ("query_non_alnum_ratio", 0.05),
    "transition": ("transition_rate", 0.05),
}


def _baseline_cols() -> str:
    parts = []
    for name, (col, floor) in _MEASURES.items():
        parts.append(f"avg({col}) AS {name}_mean")
        parts.append(f"greatest(stddev_pop({col}), {floor}) AS {name}_std")
    return ", ".join(parts)


def _features(log: str, moments: str, totals: str) -> str:
    def base(name: str, part: str) -> str:
        return f"CASE WHEN m.cnt >= 20 THEN m.{name}_{part} ELSE g.{name}_{part} END"

    def z(name: str) -> str:
        col = _MEASURES[name][0]
        return f"least(abs({col} - base_{name}_mean) / base_{name}_std, 20.0)"

    bases = ", ".join(
        f"{base(n, p)} AS base_{n}_{p}" for n in _MEASURES for p in ("mean", "std")
    )
    return f"""
    SELECT *,
      (length(query_dec) >= 8 AND (non_alnum_z > 3.0 OR transition_z > 3.0)) OR q_len > 200
        OR (length(path_dec) >= 8 AND path_non_alnum_ratio > 0.30) AS is_break,
      path_cnt = 0 AND length(path_dec) >= 8 AS is_rare_path,
      path_rarity < common_cutoff AS is_common_path
    FROM (SELECT *, -log10((path_cnt + 1) / (total + 1)) AS path_rarity,
            {z('non_alnum')} AS non_alnum_z, {z('transition')} AS transition_z,
            {z('qlen')} AS qlen_z, {z('entropy')} AS entropy_z
          FROM (SELECT t.*, coalesce(m.cnt, 0) AS path_cnt, g.total, g.common_cutoff, {bases}
                FROM {log} t LEFT JOIN {moments} m USING (path_norm) CROSS JOIN {totals} g))"""


def _moments(text: str) -> str:
    return f"SELECT path_norm, count(*) AS cnt, {_baseline_cols()} FROM {text} GROUP BY path_norm"


def _totals(text: str, moments: str) -> str:
    return f"""
    SELECT a.total, a.common_cutoff, g.* FROM (
      SELECT any_value(t.total) AS total,
             quantile_cont(-log10((m.cnt + 1) / (t.total + 1)), 0.5) AS common_cutoff
      FROM {moments} m CROSS JOIN (SELECT count(*) AS total FROM {text}) t) a
    CROSS JOIN (SELECT {_baseline_cols()} FROM {text}) g"""


def _windows(features: str) -> str:
    return f"""
    SELECT ip, date_trunc('hour', ts) AS window_ts, count(*) AS n_requests,
      avg(path_non_alnum_ratio) AS path_non_alnum_mean, max(path_non_alnum_ratio) AS path_non_alnum_max,
      avg(query_non_alnum_ratio) AS query_non_alnum_mean, max(query_non_alnum_ratio) AS query_non_alnum_max,
      avg(encoded_ratio) AS encoded_ratio, avg(query_encoded_ratio) AS query_encoded_ratio,
      avg(q_len) AS q_len_mean, max(q_len)::DOUBLE AS q_len_max,
      avg(token_entropy) AS token_entropy_mean, max(token_entropy) AS token_entropy_max,
      max(max_param_entropy) AS max_param_entropy,
      avg(transition_rate) AS transition_rate_mean, max(transition_rate) AS transition_rate_max,
      avg(param_count) AS param_count,
      avg(CASE WHEN status = 500 THEN 1.0 ELSE 0.0 END) AS status_500_ratio,
      avg(CASE WHEN status >= 400 AND status < 500 THEN 1.0 ELSE 0.0 END) AS status_4xx_ratio,
      count(DISTINCT CASE WHEN query <> '' THEN query_shape END) / count(*) AS query_diversity,
      avg(path_rarity) AS path_rarity_mean, max(path_rarity) AS path_rarity_max,
      max(qlen_z) AS qlen_z_max, max(entropy_z) AS entropy_z_max,
      count(*) FILTER (is_break) AS break_count, count(*) FILTER (is_break) / count(*) AS break_ratio,
      count(*) FILTER (is_rare_path) AS rare_path_count,
      count(*) FILTER (is_rare_path) / count(*) AS rare_path_ratio,
      count(*) FILTER (is_common_path) / count(*) AS legit_path_ratio,
      count(*) / 60 AS burst_rate
    FROM {features} GROUP BY ALL HAVING count(*) >= 20"""


def _minmax(raw: str, low: str, high: str) -> str:
    return f"greatest(0.0, least(1.0, 1.0 - ({raw} - {low}) / ({high} - {low} + 1e-9)))"


def _thresholds(rows: str) -> str:
    """Bounds and thresholds of a set of raw-scored windows, and its scores."""
    return f"""
    SELECT *, (1.0 - 0.5 * legit_path_ratio) * 0.5 * (if_score + lof_score) AS fused_score
    FROM (SELECT r.*, {_minmax('if_raw', 'if_low', 'if_high')} AS if_score,
                 {_minmax('lof_raw', 'lof_low', 'lof_high')} AS lof_score
          FROM {rows} r CROSS JOIN (
            SELECT quantile_cont(if_raw, 0.005) AS if_low, quantile_cont(if_raw, 0.995) AS if_high,
                   quantile_cont(lof_raw, 0.005) AS lof_low, quantile_cont(lof_raw, 0.995) AS lof_high
            FROM {rows}) b)"""


def _cuts(scores: str) -> str:
    return (
        f"SELECT quantile_cont(fused_score, {ALERT_PCT}) AS t1, "
        f"quantile_cont(fused_score, {CATASTROPHIC_PCT}) AS t2 FROM {scores}"
    )


def _long(rows: str, cols) -> str:
    names = ", ".join(cols)
    return (
        f"SELECT name, x::DOUBLE AS x FROM (SELECT {', '.join(f'{c}::DOUBLE AS {c}' for c in cols)} "
        f"FROM {rows}) UNPIVOT (x FOR name IN ({names}))"
    )


_DECILES = "[" + ", ".join(str(i / 10) for i in range(11)) + "]"


def _edges(long: str) -> str:
    return (
        f"SELECT name, list_sort(list_distinct(quantile_cont(x, {_DECILES}))) AS edges "
        f"FROM {long} GROUP BY name"
    )


def _hist(long: str, edges: str) -> str:
    return f"""
    SELECT l.name, least(len(list_filter(e.edges, lambda v: v <= l.x)), len(e.edges) - 1) AS bin,
           count(*) AS cnt
    FROM {long} l JOIN {edges} e ON l.name = e.name
    WHERE len(e.edges) >= 2 AND l.x >= e.edges[1] AND l.x <= e.edges[-1] GROUP BY ALL"""


def _bins(old: str, new: str, edges: str) -> str:
    return f"""
    SELECT s.name, s.bin, coalesce(o.cnt, 0) AS old, coalesce(n.cnt, 0) AS new
    FROM (SELECT name, unnest(range(1, len(edges))) AS bin FROM {edges} WHERE len(edges) >= 3) s
    LEFT JOIN {old} o ON o.name = s.name AND o.bin = s.bin
    LEFT JOIN {new} n ON n.name = s.name AND n.bin = s.bin"""


def _psi(bins: str, edges: str) -> str:
    return f"""
    SELECT e.name, coalesce(m.psi, 0.0) AS psi, coalesce(m.kl, 0.0) AS kl
    FROM {edges} e LEFT JOIN (
      SELECT name, sum((a - e) * ln(a / e)) AS psi, sum(a * ln(a / e)) AS kl
      FROM (SELECT name, CASE WHEN old = 0 THEN 1e-9 ELSE old / so END AS e,
                   CASE WHEN new = 0 THEN 1e-9 ELSE new / sn END AS a
            FROM (SELECT *, greatest(sum(old) OVER (PARTITION BY name), 1) AS so,
                         greatest(sum(new) OVER (PARTITION BY name), 1) AS sn FROM {bins}))
      GROUP BY name) m ON m.name = e.name"""


_SCALED = ", ".join(f"round((r.{c} - s.m_{c}) / s.s_{c}, 9) AS {c}" for c in FEATURE_COLUMNS)
_SCALER = ", ".join(
    f"avg({c}) AS m_{c}, CASE WHEN stddev_pop({c}) = 0 THEN 1.0 ELSE stddev_pop({c}) END AS s_{c}"
    for c in FEATURE_COLUMNS
)
_DISTANCE = "round(sqrt(" + " + ".join(
    f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in FEATURE_COLUMNS
) + "), 9)"

_TREES, _SAMPLE, _PRIME = 200, 256, 2147483647
_LEVELS = 8  # of trees over at most _SAMPLE rows
_SEED = DetectorConfig().seed


def _hex(digest: str, start: int, count: int) -> str:
    return f"('0x' || substr({digest}, {start}, {count}))::BIGINT"


def _split(level: int) -> str:
    """The nodes of one level: what each splits by, or feature -1."""
    def each(kind):
        return ", ".join(f"{kind}(x[{i + 1}])" for i in range(len(FEATURE_COLUMNS)))

    return f"""
    SELECT tree, node, size, CASE WHEN feature IS NULL THEN -1 ELSE feature END AS feature,
      CASE WHEN feature IS NULL THEN 0.0 WHEN place >= high THEN low ELSE place END AS threshold
    FROM (SELECT tree, node, size, feature, lows[feature + 1] AS low, highs[feature + 1] AS high,
            lows[feature + 1] + (highs[feature + 1] - lows[feature + 1])
              * ({_hex('digest', 8, 13)}::DOUBLE / 4503599627370496.0) AS place
          FROM (SELECT *, CASE WHEN len(usable) > 0 AND {level} < max_depth
                    THEN usable[{_hex('digest', 1, 7)} % len(usable) + 1] END AS feature
                FROM (SELECT *, md5('{_SEED}:' || tree || ':' || node) AS digest,
                        list_filter(range(0, {len(FEATURE_COLUMNS)}), lambda i: highs[i + 1] > lows[i + 1]) AS usable
                      FROM (SELECT tree, node, count(*) AS size, [{each('min')}] AS lows, [{each('max')}] AS highs
                            FROM forest_{level} GROUP BY tree, node)
                      CROSS JOIN forest_size)))"""


def _average_path(size: str) -> str:
    return (
        f"CASE WHEN {size} <= 1 THEN 0.0 WHEN {size} = 2 THEN 1.0 ELSE "
        f"2.0 * (ln({size} - 1.0) + 0.5772156649015329) - 2.0 * ({size} - 1.0) / {size} END"
    )


def _forest() -> dict[str, str]:
    """Trees grown and walked level by level, from the digits of MD5 sums."""
    blocks = {
        "forest_rows": f"""
    SELECT row_key, [{', '.join(FEATURE_COLUMNS)}]::DOUBLE[] AS x, {_hex('md5(row_key)', 1, 15)} % {_PRIME} AS number
    FROM scaled""",
        "forest_size": f"""
    SELECT least(count(*), {_SAMPLE}) AS sample, ceil(log2(greatest(least(count(*), {_SAMPLE}), 2))) AS max_depth
    FROM forest_rows""",
        "forest_factors": f"""
    SELECT tree, 1 + {_hex('digest', 1, 15)} % {_PRIME - 1} AS a, {_hex('digest', 16, 15)} % {_PRIME} AS b
    FROM (SELECT tree, md5('{_SEED}:' || tree) AS digest FROM range({_TREES}) t(tree))""",
        "forest_0": f"""
    SELECT tree, row_key, x, 1::BIGINT AS node FROM forest_rows CROSS JOIN forest_factors
    QUALIFY row_number() OVER (PARTITION BY tree ORDER BY (number * a + b) % {_PRIME}, row_key) <= {_SAMPLE}""",
    }
    for level in range(_LEVELS + 1):
        blocks[f"split_{level}"] = _split(level)
        if level < _LEVELS:
            blocks[f"forest_{level + 1}"] = f"""
    SELECT r.tree, r.row_key, r.x, 2 * r.node + CASE WHEN r.x[s.feature + 1] <= s.threshold THEN 0 ELSE 1 END AS node
    FROM forest_{level} r JOIN split_{level} s ON r.tree = s.tree AND r.node = s.node WHERE s.feature >= 0"""
    blocks["forest"] = " UNION ALL ".join(
        f"SELECT *, {level} AS depth FROM split_{level}" for level in range(_LEVELS + 1)
    )
    blocks["walk_0"] = "SELECT row_key, x, tree, 1::BIGINT AS node FROM forest_rows CROSS JOIN forest_factors"
    for level in range(_LEVELS):
        blocks[f"walk_{level + 1}"] = f"""
    SELECT w.row_key, w.x, w.tree, CASE WHEN n.feature < 0 THEN w.node
             ELSE 2 * w.node + CASE WHEN w.x[n.feature + 1] <= n.threshold THEN 0 ELSE 1 END END AS node
    FROM walk_{level} w JOIN forest n ON w.tree = n.tree AND w.node = n.node"""
    blocks["if_raws"] = f"""
    SELECT row_key, 0.5 - pow(2.0, -avg(depth + {_average_path('size')}) / any_value({_average_path('sample')})) AS if_raw
    FROM walk_{_LEVELS} w JOIN forest n ON w.tree = n.tree AND w.node = n.node CROSS JOIN forest_size GROUP BY row_key"""
    return blocks


def _density_sql(side: str) -> str:
    return (
        f"ln({side}_mass / total) - 0.5 * (ln(2.0 * pi() * {side}_variance)"
        f" + (x - {side}_mean) * (x - {side}_mean) / {side}_variance)"
    )


def _component_sql(side: str, mass: str, sx: str, sxx: str) -> str:
    return (
        f"{mass} + 1e-15 AS {side}_mass, {sx} / ({mass} + 1e-15) AS {side}_mean, greatest({sxx} / ({mass} + 1e-15)"
        f" - ({sx} / ({mass} + 1e-15)) * ({sx} / ({mass} + 1e-15)), 0.0) + 1e-6 AS {side}_variance"
    )


_NORM = "greatest(low, high) + ln(1.0 + exp(-abs(low - high)))"
_MIXED = ", ".join(f"{side}_{part}" for side in ("low", "high") for part in ("mass", "mean", "variance"))


def _mixture(name: str, scores: str) -> dict[str, str]:
    """Expectation-maximisation over the histogram of ``scores``: a row of state for each round."""
    held = ", ".join(f"CASE WHEN stop THEN o_{c} ELSE {c} END AS {c}" for c in _MIXED.split(", "))
    return {
        f"{name}_hist": f"""
    SELECT fused_score AS x, count(*)::DOUBLE AS w FROM {scores} GROUP BY fused_score""",
        f"{name}_all": f"""
    SELECT sum(w) AS total, sum(w) < 4 OR sqrt(sum(w * (x - mean) * (x - mean)) / sum(w)) < 1e-9 AS flat
    FROM {name}_hist CROSS JOIN (SELECT sum(w * x) / sum(w) AS mean FROM {name}_hist)""",
        f"{name}_sums": f"""
    SELECT x, sum(w) OVER u AS lm, sum(w * x) OVER u AS lx, sum(w * x * x) OVER u AS lxx,
      sum(w) OVER () - sum(w) OVER u AS hm, sum(w * x) OVER () - sum(w * x) OVER u AS hx,
      sum(w * x * x) OVER () - sum(w * x * x) OVER u AS hxx
    FROM {name}_hist WINDOW u AS (ORDER BY x ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
        f"{name}_em": f"""
    SELECT 0 AS i, {_component_sql('low', 'lm', 'lx', 'lxx')}, {_component_sql('high', 'hm', 'hx', 'hxx')},
      '-Infinity'::DOUBLE AS bound, false AS stop
    FROM (SELECT * FROM {name}_sums WHERE hm > 0 ORDER BY lxx - lx * lx / lm + hxx - hx * hx / hm, x LIMIT 1)
    UNION ALL
    SELECT i + 1, {held}, bound, stop FROM (
      SELECT i, {', '.join(f'o_{c}' for c in _MIXED.split(', '))}, b AS bound, abs(b - old) < 1e-3 OR i >= 99 AS stop,
        {_component_sql('low', 'lm', 'lx', 'lxx')}, {_component_sql('high', 'hm', 'hx', 'hxx')}
      FROM (
        SELECT i, {', '.join(f'any_value({c}) AS o_{c}' for c in _MIXED.split(', '))}, any_value(bound) AS old,
          sum(w * norm) / any_value(total) AS b,
          sum(w * exp(low - norm)) AS lm, sum(w * exp(low - norm) * x) AS lx, sum(w * exp(low - norm) * x * x) AS lxx,
          sum(w * exp(high - norm)) AS hm, sum(w * exp(high - norm) * x) AS hx, sum(w * exp(high - norm) * x * x) AS hxx
        FROM (SELECT *, {_NORM} AS norm FROM (
          SELECT e.*, x, w, total, {_density_sql('low')} AS low, {_density_sql('high')} AS high
          FROM {name}_em e CROSS JOIN {name}_hist CROSS JOIN {name}_all WHERE NOT stop))
        GROUP BY i))""",
        f"{name}": f"""
    SELECT x AS fused_score, CASE WHEN flat OR i IS NULL THEN 0.0 ELSE
      round(exp(CASE WHEN high_mean > low_mean THEN high ELSE low END - ({_NORM})), 4) END AS anomaly_prob
    FROM (SELECT h.x, total, flat, e.*, {_density_sql('low')} AS low, {_density_sql('high')} AS high
          FROM {name}_hist h CROSS JOIN {name}_all
          LEFT JOIN (SELECT * FROM {name}_em ORDER BY i DESC LIMIT 1) e ON true)""",
    }


SIGNAL_RULES = (
    ("breaks", "break_count > 0"),
    ("rare_paths", "rare_path_count > 0"),
    ("query_non_alnum", "query_non_alnum_max > 0.15"),
    ("path_non_alnum", "path_non_alnum_max > 0.15"),
    ("query_encoded", "query_encoded_ratio > 0.08"),
    ("query_length", "q_len_max > 200"),
    ("token_entropy", "token_entropy_max > 4.0"),
    ("param_entropy", "max_param_entropy > 4.0"),
    ("transitions", "transition_rate_max > 0.5"),
    ("errors_500", "status_500_ratio > 0.05"),
    ("errors_4xx", "status_4xx_ratio > 0.6"),
    ("diversity", "query_diversity > 0.8"),
    ("path_rarity", "path_rarity_max > p95"),
    ("length_deviation", "qlen_z_max > 3.0"),
    ("entropy_deviation", "entropy_z_max > 3.0"),
    ("burst_rate", "burst_rate > 20"),
)
# Wording of the signals; what is shown is rounded half to even.
_WORDING = (
    ("grammar-breaking URLs in window: %d of %d (%.0f%%)", "break_count, n_requests, round_even(break_ratio * 100.0, 0)"),
    ("never-before-seen paths in window: %d of %d", "rare_path_count, n_requests"),
    ("query non-alphanumeric char ratio (max): %.3f", "round_even(query_non_alnum_max, 3)"),
    ("path non-alphanumeric char ratio (max): %.3f", "round_even(path_non_alnum_max, 3)"),
    ("query pct-encoded char ratio: %.3f", "round_even(query_encoded_ratio, 3)"),
    ("max query length: %.0f chars", "round_even(q_len_max, 0)"),
    ("query token entropy (max): %.2f", "round_even(token_entropy_max, 2)"),
    ("single-parameter entropy (max): %.2f", "round_even(max_param_entropy, 2)"),
    ("char-class transition rate (max): %.2f (syntax-like structure)", "round_even(transition_rate_max, 2)"),
    ("500-error ratio: %.2f (possible landed payload)", "round_even(status_500_ratio, 2)"),
    ("4xx-error ratio: %.2f", "round_even(status_4xx_ratio, 2)"),
    ("query diversity: %.2f (many unique payload shapes)", "round_even(query_diversity, 2)"),
    ("path rarity (max): %.2f (rare vs. training traffic)", "round_even(path_rarity_max, 2)"),
    ("query length deviation for this path: %.1f std devs from this path''s norm", "round_even(qlen_z_max, 1)"),
    ("query entropy deviation for this path: %.1f std devs from this path''s norm", "round_even(entropy_z_max, 1)"),
    ("burst rate: %.1f req/min", "round_even(burst_rate, 1)"),
)
_TEXTS = "concat_ws('; ', " + ", ".join(
    f"CASE WHEN {rule} THEN printf('{text}', {values}) END"
    for (_, rule), (text, values) in zip(SIGNAL_RULES, _WORDING, strict=True)
) + ")"
_CODES = "concat_ws(',', " + ", ".join(
    f"CASE WHEN {rule} THEN '{code}' END" for code, rule in SIGNAL_RULES
) + ")"

_LOG = """
    SELECT e.event_id,
      TIMESTAMP '2024-01-01 00:00:00' + to_seconds(12 * e.event_id) AS ts,
      '10.0.0.' || CAST(e.user_id % 8 AS VARCHAR) AS ip,
      regexp_extract(p.url, '^[a-z]+://[^/]+([^?#]*)', 1) AS path,
      CASE WHEN e.user_id % 8 = 3 AND e.event_id % 4 <> 0 AND (e.event_id // 300) % 2 = 1
           THEN 'id=' || CAST(e.event_id AS VARCHAR) || repeat('%27%20OR%201%3D1--', 12)
           ELSE regexp_extract(p.url, '[?]([^#]*)', 1) END AS query,
      CASE e.event_type WHEN 'error' THEN 500 WHEN 'signup' THEN 404 ELSE 200 END AS status
    FROM (SELECT *, event_id % (SELECT count(*) FROM pages) AS pid FROM events) e
    JOIN pages p ON p.page_id = e.pid"""

_WINDOW_PLAIN = ("ip", "window_ts", "n_requests", "break_count", "rare_path_count")
_NINE = [c if c in _WINDOW_PLAIN else f"round({c}, 9) AS {c}" for c in WINDOW_COLUMNS]

_MIDDLE = "t0 + to_seconds(floor(epoch(t1 - t0) / 2)::BIGINT)"

BLOCKS: dict[str, str] = {
    "log": _LOG,
    "dec": "SELECT *, url_decode(path) AS path_dec, url_decode(query) AS query_dec FROM log",
    "txt": f"""
    SELECT *, regexp_replace(path, '\\d+', '#', 'g') AS path_norm,
      array_to_string(list_transform(string_split(query, '&'), lambda x:
        CASE WHEN regexp_full_match(x, '[^=]*=\\d+') THEN regexp_replace(x, '=\\d+$', '=#') ELSE x END), '&')
        AS query_shape,
      CASE WHEN query = '' THEN path ELSE path || '?' || query END AS url,
      {non_alnum('path_dec')} AS path_non_alnum_ratio, {non_alnum('query_dec')} AS query_non_alnum_ratio,
      {percents("(CASE WHEN query = '' THEN path ELSE path || '?' || query END)")}
        / greatest(length(CASE WHEN query = '' THEN path ELSE path || '?' || query END), 1) AS encoded_ratio,
      {percents('query')} / greatest(length(query), 1) AS query_encoded_ratio,
      length(query)::INTEGER AS q_len,
      (CASE WHEN query = '' THEN 0 ELSE len(string_split(query, '&')) END)::INTEGER AS param_count,
      {entropy('query_dec')} AS token_entropy,
      coalesce(list_max(list_transform({_PARAM_VALUES}, lambda w: {entropy('w')})), 0.0) AS max_param_entropy,
      {transition('query_dec')} AS transition_rate
    FROM dec""",
    "origin": "SELECT min(ts) AS t0, max(ts) AS t1 FROM log",
    "moments": _moments("txt"),
    "totals": _totals("txt", "moments"),
    "features": _features("txt", "moments", "totals"),
    "windows": _windows("features"),
    # the first 12 hours as the training slice
    "txt_first": f"SELECT txt.* FROM txt, origin WHERE ts < t0 + INTERVAL {SLICE_HOURS} HOUR",
    "moments_first": _moments("txt_first"),
    "totals_first": _totals("txt_first", "moments_first"),
    "features_first": _features("txt", "moments_first", "totals_first"),
    # nine digits: engines sum in different orders, and drift bins compare for equality
    "nine": "SELECT " + ", ".join(_NINE) + " FROM windows",
    "raw": """
    SELECT *,
      round(0.2 - 0.3 * query_encoded_ratio - 0.2 * break_ratio - 0.1 * status_500_ratio
            - 0.05 * path_rarity_max, 6) AS if_raw,
      round(-1.0 - 0.1 * entropy_z_max - 0.05 * qlen_z_max - 0.5 * status_4xx_ratio, 6) AS lof_raw
    FROM nine""",
    "trained": _thresholds("raw"),
    "cuts": _cuts("trained"),
    "p95": "SELECT quantile_cont(path_rarity_max, 0.95) AS p95 FROM windows",
    "scored": """
    SELECT * REPLACE (round(if_score, 4) AS if_score, round(lof_score, 4) AS lof_score,
                      round(fused_score, 4) AS fused_score) FROM trained""",
    "gated": """
    SELECT *, burst OR catastrophic AS anomaly_flag,
      CASE WHEN catastrophic AND NOT burst THEN 'catastrophic' ELSE 'burst' END AS alert_kind,
      round((fused_score - t1) / greatest(t2 - t1, 1e-9), 4) AS relative_score
    FROM (SELECT s.*, c.t1, c.t2,
            fused_score >= t1 AND break_count >= 25 AND break_ratio >= 0.05 AS burst,
            fused_score >= t2 AND status_500_ratio > 0 AS catastrophic
          FROM scored s CROSS JOIN cuts c)""",
    "flagged": "SELECT * FROM gated WHERE anomaly_flag",
    "alerts": """
    SELECT f.*, CASE WHEN fused_score >= s66 THEN 'HIGH' WHEN fused_score >= s33 THEN 'MEDIUM'
                     ELSE 'LOW' END AS severity
    FROM flagged f CROSS JOIN (SELECT quantile_cont(fused_score, 0.33) AS s33,
                                      quantile_cont(fused_score, 0.66) AS s66 FROM flagged) q""",
    "signals": f"""
    SELECT a.*, CASE WHEN {_CODES} = '' THEN 'general' ELSE {_CODES} END AS signal_codes,
      CASE WHEN {_CODES} = '' THEN 'general statistical URL anomaly — no single dominant signal' ELSE {_TEXTS} END AS signal_texts
    FROM alerts a CROSS JOIN p95""",
    "evidence": """
    SELECT t.event_id, t.ip, a.window_ts, t.ts, t.url,
      t.query_non_alnum_ratio * 20.0 + t.path_non_alnum_ratio * 10.0 + t.transition_rate * 15.0
      + (length(t.query || t.path) - length(replace(t.query || t.path, '%', ''))) * 0.5
      + CASE WHEN length(t.query_dec) > 200 THEN 5.0 ELSE 0.0 END AS url_score
    FROM txt t JOIN alerts a ON a.ip = t.ip AND a.window_ts = date_trunc('hour', t.ts)""",
    "urls": """
    SELECT ip, window_ts, url, url_score, first_ts,
      row_number() OVER (PARTITION BY ip, window_ts ORDER BY url_score DESC, first_ts, url) AS url_rank
    FROM (SELECT ip, window_ts, url, max(url_score) AS url_score,
                 arg_min(ts, (-url_score, ts)) AS first_ts
          FROM evidence GROUP BY ALL)""",
    "old_rows": f"SELECT raw.* FROM raw, origin WHERE window_ts < {_MIDDLE}",
    "new_rows": f"SELECT raw.* FROM raw, origin WHERE window_ts >= {_MIDDLE}",
    "old_trained": _thresholds("old_rows"),
    "new_trained": _thresholds("new_rows"),
    "old_cuts": _cuts("old_trained"),
    "new_cuts": _cuts("new_trained"),
    "f_old": _long("old_rows", FEATURE_COLUMNS),
    "f_new": _long("new_rows", FEATURE_COLUMNS),
    "f_edges": _edges("f_old"),
    "f_hist_old": _hist("f_old", "f_edges"),
    "f_hist_new": _hist("f_new", "f_edges"),
    "f_bins": _bins("f_hist_old", "f_hist_new", "f_edges"),
    "f_psi": _psi("f_bins", "f_edges"),
    "s_old": _long("old_trained", ("if_score", "lof_score", "fused_score")),
    "s_new": _long("new_trained", ("if_score", "lof_score", "fused_score")),
    "s_edges": _edges("s_old"),
    "s_hist_old": _hist("s_old", "s_edges"),
    "s_hist_new": _hist("s_new", "s_edges"),
    "s_bins": _bins("s_hist_old", "s_hist_new", "s_edges"),
    "s_psi": _psi("s_bins", "s_edges"),
    "feature_drift": """
    SELECT avg(psi) AS aggregate_psi, avg(kl) AS aggregate_kl, least(avg(psi) / 0.5, 1.0) AS feature_norm
    FROM f_psi""",
    "score_drift": """
    SELECT round(max(psi) FILTER (name = 'if_score'), 4) AS if_psi,
           round(max(psi) FILTER (name = 'lof_score'), 4) AS lof_psi,
           round(max(psi) FILTER (name = 'fused_score'), 4) AS fused_psi,
           least(avg(psi) / 0.5, 1.0) AS score_norm FROM s_psi""",
    "threshold_drift": """
    SELECT round(f, 4) AS fused_rel_change, round(c, 4) AS catastrophic_rel_change,
           least((f + c) / 2.0, 1.0) AS threshold_norm
    FROM (SELECT abs(n.t1 - o.t1) / greatest(abs(o.t1), 1e-9) AS f,
                 abs(n.t2 - o.t2) / greatest(abs(o.t2), 1e-9) AS c
          FROM old_cuts o CROSS JOIN new_cuts n)""",
    "keyed": """
    SELECT ip || '|' || strftime(window_ts, '%Y-%m-%d %H:%M:%S') AS row_key, * FROM windows""",
    "scaled": f"SELECT r.row_key, {_SCALED} FROM keyed r CROSS JOIN (SELECT {_SCALER} FROM windows) s",
    "pairs": f"SELECT a.row_key AS qid, b.row_key AS rid, {_DISTANCE} AS d FROM scaled a CROSS JOIN scaled b",
    "knn": """
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY d, rid) AS rn
                   FROM pairs WHERE qid <> rid) WHERE rn <= 20""",
    "k_dist": "SELECT qid AS rid, max(d) AS k_dist FROM knn GROUP BY qid",
    "density": """
    SELECT n.qid AS rid, 1.0 / (avg(greatest(k.k_dist, n.d)) + 1e-10) AS lrd
    FROM knn n JOIN k_dist k USING (rid) GROUP BY n.qid""",
    "knn_self": """
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY d, rid) AS rn
                   FROM pairs) WHERE rn <= 20""",
    "lof": """
    SELECT n.qid AS row_key,
           -avg(l.lrd) / (1.0 / (avg(greatest(k.k_dist, n.d)) + 1e-10)) AS lof_raw
    FROM knn_self n JOIN k_dist k USING (rid) JOIN density l USING (rid) GROUP BY n.qid""",
    "recent_features": "SELECT features.* FROM features, origin WHERE ts >= t1 - INTERVAL 4 HOUR",
    "recent_windows": _windows("recent_features"),
    "slices": f"""
    SELECT floor(epoch(ts - t0) / {SLICE_HOURS * 3600})::INTEGER AS slice, count(*) AS n
    FROM log, origin GROUP BY ALL""",
    "slice_windows": f"""
    SELECT slice, count(*) AS n_windows FROM (
      SELECT floor(epoch(ts - t0) / {SLICE_HOURS * 3600})::INTEGER AS slice, ip, date_trunc('hour', ts) AS w
      FROM log, origin GROUP BY ALL HAVING count(*) >= 20) GROUP BY slice""",
    "complete": f"""
    SELECT slice, n FROM slices, origin
    WHERE t0 + (slice + 1) * INTERVAL {SLICE_HOURS} HOUR <= t1""",
    # two-hour slices as stand-ins for models, their reviews and their history
    "model_slices": """
    SELECT floor(epoch(ts - t0) / 7200)::INTEGER AS slice, count(*) AS n, min(ts) AS first_ts,
           count(*) FILTER (status = 500) AS errors, count(*) FILTER (status = 404) AS misses
    FROM log, origin GROUP BY ALL""",
    "candidates": """
    SELECT 'model_' || slice AS model_id, slice > 0 AS has_active, drift_score,
           drift_score > 0.59 AS requires_approval, first_ts, misses
    FROM (SELECT *, round(least(errors * 3.5 / n, 1.0), 4) AS drift_score FROM model_slices)""",
    "decisions": """
    SELECT model_id, CASE WHEN misses % 2 = 0 THEN 'APPROVED' ELSE 'REJECTED' END AS status
    FROM candidates WHERE misses % 3 <> 0""",
    "reviewed": "SELECT c.*, d.status AS analyst_status FROM candidates c LEFT JOIN decisions d USING (model_id)",
    "history": """
    SELECT slice * 2 + 1 AS seq, 'model_' || slice AS model_id, 'candidate' AS event, first_ts AS "at",
           n, errors, misses FROM model_slices
    UNION ALL
    SELECT slice * 2 + 2, 'model_' || slice,
           CASE misses % 3 WHEN 0 THEN 'approved' WHEN 1 THEN 'rejected' ELSE 'skipped_review' END,
           first_ts + INTERVAL 1 HOUR, n, errors, misses FROM model_slices""",
}


BLOCKS |= _forest()
# the model's own scores in place of the plain ones
BLOCKS["real_raw"] = "SELECT k.*, i.if_raw, l.lof_raw FROM keyed k JOIN if_raws i USING (row_key) JOIN lof l USING (row_key)"
BLOCKS["real_trained"] = _thresholds("real_raw")
BLOCKS["real_cuts"] = _cuts("real_trained")
_SCORED = ("scored", "gated", "flagged", "alerts", "signals", "evidence", "urls")
BLOCKS |= {
    f"real_{block}": re.sub(rf"\b(trained|cuts|{'|'.join(_SCORED)})\b", r"real_\1", BLOCKS[block]) for block in _SCORED
}
BLOCKS |= _mixture("mixture", "gated") | _mixture("real_mixture", "real_gated")


def _needs(text: str) -> list[str]:
    words = set(re.findall(r"[a-z_0-9]+", text))
    return [b for b in BLOCKS if b in words]


def chain(select: str) -> str:
    """The SELECT with exactly the building blocks it reads, in order."""
    wanted, todo = set(), _needs(select)
    while todo:
        block = todo.pop()
        if block not in wanted:
            wanted.add(block)
            todo += [b for b in _needs(BLOCKS[block]) if b != block]
    ctes = [f"{name} AS ({BLOCKS[name].strip()})" for name in BLOCKS if name in wanted]
    recursive = "RECURSIVE " if any(name.endswith("_em") for name in wanted) else ""
    return f"WITH {recursive}{', '.join(ctes)} {select}" if ctes else select


def rounded(columns, plain=()) -> str:
    return ", ".join([*plain, *[f"round({c}, 6) AS {c}" for c in columns]])


_WINDOW_DOUBLES = tuple(c for c in WINDOW_COLUMNS if c not in _WINDOW_PLAIN)
WINDOW_SELECT = rounded(_WINDOW_DOUBLES, _WINDOW_PLAIN)
_STATS = tuple(f"{m}_{p}" for m in _MEASURES for p in ("mean", "std"))
_FEATURES = (
    "path_non_alnum_ratio", "query_non_alnum_ratio", "encoded_ratio", "query_encoded_ratio",
    "token_entropy", "max_param_entropy", "transition_rate", "path_rarity", "qlen_z", "entropy_z",
)
_SCORES = ("if_score", "lof_score", "fused_score")
_CONTEXT = (
    "alert_kind, severity, ip, window_ts AS window_start_utc, n_requests, if_score, lof_score, "
    "fused_score, relative_score, signal_codes"
)
_REQUEST = "ts, ip, path, query, status"


def _decide(reviewed: str) -> str:
    return (
        "SELECT model_id, drift_score, CASE WHEN NOT has_active OR NOT requires_approval "
        f"THEN 'promote' ELSE {reviewed} END AS decision FROM reviewed"
    )


_CLOSED_ALERTS = """
    SELECT alert_kind, ip, window_ts AS window_start_utc, n_requests, fused_score, relative_score, url
    FROM real_flagged JOIN real_urls USING (ip, window_ts) CROSS JOIN origin
    WHERE window_ts + INTERVAL 1 HOUR <= origin.t1 - INTERVAL 10 MINUTE"""

SELECTS: dict[str, str] = {
    "s1_ndjson_scan": f"SELECT {_REQUEST} FROM log WHERE status <> 404",
    "s1_whole_lines": """
        SELECT event_id, event_id % 5 NOT IN (1, 3) AS good,
               CASE WHEN event_id % 5 NOT IN (1, 3) THEN status END AS status FROM log""",
    "s2_json_array_scan": f"SELECT {_REQUEST} FROM log",
    "s3_layout_detection": """
        SELECT CASE WHEN chunk % 2 = 0 THEN 'array' ELSE 'ndjson' END AS layout, count(*) AS files
        FROM (SELECT DISTINCT event_id // 500 AS chunk FROM log) GROUP BY ALL""",
    "s3_mixed_layout_scan": f"SELECT {_REQUEST} FROM log",
    "s4_event_flattening": """
        SELECT ts, ip, 'GET' AS method, path, query,
               CASE WHEN status = 200 THEN 0 ELSE status END AS status, 0::BIGINT AS bytes,
               '' AS ua, '' AS referrer FROM log""",
    "s5_bad_record_split": """
        SELECT CASE WHEN status = 404 THEN 'bad' ELSE 'good' END AS kind, count(*) AS n
        FROM log GROUP BY ALL""",
    "s6_directory_batches": f"SELECT {_REQUEST} FROM log",
    "s7_watched_directory": f"SELECT {_REQUEST} FROM log",
    "s8_appended_file": f"SELECT {_REQUEST} FROM log",
    "s9_alert_sink": "SELECT alert_kind, severity, a.ip, n_requests, fused_score, url FROM alerts a JOIN urls u ON a.ip = u.ip AND a.window_ts = u.window_ts",
    "s10_alert_append": "SELECT alert_kind, severity, a.ip, n_requests, fused_score, url FROM alerts a JOIN urls u ON a.ip = u.ip AND a.window_ts = u.window_ts",
    "s11_model_tables": "SELECT path_norm, cnt FROM moments",
    "p1_path_template": "SELECT event_id, path_norm FROM txt",
    "p2_query_template": "SELECT event_id, query_shape FROM txt",
    "p3_percent_decode": "SELECT event_id, path_dec, query_dec FROM dec",
    "p4_entropy": "SELECT event_id, round(token_entropy, 6) AS token_entropy FROM txt",
    "p5_non_alnum_ratio": """
        SELECT event_id, round(CASE WHEN query_dec = '' THEN 0.0 ELSE
          length(regexp_replace(query_dec, '[A-Za-z0-9]', '', 'g')) / length(query_dec) END, 6) AS ratio
        FROM dec""",
    "p6_transition_rate": "SELECT event_id, round(transition_rate, 6) AS transition_rate FROM txt",
    "p7_max_param_entropy": "SELECT event_id, round(max_param_entropy, 6) AS max_param_entropy FROM txt",
    "p8_full_url": "SELECT event_id, url FROM txt",
    "p9_percent_share": "SELECT event_id, round(encoded_ratio, 6) AS encoded_ratio, round(query_encoded_ratio, 6) AS query_encoded_ratio FROM txt",
    "p10_query_size": "SELECT event_id, q_len, param_count FROM txt",
    "p11_gated_ratios": "SELECT event_id, round(path_non_alnum_ratio, 6) AS path_non_alnum_ratio, round(query_non_alnum_ratio, 6) AS query_non_alnum_ratio FROM txt",
    "p12_path_rarity": "SELECT event_id, round(path_rarity, 6) AS path_rarity FROM features_first",
    "p13_structure_z": "SELECT event_id, round(non_alnum_z, 6) AS non_alnum_z, round(transition_z, 6) AS transition_z FROM features_first",
    "p14_query_deviation": "SELECT event_id, round(qlen_z, 6) AS qlen_z, round(entropy_z, 6) AS entropy_z FROM features_first",
    "p15_grammar_break": "SELECT event_id, is_break FROM features",
    "p16_unseen_path": "SELECT event_id, is_rare_path FROM features_first",
    "p17_request_features": f"SELECT {rounded(_FEATURES, ('event_id', 'q_len', 'param_count', 'is_break', 'is_rare_path'))} FROM features",
    "p18_minmax_score": "SELECT ip, window_ts, round(if_score, 6) AS if_score, round(lof_score, 6) AS lof_score FROM trained",
    "p19_score_fusion": "SELECT ip, window_ts, round(fused_score, 6) AS fused_score FROM trained",
    "p20_relative_score": "SELECT ip, window_ts, relative_score FROM gated",
    "p21_url_suspicion": """
        SELECT event_id, round(query_non_alnum_ratio * 20.0 + path_non_alnum_ratio * 10.0 + transition_rate * 15.0
          + (length(query || path) - length(replace(query || path, '%', ''))) * 0.5
          + CASE WHEN length(query_dec) > 200 THEN 5.0 ELSE 0.0 END, 6) AS url_score FROM txt""",
    "p22_display_url": "SELECT event_id, CASE WHEN length(url) > 100 THEN url[1:97] || '...' ELSE url END AS shown FROM txt",
    "f1_eligible_windows": "SELECT ip, window_ts, n_requests FROM windows",
    "f2_flagged_windows": "SELECT ip, window_ts, alert_kind FROM flagged",
    "f3_high_only": "SELECT ip, window_ts, severity FROM alerts WHERE severity = 'HIGH'",
    "f4_landed_error_only": "SELECT ip, window_ts, round(status_500_ratio, 6) AS status_500_ratio FROM alerts WHERE status_500_ratio > 0",
    "f5_min_relative_score": "SELECT ip, window_ts, relative_score FROM alerts WHERE relative_score >= 0.5",
    "f6_time_range": "SELECT event_id, ts FROM log WHERE ts >= TIMESTAMP '2024-01-01 06:00:00' AND ts < TIMESTAMP '2024-01-01 18:00:00'",
    "f7_retention": f"SELECT event_id, ts FROM log, origin WHERE ts >= t1 - INTERVAL {SLICE_HOURS} HOUR",
    "f8_sampled_paths": "SELECT path_norm, cnt AS n FROM moments WHERE cnt >= 20",
    "f9_training_size": "SELECT slice, n_windows, n_windows >= 10 AS trainable FROM slice_windows",
    "j1_path_popularity_join": "SELECT event_id, path_cnt FROM features_first",
    "j2_path_baseline_join": "SELECT event_id, " + ", ".join(f"round(base_{c}, 6) AS base_{c}" for c in _STATS) + " FROM features_first",
    "j3_model_scalars": "SELECT ip, window_ts, round(t1, 6) AS fused_threshold, round(t2, 6) AS catastrophic_threshold, round(p95, 6) AS rarity_p95 FROM windows CROSS JOIN cuts CROSS JOIN p95",
    "j4_nearest_neighbours": "SELECT qid, rid, round(d, 6) AS distance FROM knn",
    "j5_histogram_join": "SELECT name, bin::INTEGER AS bin, old, new FROM f_bins",
    "j6_analyst_decisions": "SELECT model_id, drift_score, analyst_status FROM reviewed",
    "a1_path_popularity": "SELECT path_norm, cnt FROM moments",
    "a2_common_path_cutoff": "SELECT total, round(common_cutoff, 6) AS common_cutoff FROM totals",
    "a3_path_baseline": f"SELECT {rounded(_STATS, ('path_norm', 'cnt AS n'))} FROM moments WHERE cnt >= 20",
    "a4_global_baseline": f"SELECT {rounded(_STATS)} FROM totals",
    "a5_entity_windows": f"SELECT {WINDOW_SELECT} FROM windows",
    "a6_query_shapes": "SELECT ip, date_trunc('hour', ts) AS window_ts, count(DISTINCT CASE WHEN query <> '' THEN query_shape END) AS shapes FROM txt GROUP BY ALL",
    "a7_conditional_ratios": "SELECT " + rounded(("status_500_ratio", "status_4xx_ratio", "break_ratio", "rare_path_ratio", "legit_path_ratio"), ("ip", "window_ts")) + " FROM windows",
    "a8_window_requests": "SELECT event_id, ip, window_ts, url FROM evidence",
    "a9_score_bounds": "SELECT round(quantile_cont(if_raw, 0.005), 6) AS if_low, round(quantile_cont(if_raw, 0.995), 6) AS if_high, round(quantile_cont(lof_raw, 0.005), 6) AS lof_low, round(quantile_cont(lof_raw, 0.995), 6) AS lof_high FROM raw",
    "a10_thresholds": "SELECT round(t1, 6) AS fused_threshold, round(t2, 6) AS catastrophic_threshold FROM cuts",
    "a11_rarity_p95": "SELECT round(p95, 6) AS rarity_p95 FROM p95",
    "a12_severity_cuts": "SELECT round(quantile_cont(fused_score, 0.33), 6) AS low, round(quantile_cont(fused_score, 0.66), 6) AS high FROM flagged",
    "a13_scaler_stats": "SELECT name AS feature, round(avg(x), 6) AS mean, round(CASE WHEN stddev_pop(x) = 0 THEN 1.0 ELSE stddev_pop(x) END, 6) AS std FROM (" + _long("windows", FEATURE_COLUMNS) + ") GROUP BY name",
    "a14_time_bounds": "SELECT t0 AS first_ts, t1 AS last_ts FROM origin",
    "a15_histogram": "SELECT name, bin::INTEGER AS bin, cnt FROM f_hist_new",
    "a16_decile_edges": "SELECT name, i::INTEGER AS i, round(edges[i], 6) AS edge FROM (SELECT name, edges, unnest(range(1, len(edges) + 1)) AS i FROM f_edges)",
    "w1_hour_bucket": "SELECT event_id, date_trunc('hour', ts) AS window_ts FROM log",
    "w2_anchored_slices": f"SELECT event_id, floor(epoch(ts - t0) / {SLICE_HOURS * 3600})::INTEGER AS slice FROM log, origin",
    "w3_request_rank": "SELECT event_id, row_number() OVER (PARTITION BY ip, window_ts ORDER BY url_score DESC, ts, event_id)::INTEGER AS request_rank FROM evidence",
    "w4_distinct_urls": "SELECT ip, window_ts, url, round(url_score, 6) AS url_score, first_ts FROM urls",
    "w5_top_urls": "SELECT ip, window_ts, url, url_rank::INTEGER AS url_rank FROM urls WHERE url_rank <= 3",
    "w6_active_model": "SELECT arg_max(model_id, seq) AS model_id FROM history WHERE event IN ('approved', 'rolled_back')",
    "o1_alert_order": "SELECT ip, window_ts, fused_score, break_count FROM alerts",
    "o2_newest_models": """
        SELECT model_id, "at" AS created_at FROM history WHERE event = 'candidate'""",
    "o3_history_append": "SELECT ts::DATE AS dt, count(*) AS n FROM log GROUP BY ALL",
    "o4_time_order": "SELECT event_id, ts FROM log",
    "m1_scale": "SELECT row_key, name AS feature, round(x, 6) AS x FROM (SELECT * FROM scaled) UNPIVOT (x FOR name IN (" + ", ".join(FEATURE_COLUMNS) + "))",
    "m2_forest_fit": """
        SELECT tree::INTEGER AS tree_id, node::INTEGER AS node_id, feature::INTEGER AS feature,
          round(threshold, 6) AS threshold, CASE WHEN feature < 0 THEN -1 ELSE 2 * node END::INTEGER AS "left",
          CASE WHEN feature < 0 THEN -1 ELSE 2 * node + 1 END::INTEGER AS "right", depth::INTEGER AS depth,
          size::INTEGER AS size FROM forest""",
    "m3_forest_score": "SELECT row_key, round(if_raw, 6) AS if_raw FROM if_raws",
    "m4_lof_fit": "SELECT rid, round(k_dist, 6) AS k_dist, round(lrd, 6) AS lrd FROM k_dist JOIN density USING (rid)",
    "m5_lof_score": "SELECT row_key, round(lof_raw, 6) AS lof_raw FROM lof",
    "m6_mixture_posterior": "SELECT ip, window_ts, fused_score, anomaly_prob FROM gated JOIN mixture USING (fused_score)",
    "m7_calibration": "SELECT round(t1, 6) AS fused_threshold, round(t2, 6) AS catastrophic_threshold, ip, window_ts, " + rounded(_SCORES) + " FROM trained CROSS JOIN cuts",
    "m8_feature_vector": "SELECT ip, window_ts, i::INTEGER AS i, round(x[i + 1], 6) AS x FROM (SELECT ip, window_ts, [" + ", ".join(f"{c}::DOUBLE" for c in FEATURE_COLUMNS) + "] AS x, unnest(range(0, 24)) AS i FROM windows)",
    "m9_score_windows": "SELECT ip, window_ts, if_score, lof_score, fused_score FROM real_scored",
    "m10_train_candidate": "SELECT ip, window_ts, " + rounded(_SCORES) + " FROM real_trained",
    "l1_alert_gate": "SELECT ip, window_ts, fused_score, anomaly_flag, alert_kind, relative_score FROM gated",
    "l2_severity": "SELECT ip, window_ts, fused_score, severity FROM alerts",
    "l3_signals": "SELECT ip, window_ts, signal_codes FROM signals",
    "l4_worst_urls": "SELECT ip, window_ts, url, round(url_score, 6) AS url_score, first_ts FROM urls",
    "l5_url_alerts": f"SELECT {_CONTEXT}, url FROM signals JOIN urls USING (ip, window_ts)",
    "l6_window_alerts": "SELECT ip, window_ts AS window_start_utc, part, severity, len(u) AS n_urls, array_to_string(u, ' ') AS urls FROM signals JOIN (SELECT ip, window_ts, ((url_rank - 1) // 20 + 1)::INTEGER AS part, list(url ORDER BY url_rank) AS u FROM urls GROUP BY ALL) USING (ip, window_ts)",
    "l7_alert_summary": "SELECT ip, strftime(window_ts, '%Y-%m-%d %H:%M UTC') AS window_label, severity, fused_score, n_requests, array_to_string(u, ' ') AS shown_urls FROM signals JOIN (SELECT ip, window_ts, list(CASE WHEN length(url) > 100 THEN url[1:97] || '...' ELSE url END ORDER BY url_rank) AS u FROM urls WHERE url_rank <= 3 GROUP BY ALL) USING (ip, window_ts)",
    "d1_psi": "SELECT name AS feature, round(psi, 6) AS psi FROM f_psi",
    "d2_kl": "SELECT name AS feature, round(kl, 6) AS kl FROM f_psi",
    "d3_feature_drift": "SELECT " + rounded(("aggregate_psi", "aggregate_kl", "feature_norm")) + " FROM feature_drift",
    "d4_score_drift": "SELECT if_psi, lof_psi, fused_psi, round(score_norm, 6) AS score_norm FROM score_drift",
    "d5_threshold_drift": "SELECT fused_rel_change, catastrophic_rel_change, round(threshold_norm, 6) AS threshold_norm FROM threshold_drift",
    "d6_combined_drift": "SELECT drift_score, drift_score > 0.59 AS requires_approval, 0.59::DOUBLE AS approval_threshold FROM (SELECT round(0.5 * feature_norm + 0.3 * score_norm + 0.2 * threshold_norm, 4) AS drift_score FROM feature_drift CROSS JOIN score_drift CROSS JOIN threshold_drift)",
    "d7_promotion_auto": _decide("'promote'"),
    "d7_promotion_safe": _decide("CASE WHEN drift_score <= 0.85 THEN 'promote' ELSE 'reject' END"),
    "d7_promotion_table": _decide("CASE analyst_status WHEN 'APPROVED' THEN 'promote' WHEN 'REJECTED' THEN 'reject' ELSE 'pending' END"),
    "r5_active_model": "SELECT arg_max(model_id, seq) AS model_id FROM history WHERE event IN ('approved', 'rolled_back')",
    "r6_model_list": """
        SELECT model_id, arg_max(event, seq) AS status, min("at") AS created_at FROM history
        WHERE event IN ('candidate', 'approved', 'rejected', 'rolled_back') GROUP BY model_id""",
    "r7_next_model_number": "SELECT count(DISTINCT model_id) + 1 AS next_number FROM history WHERE event = 'candidate'",
    "r8_compatibility": "SELECT model_id, 'alert_pct' AS item, (90.0 + misses % 3)::DOUBLE::VARCHAR AS saved, '95.0' AS current FROM history WHERE event = 'candidate'",
    "t5_event_time_windows": f"SELECT {WINDOW_SELECT} FROM windows, origin WHERE window_ts + INTERVAL 1 HOUR <= t1 - INTERVAL 10 MINUTE",
    "t5_event_time_alerts": _CLOSED_ALERTS,
    "t6_late_corrections": f"SELECT {WINDOW_SELECT} FROM windows, origin WHERE window_ts + INTERVAL 1 HOUR <= t1 - INTERVAL 10 MINUTE",
    "t6_corrected_alerts": _CLOSED_ALERTS,
    "t7_ready_windows": "SELECT slice, n FROM complete WHERE slice > 0",
    "r1_register_candidate": "SELECT 'model_v' || (slice + 1) AS model_id, n_windows AS n_train_windows FROM slice_windows",
    "r2_approve": "SELECT 'model_v' || (slice + 1) AS model_id FROM slice_windows WHERE slice % 2 = 0",
    "r3_reject": "SELECT 'model_v' || (slice + 1) AS model_id FROM slice_windows WHERE slice % 2 = 1",
    "r4_rollback": "SELECT 'model_v1' AS model_id FROM slice_windows WHERE slice = 0",
    "t1_bootstrap": "SELECT 'model_v1' AS model_id, 'approved' AS status, count(*) AS n_train_windows FROM windows",
    "t2_score_batch": """
        SELECT 'model_v1' AS detected_by_model, alert_kind, severity, ip, window_ts AS window_start_utc,
          60::INTEGER AS window_minutes, n_requests, if_score, lof_score, fused_score, relative_score, anomaly_prob,
          signal_texts AS signals, url
        FROM real_signals JOIN real_urls USING (ip, window_ts) JOIN real_mixture USING (fused_score)""",
    "t4_microbatch_scoring": """
        SELECT alert_kind, severity, ip, n_requests, fused_score, url
        FROM real_alerts JOIN real_urls USING (ip, window_ts)""",
    "t3_backtest": """
        SELECT slice, n AS n_records, CASE WHEN slice > 0 THEN 'model_v' || slice END AS scored_by,
               'model_v' || (slice + 1) AS trained FROM slices""",
    "t3_backtest_two_behind": """
        SELECT slice, n AS n_records, CASE WHEN slice > 1 THEN 'model_v' || (slice - 1) END AS scored_by,
               CASE WHEN slice > 0 THEN 'model_v' || slice END AS trained FROM slices""",
    "t6_late_data": f"SELECT {WINDOW_SELECT} FROM recent_windows, origin WHERE window_ts + INTERVAL 1 HOUR <= t1 - INTERVAL 10 MINUTE",
    "t8_retrain": "SELECT slice, 'model_v' || (slice + 1) AS model_id, 'promote' AS decision FROM complete",
    "t9_start_mode": """
        SELECT a.attempt, a.mode, 'model_v' || count(*) AS active_model
        FROM slices CROSS JOIN (VALUES (1, 'replay'), (2, 'resume')) a(attempt, mode) GROUP BY ALL""",
    "t10_alert_filters": "SELECT ip, window_ts, url, url_rank::INTEGER AS url_rank FROM alerts JOIN urls USING (ip, window_ts) WHERE severity <> 'LOW' AND status_500_ratio > 0 AND relative_score >= 0.1 AND url_rank <= 5",
}


def oracle_sql() -> dict[str, str]:
    return {name: chain(select) for name, select in SELECTS.items()}
