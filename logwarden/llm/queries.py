"""The registered queries of the llm operators, and SQL for those that SQL can express."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    chat, fill_middle, fingerprints, hard_negatives, html_text, licenses, mixing, near_dedup, packing, quality,
    suffix_dedup, topk, url_rules,
)

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

#: (verdict, host, path)
URL_RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)


def query(function):
    _QUERIES[function.__name__] = function
    return function


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_near_duplicates(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    return near_dedup.near_duplicates(docs, near_dedup.NearDedupConfig(shingle=4))


@query
def op2_format_chats(spark, sf_dir):
    said = "</s>[INST] ok [/INST]"
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = rows.unionByName(spark.createDataFrame(
        [(-1, 0, "user", said), (-1, 1, "assistant", said)], rows.schema
    ))
    record = F.to_json(F.struct("role", "text"), {"ignoreNullFields": "false"})
    turns = chat.canonical_turns(rows.select("conv_id", "turn", record.alias("record")))
    return chat.digest_conversations(chat.format_conversations(turns))


@query
def op3_exact_top_k(spark, sf_dir):
    vectors = _table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, F.col("vec_id") % 20 == 0)


@query
def op4_quality(spark, sf_dir):
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    return quality.classify(docs, labels)


@query
def op5_license_scan(spark, sf_dir):
    return licenses.scan_licenses(_table(spark, sf_dir, "documents"), licenses.license_table(spark))


@query
def op6_mix_sources(spark, sf_dir):
    taken = mixing.copies(_table(spark, sf_dir, "documents"))
    return taken.selectExpr(
        "doc_id", "size", "source_size", "target", "copies * size AS taken", "copies"
    )


@query
def op7_extract_text(spark, sf_dir):
    return html_text.extract_text(_table(spark, sf_dir, "pages"))


@query
def op8_phrase_fingerprints(spark, sf_dir):
    return fingerprints.compare_with_edits(_table(spark, sf_dir, "documents"))


@query
def op9_pack_sequences(spark, sf_dir):
    return packing.pack(_table(spark, sf_dir, "documents"))


@query
def op10_judge_urls(spark, sf_dir):
    return url_rules.judge_urls(_table(spark, sf_dir, "pages"), URL_RULES)


@query
def op11_fill_in_middle(spark, sf_dir):
    return fill_middle.digests(_table(spark, sf_dir, "documents"))


@query
def op12_remove_repeats(spark, sf_dir):
    return suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents"), texts=False)


@query
def op13_hard_negatives(spark, sf_dir):
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = _table(spark, sf_dir, "embeddings").withColumn("label", moved)
    return hard_negatives.mine(rows, F.col("vec_id") % 50 == 0)


_MIX = r"""
WITH sized AS (
  SELECT doc_id, source,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents),
per_source AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % 3 + 1] AS weight
  FROM per_source),
levels AS (
  SELECT *, 3 * source_size / weight AS full_at,
    (sum(source_size) OVER ()
      - coalesce(sum(3 * source_size) OVER (ORDER BY 3 * source_size / weight, source
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY 3 * source_size / weight, source
          ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed),
chosen AS (SELECT level FROM levels WHERE level < full_at ORDER BY full_at, source LIMIT 1),
targets AS (
  SELECT source, source_size,
    least((3 * source_size)::DOUBLE, chosen.level * weight) AS target,
    ('0x' || substr(md5('1:' || coalesce(source, chr(0))), 1, 6))::BIGINT AS start
  FROM weighed, chosen),
steps AS (
  SELECT *, CASE WHEN source_size > 0
    THEN floor(target / source_size * 16777216)::BIGINT ELSE 0 END AS step FROM targets),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY size, doc_id) AS place FROM sized),
counted AS (
  SELECT r.doc_id, r.size, s.source_size, s.target,
    ((r.place * s.step + s.start) >> 24) - (((r.place - 1) * s.step + s.start) >> 24) AS copies
  FROM ranked r JOIN steps s ON r.source IS NOT DISTINCT FROM s.source)
SELECT doc_id, size, source_size, target, copies * size AS taken, copies FROM counted
"""

def _known_digest(text: str) -> str | None:
    """The digest of a known licence, in plain Python."""
    lines = text.split("\n")

    def notice(line: str) -> bool:
        return bool(regex.search(licenses.NOTICE, line)) and not regex.search(
            licenses.PROSE, regex.sub(licenses.ABBREVIATIONS, "", line)
        )

    notices = [notice(line) for line in lines]
    long = [i for i, line in enumerate(lines) if len(line) > licenses.HEADING_CHARS and not notices[i]]
    wordy = [i for i, line in enumerate(lines) if regex.search(r"[\p{L}\p{N}]", line) and not notices[i]]
    start = long[0] if long else wordy[-1] if wordy else len(lines)
    kept = "\n".join(line for i, line in enumerate(lines) if i >= start or not notices[i])
    words = regex.sub(licenses.NO_WORD, " ", kept.lower())
    for spelling, used in licenses.SPELLINGS:
        words = words.replace(spelling, used)
    return hashlib.sha256(words.strip().encode()).hexdigest() if words.strip() else None


def _license_sql() -> str:
    """The same rule over DuckDB's lists; known texts come as digests of all their variants."""
    known: dict[str, str] = {}
    for name, text in sorted(licenses.known_licenses()):
        known.setdefault(_known_digest(text), name)
    rows = ", ".join(f"('{name}', '{digest}')" for digest, name in known.items() if digest)

    def notice(line: str) -> str:
        return (
            f"(regexp_matches({line}, '{licenses.NOTICE}') AND NOT regexp_matches("
            f"regexp_replace({line}, '{licenses.ABBREVIATIONS}', '', 'g'), '{licenses.PROSE}'))"
        )

    digest = "array_to_string(list_transform(list_filter(range(1, len(lines) + 1), lambda i: i >= start OR NOT notices[i]), lambda i: lines[i]), chr(10))"
    digest = f"regexp_replace(lower({digest}), '{licenses.NO_WORD}', ' ', 'g')"
    for spelling, used in licenses.SPELLINGS:
        digest = f"replace({digest}, '{spelling}', '{used}')"
    return f"""
WITH known(license, digest) AS (VALUES {rows}),
texts AS (
  SELECT row_number() OVER () AS row, doc_id, string_split(text, chr(10)) AS lines, -1 AS place FROM documents),
units AS (
  SELECT row, lines, place FROM texts
  UNION ALL
  SELECT row, [unnest(lines)] AS lines, unnest(range(0, len(lines))) AS place FROM texts),
marked AS (
  SELECT *, list_transform(lines, lambda line: {notice('line')}) AS notices FROM units),
started AS (
  SELECT *, coalesce(
    list_filter(range(1, len(lines) + 1), lambda i: length(lines[i]) > {licenses.HEADING_CHARS} AND NOT notices[i])[1],
    list_filter(range(1, len(lines) + 1),
      lambda i: regexp_matches(lines[i], '[\\p{{L}}\\p{{N}}]') AND NOT notices[i])[-1],
    len(lines) + 1) AS start FROM marked),
digests AS (SELECT row, place, sha256(trim({digest})) AS digest FROM started),
hits AS (
  SELECT row, max(license) FILTER (place = -1) AS license,
    string_agg(DISTINCT license, ',' ORDER BY license) FILTER (place >= 0) AS line_licenses,
    count(*) FILTER (place >= 0) AS n_license_lines
  FROM digests JOIN known USING (digest) GROUP BY row)
SELECT doc_id, license, line_licenses, coalesce(n_license_lines, 0) AS n_license_lines
FROM texts LEFT JOIN hits USING (row)
"""


_URLS = r"""
WITH rest AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0
    THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
split AS (
  SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw, rest FROM rest),
parts AS (
  SELECT page_id,
    translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM split),
rules(verdict, rule_host, rule_path) AS (VALUES ('allow', 'org', '/'),
  ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
  ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
fits AS (
  SELECT page_id, max_by(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
    max_by(verdict, length(rule_host || rule_path)) AS verdict
  FROM parts JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host))
    AND starts_with(path, rule_path)
  GROUP BY page_id)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM parts LEFT JOIN fits USING (page_id)
"""

_FILL = r"""
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h,
    regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u FROM documents),
drawn AS (
  SELECT *, len(u) AS n, ('0x' || substr(h, 1, 8))::BIGINT % (len(u) + 1) AS c1,
    ('0x' || substr(h, 9, 8))::BIGINT % (len(u) + 1) AS c2,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
        OR ('0x' || substr(h, 17, 8))::BIGINT % 100 >= 100 THEN 'plain'
      WHEN ('0x' || substr(h, 25, 8))::BIGINT % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM units),
parts AS (
  SELECT *, coalesce(array_to_string(u[1:least(c1, c2)], ''), '') AS prefix,
    coalesce(array_to_string(u[least(c1, c2) + 1:greatest(c1, c2)], ''), '') AS middle,
    coalesce(array_to_string(u[greatest(c1, c2) + 1:], ''), '') AS suffix FROM drawn)
SELECT doc_id, n::BIGINT AS n, form,
  CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text
    WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(CASE form WHEN 'plain' THEN text ELSE prefix || middle || suffix END) AS restored_sha256
FROM parts
"""

# bytes as two hexadecimal digits each, so that places are bytes
_REPEATS = r"""
WITH texts AS (
  SELECT doc_id, row_number() OVER () AS row, hex(encode(coalesce(text, ''))) AS h FROM documents),
numbered AS (
  SELECT row, doc_id, h, unnest(range(0, length(h) // 2, 256)) AS base FROM texts),
parts AS (
  SELECT row, doc_id, base, substr(h, 2 * base + 1, 610) AS part FROM numbered),
places AS (
  SELECT *, unnest(range(0, least(256, length(part) // 2))) AS spot FROM parts),
strings AS (
  SELECT row, doc_id, base + spot AS spot, substr(part, 2 * spot + 1, 2) AS byte,
    CASE WHEN 2 * spot + 100 <= length(part) THEN md5(substr(part, 2 * spot + 1, 100)) END AS string FROM places),
firsts AS (SELECT string, min(doc_id) AS first FROM strings WHERE string IS NOT NULL GROUP BY string),
marked AS (
  SELECT row, spot, byte, max(coalesce(first < doc_id, false)::INTEGER) OVER (
    PARTITION BY row ORDER BY spot ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone
  FROM strings LEFT JOIN firsts USING (string)),
runs AS (
  SELECT *, lag(gone, 1, 0) OVER (PARTITION BY row ORDER BY spot) AS before FROM marked),
counted AS (
  SELECT row, sum(gone) AS n_removed, sum(CASE WHEN gone = 1 AND before = 0 THEN 1 ELSE 0 END) AS n_spans,
    sha256(unhex(coalesce(string_agg(byte, '' ORDER BY spot) FILTER (WHERE gone = 0), ''))) AS kept_sha256
  FROM runs GROUP BY row)
SELECT doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
  coalesce(n_spans, 0)::BIGINT AS n_spans, coalesce(kept_sha256, sha256('')) AS kept_sha256
FROM texts LEFT JOIN counted USING (row)
"""

_NEGATIVES = r"""
WITH vectors AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
    list_inner_product(a.v, b.v)::BIGINT AS score
  FROM vectors a JOIN vectors b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT anchor_id, positive_id,
  row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other)::INTEGER AS rank,
  other AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""

_SQL = {
    "op5_license_scan": _license_sql(),
    "op6_mix_sources": _MIX,
    "op10_judge_urls": _URLS,
    "op11_fill_in_middle": _FILL,
    "op12_remove_repeats": _REPEATS,
    "op13_hard_negatives": _NEGATIVES,
}
