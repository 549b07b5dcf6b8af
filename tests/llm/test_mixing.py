import re
from collections import Counter, defaultdict

import pytest

from compare import compare, duck
from logwarden.llm import mixing as mx
from logwarden.llm.queries import oracle_sql, queries


def water_fill(sizes, weights=(5, 2, 1), most=3):
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    full, total = set(), sum(sizes.values())
    while True:
        left = [s for s in order if s not in full]
        share = (total - sum(most * sizes[s] for s in full)) / (sum(weight[s] for s in left) or 1)
        over = {s for s in left if share * weight[s] >= most * sizes[s]}
        if not over:
            return {s: most * sizes[s] if s in full else share * weight[s] for s in order}
        full |= over


def test_query_against_sql_and_targets(spark, sf_dir, table):
    df = queries()["op6_mix_sources"](spark, sf_dir)
    assert compare(df, duck(sf_dir), oracle_sql()["op6_mix_sources"]) is None
    docs = {d: (s, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for d, s, t in table("documents", "doc_id, source, text")}
    sizes = defaultdict(int)
    for s, n in docs.values():
        sizes[s] += n
    targets, taken, largest = water_fill(sizes), Counter(), Counter()
    for r in df.collect():
        source, size = docs[r.doc_id]
        assert (r.size, r.source_size) == (size, sizes[source])
        assert r.target == pytest.approx(targets[source])
        assert r.taken <= 3 * size
        taken[source] += r.taken
        largest[source] = max(largest[source], size)
    for source, target in targets.items():
        assert abs(taken[source] - target) <= 2 * largest[source]


def test_edge_cases(spark, documents):
    rows = [(1, None, "en", "b"), (2, "", "en", None), (3, "a b c", "en", None), (3, "a b c", "en", None),
            (4, "w " * 200_000, "en", "a"), (None, "x y", "en", "a"), (5, "q", "en", "a"), (6, "", "en", "empty")]
    docs = documents(rows)
    got = mx.copies(docs).collect()
    assert len(got) == len(rows)
    assert sum(r.copies * r["size"] for r in got if r.source == "b") == 0
    assert {r.target for r in got if r.source in ("b", "empty")} == {0.0}
    assert all(0 <= r.copies <= 3 for r in got)
    again = mx.copies(docs.repartition(3)).collect()
    key = lambda rows: sorted((str(r.doc_id), r["size"], r.copies) for r in rows)
    assert key(got) == key(again)
    out = mx.mix(docs)
    assert out.columns == docs.columns
    emitted, want = Counter(r.doc_id for r in out.collect()), Counter()
    for r in got:
        want[r.doc_id] += r.copies
    assert emitted == +want
    assert mx.copies(documents([])).collect() == [] == mx.mix(documents([])).collect()


def test_hot_source_of_equal_documents(spark, documents):
    rows = [(i, "one two three", "en", "hot") for i in range(3000)]
    rows += [(5000 + i, "w " * (i + 1), "en", f"s{i % 4}") for i in range(200)]
    got = mx.copies(documents(rows)).collect()
    by = defaultdict(list)
    for r in got:
        by[r.source].append(r)
    for source, members in by.items():
        taken = sum(r.copies * r["size"] for r in members)
        assert abs(taken - members[0].target) <= 2 * max(r["size"] for r in members), source


@pytest.mark.parametrize(("rows", "copies"), [(11, 15), (49, 1)])
def test_rows_of_one_id_lose_no_copy(spark, documents, monkeypatch, rows, copies):
    docs = documents([(None, f"text {i}", "en", "s") for i in range(rows)])
    taken = spark.createDataFrame([(None, copies if i == 0 else 0) for i in range(rows)], "doc_id long, copies long")
    monkeypatch.setattr(mx, "copies", lambda docs, **options: taken)
    assert mx.mix(docs).count() == copies
