from collections import Counter, defaultdict

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from test_mixing import water_fill
from test_near_dedup import brute as brute_groups
from test_packing import check_packed
from test_quality import brute_scores


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "near dedup", "mix sources", "pack sequences"
    ]
    assert "pipeline" in entry.queries()


def words(text):
    return len((text or "").encode().split())


def test_each_stage_against_brute_force(spark, sf_dir, table):
    """Each on its predecessor's rows."""
    rows = table("documents")
    stages = [f for _, f in corpus_pipeline.STAGES]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns

    score, limits = brute_scores(spark, [(r[0], r[2], r[1]) for r in rows], table("labels"))
    good = stages[0](spark, docs, sf_dir).cache()
    kept = sorted(map(tuple, good.collect()))
    assert good.columns == columns
    assert kept == sorted(r for r in rows if score[r[0]] <= limits[r[2]])
    assert len(kept) < len(rows)

    single = stages[1](spark, good, sf_dir).cache()
    first = {d for d, _, _, stays in brute_groups([r[:2] for r in kept], size=5) if stays}
    left = sorted(map(tuple, single.collect()))
    assert single.columns == columns
    assert left == [r for r in kept if r[0] in first]
    assert len(left) < len(kept)

    mixed = stages[2](spark, single, sf_dir).cache()
    taken = [tuple(r) for r in mixed.collect()]
    assert mixed.columns == columns
    assert set(taken) <= set(left)
    assert max(Counter(taken).values()) <= 3
    sizes, got, largest = defaultdict(int), Counter(), Counter()
    for r in left:
        sizes[r[3]] += words(r[1])
        largest[r[3]] = max(largest[r[3]], words(r[1]))
    for r in taken:
        got[r[3]] += words(r[1])
    for source, target in water_fill(sizes).items():
        assert abs(got[source] - target) <= 2 * largest[source]

    n, fewest = check_packed(stages[3](spark, mixed, sf_dir), [r[:2] for r in taken])
    assert n <= fewest * 1.01 + 1


def test_run_agrees_with_its_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, function in corpus_pipeline.STAGES[:-1]:
        docs = function(spark, docs, sf_dir)
    pieces = ["doc_id", "piece", "start", "length", "ids_crc32"]
    want = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).select(pieces)
    got = entry.queries()["pipeline"](spark, sf_dir).select(pieces)
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))


@pytest.mark.parametrize("rows", [[], [(1, None), (2, ""), (None, "a b c"), (3, "x " * 5000), (3, "x " * 5000)]])
def test_odd_documents(spark, sf_dir, documents, rows):
    docs = documents(rows)
    columns = docs.columns
    for _, function in corpus_pipeline.STAGES[:-1]:
        docs = function(spark, docs, sf_dir)
        assert docs.columns == columns
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert set(r.doc_id for r in packed.collect()) <= {r[0] for r in rows}
