import random
import re

import numpy as np
import pyarrow as pa
import pytest

from logwarden.llm import near_dedup as nd
from logwarden.llm.components import components
from logwarden.llm.queries import queries
from logwarden.llm.words import text_slices, word_numbers

CFG = nd.NearDedupConfig(shingle=4)


def brute(rows, size=4, percent=80):
    """(doc_id, n_shingles, component_id, kept) by comparing all pairs."""
    sets = {}
    for doc_id, text in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", low)
        n = len(words)
        sets[doc_id] = {tuple(words[i : i + size]) for i in range(n - size + 1)} if n >= size else (
            {tuple(words)} if words else set()
        )
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                ra, rb = sorted((find(a), find(b)))
                root[rb] = ra
    return {(d, len(sets[d]), find(d), find(d) == d) for d in ids}


def found(df):
    return {tuple(r) for r in df.select("doc_id", "n_shingles", "component_id", "kept").collect()}


def edited(words, changes, seed):
    out, rng = list(words), random.Random(seed)
    for _ in range(changes):
        out[rng.randrange(len(out))] = f"x{rng.random()}"
    return out


def test_query_against_all_pairs(spark, sf_dir, table):
    got = found(queries()["op1_near_duplicates"](spark, sf_dir))
    assert got == brute(table("documents", "doc_id, text"))


def test_groups_of_copies_and_chains(spark, documents):
    rng = random.Random(3)
    base = [f"w{rng.randrange(300)}" for _ in range(200)]
    rows = [(100 + i, " ".join(edited(base, i % 9, i))) for i in range(60)]
    rows += [(300 + i, " ".join(base)) for i in range(40)]
    chain = list(base[::-1])
    for i in range(20):  # neighbours alike, ends not
        rows.append((500 + i, " ".join(chain)))
        chain = edited(chain, 4, 1000 + i)
    rows += [(900 + i, " ".join(f"u{rng.randrange(9**9)}" for _ in range(50))) for i in range(20)]
    got = found(nd.near_duplicates(documents(rows), CFG))
    assert got == brute(rows)


def test_edge_cases(spark, documents):
    rows = [
        (1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (4, "One two"), (5, "one two"), (6, "ONE  two"),
        (7, "É a b c d"), (8, "é a b c d"), (9, "a b c d"), (10, "\na b\rc d"), (11, "word " * 200_000),
        (12, "word " * 300), (13, "a b c"), (14, "a b"),
    ]
    got = found(nd.near_duplicates(documents(rows), CFG))
    assert got == brute(rows)


def test_null_and_repeated_ids(spark, documents):
    rows = [(None, "a b c d e"), (None, "a b c d e"), (7, "a b c d e"), (7, "a b c d e"), (9, "a b c d e")]
    got = sorted(map(tuple, nd.near_duplicates(documents(rows), CFG).collect()), key=str)
    assert got == sorted([(None, 2, None, True)] * 2 + [(7, 2, 7, True)] * 2 + [(9, 2, 7, False)], key=str)
    stay = nd.deduplicate(documents(rows), CFG)
    assert sorted((r.doc_id for r in stay.collect()), key=str) == [7, None, None]
    assert stay.columns == documents(rows).columns


def test_empty_table(spark, documents):
    assert nd.near_duplicates(documents([]), CFG).collect() == []
    assert nd.deduplicate(documents([]), CFG).collect() == []


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(5)
    pool = rng.integers(0, 2**63, 3000).astype("uint64")
    a, b = pool[:2000], pool[500:]  # similarity 0.5
    both = np.unique(np.concatenate([a, b]))
    elements = np.concatenate([a, b, both])
    owner = np.repeat([0, 1, 2], [len(a), len(b), len(both)])
    cfg = nd.NearDedupConfig(registers=1024)
    ra, rb, union = nd.registers(elements, owner, 3, cfg)
    assert (nd.merged(ra, rb) == union).all()
    n = np.array([2000.0]), np.array([2500.0])
    assert nd.similarity(ra[None], rb[None], *n, cfg.base)[0] == pytest.approx(0.5, abs=0.06)
    alone = nd.registers(a, np.zeros(len(a), int), 1, cfg)[0]
    assert (alone == ra).all()  # other sets do not matter


def test_components(spark):
    links = [(i, i + 1) for i in range(50, 120)] + [(1, 200), (200, 300), (300, 400), (2, 2), (9, 8)]
    links += [(1000, 1000 + i) for i in range(1, 400)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {i: 50 for i in range(50, 121)} | {1: 1, 200: 1, 300: 1, 400: 1, 8: 8, 9: 8}
    want |= {1000 + i: 1000 for i in range(400)}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_words_of_slices():
    texts = pa.array(["É a", "b Ç\u00a0d", None, "ÀÉ Ü x"] * 50)
    whole = word_numbers(next(text_slices(texts)))
    for start in range(0, 200, 7):
        parts = [word_numbers(t) for t in text_slices(texts.slice(start), 40)]
        assert (np.concatenate([w for w, _ in parts]) == whole[0][whole[1][start] :]).all()
