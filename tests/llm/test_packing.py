import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from logwarden.llm import packing as pk
from logwarden.llm.queries import queries

TOKENIZER = Tokenizer.from_file(pk.default_tokenizer())
WORDS = pk.WordIds(pk.default_tokenizer())


def brute_pieces(rows, most=2048):
    out = Counter()
    for doc_id, text in rows:
        ids = np.array([*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        for piece, at in enumerate(range(0, len(ids), most)):
            part = ids[at : at + most]
            out[doc_id, piece, at, len(part), zlib.crc32(part.tobytes())] += 1
    return out


def check_packed(df, rows, most=2048):
    got = df.collect()
    keys = ("doc_id", "piece", "start", "length", "ids_crc32")
    pieces = brute_pieces(rows, most)
    assert Counter(tuple(r[k] for k in keys) for r in got) == pieces
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for members in bins.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= most
    return len(bins), -(-sum(k[3] * n for k, n in pieces.items()) // most)


def test_query_against_brute_force(spark, sf_dir, table):
    n, fewest = check_packed(
        queries()["op9_pack_sequences"](spark, sf_dir), table("documents", "doc_id, text")
    )
    assert n <= fewest * 1.01 + 1


def test_several_shards_and_rounds(spark, documents):
    rng = np.random.default_rng(2)
    rows = [(i, "word " * int(n)) for i, n in enumerate(rng.integers(1, 90, 600))]
    n, fewest = check_packed(pk.pack(documents(rows), most=64, shard_pieces=50), rows, 64)
    assert n <= fewest * 1.1


def test_edge_cases(spark, documents):
    rows = [(None, "a b"), (1, None), (1, None), (2, ""), (3, "x " * 9000), (4, "<|endoftext|> A <|ENDOFTEXT|>"),
            (5, "Ünïcode, é İstanbul ΣΑΣ.\tx\x1cy z"), (6, "a,b. it's 'll 12ab ,."), (7, "İ. İ, Üb. ΑΣ. é\u0301, e\u0301.")]
    check_packed(pk.pack(documents(rows)), rows)
    assert pk.pack(documents([])).collect() == []


def test_local_search_saves_bins():
    rng = np.random.default_rng(1)
    for low, high in ((600, 1100), (650, 720), (500, 1500)):
        lengths = rng.integers(low, high, 1500).tolist()
        first = pk._Bins(lengths, 2048, 0)
        first.best_fit()
        found = pk.pack_lengths(lengths, 2048)
        assert sorted(i for b in found for i in b) == list(range(1500))
        assert all(sum(lengths[i] for i in b) <= 2048 for b in found)
        assert len(found) < first.used()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(
    alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from(list("aAbeéİΣ ,.'\n\t<|s"))), max_size=40
), min_size=1, max_size=4))
def test_words_give_the_tokenizer_s_ids(texts):
    got = [ids.tolist() for ids in WORDS.encode(pa.array(texts, pa.string()))]
    assert got == [TOKENIZER.encode(t, add_special_tokens=False).ids for t in texts]


def test_forgetting_words(monkeypatch):
    texts = [r[0] for r in duckdb.sql("SELECT text FROM '/root/testdata/sf0.001/documents.parquet'").fetchall()]
    monkeypatch.setattr(pk, "WORDS_KEPT", 100)
    monkeypatch.setattr(pk, "BATCH_BYTES", 5_000)
    words = pk.WordIds(pk.default_tokenizer())
    got = [ids.tolist() for ids in words.encode(pa.array(texts))]
    assert got == [TOKENIZER.encode(t, add_special_tokens=False).ids for t in texts]


def test_a_pair_goes_to_the_next_receiver():
    """The first by reach would give two pieces back, the second gives one."""
    bins = pk._Bins([10, 10, 5, 14, 80, 18, 79], 100, 100)
    bins.bins, bins.fill = [[0, 1], [2, 3, 4], [5, 6]], [20, 99, 97]
    for b in range(3):
        bins.list_bin(b)
    assert bins._give(0)
    assert sorted(bins.fill) == [18, 99, 99]
