import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from logwarden.llm import suffix_dedup
from logwarden.llm.suffix_dedup import SuffixDedupConfig, remove_repeats

SMALL = {"block_bytes": 300, "slice_bytes": 64, "bucket_anchors": 20, "shard_bytes": 200}


def brute(rows, length):
    """By the definition: a byte goes if a string over it also starts under a smaller id."""
    first = {}
    data = [((2**63 - 1 if i is None else i), (t or "").encode() if not isinstance(t, bytes) else t) for i, t in rows]
    for order, text in data:
        for at in range(len(text) - length + 1):
            part = text[at : at + length]
            first[part] = min(order, first.get(part, order))
    out = []
    for (doc_id, _), (order, text) in zip(rows, data, strict=True):
        gone = bytearray(len(text))
        for at in range(len(text) - length + 1):
            if first[text[at : at + length]] < order:
                gone[at : at + length] = b"\1" * length
        kept = bytes(b for b, g in zip(text, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((doc_id, len(text), len(text) - len(kept), spans, hashlib.sha256(kept).hexdigest(), kept))
    return out


def bag(rows):
    return sorted(((*r[:5], bytes(r[5])) for r in rows), key=repr)


def made(seed=3):
    pick = random.Random(seed)
    words = ["ab", "ü", "lorem", "x", "日本", "passage", "\n", "zz"]
    shared = [" ".join(pick.choice(words) for _ in range(30)) for _ in range(4)]
    rows = []
    for i in range(60):
        own = " ".join(pick.choice(words) for _ in range(pick.randint(0, 25)))
        rows.append((i * 7 % 61, own + pick.choice(["", *shared])[pick.randint(0, 9) :] + own[:5]))
    return [
        *rows, (100, rows[0][1]), (101, rows[0][1]), (3, rows[0][1]), (3, rows[0][1]),  # copies, repeated rows
        (None, rows[1][1]), (None, "only here, under no id at all"), (102, None), (103, ""), (104, "short"),
        (105, "a" * 2000), (106, "b" + "a" * 1500 + "c"), (-5, "b" + "a" * 60),
    ]


@pytest.mark.parametrize("length, gram, crowd", [(20, 7, 1000), (20, 8, 1), (12, 12, 2), (5, 1, 1000), (50, 16, 2)])
def test_brute_force(spark, documents, length, gram, crowd):
    rows = made()
    cfg = SuffixDedupConfig(length, gram, crowd=crowd, **SMALL)
    got = remove_repeats(documents(rows).repartition(5), cfg).collect()
    assert bag(got) == bag(brute(rows, length))


def test_default_sizes(spark, documents):
    rows = made(4)
    got = remove_repeats(documents(rows)).collect()
    assert bag(got) == bag(brute(rows, 50))
    assert remove_repeats(documents(rows), texts=False).columns == [
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"
    ]


def test_empty(spark, documents):
    assert remove_repeats(documents([])).collect() == []
    rows = [(1, None), (2, ""), (2, "")]
    assert bag(remove_repeats(documents(rows)).collect()) == bag(brute(rows, 50))


def test_bytes_that_are_no_text(spark):
    rows = [(2, b"\xff\xfe" * 40 + b"tail"), (1, b"x" + b"\xff\xfe" * 40), (3, b"\xff" * 100)]
    frame = spark.createDataFrame([(i, bytearray(t)) for i, t in rows], "doc_id long, text binary")
    frame = frame.selectExpr("doc_id", "cast(text as string) text")
    out = {r.doc_id: r.n_bytes for r in remove_repeats(frame).collect()}
    assert out == {1: 81, 2: 84, 3: 100}  # kept whole lengths; strings over the byte 255 are not compared


def test_config():
    with pytest.raises(ValueError):
        SuffixDedupConfig(length=10, gram=11)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.binary(max_size=40).map(lambda b: bytes(97 + x % 3 for x in b)), min_size=1, max_size=6))
def test_suffix_array_and_prefixes(parts):
    text = np.frombuffer(b"\xff".join([*parts, b""]), "u1")
    raw = text.tobytes()

    def key(i):
        end = raw.index(b"\xff", i)
        return [*raw[i:end], 255 + end]

    assert suffix_dedup.suffix_array(text)[0].tolist() == sorted(range(len(raw)), key=key)
    for length in (1, 2, 5, 7):
        places, groups = suffix_dedup.common_prefixes(text, length)
        got = {}
        for place, group in zip(places.tolist(), groups.tolist(), strict=True):
            got.setdefault(group, set()).add(place)
        want = {}
        for at in range(len(raw) - length + 1):
            if b"\xff" not in raw[at : at + length]:
                want.setdefault(raw[at : at + length], set()).add(at)
        assert sorted(map(sorted, got.values())) == sorted(sorted(v) for v in want.values() if len(v) > 1)
