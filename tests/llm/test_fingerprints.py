import hashlib

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from logwarden.llm import fingerprints as fp
from logwarden.llm.queries import queries


def phrases(text):
    seen, start = set(), 0
    for end in range(1, len(text) + 1):
        if text[start:end] not in seen:
            seen.add(text[start:end])
            start = end
    return seen | ({text[start:]} if start < len(text) else set())


def edits(rows):
    rows = sorted(((d, t or "") for d, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    for i, (doc_id, text) in enumerate(rows):
        following, cut = rows[(i + 1) % len(rows)][1], len(text) // 4
        yield doc_id, text, text[: len(text) - cut] + following[:cut], following


def check(df, rows):
    got = sorted(df.collect(), key=lambda r: (str(r.doc_id), r.n_chars, r.edited_sha256))
    want = sorted(
        ((d, len(t), hashlib.sha256(e.encode()).hexdigest(), fp.as_text(fp.fingerprint(t)), fp.as_text(fp.fingerprint(e)), t, e, f)
         for d, t, e, f in edits(rows)), key=lambda r: (str(r[0]), r[1], r[2]),
    )
    assert [tuple(r)[:5] for r in got] == [w[:5] for w in want]
    for r, (*_, t, e, f) in zip(got, want, strict=True):
        for estimate, other in ((r.near_edited, e), (r.near_next, f)):
            a, b = phrases(t), phrases(other)
            true = len(a & b) / len(a | b) if a | b else 1.0
            assert estimate == pytest.approx(true, abs=0 if len(a | b) <= fp.SIGNATURE else 0.3)


def test_query_against_brute_force(spark, sf_dir, table):
    check(queries()["op8_phrase_fingerprints"](spark, sf_dir), table("documents", "doc_id, text"))


def test_many_ranges(spark, documents, table):
    rows = table("documents", "doc_id, text")
    check(fp.compare_with_edits(documents(rows).repartition(3), range_bytes=20_000), rows)


def test_edge_cases(spark, documents):
    rows = [(5, None), (None, "no id"), (3, ""), (9, "é" * 200_000), (7, "same text twice"), (7, "same text twice"),
            (8, "same text twice"), (1, "abc"), (2, "\U0001f600\0x" * 9)]
    for size in (16, 10_000_000):
        check(fp.compare_with_edits(documents(rows), range_bytes=size), rows)
    check(fp.compare_with_edits(documents([(4, "alone in here")])), [(4, "alone in here")])
    assert fp.compare_with_edits(documents([])).collect() == []
    marks = {r.doc_id: r.fingerprint for r in fp.fingerprints(documents(rows)).collect()}
    assert marks[7] == marks[8] != marks[1] and marks[5] == marks[3] == ""


@given(st.text(st.sampled_from("abé\U0001f600"), max_size=200), st.text(st.sampled_from("abx"), max_size=80))
def test_parse_shares_its_beginning(text, following):
    parsed = fp.Parsed(text)
    assert parsed.ends == fp.phrase_ends(text)
    edited, ends = parsed.edited(following)
    assert edited == text[: len(text) - len(text) // 4] + following[: len(text) // 4]
    assert ends == fp.phrase_ends(edited)
    cuts = [0, *ends]
    assert {edited[a:b] for a, b in zip(cuts, cuts[1:])} == phrases(edited)
    assert len(np.unique(fp.phrase_hashes(edited, ends))) == len(phrases(edited))


def test_likeness():
    a = np.arange(0, 300, 1, dtype="uint32") * 7919
    assert fp.likeness(a[:64], a[:64]) == 1.0
    assert fp.likeness(a[:0], a[:0]) == 1.0 and fp.likeness(a[:0], a[:5]) == 0.0
    assert fp.likeness(a[:10], a[5:15]) == pytest.approx(5 / 15)
