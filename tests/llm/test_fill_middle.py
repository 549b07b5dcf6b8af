import hashlib
import random
import re

import pytest

from logwarden.llm import fill_middle
from logwarden.llm.fill_middle import FillMiddleConfig


def brute(doc_id, text, cfg):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"{cfg.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    one, two = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    prefix, middle, suffix = ("".join(p) for p in (units[:one], units[one:two], units[two:]))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= cfg.rate:
        form, out, sizes = "plain", text, (None, None)
    elif h4 % 100 < cfg.spm:
        form, out, sizes = "spm", f"<S>{suffix}<P>{prefix}<M>{middle}", (len(prefix), len(middle))
    else:
        form, out, sizes = "psm", f"<P>{prefix}<S>{suffix}<M>{middle}", (len(prefix), len(middle))
    return (doc_id, len(units), form, *sizes, out, text)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def made():
    pick = random.Random(5)
    bits = ["a", "\n", "\n\n", "ü", "日本", "<", "<P", "<S", "S>", "\r\n", " ", "word ", "<M"]
    rows = [(i, "".join(pick.choice(bits) for _ in range(pick.randint(0, 40)))) for i in range(80)]
    return [
        *rows, (200, None), (201, ""), (202, "\n"), (203, "no break"), (204, "with <M> inside\nx\n"),
        (205, "x" * 5000), (206, "long line ü " * 400 + "\n" + "short\n" * 300), (None, "a\nb\nc\n"), (None, None),
        (7, "other text\nunder\na used id"), rows[9], rows[9], (-3, "a\nb\nc"),
    ]


@pytest.mark.parametrize("cfg", [
    FillMiddleConfig(), FillMiddleConfig(piece_bytes=3), FillMiddleConfig(seed=1, rate=60, spm=20, piece_bytes=64),
])
def test_brute_force(spark, documents, cfg):
    docs, want = documents(made()).repartition(5), [brute(i, t, cfg) for i, t in made()]
    got = [tuple(r) for r in fill_middle.digests(docs, cfg).collect()]
    assert sorted(got, key=repr) == sorted(((*w[:5], sha(w[5]), sha(w[6])) for w in want), key=repr)
    got = [tuple(r) for r in fill_middle.texts(docs, cfg).collect()]
    assert sorted(got, key=repr) == sorted(((w[0], w[2], w[5]) for w in want), key=repr)
    assert {w[2] for w in want} == {"plain", "psm", "spm"}


def test_pieces_are_bounded(spark, documents):
    cfg = FillMiddleConfig(piece_bytes=100)
    pieces = fill_middle.pieces(documents(made()), cfg).collect()
    assert max(len(r.piece) for r in pieces) <= 103
    long = [r for r in pieces if r.doc_id == 206]
    assert [r.place for r in long] == list(range(len(long)))


def test_one_shuffle(spark, documents):
    plan = fill_middle.digests(documents(made()))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_empty(spark, documents):
    assert fill_middle.digests(documents([])).collect() == []
