from pathlib import Path

import pytest
from pyspark.sql import functions as F

from compare import compare, duck
from logwarden.llm import licenses as lc
from logwarden.llm.queries import oracle_sql, queries


def test_query_against_sql(spark, sf_dir):
    df = queries()["op5_license_scan"](spark, sf_dir)
    assert compare(df, duck(sf_dir), oracle_sql()["op5_license_scan"]) is None


MIT = dict(x for x in lc.LICENSES if x[0] == "MIT" and "\n" in x[1])["MIT"]


@pytest.mark.parametrize(("text", "license", "lines"), [
    (MIT, "MIT", None),
    ("Copyright (c) 2020 A. Person\n\n" + MIT.upper().replace("\n", "\n\n"), "MIT", None),
    ("© B\n(C) 1999 C\n" + MIT.replace('"', "“").replace("license", "licence"), "MIT", None),
    (MIT + " And more.", None, None),
    ("released under the mit licence", "MIT", "MIT"),
    ("A story.\n* Licensed under CC-BY-NC 4.0! \nMore.\nLicenced under the Apache License, version 2.0", None,
     "Apache-2.0,CC-BY-NC-4.0"),
    ("A story about the copyright.\nReleased under the MIT License.", None, "MIT"),
    ("Copyright 2020 Released under the MIT License.", None, None),
    ("", None, None),
    (" ... ", None, None),
    (None, None, None),
])
def test_texts(spark, documents, text, license, lines):
    row = lc.scan_licenses(documents([(1, text)])).first()
    assert (row.license, row.line_licenses) == (license, lines)


def test_edge_cases(spark, documents):
    rows = [(1, "x\nReleased under the MIT License.\nReleased under the MIT License."), (1, "other"), (None, "Licensed under CC BY 4.0."),
            (1, "x\nReleased under the MIT License.\nReleased under the MIT License."), (2, "word " * 300_000)]
    got = sorted((str(r.doc_id), r.line_licenses or "", r.n_license_lines) for r in lc.scan_licenses(documents(rows)).collect())
    assert got == [("1", "", 0), ("1", "MIT", 2), ("1", "MIT", 2), ("2", "", 0), ("None", "CC-BY-4.0", 1)]
    assert lc.scan_licenses(documents([])).collect() == []
    none = spark.createDataFrame([("X", None), (None, "Released under the MIT License.")], "license string, text string")
    assert [r.line_licenses for r in lc.scan_licenses(documents(rows[:1]), none).collect()] == [None]


def test_whole_texts(spark, documents):
    apache, gpl2, gpl3, bsd, mpl, cc0 = (
        (Path(lc.__file__).parent / f"license_texts/{n}.txt").read_text()
        for n in ("Apache-2.0", "GPL-2.0-only", "GPL-3.0-only", "BSD-3-Clause", "MPL-2.0", "CC0-1.0")
    )
    bsd = bsd[bsd.index("Redistribution and"):]
    terms = apache[:apache.index("   APPENDIX")]
    body = MIT.split("\n", 1)[1]
    two = bsd[:bsd.index("3. Neither")] + bsd[bsd.index("\nTHIS SOFTWARE"):]
    rows = [
        (apache, "Apache-2.0"), (terms, "Apache-2.0"), (apache.replace("http:", "https:"), "Apache-2.0"),
        (gpl2, "GPL-2.0-only"), (gpl2[:gpl2.index("How to Apply")], "GPL-2.0-only"), (gpl3, "GPL-3.0-only"),
        (gpl3.replace("https:", "http:"), "GPL-3.0-only"), (bsd, "BSD-3-Clause"), ("New BSD License\n\n" + bsd, "BSD-3-Clause"),
        (two, "BSD-2-Clause"), (mpl, "MPL-2.0"), (cc0, "CC0-1.0"), (" ".join(cc0.split()), "CC0-1.0"),
        ("The MIT License (MIT)\n\nCopyright (c) 2020 A\n\n" + body, "MIT"), (body, "MIT"), (apache[:5000], None),
    ]
    got = lc.scan_licenses(documents([(i, t) for i, (t, _) in enumerate(rows)])).collect()
    assert {r.doc_id: r.license for r in got} == {i: name for i, (_, name) in enumerate(rows)}


def test_notices_and_scripts(spark, documents):
    body = MIT.split("\n", 1)[1]
    wrapped = body.replace("OR COPYRIGHT HOLDERS", "OR\nCOPYRIGHT HOLDERS").replace("above copyright", "above\ncopyright")
    bsd = (Path(lc.__file__).parent / "license_texts/BSD-3-Clause.txt").read_text()
    notice = "Released under the MIT License."
    rows = [
        (wrapped, "MIT"), ("MIT License\n\nCopyright (c) 2020 A\n2021, B\n" + wrapped, None),
        ("MIT License\n\nCopyright (c) 2020 A\nCopyright 2021 B\n\n" + wrapped, "MIT"), (bsd, "BSD-3-Clause"),
        ("Copyright law is old." + " It has a long story." * 40 + "\n" + notice, None),
        ("Copyright 2020" + " and a long story." * 40 + "\n" + notice, None),
        ("\u7248\u6743\u6587\u6863 \u6211\u4eec\n" + notice, None), ("\u041b\u0438\u0446\u0435\u043d\u0437\u0438\u044f\n" + notice, None),
        ("\u8bb8\u53ef \u8bc1\uff01", "ZH"), ("terms\n(c) the third item\nend", "LIST"), ("terms\nend", None),
        (body.replace("CLAIM", "CLAIM\nCopyright 2020 in the body\n"), None),
    ]
    known = lc.license_table(spark, [*lc.known_licenses(), ("ZH", "\u8bb8\u53ef \u8bc1"), ("LIST", "Terms (c) the third item end")])
    got = lc.scan_licenses(documents([(i, t) for i, (t, _) in enumerate(rows)]), known).collect()
    assert {r.doc_id: r.license for r in got} == {i: name for i, (_, name) in enumerate(rows)}


def test_notices_of_any_length_and_number(spark, documents):
    body = MIT.split("\n", 1)[1]
    long = "Copyright (c) 2020 " + ", ".join(f"Person {i} of a Company" for i in range(40))
    rows = [
        (long + "\n\n" + body, "MIT"), ("Copyright A. Person\n\n" + body, "MIT"), ("Copyright by The Firm Ltd. and others\n" + body, "MIT"),
        ("MIT License\n\n" + "\n".join(f"Copyright (c) {y} Some One" for y in range(1990, 2020)) + "\n\n" + body, "MIT"),
        ("The MIT License (MIT)\n\n\n\n\n\n\n\nCopyright 2020 Foo Inc. All rights reserved.\n" + body, "MIT"),
        ("Copyright law is old. It has a story.\nReleased under the MIT License.", None),
        ("Released under the MIT License.\nCopyright 2020 A", None), ("Copyright 2020 A\n\nReleased under the MIT License.", "MIT"),
        ("Released under the MIT License." + " ." * 300, "MIT"), ("\n".join(["x" * 70, "Copyright 2020 A", "end"]), None),
        (body + "\nCopyright 2020 A", None), ("Copyright 2020 A", None),
    ]
    got = lc.scan_licenses(documents([(i, t) for i, (t, _) in enumerate(rows)])).collect()
    assert {r.doc_id: r.license for r in got} == {i: name for i, (_, name) in enumerate(rows)}
    few = lc.license_table(spark, [("A", "a b"), ("MIT", body)])  # a text of few letters
    got = lc.scan_licenses(documents([(1, "© X\nA. B!"), (2, body), (3, "b a")]), few).collect()
    assert {r.doc_id: r.license for r in got} == {1: "A", 2: "MIT", 3: None}


def test_sql_knows_the_same_digests(spark):
    from logwarden.llm.queries import _known_digest

    known = lc.known_licenses()
    rows = spark.createDataFrame([(t,) for _, t in known], "text string").select(lc.license_digest(F.col("text")).alias("d"))
    assert [r.d for r in rows.collect()] == [_known_digest(t) for _, t in known]
