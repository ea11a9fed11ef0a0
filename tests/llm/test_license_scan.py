from cardamom.llm.license_scan import KNOWN, license_scan


def test_known_texts_in_other_dress(spark):
    mit = KNOWN["MIT"][1]
    rows = [
        (0, mit),
        (1, mit.upper().replace(",", " ;").replace("\n", "\r\n")),
        (2, "Copyright (c) 2020 Jane Doe\nAll rights reserved.\n\n" + mit),
        (3, mit + " and more"),
        (4, KNOWN["ISC"][0].replace("license", "licence")),
        (5, None),
        (6, ""),
        (0, mit),
    ]
    got = license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["license_id"]) for r in got if r["license_id"]) == [(0, "MIT"), (0, "MIT"), (1, "MIT"), (2, "MIT"), (4, "ISC")]
    assert len(got) == len(rows)


def test_notices(spark):
    df = spark.createDataFrame([(1, "some text\nReleased under the MIT Licence!\nLicensed under CC BY-NC 4.0.\nmore"), (2, "a license to drive")], "doc_id long, text string")
    got = {r["doc_id"]: r["notice_ids"] for r in license_scan(df).collect()}
    assert got == {1: "CC-BY-NC-4.0,MIT-notice", 2: ""}


def test_spellings_next_to_each_other_and_long_texts(spark):
    from cardamom.llm.license_scan import canonical, digest

    df = spark.createDataFrame([(1, "http http http://x licence licence"), (2, "Licence, " * 50_000)], "doc_id long, text string")
    got = [r["c"] for r in df.select(canonical(df["text"]).alias("c")).collect()]
    assert got == ["https https https x license license", ("license " * 50_000).strip()]
    assert df.select(digest(df["text"]).alias("d")).distinct().count() == 2


def test_empty_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, "x", "d", "l")], "doc_id long, text string, digest string, license_id string")
    assert license_scan(df).count() == 1 and license_scan(df.limit(0)).count() == 0


def test_common_licences_and_headers(spark):
    from pathlib import Path

    from cardamom.llm.license_scan import DIGESTS

    assert {"Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "BSD-2-Clause", "BSD-3-Clause", "MPL-2.0", "Unlicense", "CC0-1.0"} <= set(DIGESTS)
    rows = [(1, '# Licensed under the Apache License, Version 2.0 (the "License");\n# you may not use this file'), (2, "// SPDX-License-Identifier: GPL-3.0\nx")]
    want = {1: (None, "Apache-2.0"), 2: (None, "GPL-3.0")}
    for k, (name, file) in enumerate({"Apache-2.0": "Apache-2.0", "GPL-3.0": "GPL-3", "CC0-1.0": "CC0-1.0"}.items()):
        p = Path("/usr/share/common-licenses", file)
        if p.exists():
            rows.append((10 + k, p.read_text("utf-8")))
            want[10 + k] = (name, None)
    got = {r["doc_id"]: r for r in license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, (whole, line) in want.items():
        assert got[i]["license_id"] == whole and (line is None or got[i]["notice_ids"] == line)
