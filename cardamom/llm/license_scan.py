"""License scans: canonical digests of whole texts, looked up by a hash join (built-in functions only).

Canonical form: lower case; lines that state a copyright are dropped; equivalent
spellings become one; what is neither letter nor digit separates words. Null and
empty texts have the digest of the empty text and match nothing. Repeated rows
each get a row, very long texts are digested whole, and an empty table gives an empty result. Besides,
each line that speaks of a licence is digested alike and looked up among known notices. Columns besides
id and text do not matter, whatever their names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Texts of well-known licences (public) and one-line notices.
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_ZERO_BSD = _ISC.replace(", provided that the above copyright notice and this permission notice appear in all copies", "")
KNOWN = {
    "MIT": (_MIT, "MIT License\n\n" + _MIT, "The MIT License (MIT)\n\n" + _MIT),
    "ISC": (_ISC, "ISC License\n\n" + _ISC),
    "0BSD": (_ZERO_BSD, "BSD Zero Clause License\n\n" + _ZERO_BSD),
    "Apache-2.0": ("Licensed under the Apache License, Version 2.0.",),
    "GPL-3.0": ("This work is licensed under the GNU General Public License, version 3.",),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.",),
    "MIT-notice": ("Released under the MIT License.",),
}

# Canonical digests of whole texts, as published (with and without their appendix).
DIGESTS = {
    "Apache-2.0": (
        "4db164cc277b72e3d03f4161513c53b32de1cf3a402162a025e00d038383a74f",
        "b93faad605f4e5d56d92cb01789c993887913c893e441b2305b4f880a9cead93",
    ),
    "GPL-1.0": (
        "8f586b09c093668e2db772bdcfc1d5dc0b03e0e862fccbff035e1bf134e9b224",
        "6375a768fd262bf5281905a9585411d2d0fb4ea15cb08cfcba49f73fedb82abc",
    ),
    "GPL-2.0": (
        "efe73660e5476cf0368fc0fc143f624ff9d1b73c4484b14a9969dd20c5786821",
        "e1270b653c300290e7c039142bccb8776f9b5d14e8a05bc4e87dc7d1614a3b34",
        "aa997bc1c3422ccdc7ccabdc6f9aaa9ce2ebeed7be208887d2b13ff901326c75",
        "c2eea7a9d82a254e540a96d8107801d93d00bcef2742a78b7e8e8d0c0efcbd1c",
    ),
    "GPL-3.0": (
        "a8cd54d6683aa630f0b8d05d56184ad91dc486756da2df61c94d3e4e8d5ecb68",
        "ac6b52d57c0104e687039148f7b8e370e04c9bb5705bb786f8ef814eb65e8636",
    ),
    "LGPL-2.0": (
        "61af4dcea4e412e8ccfb8877fd2762bd6d962f8d42a9fa2c06cf7b4613f2c908",
        "504542bce5421b0f5a7e63ddb55443ccb300b27a65ba6bfc1370fed16a3af260",
    ),
    "LGPL-2.1": (
        "4d55922bdeafabde164d75448bbfb0b474bf952bbb541325364010900acd9891",
        "48d2010e70a815a564f914b0c7c1e80d7a6843793348fed3684c957112fe0aa4",
    ),
    "LGPL-3.0": (
        "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be",
    ),
    "MPL-1.1": (
        "26ba73e836ecb04fe87d5eca80ca27cff1afa2d7683455be1517bd23b8d27986",
    ),
    "MPL-2.0": (
        "9eab7902f21bef0326dee4ed0cae1402c781cbf1f8e3dbeed6fbe176d641bb13",
    ),
    "CC0-1.0": (
        "cccf7894e1b9f4ba9f97728bf0c5baf9e07bc2ac93da7a51556451b1fb2b868e",
    ),
    "GFDL-1.2": (
        "5379e6f33e826ba185b23fd11a414555c2161fda481478babd1e73a3ae098a71",
    ),
    "GFDL-1.3": (
        "93d6108daecdddc5f284cf8f2512fb0d72f6e9ee12381feb9704ba194b00c3e6",
    ),
    "BSD-3-Clause": (
        "21ce5e311a0ef74591e636cf6d0a236029bcaa0ee86324ac68d5748657aa8651",
        "cc65957a28f15bbcef5b0c23770aae3bd8462cb25904250f77a812ab3b2efe15",
    ),
    "BSD-2-Clause": (
        "a56fee4b2f66331ed54da4950ef9c9391453fd1490b4d8ea202bc29683bcbd30",
        "986c3c3199a93b916c8f2e0aeed57819bcbdcb2cd9d99902dcc9d74b53f93a74",
    ),
    "CC-BY-SA-4.0": (
        "6fd32d7fe30fa66c101714769c97e3e375bdf90cc19532508e2dfb4d98a92a9d",
    ),
    "OFL-1.1": (
        "a4915a2dcd67c648b73ad8364858cba28bbfb700e62ca5847e2c30544066e01a",
    ),
    "NCSA": (
        "bb6c44416437f5ab412ca9d762d4bdae1dc4e6a9c5afc9ac0965eb5e57b4e055",
    ),
    "Unlicense": (
        "fd1b07be5f4f94926b6ea4df3943b05ab90c1a1f3b1a3d574ae7ab58bca58fff",
    ),
}
# Lines of customary headers that name one licence.
HEADERS = {
    "Apache-2.0": ('Licensed under the Apache License, Version 2.0 (the "License");', "Licensed under the Apache License, Version 2.0 (the License);"),
    "MPL-2.0": ("License, v. 2.0. If a copy of the MPL was not distributed with this",),
} | {name: (f"SPDX-License-Identifier: {name}",) for name in (*DIGESTS, "MIT", "ISC", "0BSD") if name not in ("Apache-2.0", "MPL-2.0")}
HEADERS = HEADERS | {name: (*HEADERS[name], f"SPDX-License-Identifier: {name}") for name in ("Apache-2.0", "MPL-2.0")}

# Spellings that count as one (after lower-casing).
SPELLINGS = (
    ("licence", "license"),
    ("licenced", "licensed"),
    ("merchantibility", "merchantability"),
    ("noninfringment", "noninfringement"),
    ("non infringement", "noninfringement"),
    ("organisation", "organization"),
    ("favour", "favor"),
    ("copyright owner", "copyright holder"),
    ("http", "https"),
)
COPYRIGHT_LINE = r"(?m)^[^a-z0-9\n]*(copyright|\(c\)|©)[^\n]*([0-9]{4}|\(c\)|©)[^\n]*$|(?m)^[^a-z0-9\n]*all rights reserved[^a-z0-9\n]*$"


def canonical(text: Column) -> Column:
    out = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), COPYRIGHT_LINE, " ")
    out = F.trim(F.regexp_replace(out, r"[^\p{L}\p{N}]+", " "))
    padded = F.concat(F.lit(" "), out, F.lit(" "))
    for a, b in SPELLINGS:
        for _ in range(2):  # of two next to each other, which share a space, the second time takes the other
            padded = F.replace(padded, F.lit(f" {a} "), F.lit(f" {b} "))
    return F.trim(padded)


def digest(text: Column) -> Column:
    return F.sha2(canonical(text), 256)


def known_digests(spark: SparkSession, known: dict = KNOWN) -> DataFrame:
    """(digest, license_id) of ``known``, HEADERS and DIGESTS: a table of fixed length, which bounds what is broadcast."""
    rows = [(name, text) for texts_of in (known, HEADERS) for name, texts in texts_of.items() for text in texts]
    table = spark.createDataFrame(rows, "license_id string, text string")
    whole = spark.createDataFrame([(d, name) for name, ds in DIGESTS.items() for d in ds], "digest string, license_id string")
    return table.select(digest(F.col("text")).alias("digest"), "license_id").unionByName(whole).groupBy("digest").agg(F.min("license_id").alias("license_id"))


def license_scan(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", known: dict = KNOWN) -> DataFrame:
    """One row per input row: digest of the whole text, license_id (null if unknown), notice_ids.

    notice_ids has the ids of the lines that are known notices, sorted, comma-joined."""
    spark = df.sparkSession
    table = known_digests(spark, known)
    pairs = [(r["digest"], r["license_id"]) for r in table.collect()]  # of fixed length
    lookup = F.create_map(*[F.lit(x) for pair in pairs for x in pair])
    lines = F.filter(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n"), lambda x: F.lower(x).rlike("licen[cs]e"))
    found = F.array_distinct(F.array_compact(F.transform(lines, lambda x: F.element_at(lookup, digest(x)))))
    rows = df.select(F.col(id_col), digest(F.col(text_col)).alias("digest"), F.array_join(F.array_sort(found), ",").alias("notice_ids"))
    return rows.join(F.broadcast(table), "digest", "left").select(id_col, "digest", "license_id", "notice_ids")
