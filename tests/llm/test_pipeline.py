import collections
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from test_pii import brute
from test_quality_model import perplexity, plain_model, quantile
from test_simhash import jaccard_groups
from tokenizers import Tokenizer

import corpus_pipeline as C
from cardamom.llm.mixing import targets
from cardamom.llm.quality_classifier import class_table


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(9)
    words = ["".join(rng.choices("etaoinshr", k=rng.randint(2, 7))) for _ in range(400)]
    text = lambda: " ".join(rng.choices(words, k=80)).capitalize() + "."
    mail = lambda k: f" mail me.{k}@mail.example.com now" if k % 4 == 0 else ""
    rows = [(k, text() + mail(k), "en", f"s{k % 3}", 0) for k in range(300)]
    rows += [(1000 + k, rows[k][1], "en", "s0", 0) for k in range(20)]
    rows += [(2000 + k, text().replace(" ", "*** "), "en", "s1", 0) for k in range(20)]
    rows += [(3000, text() + " mail me.x@mail.example.com now", "en", None, 0), (None, text(), None, "s1", 0), (3001, None, "en", "s2", 0), (1, rows[1][1], "en", "s1", 0)]
    top = tmp_path_factory.mktemp("sf")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{top}/documents.parquet")
    spark.createDataFrame([(k, 1, 0) for k in range(0, 300, 2)] + [(2000, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{top}/labels.parquet")
    return str(top)


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names, kept = docs.columns, {}
    for name, stage in C.STAGES:
        docs = stage(spark, docs, folder).cache()
        kept[name] = docs.collect()
        if name != "packing":
            assert docs.columns == names
    ids = {n: [r["doc_id"] for r in rows] for n, rows in kept.items()}
    assert not [i for i in ids["quality"] if i is not None and 2000 <= i < 3000] and set(range(300)) <= set(ids["quality"])
    dup = ids["near_duplicates"]
    assert not [i for i in dup if i is not None and 1000 <= i < 2000] and dup.count(1) == 1 and dup.count(None) == 1
    mail = next(r for r in kept["personal_data"] if r["doc_id"] == 3000)
    assert "<EMAIL>" in mail["text"] and "@" not in mail["text"] and mail["n_chars"] == len(mail["text"])
    assert max(ids["mixing"].count(i) for i in set(ids["mixing"])) <= 3
    assert set(ids["packing"]) == set(ids["mixing"])


def near_copies(rng, texts):
    """Copies with a few words changed, so that some are within the limit and some are not."""
    for k, t in enumerate(texts):
        w = t.split()
        for j in range(k % 6):
            w[(7 + 13 * j) % len(w)] = f"q{rng.randrange(10**6)}"
        yield " ".join(w)


def test_stages_match_brute_force(spark, folder, tmp_path):
    """Each stage on what its predecessor gave, with clashing columns."""
    rng = random.Random(4)
    base = spark.read.parquet(f"{folder}/documents.parquet").collect()
    rows = [tuple(r) for r in base]
    rows += [(4000 + k, t, "en", "s0", 0) for k, t in enumerate(near_copies(rng, [r["text"] for r in base[100:160]]))]
    rows += [(7, rows[50][1] + " other words under an id that is taken " + rows[51][1], "en", "s2", 0), (5000, "", "en", "s0", 0), (5001, "same words " * 300, "en", "s0", 0)]
    clash = {"_id": 5, "_quality_kept": "q", "_row": "r", "_copy": "c", "_pii_key": "p", "copies": 9}
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for c, v in clash.items():
        docs = docs.withColumn(c, F.lit(v))
    stages, columns = dict(C.STAGES), docs.columns
    key = lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "")

    def after(name, df):
        out = stages[name](spark, df, folder)
        assert name == "packing" or (out.columns == columns and all(r[c] == v for r in out.collect() for c, v in clash.items()))
        path = str(tmp_path / name)
        out.write.parquet(path)
        return spark.read.parquet(path)

    # quality: a plain model of dictionaries
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    good = {r["doc_id"] for r in labels.filter("quality = 1").collect()}
    seen = {r["doc_id"] for r in docs.filter(F.pmod(F.xxhash64("doc_id", F.lit(13)), F.lit(5)) > 0).select("doc_id").collect()}
    trusted = [r for r in rows if r[0] in good and r[1]]
    points = collections.Counter(ord(x) for r in trusted if r[0] in seen for x in r[1])
    table = class_table(sorted(points.items(), key=lambda x: (-x[1], x[0])))
    p = plain_model([r[1] for r in trusted if r[0] in seen], table)
    score = {t: perplexity(t, p, table) for t in {r[1] for r in rows if r[1]}}
    limit = quantile([score[r[1]] for r in trusted if r[0] not in seen], 0.999)
    kept = after("quality", docs)
    got = collections.Counter(map(key, kept.collect()))
    for r in docs.collect():
        s = score.get(r["text"])
        if s is None or abs(s / limit - 1) > 0.01:  # half precision decides what is closer
            assert (got[key(r)] > 0) == (s is None or s < limit)

    # near duplicates: all pairs, and the least of each group
    before = sorted(kept.collect(), key=key)
    group = jaccard_groups([(k, r["text"]) for k, r in enumerate(before)])
    want = sorted(key(before[k]) for k in set(group.values()))
    unlike = after("near_duplicates", kept)
    assert sorted(map(key, unlike.collect())) == want and len(want) < len(before) and (7, ) in {k[1:2] for k in want}

    # personal data: the plain patterns (no context here is trusted)
    def masked(t):
        at, out = 0, ""
        for kind, a, b in sorted(brute(t or ""), key=lambda s: (s[1], -s[2], s[0])):
            if a >= at:
                out += (t or "")[at:a] + f"<{kind.upper()}>"
            at = max(at, b)
        return out + (t or "")[at:]

    masked_docs = after("personal_data", unlike)
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "", r["n_chars"]) for r in masked_docs.collect())
    assert got == sorted((r["doc_id"] is None, r["doc_id"] or 0, masked(r["text"]), None if r["text"] is None else len(masked(r["text"]))) for r in unlike.collect())

    # mixing: as many copies as the rates of the dual say, in all
    mixed = after("mixing", masked_docs)
    copies = collections.Counter(map(key, mixed.collect()))
    size = lambda t: len((t or "").split())
    by_source = collections.defaultdict(list)
    for r in masked_docs.collect():
        assert copies[key(r)] <= 3
        by_source[r["source"]].append(r)
    goal = targets([(s, sum(size(r["text"]) for r in rs)) for s, rs in by_source.items()])
    for s, rs in by_source.items():
        assert abs(sum(copies[key(r)] * size(r["text"]) for r in rs) - goal[s]) <= max(2, 0.01 * goal[s])

    # packing: an exact round trip
    encode = Tokenizer.from_file(public_tokenizers.path(C.TOKENIZER))
    ids = lambda t: encode.encode(t or "", add_special_tokens=False).ids + [1]
    pieces = after("packing", mixed).collect()
    assert sum(r["length"] for r in pieces) == sum(len(ids(r["text"])) for r in mixed.collect())
    texts = collections.defaultdict(list)
    for r in mixed.collect():
        texts[r["doc_id"]].append(ids(r["text"]))
    for r in pieces:
        assert any(len(x) == r["doc_tokens"] and zlib.crc32(np.array(x[r["start"] : r["start"] + r["length"]], "<u4").tobytes()) == r["ids_crc32"] for x in texts[r["doc_id"]])
    sequences = collections.defaultdict(list)
    for r in pieces:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for s in sequences.values():
        at = 0
        for offset, n in sorted(s):
            assert offset == at
            at += n
        assert at <= 2048


def test_run_and_empty(spark, folder, tmp_path):
    assert C.run(spark, folder).agg(F.sum("length")).first()[0] > 0
    for t in ("documents", "labels"):
        spark.read.parquet(f"{folder}/{t}.parquet").limit(0).write.parquet(str(tmp_path / f"{t}.parquet"))
    assert C.run(spark, str(tmp_path)).count() == 0


def test_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))


def test_quality_learns_from_every_labelled_document(spark, tmp_path):
    """More labels than the 20,000 documents that were once drawn."""
    from unittest import mock

    from cardamom.llm import quality_classifier as Q

    docs = spark.range(30_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"), F.lit("en").alias("lang"))
    docs.select("doc_id", F.lit(1).alias("quality")).write.parquet(f"{tmp_path}/labels.parquet")
    held = []
    with mock.patch.object(Q, "train", lambda trusted, text_col, f=Q.train: held.append(trusted.count()) or f(trusted, text_col)):
        C.quality(spark, docs, str(tmp_path)).count()
    assert held == [docs.filter(F.pmod(F.xxhash64("doc_id", F.lit(13)), F.lit(5)) > 0).count()]
