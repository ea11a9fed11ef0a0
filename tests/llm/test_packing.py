import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from cardamom.llm.packing import Packer, WordEncoder, pack, powers

tokenizers = pytest.importorskip("public_tokenizers")
PATH = tokenizers.path("word_bpe_49k.json")


def test_encoder_is_the_tokenizer():
    encode = WordEncoder(PATH)
    rng = random.Random(1)
    parts = [*"abcXYZ019  \n\t'’.,!-sStTrRéÉσΣςİḰ̈K  \x0b\x1c\x85<|>", "'s", "'LL", "<|endoftext|>", "<|ENDOFTEXT|>", "...", "日本", "😀", "ß", "ẞ", "é"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 25))) for _ in range(1500)]
    texts += [t.replace("<|", "") for t in texts]
    for t in texts:
        ids, ends = encode(pa.array([t]))
        assert ids.tolist() == encode.tokenizer.encode(t, add_special_tokens=False).ids, t
    ids, ends = encode(pa.array([None, "a b", ""]))
    assert list(ends) == [0, 0, 2, 2]


def check(rows, texts, length=2048):
    """Every id in one piece; sequences gapless, full or a power of two."""
    encode = WordEncoder(PATH)
    docs = {}
    for i, t in texts:
        docs.setdefault(i, []).append(np.append(encode.tokenizer.encode(t or "", add_special_tokens=False).ids, 1).astype("<u4"))
    by_seq, by_doc = {}, {}
    for r in rows:
        by_seq.setdefault(r["sequence_id"], []).append(r)
        by_doc.setdefault(r["doc_id"], []).append(r)
    for pieces in by_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at == length or (at < length and at & (at - 1) == 0)
    assert set(by_doc) == set(docs)
    for i, pieces in by_doc.items():
        want = docs[i]
        assert sum(r["length"] for r in pieces) == sum(map(len, want))
        for r in pieces:
            assert any(r["doc_tokens"] == len(w) and zlib.crc32(w[r["start"] : r["start"] + r["length"]].tobytes()) == zlib.crc32(r["ids"]) for w in want)


def test_pack(spark):
    rng = random.Random(2)
    texts = [(k, " ".join(rng.choices(["alpha", "Beta.", "gamma,"], k=rng.choice([0, 1, 5, 300, 3000])))) for k in range(60)]
    texts += [(100, None), (101, ""), (3, texts[3][1]), (102, "word " * 20_000)]
    df = spark.createDataFrame([(i, t, "c") for i, t in texts], "doc_id long, text string, sequence_id string").repartition(5)
    check(pack(df, PATH).collect(), texts)
    check(pack(df, PATH, length=64, open_windows=2).collect(), texts, 64)
    assert pack(df.limit(0), PATH).count() == 0


def test_packer_is_bounded_and_full():
    p = Packer(16, 3, 0)
    rng = random.Random(3)
    total = 0
    for k in range(500):
        n = rng.randint(1, 40)
        total += n
        p.add(k, b"\0\0\0\0" * n)
        assert len(p.windows) <= 3
    p.close()
    full = {}
    for row in p.out:
        full.setdefault(row[4], [0, row[7]])[0] += row[2]
    assert sum(n for n, _ in full.values()) == total
    assert all(n == 16 for n, is_open in full.values() if not is_open) and sum(is_open for _, is_open in full.values()) <= 1
    q = Packer(16, 3, 0)
    powers([(1, 0, b"\0" * 44, 11), (2, 0, b"\0" * 8, 2)], q)
    sizes = {}
    for row in q.out:
        sizes[row[4]] = sizes.get(row[4], 0) + row[2]
    assert sorted(sizes.values()) == [1, 4, 8]
