import random
import re

import pytest

from cardamom.llm import pii as P

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute(t):
    out = [("email", *m.span()) for m in EMAIL.finditer(t)]
    out += [("ip", *m.span()) for m in IP.finditer(t) if all(int(x) <= 255 for x in m.group().split("."))]
    for m in CARD.finditer(t):
        d = re.sub("[ -]", "", m.group())
        if 16 <= len(d) <= 19 and P.luhn(d):
            out.append(("card", *m.span()))
    return out + [("phone", *m.span()) for m in PHONE.finditer(t) if 8 <= len(re.sub("[^0-9]", "", m.group())) <= 15]


def test_base_matches_the_plain_patterns():
    rng = random.Random(3)
    parts = [*"ab@@..-+ 1234567890()é%", "1.2.3.4", "4111111111111111", "+1 (555)", "000255."]
    for _ in range(20_000):
        t = "".join(rng.choices(parts, k=rng.randint(0, 24)))
        assert P.base_spans(t) == brute(t), t
        P.mentions(t, P.base_spans(t))


def test_long_runs_take_linear_time():
    for t in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "@" * 100_000, "+1" * 100_000, "a@b" * 60_000):
        P.mentions(t, P.base_spans(t))


@pytest.fixture(scope="module")
def rows():
    seeds = [(k, f"foo bar contact: +1 ({500 + k}) 555-1{k:03d} baz") for k in range(20)]
    plain = [(100 + k, f"in room 123-{k:04d}x he said in the {k:06d} house") for k in range(20)]
    seeds += [(200 + k, f"he is in a+{k}@mail.example.com and in town in may in june in july") for k in range(5)]
    return seeds + plain + [(50, "é contact: 555-0199x7 ok"), (51, None), (52, ""), (50, "é contact: 555-0199x7 ok"), (None, "x@y.zz")]


def test_contexts_find_unseen_identifiers(spark, rows):
    df = spark.createDataFrame([(i, t, "c") for i, t in rows], "doc_id long, text string, spans string")
    got = [(r["doc_id"], [(s["kind"], s["start"], s["end"]) for s in r["added_spans"]]) for r in P.find_pii(df).collect()]
    assert sorted((i, s) for i, s in got if s) == [(50, [("id", 11, 21)])] * 2  # and none after "in" or "room"
    assert len(got) == len(rows)
    assert P.find_pii(df.limit(0)).count() == 0


def test_redaction(spark, rows):
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, row_key int")
    out = P.redact(df)
    assert out.columns == df.columns
    got = [(r["doc_id"], r["text"]) for r in out.collect()]
    assert got.count((50, "é contact: <ID> ok")) == 2 and (None, "<EMAIL>") in got and (51, None) in got and (52, "") in got
    assert (3, "foo bar contact: <PHONE> baz") in got
    both = spark.createDataFrame([(1, "a 1.2.3.4@x.yy b")], "doc_id long, text string")  # an address within an address
    assert P.redact(both).first()["text"] == "a <EMAIL> b"


def test_found_values_teach_further_contexts(spark):
    """Values found after a seeded context make "badge" trusted, and those found there "locker" in turn."""
    rows = [(k, f"foo contact: +1 ({500 + k}) 555-1{k:03d} baz") for k in range(20)]
    rows += [(100 + k, f"bar contact: x-{k}88213 baz") for k in range(4)] + [(200 + k, f"bar badge x-{k}88213 baz") for k in range(4)]
    rows += [(300 + k, f"bar badge y-{k}77512 baz") for k in range(3)] + [(400 + k, f"bar locker y-{k}77512 baz") for k in range(3)]
    rows += [(500, "bar locker z-991827 baz"), (600, "bar room z-991828 baz")]
    got = {r["doc_id"]: len(r["added_spans"]) for r in P.find_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {i for i, n in got.items() if n} == {i for i, _ in rows if 100 <= i < 600}


def test_instances_of_several_groups_and_glued_labels(spark):
    rows = [(k, f"foo phone: +1 ({500 + k}) 555-1{k:03d} baz") for k in range(20)] + [(50 + k, f"foo phone:+1{5550000000 + k} baz") for k in range(9)]
    cases = ["555 123 4567", "078 05 1120", "GB29 NWBK 6016 1331", "4411", "(555) 123 4567", "00:1b:44:11:3a:b7"]
    rows += [(100 + k, f"bar phone: {c}, and 17 more") for k, c in enumerate(cases)] + [(200 + k, f"bar phone:{c} and 17 more") for k, c in enumerate(cases)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in P.redact(df).collect()}
    for k in range(len(cases)):
        assert got[100 + k].replace("(<", "<") == "bar phone: <ID>, and 17 more"
        assert got[200 + k].replace("(<", "<") == "bar phone:<ID> and 17 more"
    values = lambda t: [(v, p) for _, _, v, p, _ in P.mentions(t, P.base_spans(t))]
    assert values("at 2020-01-01T10:30 x") == [("2020-01-01t10:30", "at")]
    assert values("mac 00:1b:44:11:3a:b7 or aa:bb:cc:11:22:33 x") == [("00:1b:44:11:3a:b7", "mac"), ("aa:bb:cc:11:22:33", "or")]
    assert values("key 12 a 34") == [("12", "key"), ("34", "a")] and values("id 12. 34\n6") == [("12", "id"), ("34", "id"), ("6", "id")]


def test_long_labels_and_words_are_patterns(spark):
    """Of any length, each whole; in a long word the pattern of each place is what stands before it."""
    label, word = "x" * 200 + "=", "ü" * 90
    rows = [(k, f"foo {label}+1555{1000000 + k} baz") for k in range(6)] + [(100, f"bar {label}8821377 baz"), (101, f"bar y{label}8821377 baz"), (102, "a 8821377 " * 2000)]
    rows += [(200 + k, f"{word} 4{k}.2.3.4 and") for k in range(6)] + [(300, f"{word} 5551234 and"), (301, f"{word}ü 5551234 and")]
    got = {r["doc_id"]: len(r["added_spans"]) for r in P.find_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {i for i, n in got.items() if n} == {100, 300}
    text = "ab" * 50 + "1.2.3.4" + "cd" * 50 + "5.6.7.8"
    seen = P.Before(text)
    assert [seen(k) for k in (100, 207, 100, 207)] == [P._pattern(text[:k]) for k in (100, 207, 100, 207)]
    assert P.Before("a " + "7" * 100)(102) == "a" and P.Before("1" * 100)(100) is None
