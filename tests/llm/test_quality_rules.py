import re

from pyspark.sql import functions as F

from cardamom.llm.quality_rules import Rule, quality_rules

WORD = r"[^\x20\x09-\x0D]+"


def brute(text):
    text = text or ""
    w = re.findall(WORD, text)
    seen = {}
    for i in range(len(w) - 7):
        seen.setdefault(tuple(w[i : i + 8]), []).append(i)
    covered = {k for at in seen.values() if len(at) > 1 for i in at for k in range(i, i + 8)}
    lines, dup = set(), 0
    for x in text.split("\n"):
        if re.search(WORD, x):
            dup += x in lines
            lines.add(x)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


TEXTS = [None, "", " \n\t ", "a", "a b\n a b\na b\n", "é ü x #*|", "w " * 9, "one two three four five six seven eight nine " * 3, "x y z\x0bq\r\n" * 30, "same line\nsame line \nsame line", " ".join(f"w{i % 50}" for i in range(3000))]


def test_counts_match_brute_force(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in quality_rules(df).collect()}
    assert got == {k: brute(t) for k, t in enumerate(TEXTS)}


def test_verdicts(spark):
    clean = "The cat sat on the mat and it was warm. We saw that this is a house for all of them with a red door by the sea."
    rows = [(0, clean), (1, clean.replace(" ", "*** ")), (2, clean.replace(" ", " | ")), (3, "too short"), (4, clean.upper().replace(" ", "!! ")), (5, "spam " * 50), (5, clean)]
    out = quality_rules(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [r["kept"] for r in out] == [True, False, False, False, False, False, True]
    assert out[1]["broken_rules"] == ["symbols"] and out[4]["broken_rules"] == ["shouting"]
    assert out[3]["base_failed"] and not out[1]["base_failed"]


def test_repeated_rows_and_very_long_texts(spark):
    rows = [(1, "a b c"), (1, "a b c"), (1, "d"), (None, "a"), (2, " ".join(f"w{i}" for i in range(60_000)))]
    got = sorted((r["doc_id"] or 0, r["n_words"]) for r in quality_rules(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [(0, 1), (1, 1), (1, 3), (1, 3), (2, 60_000)]


def test_other_columns_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "a b", 7, True)], "doc_id long, text string, n_words int, kept boolean")
    assert quality_rules(df).columns.count("kept") == 1
    assert quality_rules(df.limit(0)).count() == 0
    assert quality_rules(df, rules=(Rule("none", "n_words", "<", 5.0, 0),)).first()["broken_rules"] == ["none"]


def test_plan_has_no_python(spark):
    plan = quality_rules(spark.range(1).select(F.col("id").alias("doc_id"), F.lit("a").alias("text")))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
