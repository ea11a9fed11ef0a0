"""Quality rules: a threshold table compiled into one projection (built-in functions only).

Null text counts as empty. An empty table gives an empty result. Repeated rows
are judged one by one. Other columns of the input do not matter."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardamom.llm._common import SPACE, SPACES, let

SYMBOLS = "#*$%&|<>"
WINDOW = 8

# The commonest function words of the four languages of the corpus.
STOP_WORDS = (
    "the of and to in a is that it for on was with as by this be are or an "
    "le la les de des et un une en que est dans pour par sur "
    "der die das und ist den dem von zu mit sich nicht ein eine im auf "
    "el los las y del al por con para su se no"
).split()


@dataclass(frozen=True)
class Rule:
    """A document breaks the rule if ``metric`` is ``op`` ``limit`` and it has ``min_words``."""

    name: str
    metric: str
    op: str
    limit: float
    min_words: int = 20


#: The threshold table. A ratio whose denominator is 0 is 0.
RULES = (
    Rule("short_words", "mean_word_chars", "<", 2.0),
    Rule("long_words", "mean_word_chars", ">", 18.0),
    Rule("symbols", "symbol_ratio", ">", 0.1),
    Rule("shouting", "exclaim_ratio", ">", 0.3),
    Rule("bars", "bar_ratio", ">", 0.1),
    Rule("repeated_lines", "dup_line_ratio", ">", 0.35),
    Rule("bullets", "bullet_line_ratio", ">", 0.9, 50),
    Rule("ellipses", "ellipsis_line_ratio", ">", 0.3, 50),
    Rule("few_letters", "letter_word_ratio", "<", 0.5),
    Rule("no_stop_words", "n_stop_words", "<", 1.0, 200),
)


def _count(array: Column, keep) -> Column:
    return F.size(F.filter(array, keep)).cast("long")


def repeat_words(words: Column) -> Column:
    """Words in windows of 8 that stand twice or more in the text.

    Windows are compared by a 64-bit hash of eight 64-bit word hashes."""
    hashed = F.transform(words, lambda w: F.xxhash64(w))

    def windows(h: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(h) - WINDOW)
        return F.transform(at, lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)]))

    def covered(keys: Column) -> Column:
        pairs = F.array_sort(F.transform(keys, lambda k, i: F.struct(k.alias("k"), i.alias("i"))))

        def starts(s: Column) -> Column:
            again = lambda p, i: F.coalesce(p["k"] == F.get(s, i - 1)["k"], F.lit(False)) | F.coalesce(p["k"] == F.get(s, i + 1)["k"], F.lit(False))
            return F.array_sort(F.transform(F.filter(s, again), lambda p: p["i"]))

        def union(p: Column) -> Column:
            gaps = F.transform(p, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(p, i + 1) - x, F.lit(WINDOW))).cast("long"))
            return F.aggregate(gaps, F.lit(0).cast("long"), lambda a, b: a + b)

        return let(let(pairs, starts), union)

    none = F.lit(0).cast("long")
    counted = let(let(hashed, windows), lambda k: F.when(F.size(F.array_distinct(k)) == F.size(k), none).otherwise(covered(k)))
    return F.when(F.size(words) <= WINDOW, none).otherwise(counted)


def metrics(text: Column) -> Column:
    """A struct of all the counts and ratios that a rule may name."""
    text = F.coalesce(text, F.lit(""))
    bare = F.btrim(text, F.lit(SPACE))

    def of(words: Column) -> Column:
        lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != "")
        n_symbols = F.length(bare) - F.length(F.translate(bare, SYMBOLS, ""))
        counts = F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            n_symbols.cast("long").alias("n_symbols"),
            let(lines, lambda x: F.struct(
                F.size(x).cast("long").alias("n_lines"),
                (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
                _count(x, lambda y: F.substring(F.ltrim(y), 1, 1).isin("-", "*", "•")).alias("n_bullet_lines"),
                _count(x, lambda y: F.endswith(y, F.lit("...")) | F.endswith(y, F.lit("…"))).alias("n_ellipsis_lines"),
            )).alias("lines"),
            repeat_words(words).alias("n_repeat_words"),
            _count(words, lambda w: F.lower(w).isin(STOP_WORDS)).alias("n_stop_words"),
            _count(words, lambda w: F.endswith(w, F.lit("!!"))).alias("n_exclaims"),
            _count(words, lambda w: w == "|").alias("n_bars"),
            _count(words, lambda w: w.rlike(r"\p{L}")).alias("n_letter_words"),
        )
        return let(counts, ratios)

    def ratios(c: Column) -> Column:
        over = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))
        n, lines = c["n_words"], c["lines"]
        return F.struct(
            *[c[k].alias(k) for k in ("n_words", "word_chars", "n_symbols")],
            lines["n_dup_lines"].alias("n_dup_lines"),
            c["n_repeat_words"].alias("n_repeat_words"),
            c["n_stop_words"].alias("n_stop_words"),
            over(c["word_chars"], n).alias("mean_word_chars"),
            over(c["n_symbols"], c["word_chars"]).alias("symbol_ratio"),
            over(c["n_exclaims"], n).alias("exclaim_ratio"),
            over(c["n_bars"], n).alias("bar_ratio"),
            over(lines["n_dup_lines"], lines["n_lines"]).alias("dup_line_ratio"),
            over(lines["n_bullet_lines"], lines["n_lines"]).alias("bullet_line_ratio"),
            over(lines["n_ellipsis_lines"], lines["n_lines"]).alias("ellipsis_line_ratio"),
            over(c["n_letter_words"], n).alias("letter_word_ratio"),
            ((n < 20) | (100 * c["n_repeat_words"] > 30 * n)).alias("base_failed"),
        )

    words = F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACES))
    return let(words, of)


def broken(m: Column, rules=RULES) -> Column:
    """Names of the rules that the metrics break, in the table's order."""
    tests = {"<": lambda a, b: a < b, ">": lambda a, b: a > b}
    hits = [F.when((m["n_words"] >= r.min_words) & tests[r.op](m[r.metric], F.lit(r.limit)), F.lit(r.name)) for r in rules]
    return F.array_compact(F.array(*hits)) if hits else F.array().cast("array<string>")


def quality_rules(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", rules=RULES) -> DataFrame:
    """One row per input row: its metrics, ``base_failed``, ``broken_rules`` and ``kept``."""
    m = metrics(F.col(text_col))
    judged = let(m, lambda x: F.struct(x.alias("m"), broken(x, rules).alias("broken_rules")))
    out = df.select(F.col(id_col), judged.alias("j")).select(id_col, "j.m.*", "j.broken_rules")
    return out.withColumn("kept", ~F.col("base_failed") & (F.size("broken_rules") == 0))
