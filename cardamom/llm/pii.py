"""Personal data: patterns of fixed kinds, and what bootstrapped contexts find besides.

Base entities (email, ip, card, phone) are the seeds. A lexical pattern is the word
before an entity: the label before "=" or ":" in its own token, or else the nearest
earlier word with a letter. Spark holds the graph of patterns and instances and scores
it in rounds until nothing is added: a pattern's confidence is the summed score of its
instances over all occurrences of its word in the corpus; an instance's score is the best
confidence of a trusted pattern, and found instances make further patterns trusted as
seeds do. Instances that stand after trusted patterns become spans of kind "id": tokens
with digits, and digit groups that single blanks join (of any length, but those of fewer
than 6 characters or 3 digits are no evidence for a pattern).

Offsets are code points, ends exclusive. Null text is empty. Repeated rows each get
a row. An empty table gives an empty result. Columns besides id and text do not matter."""

from __future__ import annotations

import bisect
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardamom.llm._common import Staged, at_most, free, tasks_for
from cardamom.llm.packing import chunks

KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGIT_TOKEN = re.compile(r"[0-9][^ \t-\r]*")
BLANK = " \t\n\x0b\x0c\r"
LABEL_START = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz_")
LABEL_CHARS = LABEL_START | frozenset("0123456789.-")
WORD = re.compile(r"[^ \t-\r]+")
QUOTES = "\"'"
#: Longer patterns are known by their digest.
LONG_PATTERN = 64
#: Blank-separated groups of digits, and of capitals between them, may be pieces of one instance.
PIECE = re.compile(r"[+(]?[0-9A-Z][0-9A-Z().+/-]*")
#: Not a label: groups of hexadecimal digits with colons.
HEX_GROUPS = re.compile(r"(?:[0-9A-Fa-f]{0,4}:){2}")
#: Shorter values stand in too many contexts to teach a pattern; they are found like any other.
LEAST_CHARS, LEAST_DIGITS = 6, 3


def _emails(text: str) -> Iterator[tuple[int, int]]:
    end = 0
    for m in DOMAIN.finditer(text):
        start = m.start()
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        if start < m.start():
            end = m.end()
            yield start, end


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind as in KINDS, then start."""
    out = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    if not re.search("[0-9]", text):
        return out
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(map(_small, m.group().split(".")))]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m.group().replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= sum("0" <= c <= "9" for c in m.group()) <= 15:
                out.append(("phone", *m.span()))
    return out


def _pattern(word: str) -> str:
    """A word or label as a lexical pattern."""
    word = word.strip(QUOTES)
    return word.lower() if len(word) <= LONG_PATTERN else "#" + hashlib.sha256(word.casefold().encode("utf-8", "surrogatepass")).hexdigest()


class Before:
    """The lexical patterns before positions of a text: a label or word with a letter, up to three words back.

    The digest of what stands in a long word before a position goes on from that of an earlier position."""

    def __init__(self, text: str):
        self.text, self.starts, self.long = text, None, (-1, 0, None, False)

    def __call__(self, start: int) -> str | None:
        text, end = self.text, start
        for _ in range(3):
            while end and text[end - 1] in BLANK:
                end -= 1
            if not end:
                return None
            at = end - 1
            while at and text[at - 1] not in BLANK and end - at <= LONG_PATTERN:
                at -= 1
            if end - at <= LONG_PATTERN:
                if any(c.isalpha() for c in text[at:end]):
                    return _pattern(text[at:end])
            else:
                at = self._word_start(end)
                if found := self._digest(at, end):
                    return found
            end = at
        return None

    def _word_start(self, end: int) -> int:
        if self.starts is None:
            self.starts = [m.start() for m in WORD.finditer(self.text)]
        return self.starts[bisect.bisect_left(self.starts, end) - 1]

    def _digest(self, at: int, end: int) -> str | None:
        text = self.text
        while at < end and text[at] in QUOTES:
            at += 1
        while end > at and text[end - 1] in QUOTES:
            end -= 1
        if end - at <= LONG_PATTERN:
            return _pattern(text[at:end]) if any(c.isalpha() for c in text[at:end]) else None
        key, upto, digest, letters = self.long
        if key != at or upto > end:
            upto, digest, letters = at, hashlib.sha256(), False
        new = text[upto:end]
        digest.update(new.casefold().encode("utf-8", "surrogatepass"))
        letters = letters or any(c.isalpha() for c in new)
        self.long = (at, end, digest, letters)
        return "#" + digest.hexdigest() if letters else None


def _label(token: str) -> tuple[str, int] | None:
    """(pattern of the label, its end) of a token with a label glued to its value by "=" or ":"."""
    at = {c: token.find(c) for c in "=:"}
    for c, cut in sorted(at.items(), key=lambda x: x[1]):
        if cut < 0:
            continue
        start = cut
        while start and token[start - 1] in LABEL_CHARS:
            start -= 1
        while start < cut and token[start] not in LABEL_START:
            start += 1
        # A colon also stands within values: its label starts the token.
        if start < cut and (c == "=" or (not token[:start].strip("\"'([{<") and not HEX_GROUPS.match(token))):
            return _pattern(token[start : cut + 1]), cut + 1
    return None


def _bare(text: str, a: int, b: int) -> tuple[int, int]:
    while a < b and text[a] in "\"'([{<":
        a += 1
    while b > a and text[b - 1] in "\"')]}>.,;:!?":
        b -= 1
    return a, b


def _run(text: str, a: int, end: int, stop: int) -> int:
    """Where the instance ends that begins with the token [a, end): the last digit group of those joined by single blanks."""
    last = at = end
    if not PIECE.fullmatch(text, a, end):
        return end
    while at < stop and text[at : at + 1] in (" ", "\t") and text[at - 1] not in ".,;:!?":
        m = PIECE.match(text, at + 1, stop)
        if not m:
            break
        to = m.end()
        tail = text[to : to + 1]
        if tail and tail not in BLANK:
            closing = _closes(text, to)
            if closing and any("0" <= c <= "9" for c in m.group()):
                last = to
            break
        at = to
        if any("0" <= c <= "9" for c in m.group()):
            last = at
    return last


def _closes(text: str, at: int) -> bool:
    """Whether only closing marks stand from here to the end of the token."""
    while at < len(text) and text[at] in "\"')]}>.,;:!?":
        at += 1
    return at == len(text) or text[at] in BLANK


def mentions(text: str, spans: list[tuple[str, int, int]]) -> list[tuple[int, int, str, str, bool]]:
    """(start, end, value, pattern, is seed) of the base spans and of other instances with digits.

    An instance is a token, or digit groups that single blanks join."""
    out, taken, before = [], sorted((a, b) for _, a, b in spans), Before(text)
    for _, a, b in spans:
        if p := before(a):
            out.append((a, b, text[a:b].lower(), p, True))
    k = done = 0
    for m in DIGIT_TOKEN.finditer(text):
        a, b = m.span()
        if a < done:
            continue
        while a and text[a - 1] not in BLANK:
            a -= 1
        pattern = None
        if label := _label(text[a:b]):
            pattern, a = label[0], a + label[1]
        while k < len(taken) and taken[k][1] <= a:
            k += 1
        a, end = _bare(text, a, b)
        if a == end or (k < len(taken) and taken[k][0] < end):
            continue
        if end == b or text[end:b] == ")":
            end = _run(text, a, b, taken[k][0] if k < len(taken) else len(text))
        a, b = _bare(text, a, end)
        done = b
        if pattern := pattern or before(a):
            out.append((a, b, text[a:b].lower(), pattern, False))
    return out


SPAN = "struct<kind:string,start:int,end:int>"
FOUND = f"row_key binary, doc_id long, spans array<{SPAN}>, mentions array<struct<start:int,end:int,value:string,pattern:string,seed:boolean>>"
_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
_MENTION = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("value", pa.string()), ("pattern", pa.string()), ("seed", pa.bool_())]))


def _row_key(id_col: str, text_col: str) -> Column:
    """128 bits that tell rows of different id or text apart; rows alike in both have the same spans."""
    return F.unhex(F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit("\0"), F.coalesce(F.col(text_col), F.lit("")))))


def _find(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    names = ("start", "end", "value", "pattern", "seed")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, ments = [], []
            for x in batch.column(2):
                text = x.as_py() or ""
                own = base_spans(text)
                spans.append([{"kind": k, "start": a, "end": b} for k, a, b in own])
                ments.append([dict(zip(names, m, strict=True)) for m in mentions(text, own)])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(spans, _SPAN), pa.array(ments, _MENTION)], names=["row_key", "doc_id", "spans", "mentions"])

    rows = df.select(_row_key(id_col, text_col).alias("row_key"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, FOUND)


BITS = 22


def _word_counts(df: DataFrame, text_col: str, patterns: DataFrame) -> DataFrame:
    """(pattern, total): how often each pattern's word stands in the corpus.

    Words are first held against a filter of 2**22 bits (512 KB, whatever the number
    of patterns); the few that pass are summed and joined exactly."""
    bit = F.xxhash64("pattern").bitwiseAND((1 << BITS) - 1)
    slots = patterns.select(F.shiftright(bit, 5).alias("slot"), F.expr("shiftleft(1L, cast(xxhash64(pattern) & 31 as int))").alias("one")).groupBy("slot").agg(F.bit_or("one").alias("bits")).collect()
    table = np.zeros(1 << (BITS - 5), np.uint64)
    for r in slots:  # 131,072 at most
        table[r["slot"]] = r["bits"]
    bitmap = df.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        h, held = xxhash.xxh64_intdigest, bitmap.value.tolist()
        mask = (1 << BITS) - 1
        for batch in (x for whole in batches for x in chunks(whole, 0)):
            text = pc.fill_null(batch.column(0).cast(pa.large_string()), "")
            words = pc.split_pattern(pc.replace_substring_regex(text, pattern=r"[\t-\r]", replacement=" "), " ").flatten()
            counted = words.value_counts()
            sums: dict[str, int] = {}
            for w, n in zip(counted.field(0).to_pylist(), counted.field(1).to_pylist(), strict=True):
                bare, w = w.strip("\"'"), _pattern(w)
                x = h(w, 42) & mask
                if held[x >> 5] >> (x & 31) & 1:
                    sums[w] = sums.get(w, 0) + n
                if ("=" in bare or ":" in bare[:-1]) and (label := _label(bare)) and label[0] != w:
                    sums[label[0]] = sums.get(label[0], 0) + n
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array(list(sums.values()), pa.int64())], names=["pattern", "n"])

    return df.select(F.col(text_col).alias("text")).mapInArrow(run, "pattern string, n long").groupBy("pattern").agg(F.sum("n").alias("total"))


def trusted_patterns(df: DataFrame, found: DataFrame, text_col: str, *, support: int = 3, confidence: float = 0.5) -> DataFrame:
    """(pattern, confidence) of the patterns that scoring over the graph trusts, seeds and found values alike as evidence.

    Scores only rise, so rounds end: when none adds a pattern and all confidences together move by less than 1e-6."""
    tasks = tasks_for(df)
    each = found.select("row_key", F.explode("mentions").alias("m")).select("m.*")
    firm = (F.length("value") >= LEAST_CHARS) & (F.length(F.regexp_replace("value", "[^0-9]", "")) >= LEAST_DIGITS)
    graph = Staged(at_most(each.filter(F.col("seed") | firm).groupBy("pattern", "value").agg(F.max("seed").alias("seed"), F.count("*").alias("n")), tasks), "pii-graph").read()
    # A pattern of fewer values is never trusted; all others are counted in one pass, as any round may reach them.
    wide = graph.groupBy("pattern").agg(F.count("*").alias("kinds")).filter(F.col("kinds") >= support).select("pattern")
    totals = Staged(at_most(_word_counts(df, text_col, wide).join(wide, "pattern", "left_semi"), tasks), "pii-totals").read()
    seeds = graph.groupBy("value").agg(F.max(F.col("seed").cast("double")).alias("seed"))
    edges = Staged(at_most(graph.drop("seed").join(totals, "pattern").join(seeds, "value"), tasks), "pii-edges").read()
    good, state = None, None
    while True:
        if good is None:
            scored = edges.withColumn("score", F.col("seed"))
        else:
            lifted = edges.join(good.read(), "pattern").groupBy("value").agg(F.max("confidence").alias("lift"))
            scored = edges.join(lifted, "value", "left").withColumn("score", F.greatest("seed", F.coalesce("lift", F.lit(0.0))))
        weight = F.sum(F.col("n") * F.col("score")) / F.greatest(F.max("total"), F.sum("n"))
        new = scored.groupBy("pattern").agg(weight.alias("confidence"), F.sum((F.col("score") >= confidence).cast("long")).alias("held"))
        good = Staged(at_most(new.filter((F.col("held") >= support) & (F.col("confidence") >= confidence)).select("pattern", "confidence"), tasks), "pii-trusted")
        row = good.read().agg(F.count("*").alias("n"), F.sum("confidence").alias("s")).first()
        now = (row["n"], row["s"] or 0.0)
        if not now[0] or (state and now[0] == state[0] and now[1] - state[1] < 1e-6):
            return good.read()
        state = now


def find_pii(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **scoring) -> DataFrame:
    """One row per input row: row_key, doc_id, base_spans and added_spans (arrays of kind, start, end)."""
    found = Staged(_find(df, id_col, text_col), "pii-found").read()
    good = trusted_patterns(df, found, text_col, **scoring)
    each = found.select("row_key", F.explode("mentions").alias("m")).filter("not m.seed")
    hits = each.join(good, each["m.pattern"] == good["pattern"], "left_semi").select("row_key", F.struct(F.lit("id").alias("kind"), F.col("m.start").alias("start"), F.col("m.end").alias("end")).alias("span"))
    added = hits.groupBy("row_key").agg(F.array_sort(F.collect_set("span")).alias("added_spans"))
    none = F.array().cast(f"array<{SPAN}>")
    return found.select("row_key", "doc_id", F.col("spans").alias("base_spans")).join(added, "row_key", "left").withColumn("added_spans", F.coalesce("added_spans", none))


def span_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **scoring) -> DataFrame:
    """The input with each span of ``text_col`` replaced by its kind in angle brackets."""
    found = find_pii(df, id_col=id_col, text_col=text_col, **scoring)
    key, row, spans = (free(df, c) for c in ("_pii_key", "_pii_row", "_pii_spans"))
    hit = found.filter((F.size("base_spans") > 0) | (F.size("added_spans") > 0)).groupBy(F.col("row_key").alias(row)).agg(F.first(F.concat("base_spans", "added_spans")).alias(spans))
    rows = df.withColumn(key, _row_key(id_col, text_col)).join(hit, F.col(key) == F.col(row), "left")
    # Spans may overlap: those that begin inside an earlier one only widen it.
    by_place = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("longest_first"), s["end"].alias("end"), s["kind"].alias("kind"))))
    step = lambda a, s: F.struct(
        F.when(s["start"] >= a["at"], F.concat(a["out"], F.substring(F.col(text_col), a["at"] + 1, s["start"] - a["at"]), F.lit("<"), F.upper(s["kind"]), F.lit(">"))).otherwise(a["out"]).alias("out"),
        F.greatest(a["at"], s["end"]).alias("at"),
    )
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    done = F.aggregate(by_place, start, step, lambda a: F.concat(a["out"], F.substring(F.col(text_col), a["at"] + 1, F.length(F.col(text_col)))))
    return rows.withColumn(text_col, F.when(F.col(spans).isNull(), F.col(text_col)).otherwise(done)).select(*df.columns)
