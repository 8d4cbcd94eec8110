"""Quality rules as a short-circuit cascade of native expressions.

Each rule is a boolean Column that is true when it rejects a text.  On a
bounded sample every rule is timed alone and its rejections counted; the rules
then run as one CASE, ordered by rejections per second, so a text that an early
rule rejects never pays for the later ones.  The order changes the cost only:
the verdict is the conjunction of all rules.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import SPACE, count_words, free_prefix

SAMPLE_ROWS = 500      # texts that costs and rejections are estimated on, at most
SYMBOLS = "#*$%&|<>"


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is evaluated once per row."""
    return F.transform(F.array(value), body)[0]


def word_array(t: Column) -> Column:
    return F.array_remove(F.split(t, f"[{SPACE}]+", -1), "")


def symbol_count(t: Column) -> Column:
    return F.regexp_count(t, F.lit(f"[{SYMBOLS}]")).cast("long")


def line_counts(t: Column) -> Column:
    """struct(lines, dup): lines that hold a word; those equal to an earlier one."""
    lines = F.filter(F.split(t, "\n", -1), lambda x: F.rlike(x, F.lit(f"[^{SPACE}]")))
    return _let(lines, lambda a: F.struct(
        F.size(a).cast("long").alias("lines"),
        (F.size(a) - F.size(F.array_distinct(a))).cast("long").alias("dup")))


def repeated_words(w: Column) -> Column:
    """Words (of the array ``w``) inside three-word windows that occur twice or
    more in the text.

    A text whose windows' 64-bit hashes are all distinct has none.  Otherwise the
    windows are ordered by (hash, position); neighbours with equal hash are
    repeats, and the covered words are counted over the ordered positions.
    """
    windows = F.when(F.size(w) >= 4, F.transform(F.slice(w, 1, F.size(w) - 2), lambda x, i: F.xxhash64(
        x, F.get(w, i + 1), F.get(w, i + 2))))

    def repeats(s):
        return F.transform(F.filter(s, lambda x, i: (F.get(s, i + 1)["h"] == x["h"])
                                    | ((i > 0) & F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False)))),
                           lambda x: x["p"])

    def covered(h):
        ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p"))))
        return F.aggregate(
            _let(ordered, lambda s: F.sort_array(repeats(s))),
            F.struct(F.lit(0).cast("long").alias("n"), F.lit(-1).alias("end")),
            lambda acc, p: F.struct((acc["n"] + F.least(F.lit(3), p + 2 - acc["end"])).cast("long").alias("n"),
                                    (p + 2).alias("end")),
            lambda acc: acc["n"])

    zero = F.lit(0).cast("long")
    return _let(windows, lambda h: F.when(h.isNull() | (F.size(F.array_distinct(h)) == F.size(h)), zero).otherwise(covered(h)))


class Text:
    """Measures of a text column as expressions; a report hands its columns in
    (``known``), so that no measure is taken twice."""

    def __init__(self, t: Column, **known: Column):
        self.t, self.known = t, known

    def __getattr__(self, name: str) -> Column:
        return self.known[name] if name in self.known else getattr(self, "_" + name)()

    def _n_words(self):
        return count_words(self.t)

    def _word_chars(self):
        return F.length(F.array_join(word_array(self.t), "")).cast("long")

    def _n_symbols(self):
        return symbol_count(self.t)

    def _lines(self):
        return line_counts(self.t)

    def _n_repeat_words(self):
        return _let(word_array(self.t), repeated_words)

    def _n_lettered(self):
        return F.regexp_count(self.t, F.lit(rf"\p{{L}}[^{SPACE}]*"))

    def _n_capitals(self):
        return F.regexp_count(self.t, F.lit("[A-Z]"))


@dataclass(frozen=True)
class Rule:
    """``rejects``: Text -> boolean Column (true: the text goes)."""
    name: str
    rejects: object


BASE_RULES = (
    Rule("few_words", lambda m: m.n_words < 50),
    Rule("repeated_windows", lambda m: 100 * m.n_repeat_words > 50 * m.n_words),
)
#: Thresholds after the public quality rules of large web corpora.
METHOD_RULES = (
    Rule("symbols", lambda m: 10 * m.n_symbols > m.n_words),
    Rule("word_length", lambda m: (m.word_chars < 3 * m.n_words) | (m.word_chars > 10 * m.n_words)),
    Rule("duplicate_lines", lambda m: _let(m.lines, lambda x: 100 * x["dup"] > 40 * x["lines"])),
    Rule("few_letter_words", lambda m: 10 * m.n_lettered < 8 * m.n_words),
    Rule("capitals", lambda m: 10 * m.n_capitals > 4 * m.word_chars),
)
RULES = BASE_RULES + METHOD_RULES


def estimate(docs: DataFrame, rules=RULES, text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> list[dict]:
    """Cost (seconds) and rejections of each rule on at most ``sample_rows``
    texts; one scalar row per rule reaches the driver."""
    sample = docs.select(F.col(text_col).alias("t")).limit(sample_rows).persist()
    try:
        rows = sample.count()
        found = []
        for r in rules:
            began = time.perf_counter()
            hit = sample.agg(F.count(F.when(r.rejects(Text(F.coalesce("t", F.lit("")))), 1))).first()[0]
            found.append({"rule": r.name, "rows": rows, "rejected": hit, "seconds": time.perf_counter() - began})
        return found
    finally:
        sample.unpersist()


def order(rules, estimates: list[dict]) -> list:
    """Rules by rejections per second, best first (names break ties)."""
    by = {e["rule"]: e for e in estimates}
    return sorted(rules, key=lambda r: (-by[r.name]["rejected"] / max(by[r.name]["seconds"], 1e-6), r.name))


def first_failure(m: Text, rules) -> Column:
    """Name of the first rule that rejects the text, NULL if none does; later
    rules are not evaluated once one has rejected."""
    c = F.when(rules[0].rejects(m), F.lit(rules[0].name))
    for r in rules[1:]:
        c = c.when(r.rejects(m), F.lit(r.name))
    return c


def passes(docs: DataFrame, text_col: str = "text", rules=RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The documents that no rule rejects, all columns unchanged.

    NULL and empty texts have no words and go; equal rows share their fate.  Texts
    of any length are read whole; an empty table gives no rows; columns of any
    name are returned as they are.
    """
    ranked = order(rules, estimate(docs, rules, text_col, sample_rows))
    t = F.coalesce(F.col(text_col), F.lit(""))
    by_word = _let(word_array(t), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars")))
    # most rules are shares of the words: those are counted once, in front of the cascade
    name = free_prefix(docs) + "words"
    counted = docs.select("*", F.explode(F.array(by_word)).alias(name))
    known = Text(t, n_words=F.col(f"{name}.n_words"), word_chars=F.col(f"{name}.word_chars"))
    return counted.where(first_failure(known, ranked).isNull()).drop(name)


def quality_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row per document row: the counts, base_failed, kept and the method's
    rule that rejected it (NULL if none or if a base rule did already).

    NULL and empty texts count as no words (base_failed).  The base rules are
    counts of the report; the method's rules run as a cascade behind them.
    """
    ranked = order(METHOD_RULES, estimate(docs, METHOD_RULES, text_col, sample_rows))
    t = F.col("t")
    by_word = _let(word_array(t), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        repeated_words(w).alias("n_repeat_words")))
    counted = (docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
               .select("id", "t", by_word.alias("w"), line_counts(t).alias("lines"), symbol_count(t).alias("n_symbols"))
               .select("id", "t", "w.*", "n_symbols", "lines"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    known = Text(t, **{c: F.col(c) for c in ("n_words", "word_chars", "n_symbols", "lines")})
    return (counted.withColumn("base_failed", failed)
            .withColumn("rejected_by", F.when(~F.col("base_failed"), first_failure(known, ranked)))
            .select("id", "n_words", "word_chars", "n_symbols", F.col("lines.dup").alias("n_dup_lines"), "n_repeat_words",
                    "base_failed", (~F.col("base_failed") & F.col("rejected_by").isNull()).alias("kept"), "rejected_by"))
