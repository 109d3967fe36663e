"""Operator 7, quality rules: a threshold table compiled into one Spark projection, without any user function.

Measures of a whole text (words are ``[^\\x20\\x09-\\x0D]+``):

* base: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words;
* ratios for the table: symbols a word character, stop words a word, mean word length, lines that repeat.

``n_repeat_words`` counts the words that stand in a five-word window found twice or more: windows are compared by their
64-bit hash, and only a text with some window twice sorts its windows, so a text of n words costs n log n at most.

Defined cases: a null or empty text has no words, fails the base and is not kept; a ratio without a denominator is
null and breaks no rule; repeated rows and null ids are rows as any other; extra columns pass through ``kept_only``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .storage import table, unused

SPACES = r"[\x20\x09-\x0D]+"
WORDLESS = r"[^\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20

#: Frequent function words of four languages.
STOP_WORDS = (
    "the", "be", "to", "of", "and", "that", "have", "with", "a", "in", "is", "it", "for", "was", "on", "are", "as", "this", "by", "or",
    "der", "die", "das", "und", "zu", "den", "von", "mit", "sich", "des", "im", "für", "ist", "nicht", "ein", "eine", "auf", "als", "auch",
    "le", "la", "les", "de", "et", "un", "une", "du", "est", "que", "qui", "dans", "pour", "par", "sur", "pas", "au", "en", "il", "elle",
    "el", "los", "las", "y", "del", "se", "por", "con", "para", "su", "no", "al", "lo", "como",
)


@dataclass(frozen=True)
class Rule:
    """Bounds (inclusive) of a measure; ``from_words`` is the number of words from which it holds."""

    measure: str
    least: float | None = None
    most: float | None = None
    from_words: int = 0


#: The method's table beside the base rules. Wide of what any clean text of the four languages shows.
TABLE = (
    Rule("mean_word_length", least=2.0, most=25.0),
    Rule("symbols_per_char", most=0.05),
    Rule("stop_word_share", least=0.02, from_words=100),
    Rule("dup_line_share", most=0.5),
)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once: a lambda variable, not a copy of the expression."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _repeat_words(words: Column) -> Column:
    """Words covered by a window whose hash occurs twice or more."""
    size = F.size(words)

    def covered(marked: Column) -> Column:
        gaps = F.transform(marked, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(marked, k + 1) - x, F.lit(WINDOW))))
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda a, x: a + x)

    def by_sorting(hashes: Column) -> Column:
        return _let(
            F.sort_array(F.transform(hashes, lambda h, k: F.struct(h.alias("h"), k.alias("k")))),
            lambda s: _let(
                F.sort_array(F.transform(F.filter(s, lambda x, i: (F.get(s, i - 1)["h"] == x["h"]) | (F.get(s, i + 1)["h"] == x["h"])), lambda x: x["k"])),
                covered,
            ),
        )

    def windows(hashed: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), size - WINDOW), lambda i: F.xxhash64(*[F.get(hashed, i + k) for k in range(WINDOW)]))

    def counted(hashes: Column) -> Column:
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(by_sorting(hashes))

    return F.when(size < WINDOW + 1, F.lit(0).cast("long")).otherwise(_let(_let(F.transform(words, lambda w: F.xxhash64(w)), windows), counted))


def measures(text: Column) -> Column:
    """A struct of all measures of a text column."""
    text = F.coalesce(text, F.lit(""))

    def of(words: Column, lines: Column) -> Column:
        n = F.size(words).cast("long")
        chars = F.aggregate(words, F.lit(0).cast("long"), lambda a, w: a + F.length(w))
        symbols = F.length(F.regexp_replace(text, f"[^{SYMBOLS}]+", "")).cast("long")
        stops = F.size(F.filter(words, lambda w: F.lower(w).isin(*STOP_WORDS))).cast("long")
        full = F.size(lines).cast("long")
        dups = full - F.size(F.array_distinct(lines))
        return F.struct(n.alias("n_words"), chars.alias("word_chars"), symbols.alias("n_symbols"), dups.alias("n_dup_lines"), _repeat_words(words).alias("n_repeat_words"), stops.alias("n_stop_words"), full.alias("n_lines"))

    words = F.filter(F.split(text, SPACES), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORDLESS))
    return _let(words, lambda w: _let(lines, lambda x: of(w, x)))


def verdict(m: Column, rules: tuple[Rule, ...] = TABLE) -> tuple[Column, Column]:
    """(base_failed, kept) from the measures."""
    failed = (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEATED_PERCENT * m["n_words"])
    value = {
        "mean_word_length": F.try_divide(m["word_chars"], m["n_words"]),
        "symbols_per_char": F.try_divide(m["n_symbols"], m["word_chars"]),
        "stop_word_share": F.try_divide(m["n_stop_words"], m["n_words"]),
        "dup_line_share": F.try_divide(m["n_dup_lines"], m["n_lines"]),
    }
    kept = ~failed
    for rule in rules:
        x = value[rule.measure]
        broken = F.lit(False)
        if rule.least is not None:
            broken = broken | (x < rule.least)
        if rule.most is not None:
            broken = broken | (x > rule.most)
        kept = kept & ~F.coalesce(broken & (m["n_words"] >= rule.from_words), F.lit(False))
    return failed, kept


def measured(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = TABLE, out: str = "__rules") -> DataFrame:
    """``docs`` with a struct column ``out`` of all measures and verdicts."""

    def judged(m: Column) -> Column:
        failed, kept = verdict(m, rules)
        return m.withField("base_failed", failed).withField("kept", kept)

    return docs.withColumn(out, _let(measures(F.col(text_col)), judged))


def kept_only(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = TABLE) -> DataFrame:
    name = unused(docs, "__rules")
    return measured(docs, text_col, rules, name).where(F.col(name)["kept"]).drop(name)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measured(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "__rules.*")


_STOPS = ", ".join(f"'{w}'" for w in STOP_WORDS)
ORACLE = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
     w AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws,
                  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
     win AS (SELECT doc_id, unnest(range(1, greatest(len(ws) - {WINDOW - 2}, 1))) AS i, ws FROM w),
     keyed AS (SELECT doc_id, i, array_to_string(ws[i:i+{WINDOW - 1}], ' ') AS k FROM win),
     twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS n FROM keyed) WHERE n > 1),
     cov AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + {WINDOW})) AS p FROM twice) GROUP BY doc_id),
     m AS (SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
                  length(regexp_replace(text, '[^{SYMBOLS}]+', '', 'g'))::BIGINT AS n_symbols,
                  (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(cov.n, 0)::BIGINT AS n_repeat_words,
                  len(list_filter(ws, lambda x: lower(x) IN ({_STOPS})))::BIGINT AS n_stop_words, len(ls)::BIGINT AS n_lines
           FROM w LEFT JOIN cov USING (doc_id)),
     f AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED_PERCENT} * n_words AS base_failed FROM m)
SELECT *, NOT base_failed
       AND NOT coalesce(word_chars / nullif(n_words, 0) < 2.0 OR word_chars / nullif(n_words, 0) > 25.0, false)
       AND NOT coalesce(n_symbols / nullif(word_chars, 0) > 0.05, false)
       AND NOT coalesce(n_stop_words / nullif(n_words, 0) < 0.02 AND n_words >= 100, false)
       AND NOT coalesce(n_dup_lines / nullif(n_lines, 0) > 0.5, false) AS kept
FROM f
"""

QUERIES = {"op7_quality_rules": op7_quality_rules}
ORACLES = {"op7_quality_rules": ORACLE}
