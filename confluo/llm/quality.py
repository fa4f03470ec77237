"""Quality rules: a threshold table compiled into one projection of native Spark expressions.

Edge cases: a null or empty text has no words, so every count is 0 and base_failed is true; very long texts take time
in proportion to n log n words; repeated rows are judged each; columns of the input other than id and text are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = " \t\n\x0b\f\r"
#: Frequent short words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to a in is that it for on was with as be by this are from or an at not "
    "der die das und den von zu mit ist ein eine im auf für nicht als auch sich des dem "
    "de la le les et en un une du que qui est dans pour par sur au avec ne pas plus "
    "el los del las y por con no se su para al lo como es una"
).split()
#: (measure, least, most); a document is kept if each measure is between its bounds.
RULES = (
    ("n_words", 50, 1e9),
    ("mean_word_chars", 2, 12),
    ("symbol_ratio", 0, 0.2),
    ("stop_ratio", 0.06, 1),
    ("dup_line_ratio", 0, 0.5),
    ("repeat_ratio", 0, 0.5),
)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), the value being computed once however often it is used."""
    return F.transform(F.array(value), use)[0]


def _repeat_words(words: Column, n: Column) -> Column:
    """Words in windows of three words that the text has twice or more."""
    windows = F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(words[i], words[i + 1], words[i + 2]))

    def covered(w: Column) -> Column:
        def places(s: Column) -> Column:
            last = F.size(s) - 1
            same = F.filter(F.sequence(F.lit(0), last), lambda k: ((k > 0) & (s[F.greatest(k - 1, F.lit(0))]["h"] == s[k]["h"])) | ((k < last) & (s[F.least(k + 1, last)]["h"] == s[k]["h"])))
            at = F.sort_array(F.transform(same, lambda k: s[k]["i"]))
            none = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("bigint").alias("n"))
            return F.aggregate(at, none, lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(3), p - a["last"])).alias("n")), lambda a: a["n"])

        tagged = F.sort_array(F.transform(w, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0).cast("bigint")).otherwise(let(tagged, places))

    return F.when(n < 3, F.lit(0).cast("bigint")).otherwise(let(windows, covered))


def _measures(text_col: str) -> list[Column]:
    """Structs of counts of each text: words, their characters, repeated and stop words; lines; symbols."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    trimmed = F.trim(text, F.lit(SPACE))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, "[\\x20\\x09-\\x0D]+"))

    def of_words(w: Column) -> Column:
        return let(
            F.size(w),
            lambda n: F.struct(
                n.cast("bigint").alias("n_words"),
                F.length(F.array_join(w, "")).cast("bigint").alias("word_chars"),
                _repeat_words(w, n).alias("n_repeat_words"),
                F.size(F.filter(w, lambda x: F.lower(x).isin(STOP_WORDS))).cast("bigint").alias("n_stop"),
            ),
        )

    def of_lines(x: Column) -> Column:
        return F.struct(F.size(x).cast("bigint").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"))

    lines = F.filter(F.split(text, "\n"), lambda x: F.trim(x, F.lit(SPACE)) != "")
    symbols = F.struct(F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("bigint").alias("n_symbols"))
    return [let(words, of_words).alias("w"), let(lines, of_lines).alias("l"), symbols.alias("s")]


def compile_rules(rules=RULES) -> Column:
    """One boolean column of a threshold table; a ratio over nothing is 0."""
    per = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))
    known = {
        "n_words": F.col("n_words"),
        "mean_word_chars": per("word_chars", "n_words"),
        "symbol_ratio": per("n_symbols", "n_words"),
        "stop_ratio": per("n_stop", "n_words"),
        "dup_line_ratio": per("n_dup_lines", "n_lines"),
        "repeat_ratio": per("n_repeat_words", "n_words"),
    }
    return reduce(lambda a, b: a & b, (known[m].between(lo, hi) for m, lo, hi in rules))


FAILED = "n_words < 50 OR 100 * n_repeat_words > 50 * n_words"


def judge(docs: DataFrame, rules=RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its counts, base_failed (too short or too repetitive) and kept."""
    m = docs.select(F.col(id_col).alias("doc_id"), *_measures(text_col)).select("doc_id", "w.*", "l.*", "s.*")
    failed = F.expr(FAILED)
    return m.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_stop", "n_lines", failed.alias("base_failed"), (~failed & compile_rules(rules)).alias("kept"))


def keep(docs: DataFrame, rules=RULES, text_col: str = "text") -> DataFrame:
    """The rows of docs, all columns as they are, that the rules keep."""
    m = docs.select(F.struct(*docs.columns).alias("_row"), *_measures(text_col)).select("_row", "w.*", "l.*", "s.*")
    return m.where(~F.expr(FAILED) & compile_rules(rules)).select("_row.*")


_WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"
_STOP = ", ".join(f"'{w}'" for w in STOP_WORDS)
#: The same rows by DuckDB, windows being compared as the words themselves.
SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, {_WORDS} AS w,
  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM documents),
win AS (SELECT r, i, w[i] || ' ' || w[i+1] || ' ' || w[i+2] AS t FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
dup AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, t) AS n FROM win) WHERE n > 1),
rep AS (SELECT r, count(DISTINCT i + k) AS n FROM dup, (VALUES (0), (1), (2)) AS s(k) GROUP BY r),
m AS (SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
  (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
  (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words,
  len(list_filter(w, lambda x: lower(x) IN ({_STOP})))::BIGINT AS n_stop, len(l)::BIGINT AS n_lines
  FROM d LEFT JOIN rep USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_stop, n_lines,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
  AND word_chars / n_words BETWEEN 2 AND 12 AND n_symbols / n_words BETWEEN 0 AND 0.2 AND n_stop / n_words BETWEEN 0.06 AND 1
  AND n_dup_lines / n_lines BETWEEN 0 AND 0.5 AND n_repeat_words / n_words BETWEEN 0 AND 0.5 AS kept
FROM m
"""
