"""Operator 1, quality rules: one projection of built-in functions from a threshold table.

``RULES`` is the table: a measure, and the least and greatest value of a document that is
kept. Measures are ratios of the counts below. No user function is involved.

Repeated words are words inside 5-word windows that stand at least twice in the text. A
window is named by the 64-bit hash of its words; only texts whose window hashes are not all
different are looked at more closely: their (hash, place) pairs are sorted, places of hashes
with an equal neighbour are put in order, and each adds min(5, distance to the next) words.
So the work is n log n for a text of any length.

Defined cases: null and empty texts have no words and fail the base rule; ties and repeated
rows do not matter, since each row is judged alone; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changelake.llm.store import table

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
GRAM = 5
#: Frequent words of the languages in use, for the stop-word ratio.
STOP_WORDS = {
    "en": "the of and to in a is that for it was on with as be at by this are or an from",
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an",
    "fr": "de la le et les des en un du une que est pour qui dans par plus pas au sur ne se ce",
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más",
}
#: Texts of fewer words say too little about their share of stop words; they pass that rule.
STOP_WORDS_FROM = 50
#: (measure, least, greatest); None: no bound. A text is kept if all hold.
RULES: list[tuple[str, float | None, float | None]] = [
    ("n_words", 10, None),
    ("mean_word_length", 2.0, 25.0),
    ("symbols_per_word", None, 0.25),
    ("stop_word_ratio", 0.01, None),
    ("duplicate_line_ratio", None, 0.5),
    ("repeated_word_ratio", None, 0.2),
]


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, also where body uses it in a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _repeated_words(words: Column, n: Column) -> Column:
    """Words covered by 5-word windows that occur at least twice in ``words``."""
    window = lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(GRAM)])
    hashes = F.when(n >= GRAM, F.transform(F.sequence(F.lit(0), n - GRAM), window))

    def places(h: Column) -> Column:
        pairs = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return _let(pairs, lambda p: F.array_sort(F.transform(
            F.filter(p, lambda x, k: F.get(p, k - 1)["h"].eqNullSafe(x["h"]) | F.get(p, k + 1)["h"].eqNullSafe(x["h"])),
            lambda x: x["i"])))

    def total(p: Column) -> Column:
        step = lambda s, x: F.struct((s["n"] + F.least(F.lit(GRAM), x - s["last"])).cast("int").alias("n"), x.alias("last"))
        start = F.struct(F.lit(0).alias("n"), F.get(p, F.lit(0)).alias("last"))
        return F.aggregate(p, start, step, lambda s: s["n"] + GRAM)

    return F.coalesce(_let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), _let(places(h), total))), F.lit(0))


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the counts of every row, from built-in functions alone."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("t"))
    # each array leaves through a generator, so that no later expression computes it again
    rows = rows.select("doc_id", "t", F.explode(F.array(F.filter(F.split("t", SPACE), lambda w: w != ""))).alias("words"))
    n = F.size("words")
    lines = F.filter(F.split("t", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return rows.select(
        "doc_id", n.cast("long").alias("n_words"),
        F.length(F.regexp_replace("t", SPACE, "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("t", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        F.size(lines).cast("long").alias("n_lines"),
        _repeated_words(F.col("words"), n).cast("long").alias("n_repeat_words"),
        F.regexp_count(F.lower("t"), F.lit(r"(?<![^\x20\x09-\x0D])(?:" + _stop_pattern() + r")(?![^\x20\x09-\x0D.,])")).cast("long").alias("n_stop_words"))


def _measure(name: str) -> Column:
    per_word = lambda c: F.col(c) / F.greatest(F.col("n_words"), F.lit(1))
    return {"n_words": F.col("n_words").cast("double"), "mean_word_length": per_word("word_chars"),
            "symbols_per_word": per_word("n_symbols"), "stop_word_ratio": F.when(F.col("n_words") >= STOP_WORDS_FROM, per_word("n_stop_words")).otherwise(1.0),
            "duplicate_line_ratio": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
            "repeated_word_ratio": per_word("n_repeat_words")}[name]


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          rules: list[tuple[str, float | None, float | None]] | None = None) -> DataFrame:
    """The counts, base_failed, and kept: false if the base rule or any rule of the table fails."""
    base_failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    passes = ~base_failed
    for name, least, most in RULES if rules is None else rules:
        if least is not None:
            passes &= _measure(name) >= least
        if most is not None:
            passes &= _measure(name) <= most
    return measured(docs, id_col, text_col).select("*", base_failed.alias("base_failed"), passes.alias("kept"))


def query(spark, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"))


def _stop_pattern() -> str:
    return "|".join(sorted({w for words in STOP_WORDS.values() for w in words.split()}))


ORACLE_SQL = r"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
                  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
           FROM documents),
grams AS (SELECT doc_id, p, words[p + 1:p + 5] AS g FROM (SELECT doc_id, words, unnest(range(0, len(words) - 4)) AS p FROM w WHERE len(words) >= 5)),
again AS (SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, g) AS n FROM grams) WHERE n > 1),
repeated AS (SELECT doc_id, count(DISTINCT x) AS n FROM (SELECT doc_id, unnest(range(p, p + 5)) AS x FROM again) GROUP BY 1),
m AS (SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(len(lines) AS BIGINT) AS n_lines,
             coalesce(repeated.n, 0) AS n_repeat_words,
             CAST(len(list_filter(words, lambda x: regexp_full_match(lower(x), '(?:STOP)([.,].*)?'))) AS BIGINT) AS n_stop_words
      FROM w LEFT JOIN repeated USING (doc_id)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT *, NOT base_failed AND word_chars / greatest(n_words, 1) BETWEEN 2.0 AND 25.0 AND n_symbols / greatest(n_words, 1) <= 0.25
       AND (n_words < 50 OR n_stop_words / greatest(n_words, 1) >= 0.01) AND n_dup_lines / greatest(n_lines, 1) <= 0.5
       AND n_repeat_words / greatest(n_words, 1) <= 0.2 AS kept
FROM b
""".replace("STOP", _stop_pattern())
