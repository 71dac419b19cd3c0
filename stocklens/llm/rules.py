"""Quality rules: a table of thresholds compiled into one projection.

Each row is measured where it is read (code points, words, symbols, marks, stop words, lines, duplicate lines, words in
repeated windows), and a table of rules ``part / whole`` between ``low`` and ``high`` per mille becomes one boolean
column each in the same projection. Thresholds are whole numbers and rules compare products of whole numbers, so
no rounding decides. All of it is built-in functions: nothing is shuffled, and no Python runs on the executors.

Repeated windows: a text's windows of eight words are hashed to 64 bits. If all hashes differ nothing repeats; else
(hash, place) pairs are sorted within the row, those equal to a neighbour give the places, and the words covered
by them are summed from place to place. Two different windows of a text of a million words share a hash once in
4e7 texts. A row's arrays take some hundred bytes a word, so a very long text needs that memory in its
one task; nothing grows with the number of rows.

Nulls and ties: a null text counts as empty: no words, and so ``base_failed``. Null ids and repeated rows come out as they
are. Extra columns, whatever their names, are not read by ``query`` and are returned by ``kept_rows``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocklens.llm.common import table

WINDOW, LEAST_WORDS, REPEAT_PERCENT = 8, 20, 30
#: Frequent words of English, French, German and Spanish.
STOP_WORDS = ("a the of and in that to is it for with on as be this "
              "le la les de des du et un une en dans que pour "
              "der die das und zu ein eine von mit ist den "
              "el los las y del con por se no").split()
BLANK, LINE_BLANKS = r"[\x20\x09-\x0D]+", " \t\x0b\x0c\r"


class Rule(NamedTuple):
    """``part`` may be from ``low`` to ``high`` thousandths of ``whole``; ``slack`` units of it are forgiven."""
    name: str
    part: str
    whole: str
    low: int | None = None
    high: int | None = None
    slack: int = 0


RULES = [
    Rule("word_length", "word_chars", "n_words", 3000, 10000),
    Rule("symbols", "n_symbols", "n_words", high=100),
    Rule("marks", "n_marks", "n_words", high=500),
    Rule("letters", "n_letter_words", "n_words", low=700),
    Rule("stop_words", "n_stop_words", "n_words", low=25, slack=2),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", high=500),
    Rule("bullet_lines", "n_bullet_lines", "n_lines", high=900, slack=1),
    Rule("cut_lines", "n_cut_lines", "n_lines", high=300, slack=1),
]
MEASURES = ["n_words", "word_chars", "n_symbols", "n_marks", "n_letter_words", "n_stop_words", "n_lines", "n_dup_lines",
            "n_bullet_lines", "n_cut_lines", "n_repeat_words"]


#: Ahead of the names of all helper columns, so that they clash with none of a table's own.
OWN = "_rules_"


def measure(name: str) -> Column:
    """A measure of ``measured`` rows."""
    return F.col(OWN + name)


def failed_rules(rules: Sequence[Rule] = RULES) -> Column:
    """Names of the rules that a measured row breaks, in the table's order."""
    def broken(r: Rule) -> Column:
        part, whole = measure(r.part), measure(r.whole)
        tests = [F.lit(False)]
        if r.low is not None:
            tests.append(1000 * (part + r.slack) < r.low * whole)
        if r.high is not None:
            tests.append(1000 * (part - r.slack) > r.high * whole)
        return reduce(Column.__or__, tests)

    return F.array_compact(F.array(*[F.when(broken(r), F.lit(r.name)) for r in rules]).cast("array<string>"))


def base_failed() -> Column:
    """Too few words, or too many of them in repeated windows."""
    return ((measure("n_words") < LEAST_WORDS)
            | (100 * measure("n_repeat_words") > REPEAT_PERCENT * measure("n_words")))


def _characters(pattern: str, text: Column) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def _met(array: Column, test) -> Column:
    return F.size(F.filter(array, test))


def _covered(first: Column, size: int) -> Column:
    """Words covered by windows of ``size`` that begin at the places ``first`` (ascending)."""
    start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("words"))
    return F.aggregate(first, start, lambda a, x: F.struct(
        (x + size).alias("end"), (a["words"] + x + size - F.greatest(a["end"], x)).alias("words")), lambda a: a["words"])


def measured(documents: DataFrame, window: int = WINDOW, stop_words: Sequence[str] = STOP_WORDS) -> DataFrame:
    """``documents`` with a helper column per name of ``MEASURES``, see ``measure``.

    The steps below stay apart in the plan, since what a step adds is used more than once by the next. A condition on a
    measure stays above them too: pushed down, it would hold every step within the next and make each array anew for
    every word. What hangs on the row's number is not pushed down, so each measure does.
    """
    text, words, lines, hashes, order = (measure(n) for n in ("text", "words", "lines", "hashes", "order"))

    def with_own(df: DataFrame, **columns: Column) -> DataFrame:
        return df.withColumns({OWN + n: c for n, c in columns.items()})

    df = with_own(documents, text=F.coalesce("text", F.lit("")))
    df = with_own(df, words=F.array_remove(F.split(text, BLANK), ""),
                  lines=F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(LINE_BLANKS)) != ""))
    places = F.when(F.size(words) >= window, F.sequence(F.lit(0), F.size(words) - window)).otherwise(
        F.array().cast("array<int>"))
    df = with_own(df, hashes=F.transform(places, lambda i: F.xxhash64(F.slice(words, i + 1, window))))
    pairs = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    df = with_own(df, order=F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), F.sort_array(pairs)))

    def twice(x: Column, k: Column) -> Column:
        return F.get(order, k - 1)["h"].eqNullSafe(x["h"]) | F.get(order, k + 1)["h"].eqNullSafe(x["h"])

    first = F.sort_array(F.transform(F.filter(order, twice), lambda x: x["i"]))
    measures = dict(
        n_words=F.size(words).cast("long"), word_chars=F.length(F.array_join(words, "")).cast("long"),
        n_symbols=_characters("[#*$%&|<>]", text).cast("long"), n_marks=_characters("[!?]", text),
        n_letter_words=_met(words, lambda x: x.rlike(r"\p{L}")),
        n_stop_words=_met(words, lambda x: F.lower(x).isin(*stop_words)), n_lines=F.size(lines),
        n_dup_lines=(F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        n_bullet_lines=_met(lines, lambda x: x.rlike(r"^[\x20\t]*[-*\u2022]")),
        n_cut_lines=_met(lines, lambda x: x.rlike(r"(\.\.\.|\u2026)[\x20\t\r]*$")),
        n_repeat_words=F.when(order.isNull(), F.lit(0).cast("long")).otherwise(_covered(first, window)))
    numbered = F.monotonically_increasing_id() >= 0
    df = with_own(df, **{n: F.when(numbered, c) for n, c in measures.items()})
    return df.drop(*[OWN + n for n in ("text", "words", "lines", "hashes", "order")])


def judged(documents: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Measured rows with helper columns ``base_failed``, ``failed`` (names of broken rules) and ``kept``."""
    df = measured(documents).withColumns({OWN + "base_failed": base_failed(), OWN + "failed": failed_rules(rules)})
    return df.withColumn(OWN + "kept", ~measure("base_failed") & (F.size(measure("failed")) == 0))


def kept_rows(documents: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """The rows of ``documents`` that no rule rejects, with all their columns."""
    return judged(documents, rules).where(measure("kept")).select(*[documents[c] for c in documents.columns])


def query(spark, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return judged(documents).select("doc_id", *[measure(n).alias(n) for n in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")],
        F.array_join(measure("failed"), ",").alias("failed_rules"))


_LIST = ", ".join(f"'{w}'" for w in STOP_WORDS)
SQL = f"""
WITH t AS (
    SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
windows AS (
    SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS words
    FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 7)) AS i FROM t)),
again AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, words) > 1),
hit AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM again, unnest(generate_series(0, 7)) AS s(j) GROUP BY doc_id),
line AS (SELECT doc_id, line FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM t) WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
lines AS (
    SELECT doc_id, count(*) AS n, count(*) - count(DISTINCT line) AS dup,
           count(*) FILTER (ltrim(line, ' ' || chr(9))[1] IN ('-', '*', chr(8226))) AS bullets,
           count(*) FILTER (regexp_matches(line, '(\\.\\.\\.|\\x{{2026}})[\\x20\\t\\r]*$')) AS cut
    FROM line GROUP BY doc_id),
m AS (
    SELECT t.doc_id, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
           len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, len(regexp_extract_all(text, '[!?]')) AS marks,
           len(list_filter(w, lambda x: regexp_matches(x, '\\pL'))) AS letters,
           len(list_filter(w, lambda x: lower(x) IN ({_LIST}))) AS stops, coalesce(lines.n, 0) AS n_lines,
           coalesce(lines.dup, 0) AS n_dup_lines, coalesce(bullets, 0) AS bullets, coalesce(cut, 0) AS cut,
           coalesce(hit.n, 0) AS n_repeat_words
    FROM t LEFT JOIN lines USING (doc_id) LEFT JOIN hit USING (doc_id)),
v AS (
    SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
           concat_ws(',', CASE WHEN word_chars < 3 * n_words OR word_chars > 10 * n_words THEN 'word_length' END,
               CASE WHEN 10 * n_symbols > n_words THEN 'symbols' END, CASE WHEN 2 * marks > n_words THEN 'marks' END,
               CASE WHEN 10 * letters < 7 * n_words THEN 'letters' END, CASE WHEN 40 * (stops + 2) < n_words THEN 'stop_words' END,
               CASE WHEN 2 * n_dup_lines > n_lines THEN 'duplicate_lines' END,
               CASE WHEN 10 * (bullets - 1) > 9 * n_lines THEN 'bullet_lines' END,
               CASE WHEN 10 * (cut - 1) > 3 * n_lines THEN 'cut_lines' END) AS failed_rules
    FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND failed_rules = '' AS kept, failed_rules
FROM v
"""
