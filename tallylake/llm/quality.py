"""Line-first cleaning: judge every line, drop failing lines, reject texts that lose too much.

Everything is built from DataFrame functions. Arrays live within one row, so the
longest text bounds a task's memory; no row is exploded and nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallylake.llm.words import GAP_CHARACTERS, word_array

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_LOST_PERCENT = 50  # of a text's words, in lines that fail

# A line ends like prose, in any of the scripts we see, if it ends in one of these.
TERMINAL = r"""[.!?:;…。！？]["'”’»)\]]*$"""
# Menus and breadcrumbs: bars, arrows or bullets stand between the items as words of their own.
SEPARATORS = "|»›>•·/"
MIN_SEPARATORS = 2
ITEM_WORDS = 4  # at most so many words for each separator
SYMBOL_SHARE = 8  # a line fails if every eighth visible character is a symbol
BOILERPLATE = (
    r"(?i)(all rights reserved|cookie (policy|settings)|accept (all )?cookies|enable javascript"
    r"|terms of (use|service)|privacy policy|click here|sign (in|up)|subscribe (now|to our)"
    r"|share (on|this)|lorem ipsum|copyright (©|\(c\))|powered by)"
)
SHORT_LINE = 3  # words; shorter lines without terminal punctuation look like headings or buttons
BOILERPLATE_WORDS = 25  # a longer line merely mentions such a phrase


def _bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once per row, also inside lambdas."""
    return F.transform(F.array(value), use)[0]


def repeated_words(words: Column) -> Column:
    """Words that lie in a 3-word window found twice or more in the text.

    Windows are sorted by a 64-bit hash and their place, so equal ones are neighbours; each
    of them covers three words, and overlaps count once.
    """
    n = F.size(words)

    def windows(w: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(w) - 3)
        return F.transform(
            places,
            lambda i: F.struct(
                F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i")
            ),
        )

    def places_of_repeats(s: Column) -> Column:
        last = F.size(s) - 1
        marked = F.transform(
            s,
            lambda x, k: F.when(
                ((k > 0) & (F.get(s, k - 1)["h"] == x["h"]))
                | ((k < last) & (F.get(s, k + 1)["h"] == x["h"])),
                x["i"],
            ),
        )
        return F.array_sort(F.filter(marked, lambda i: i.isNotNull()))

    def covered(p: Column) -> Column:
        steps = F.transform(
            p,
            lambda i, k: F.when(k == F.size(p) - 1, 3).otherwise(F.least(F.get(p, k + 1) - i, F.lit(3))),
        )
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

    def count(w: Column) -> Column:
        found = windows(w)
        hashes = F.transform(found, lambda x: x["h"])
        some = F.size(F.array_distinct(hashes)) < F.size(hashes)
        return F.when(
            some,
            _bound(
                F.sort_array(found), lambda s: _bound(places_of_repeats(s), lambda p: covered(p))
            ),
        ).otherwise(F.lit(0).cast("long"))

    return F.when(n < 4, F.lit(0).cast("long")).otherwise(_bound(words, count))


def without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def described_line(line: Column) -> Column:
    """(line, n, bad): a line with its number of words and whether it fails.

    A line fails that is navigation, boilerplate, mostly symbols, or a fragment without punctuation.
    Cheap tests come first: the patterns see short lines only, and letters are counted last.
    """
    trimmed = F.btrim(line, F.lit(GAP_CHARACTERS))

    def judge(words: Column) -> Column:
        n = F.size(words)
        separators = F.size(F.filter(words, lambda w: w.isin(*SEPARATORS)))
        visible = F.array_join(words, "")
        symbols = F.length(visible) - F.length(without(visible, SYMBOLS))
        letters = F.length(F.regexp_replace(visible, r"[^\p{L}\p{N}]+", ""))
        bad = (
            ((n <= SHORT_LINE) & ~trimmed.rlike(TERMINAL))
            | ((separators >= MIN_SEPARATORS) & (separators * ITEM_WORDS >= n))
            | (symbols * SYMBOL_SHARE >= F.length(visible))
            | ((n <= BOILERPLATE_WORDS) & trimmed.rlike(BOILERPLATE))
            | (letters * 2 < F.length(visible))
        )
        return F.struct(line.alias("line"), n.alias("n"), bad.alias("bad"))

    return _bound(word_array(trimmed), judge)


def lines_with_words(text: Column) -> Column:
    """The ``\\n``-separated lines that hold a word."""
    lines = F.split(F.coalesce(text, F.lit("")), "\n")
    return F.filter(lines, lambda x: F.btrim(x, F.lit(GAP_CHARACTERS)) != "")


def judged(
    docs: DataFrame,
    text: str = "text",
    min_words: int = MIN_WORDS,
    max_repeat_percent: int = MAX_REPEAT_PERCENT,
    max_lost_percent: int = MAX_LOST_PERCENT,
) -> DataFrame:
    """``docs`` with one struct column ``quality``, in place of any column of that name.

    Fields: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    kept_words (words in lines that pass), clean_text (those lines) and kept.
    NULL and empty texts have no words and fail the word count.
    """
    content = F.coalesce(F.col(text), F.lit(""))

    def measure(words: Column) -> Column:
        lines = lines_with_words(F.col(text))
        good = F.filter(F.transform(lines, described_line), lambda x: ~x["bad"])
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            (F.length(content) - F.length(without(content, SYMBOLS)))
            .cast("long")
            .alias("n_symbols"),
            _bound(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))
            .cast("long")
            .alias("n_dup_lines"),
            repeated_words(words).alias("n_repeat_words"),
            good.alias("good"),
        )

    def decide(m: Column) -> Column:
        failed = (m["n_words"] < min_words) | (
            100 * m["n_repeat_words"] > max_repeat_percent * m["n_words"]
        )
        left = F.aggregate(m["good"], F.lit(0).cast("long"), lambda total, x: total + x["n"])
        return F.struct(
            *[m[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
            failed.alias("base_failed"),
            left.alias("kept_words"),
            F.array_join(F.transform(m["good"], lambda x: x["line"]), "\n").alias("clean_text"),
            (~failed & (100 * (m["n_words"] - left) <= max_lost_percent * m["n_words"])).alias("kept"),
        )

    verdict = _bound(word_array(F.col(text)), lambda w: _bound(measure(w), decide))
    return docs.withColumn("quality", verdict)


def clean(docs: DataFrame, text: str = "text", **limits) -> DataFrame:
    """The kept documents with failing lines taken out of their text; same columns."""
    rows = docs.select(F.struct("*").alias("row"))
    rows = judged(rows.withColumn("text", F.col(f"row.`{text}`")), "text", **limits)
    fields = [
        F.col("quality.clean_text").alias(c) if c == text else F.col(f"row.`{c}`").alias(c)
        for c in docs.columns
    ]
    return rows.filter("quality.kept").select(*fields)


def measures(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **limits) -> DataFrame:
    """One row per document with its measures and verdict; other columns are ignored.

    Repeated rows come out once each, an empty table gives no rows.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return judged(rows, "text", **limits).select(
        "doc_id",
        *[f"quality.{c}" for c in (
            "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            "base_failed", "kept_words", "kept",
        )],
    )


# DuckDB SQL for the same rows.
ORACLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
g AS (SELECT d.doc_id, i.i AS i, [w[i.i], w[i.i + 1], w[i.i + 2]] AS gram
      FROM d, unnest(range(1, greatest(len(w) - 1, 1))) AS i(i)),
r AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM g) WHERE n > 1),
c AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM r, (VALUES (0), (1), (2)) AS v(k) GROUP BY doc_id),
l AS (SELECT doc_id, trim(x.x, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS line
      FROM d, unnest(lines) AS x(x)),
p AS (SELECT *, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS w FROM l),
q AS (SELECT *, len(w) AS n, array_to_string(w, '') AS visible,
             len(list_filter(w, lambda x: regexp_matches(x, '__SEPARATOR__'))) AS separators FROM p),
j AS (SELECT doc_id, n,
             (separators >= 2 AND separators * 4 >= n)
             OR (length(visible) - length(regexp_replace(visible, '[#*$%&|<>]', '', 'g'))) * 8 >= length(visible)
             OR length(regexp_replace(visible, '[^\p{L}\p{N}]+', '', 'g')) * 2 < length(visible)
             OR (regexp_matches(line, '__BOILERPLATE__') AND n <= __LONG__)
             OR (NOT regexp_matches(line, '__TERMINAL__') AND n <= __SHORT__) AS bad
      FROM q),
k AS (SELECT doc_id, sum(n) FILTER (WHERE NOT bad) AS n FROM j GROUP BY doc_id),
m AS (SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words,
             CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
             CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words,
             CAST(coalesce(k.n, 0) AS BIGINT) AS kept_words
      FROM d LEFT JOIN c ON c.doc_id = d.doc_id LEFT JOIN k ON k.doc_id = d.doc_id)
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
       AND 100 * (n_words - kept_words) <= 50 * n_words AS kept
FROM m
"""
for _name, _value in {
    "SEPARATOR": f"^[{SEPARATORS}]$",
    "BOILERPLATE": BOILERPLATE,
    "TERMINAL": TERMINAL.replace("'", "''"),
    "LONG": str(BOILERPLATE_WORDS),
    "SHORT": str(SHORT_LINE),
}.items():
    ORACLE = ORACLE.replace(f"__{_name}__", _value)
