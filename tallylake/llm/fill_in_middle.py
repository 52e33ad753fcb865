"""Fill-in-middle texts: a text is cut at two ranks and its middle moved to the end.

The cut ranks count units (code points, words, lines: any pattern) and are found in an indexable skip
list (:mod:`skip_list`), which gives the code points before each cut exactly. Cuts and form
depend on the document's id and a seed alone, so reruns agree and one text never needs another.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallylake.llm.skip_list import SkipList, unit_widths
from tallylake.llm.tables import Batches, map_batches

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
MARKED_SHARE = 90  # of 100 texts get a form other than plain
SPM_SHARE = 20  # of 100 texts with a form begin with the suffix

SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def draws(doc_id: int | None, seed: int) -> list[int]:
    """Four 32-bit integers that belong to a document."""
    name = f"{seed}:{'' if doc_id is None else doc_id}"
    digest = hashlib.sha256(name.encode()).hexdigest()
    return [int(digest[k : k + 8], 16) for k in range(0, 32, 8)]


def arranged(text: str, doc_id: int | None, seed: int, unit: re.Pattern | None) -> tuple:
    """(n, form, prefix_chars, middle_chars, output) of one text."""
    widths = unit_widths(text, unit)
    n = len(widths)
    first, second, marked, order = draws(doc_id, seed)
    taken = any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE))
    if not text or taken or marked % 100 >= MARKED_SHARE:
        return n, PLAIN, None, None, text
    units = SkipList(widths)
    low, high = sorted((first % (n + 1), second % (n + 1)))
    start, end = units.code_points(low), units.code_points(high)
    prefix, middle, suffix = text[:start], text[start:end], text[end:]
    if order % 100 < SPM_SHARE:
        return n, SPM, start, end - start, SUFFIX + suffix + PREFIX + prefix + MIDDLE + middle
    return n, PSM, start, end - start, PREFIX + prefix + SUFFIX + suffix + MIDDLE + middle


def transformed(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    seed: int = 1,
    unit: str | None = None,
) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of every document.

    ``unit`` is a pattern of what a cut may not split, by default one code point; n counts units. A NULL
    text counts as empty. Empty texts, texts that hold a mark already and one text in ten stay as
    they are (plain, no widths). Rows without a doc_id share one draw; repeated rows come out once each
    and alike. Other columns are ignored. A task holds one Arrow batch, and one text's lanes.
    """
    pattern = re.compile(unit) if unit is not None else None

    def arrange(batches: Batches) -> Batches:
        for batch in batches:
            ids = batch.column(0)
            rows = [
                arranged(value.as_py() or "", key.as_py(), seed, pattern)
                for key, value in zip(ids, batch.column(1))
            ]
            n, form, prefix, middle, output = zip(*rows) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    pa.array(n, pa.int64()),
                    pa.array(form, pa.string()),
                    pa.array(prefix, pa.int64()),
                    pa.array(middle, pa.int64()),
                    pa.array(output, pa.string()),
                ],
                names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
            )

    chosen = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return map_batches(chosen, arrange, SCHEMA)


def restored(output: Column, form: Column) -> Column:
    """The text an output was made from, from the output and its form alone."""

    def between(after: str, before: str) -> Column:
        return F.split_part(F.split_part(output, F.lit(after), F.lit(2)), F.lit(before), F.lit(1))

    middle = F.split_part(output, F.lit(MIDDLE), F.lit(2))
    return (
        F.when(form == PSM, F.concat(between(PREFIX, SUFFIX), middle, between(SUFFIX, MIDDLE)))
        .when(form == SPM, F.concat(between(PREFIX, MIDDLE), middle, between(SUFFIX, PREFIX)))
        .otherwise(output)
    )


def digests(texts: DataFrame) -> DataFrame:
    """:func:`transformed` rows with the output and the text rebuilt from it as digests."""

    def sha256(value: Column) -> Column:
        return F.sha2(value.cast("binary"), 256)

    return texts.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        sha256(F.col("output")).alias("output_sha256"),
        sha256(restored(F.col("output"), F.col("form"))).alias("restored_sha256"),
    )


ORACLE = """
WITH drawn AS (
    SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n,
           sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h
    FROM documents
), numbers AS (
    SELECT doc_id, t, n,
           ('0x' || substr(h, 1, 8))::BIGINT % (n + 1) AS one,
           ('0x' || substr(h, 9, 8))::BIGINT % (n + 1) AS two,
           ('0x' || substr(h, 17, 8))::BIGINT % 100 AS marked,
           ('0x' || substr(h, 25, 8))::BIGINT % 100 AS turned
    FROM drawn
), cut AS (
    SELECT doc_id, t, n, least(one, two) AS low, greatest(one, two) AS high,
           CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                     OR marked >= 90 THEN 'plain'
                WHEN turned < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM numbers
), parts AS (
    SELECT *, substr(t, 1, low) AS prefix, substr(t, low + 1, high - low) AS middle,
           substr(t, high + 1) AS suffix
    FROM cut
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN low END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN high - low END AS middle_chars,
       sha256(CASE form WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle
                        ELSE t END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts
"""
