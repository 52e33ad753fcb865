"""What each filter removes, alone and after others, in every order they can be applied in.

Every filter keeps, per part of the corpus, the sorted list of the ids that fail it. A list is cut at
fixed ids, so an id range of a part is a bounded unit of work whatever the part's size. In each
unit, galloping merges give the union of every set of filters and what each further filter
adds to it; only the sizes leave the unit, and summed over the ranges they answer every order.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallylake.llm import postings
from tallylake.llm.hot_keys import join_facts
from tallylake.llm.tables import Batches, map_batches, written

FILTERS = "ABCDE"
RANGE_IDS = 1 << 16  # ids in a range, so the longest list of a unit
MIN_WORDS = 200
MIN_DISTINCT_PERCENT = 50
MAX_CAPITALS_PERCENT = 2
SYMBOLS = b"#$%&*|"
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
CONTINUATION = bytes(range(0x80, 0xC0))  # bytes of UTF-8 that begin no code point

# lists besides those of the filters
EVERY, GOOD, TOXIC = "every", "good", "toxic"


def failed_alone(text: bytes) -> str:
    """The filters among A to D that a UTF-8 text fails."""
    words = text.split()
    points = len(text.translate(None, CONTINUATION))
    capitals = len(text) - len(text.translate(None, CAPITALS))
    failed = ""
    if len(words) < MIN_WORDS:
        failed += "A"
    if 100 * len(set(words)) < MIN_DISTINCT_PERCENT * len(words):
        failed += "B"
    if 100 * capitals > MAX_CAPITALS_PERCENT * points:
        failed += "C"
    if len(text.translate(None, SYMBOLS)) < len(text):
        failed += "D"
    return failed


def verdicts(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "source"
) -> DataFrame:
    """(doc_id, part, text_key, failed): the filters each document fails, as a string of letters.

    E compares texts by a 128-bit hash. NULL texts are empty, NULL parts the empty string.
    A document without an id is never a copy and no document is a copy of it.
    """

    def judge(batches: Batches) -> Batches:
        for batch in batches:
            texts = [value.as_py() or b"" for value in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([xxhash.xxh3_128_digest(t) for t in texts], pa.binary()),
                    pa.array([failed_alone(t) for t in texts], pa.string()),
                ],
                names=["doc_id", "part", "text_key", "alone"],
            )

    chosen = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.col(text).cast("binary").alias("text"),
    )
    schema = "doc_id long, part string, text_key binary, alone string"
    judged = written(map_batches(chosen, judge, schema), "audit-judged")
    known = judged.filter(F.col("doc_id").isNotNull())
    first = known.groupBy("text_key").agg(
        F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id")
    )
    first = first.filter("first_id < last_id").select("text_key", "first_id")
    rows = join_facts(judged, first, "text_key", F.col("doc_id"))
    copy = F.when(F.col("doc_id") > F.col("first_id"), "E").otherwise("")
    return rows.select("doc_id", "part", "text_key", F.concat("alone", copy).alias("failed"))


def marked(labels: DataFrame) -> DataFrame:
    """(doc_id, good, toxic), one row per labelled id; an id is either if any of its rows says so."""
    return (
        labels.select(F.col("doc_id").cast("long"), "quality", "toxic")
        .filter(F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(
            F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
            F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"),
        )
    )


def posting_lists(judged: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, id_range, list, ids): the sorted ids of each list in each id range of a part.

    Lists are the filters, ``every`` document, and the ``good`` and ``toxic`` ones. Rows that
    share a part and an id are one document, which fails what any of its rows fails. Documents
    without an id share the NULL range and are one document of their part.
    """
    rows = judged.join(marked(labels), "doc_id", "left")
    named = [F.lit(EVERY), F.when(F.col("good"), GOOD), F.when(F.col("toxic"), TOXIC)]
    named += [F.when(F.contains("failed", F.lit(letter)), letter) for letter in FILTERS]
    entries = rows.select(
        "part",
        F.floor(F.col("doc_id") / F.lit(RANGE_IDS)).cast("long").alias("id_range"),
        F.coalesce("doc_id", F.lit(0).cast("long")).alias("doc_id"),
        F.explode(F.array_compact(F.array(*named))).alias("list"),
    )
    return entries.groupBy("part", "id_range", "list").agg(
        F.sort_array(F.collect_set("doc_id")).alias("ids")
    )


def _sizes(lists: dict[str, list[int]]) -> list[tuple[int, ...]]:
    """(before, filter, documents, gone, failing, removed, good, toxic) of one unit.

    ``before`` is the set of filters already applied, as bits, and ``gone`` the size of its union.
    """
    failing = [lists.get(letter, []) for letter in FILTERS]
    documents = len(lists.get(EVERY, []))
    good, toxic = lists.get(GOOD, []), lists.get(TOXIC, [])
    out = []
    for before in range(1 << len(FILTERS)):
        gone = postings.union([ids for k, ids in enumerate(failing) if before >> k & 1])
        for k, ids in enumerate(failing):
            if before >> k & 1:
                continue
            removed = postings.difference(ids, gone)
            out.append(
                (
                    before,
                    k,
                    documents,
                    len(gone),
                    len(ids),
                    len(removed),
                    postings.common(removed, good),
                    postings.common(removed, toxic),
                )
            )
    return out


SIZES = ("before", "filter", "documents", "gone", "failing", "removed", "good", "toxic")


def sizes(lists: DataFrame) -> DataFrame:
    """(part, before, filter, documents, gone, failing, removed, good, toxic), summed over the ranges."""

    def measure(table: pa.Table) -> pa.Table:
        found = dict(zip(table["list"].to_pylist(), table["ids"].to_pylist()))
        columns = zip(*_sizes(found))
        part = pa.array([table["part"][0].as_py()], pa.string())
        rows = {name: pa.array(values, pa.int64()) for name, values in zip(SIZES, columns)}
        height = len(rows["before"])
        return pa.table({"part": part.take(pa.array([0] * height))} | rows)

    schema = "part string, " + ", ".join(f"{name} long" for name in SIZES)
    units = lists.groupBy("part", "id_range").applyInArrow(measure, schema)
    totals = [F.sum(name).alias(name) for name in SIZES[2:]]
    return units.groupBy("part", "before", "filter").agg(*totals)


def _steps(lists: DataFrame) -> DataFrame:
    """(filter_order, step, before, filter): every step of every order, a table of fixed size."""
    rows = []
    for order in permutations(range(len(FILTERS))):
        before = 0
        for step, k in enumerate(order, 1):
            rows.append(("".join(FILTERS[i] for i in order), step, before, k))
            before |= 1 << k
    schema = "filter_order string, step int, before long, filter long"
    return lists.sparkSession.createDataFrame(rows, schema)


def audit(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    part: str = "source",
) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley).

    One row per part, order of the five filters and step of it, zeros included. See
    :func:`verdicts` and :func:`posting_lists` for NULLs and repeated rows; an empty table
    gives no rows. Other columns are ignored, labels of unknown ids too.
    """
    lists = written(posting_lists(verdicts(docs, doc_id, text, part), labels), "audit-postings")
    found = written(sizes(lists), "audit-sizes")
    n = len(FILTERS)
    # in how many orders exactly the filters of ``before`` come first and this one next
    size = F.bit_count("before")
    times = F.array(*[F.lit(factorial(k) * factorial(n - 1 - k)) for k in range(n)])
    last = size == n - 1  # all others have been applied
    overall = found.groupBy("part", "filter").agg(
        F.sum(F.col("removed") * times[size]).alias("shapley"),
        F.max(F.when(last, F.col("removed"))).alias("unique_fails"),
    )
    rows = found.join(F.broadcast(_steps(lists)), ["before", "filter"]).join(overall, ["part", "filter"])
    return rows.select(
        "part",
        "filter_order",
        "step",
        (F.col("documents") - F.col("gone") - F.col("removed")).alias("kept"),
        "removed",
        (F.col("failing") - F.col("removed")).alias("redundant"),
        "unique_fails",
        F.col("good").alias("good_lost"),
        F.col("toxic").alias("toxic_lost"),
        F.col("shapley").cast("long").alias("shapley"),
    )


# DuckDB SQL for the rows of audit(): counts per set of failed filters, without posting lists.
ORACLE = """
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents),
first AS (SELECT t, min(doc_id) AS first_id FROM d GROUP BY t),
f AS (
  SELECT d.doc_id, d.part,
         (len(w) < 200) AS a, (100 * list_unique(w) < 50 * len(w)) AS b,
         (100 * length(regexp_replace(d.t, '[^A-Z]', '', 'g')) > 2 * length(d.t)) AS c,
         regexp_matches(d.t, '[#$%&*|]') AS s,
         coalesce(d.doc_id > first.first_id, false) AS e
  FROM d JOIN first ON d.t = first.t),
one AS (
  SELECT doc_id, part, bool_or(a)::INT + 2 * bool_or(b)::INT + 4 * bool_or(c)::INT
         + 8 * bool_or(s)::INT + 16 * bool_or(e)::INT AS mask
  FROM f GROUP BY doc_id, part),
l AS (SELECT doc_id, coalesce(max((quality = 1)::INT), 0) AS good, coalesce(max((toxic = 1)::INT), 0) AS toxic
      FROM labels GROUP BY doc_id),
m AS (SELECT part, mask, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
      FROM one LEFT JOIN l ON one.doc_id = l.doc_id GROUP BY part, mask),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS name, unnest([1, 2, 4, 8, 16]) AS bit),
p AS (
  SELECT p1.name || p2.name || p3.name || p4.name || p5.name AS filter_order,
         [p1.bit, p2.bit, p3.bit, p4.bit, p5.bit] AS bits
  FROM x p1, x p2, x p3, x p4, x p5
  WHERE p1.bit | p2.bit | p3.bit | p4.bit | p5.bit = 31),
s AS (SELECT filter_order, step, bits[step] AS bit,
             coalesce(list_sum(bits[1:step - 1]), 0)::INT AS before
      FROM p, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
r AS (
  SELECT part, filter_order, step, bit,
         sum(n) FILTER (mask & (before | bit) = 0) AS kept,
         sum(n) FILTER (mask & bit > 0 AND mask & before = 0) AS removed,
         sum(n) FILTER (mask & bit > 0 AND mask & before > 0) AS redundant,
         sum(n) FILTER (mask = bit) AS unique_fails,
         sum(good) FILTER (mask & bit > 0 AND mask & before = 0) AS good_lost,
         sum(toxic) FILTER (mask & bit > 0 AND mask & before = 0) AS toxic_lost
  FROM m, s GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step::INT AS step, coalesce(kept, 0)::BIGINT AS kept,
       coalesce(removed, 0)::BIGINT AS removed, coalesce(redundant, 0)::BIGINT AS redundant,
       coalesce(unique_fails, 0)::BIGINT AS unique_fails, coalesce(good_lost, 0)::BIGINT AS good_lost,
       coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
       (sum(coalesce(removed, 0)) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM r
"""
