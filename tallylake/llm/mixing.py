"""Mix sources to target weights with hash-threshold histograms.

Every document has a fixed hash. A source gives all its documents below a hash
threshold, so a larger budget only ever adds documents. The threshold is found
from histograms: words summed by source and leading hash bits show the bucket in
which the budget runs out, and only that bucket is cut further by the next bits,
until it holds one hash. Documents are never sorted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallylake.llm.tables import written
from tallylake.llm.words import word_array

HASH_BITS = 60
LEVEL_BITS = (12, 16, 16, 16)


def document_hash(doc_id: Column) -> Column:
    """The first 60 bits of the MD5 of the id as text; NULL counts as the empty text."""
    digest = F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("long")


def source_targets(
    sizes: DataFrame, weights: Sequence[int], share: float, ceiling: float
) -> DataFrame:
    """(source, source_size) with the words each source should give.

    Sources in code point order, NULL last, get the weights in turn. ``share`` times all
    words are dealt by weight; a source stops at ``ceiling`` times its own words and the
    excess is dealt again among the others. Each round is one aggregate of one row.
    """
    spark = sizes.sparkSession
    placed = sizes.orderBy(F.col("source").asc_nulls_last()).withColumn(
        "at", F.monotonically_increasing_id()
    )
    placed = written(placed.withColumn("part", F.shiftright("at", 33)), "mix-sources")
    # the rank is the place in a range partition plus the rows of earlier partitions;
    # the running sum is over one row per partition, not over sources
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("part").agg(F.count("*").alias("n"))
    offsets = offsets.withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0)))
    rank = F.col("offset") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    turn = F.array(*[F.lit(int(w)) for w in weights])
    ranked = placed.join(offsets.drop("n"), "part").select(
        "source",
        "source_size",
        turn[(rank % len(weights)).cast("int")].alias("weight"),
        (F.lit(float(ceiling)) * F.col("source_size")).alias("most"),
    )
    ranked = written(ranked, "mix-ranked")

    budget = share * (ranked.agg(F.sum("source_size")).first()[0] or 0)
    level, full = 0.0, -1
    while True:
        capped = F.col("most") <= F.col("weight") * F.lit(level)
        row = ranked.agg(
            F.count_if(capped).alias("full"),
            F.coalesce(F.sum(F.when(capped, F.col("most"))), F.lit(0.0)).alias("spent"),
            F.coalesce(F.sum(F.when(~capped, F.col("weight"))), F.lit(0)).alias("weight"),
        ).first()
        if row["full"] == full or not row["weight"]:
            break
        full, level = row["full"], (budget - row["spent"]) / row["weight"]
    target = F.least(F.col("most"), F.col("weight") * F.lit(level))
    if not row["weight"]:
        target = F.col("most")
    return ranked.select("source", "source_size", target.cast("double").alias("target"))


def _sized(docs: DataFrame, doc_id: str, text: str, source: str) -> DataFrame:
    """``docs`` as one struct column ``row`` with the source, size and hash of each."""
    return docs.select(F.struct("*").alias("row")).select(
        "row",
        F.col(f"row.`{doc_id}`").alias("doc_id"),
        F.col(f"row.`{source}`").cast("string").alias("source"),
        F.size(word_array(F.col(f"row.`{text}`"))).cast("long").alias("size"),
        document_hash(F.col(f"row.`{doc_id}`")).alias("h"),
    )


def _thresholds(slim: DataFrame, weights: Sequence[int], share: float, ceiling: float) -> DataFrame:
    """One row per source: its target, whole repeats, hash threshold, and what the threshold still gives."""
    if int(ceiling) != ceiling:
        raise ValueError("the ceiling is a whole number of repeats")
    sizes = slim.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = source_targets(sizes, weights, share, ceiling)

    # whole repeats of the source, then words still to be found below the threshold
    repeats = F.when(
        F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))
    ).otherwise(0)
    state = sources.withColumn("repeats", repeats.cast("long")).withColumn(
        "left", F.floor(F.col("target") - F.col("repeats") * F.col("source_size")).cast("long")
    )
    state = written(state.withColumn("prefix", F.lit(0).cast("long")), "mix-state")

    shift = HASH_BITS
    rows = slim
    for bits in LEVEL_BITS:
        edge = state.select(F.col("source").alias("of"), F.col("prefix").alias("edge"), "left")
        if shift < HASH_BITS:  # rows of the boundary bucket only
            rows = rows.join(
                edge,
                rows["source"].eqNullSafe(edge["of"])
                & (F.shiftright(rows["h"], shift) == edge["edge"]),
                "left_semi",
            )
        shift -= bits
        histogram = rows.groupBy("source", F.shiftright("h", shift).alias("bucket")).agg(
            F.sum("size").alias("words"), F.min("h").alias("low"), F.max("h").alias("high")
        )
        upto = Window.partitionBy("source").orderBy("bucket")  # at most 2^bits rows a source
        histogram = histogram.withColumn("cum", F.sum("words").over(upto))
        cut = histogram.join(edge, histogram["source"].eqNullSafe(edge["of"]))
        before = F.col("cum") - F.col("words")
        # at most one bucket a source holds the point where its budget runs out
        cut = cut.filter((F.col("cum") > F.col("left")) & (before <= F.col("left"))).select(
            "of", "bucket", (F.col("left") - before).alias("rest"), "words", "low", "high"
        )
        base = state.select("source", "source_size", "target", "repeats")
        state = base.join(cut, base["source"].eqNullSafe(cut["of"]), "left").select(
            "source",
            "source_size",
            "target",
            "repeats",
            F.coalesce("bucket", F.lit(-1)).alias("prefix"),  # -1: nothing left to find
            F.coalesce("rest", F.lit(0)).alias("left"),
            F.coalesce("words", F.lit(0)).alias("words"),
            "low",
            "high",
        )
        state = written(state, "mix-state")
        if not state.filter(F.col("low") < F.col("high")).take(1):
            break
    # one hash is left per boundary bucket; a source without one takes nothing more
    return state.select(
        F.col("source").alias("of"),
        "source_size",
        "target",
        "repeats",
        F.coalesce("low", F.lit(-1)).alias("threshold"),
        F.col("left").alias("rest"),
        "words",
    )


def _taken() -> Column:
    part = (
        F.when(F.col("h") < F.col("threshold"), F.col("size"))
        .when(
            (F.col("h") == F.col("threshold")) & (F.col("words") > 0),
            F.expr("size * rest div words"),
        )
        .otherwise(0)
    )
    return (F.col("repeats") * F.col("size") + part).cast("long").alias("taken")


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[int] = (5, 2, 1),
    share: float = 1.5,
    ceiling: float = 2.0,
) -> DataFrame:
    """(doc_id, size, source_size, target, taken): the words each document gives to the mix.

    A source whose target is above its size gives every document once and part of them
    twice. Where the budget runs out inside a document, ``taken`` counts only its first
    words, so a source meets its target but for rounding. Rows with the same doc_id share a
    hash and so a decision; at the threshold each gives the same share of its words.
    NULL ids hash as the empty text, NULL sources are a source of their own, NULL texts have
    no words and give none. Other columns are ignored. An empty table gives no rows.
    """
    slim = written(_sized(docs, doc_id, text, source).drop("row"), "mix-documents")
    final = _thresholds(slim, weights, share, ceiling)
    rows = slim.join(final, slim["source"].eqNullSafe(final["of"]))
    return rows.select("doc_id", "size", "source_size", "target", _taken())


def mixed_documents(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[int] = (5, 2, 1),
    share: float = 1.5,
    ceiling: float = 2.0,
) -> DataFrame:
    """The documents that the mix takes words of, with all their columns and ``taken``.

    A column of that name in the input is replaced. See :func:`mix` for the decisions.
    """
    sized = _sized(docs, doc_id, text, source)
    slim = written(sized.drop("row"), "mix-documents")
    final = _thresholds(slim, weights, share, ceiling)
    rows = sized.join(final, sized["source"].eqNullSafe(final["of"])).withColumn("taken", _taken())
    columns = [F.col(f"row.`{c}`").alias(c) for c in docs.columns if c != "taken"]
    return rows.filter("taken > 0").select(*columns, "taken")


# DuckDB SQL for the rows of mix().
ORACLE = """
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS h
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
r AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
                WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight,
             2.0::DOUBLE * source_size AS most FROM s),
o AS (SELECT *, row_number() OVER (ORDER BY most / weight, source NULLS LAST) AS k FROM r),
c AS (SELECT k, most / weight AS own,
             coalesce(sum(most) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spent,
             sum(weight) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight
      FROM o),
v AS (SELECT arg_min((1.5::DOUBLE * (SELECT sum(source_size) FROM s) - spent) / open_weight, k) AS level
      FROM c WHERE (1.5::DOUBLE * (SELECT sum(source_size) FROM s) - spent) / open_weight <= own),
t AS (SELECT source, source_size, least(most, weight * level) AS target FROM r, v),
b AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS repeats
      FROM t),
l AS (SELECT *, CAST(floor(target - repeats * source_size) AS BIGINT) AS budget FROM b),
g AS (SELECT source, h, sum(size) AS words FROM d GROUP BY source, h),
u AS (SELECT *, sum(words) OVER (PARTITION BY source ORDER BY h) - words AS before FROM g)
SELECT d.doc_id, CAST(d.size AS BIGINT) AS size, l.source_size, l.target,
       CAST(l.repeats * d.size
         + CASE WHEN u.before + u.words <= l.budget THEN d.size
                WHEN u.before >= l.budget OR u.words = 0 THEN 0
                ELSE CAST(d.size AS BIGINT) * (l.budget - u.before) // u.words END AS BIGINT) AS taken
FROM d JOIN l ON d.source IS NOT DISTINCT FROM l.source
JOIN u ON u.source IS NOT DISTINCT FROM d.source AND u.h = d.h
"""
