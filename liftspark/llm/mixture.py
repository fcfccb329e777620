"""Mixing sources to target weights, with DataFrame functions only.

Every document gets a random key that is a hash of its id. Within its source, documents are cut into
ranges of equal key width (keys are uniform, so ranges are even and no sampling is needed), token counts
are summed per range, and prefix sums over ranges plus a running sum inside each range place every
document on its source's line. The source's budget cuts that line exactly; whole epochs come first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from liftspark.llm.common import checked_broadcast, stored, unused

WORD = r"[^\x20\x09-\x0D]+"
#: Rows of a range; a running sum is taken within one.
ROWS_PER_RANGE = 8192
KEY_BITS, CELL_BITS = 60, 36


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sources: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """Adds ``weight`` and ``target`` to one row per source (``source``, ``source_size``).

    Sources by code point, null last, take ``weights`` in turn and divide ``share`` times all sizes by weight.
    A target stops at ``most`` times its source's size and the excess goes to the others by weight: the level
    at which ``sum(least(most * size, level * weight))`` meets the budget. In the order of ``most * size / weight``,
    the level assuming that all before are full is highest just behind the last full source.
    Without any word all targets are 0. The windows run over one row per source, not over documents.
    """
    by_name = Window.orderBy(F.asc_nulls_last("source"))
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (turn + 1).cast("int"))
    by_ratio = Window.orderBy((F.col("cap") / F.col("weight")), F.asc_nulls_last("source"))
    before, everything = by_ratio.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    level = (F.lit(float(share)) * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    return (
        sources.withColumn("weight", weight)
        .withColumn("cap", most * F.col("source_size"))
        .withColumn("level", level)
        .withColumn("target", F.least("cap", F.max("level").over(everything) * F.col("weight")))
        .drop("cap", "level")
    )


def hash_key(id: str, seed: str = "") -> Column:
    """A uniform random key of ``KEY_BITS`` bits that is a function of the id."""
    digest = F.md5(F.concat(F.lit(seed), F.coalesce(F.col(id).cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, KEY_BITS // 4), 16, 10).cast("long")


def _placed(documents: DataFrame, weights, share: float, most: float, id: str, source: str, text: str, seed: str, rows_per_range: int) -> DataFrame:
    """``doc_id, source, size, key, source_size, target, epochs, part``: ``part`` words are taken besides whole epochs."""
    rows = stored(
        documents.select(
            F.col(id).alias("doc_id"), F.col(source).alias("source"), word_count(text).alias("size"), hash_key(id, seed).alias("key")
        ),
        "mixture",
    )
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    sources = source_targets(sources, weights, share, most).select(
        F.col("source").alias("s"),
        "source_size",
        "target",
        F.ceil(F.col("n") / rows_per_range).alias("ranges"),
        F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long").alias("epochs"),
    )
    cell = F.shiftright(F.shiftright("key", KEY_BITS - CELL_BITS) * F.col("ranges"), CELL_BITS)
    placed = rows.join(sources, F.col("source").eqNullSafe(F.col("s")), "left").drop("s").withColumn("cell", cell)

    along = Window.partitionBy("s").orderBy("c").rowsBetween(Window.unboundedPreceding, -1)
    cells = (
        placed.groupBy(F.col("source").alias("s"), F.col("cell").alias("c"))
        .agg(F.sum("size").alias("held"))
        .select("s", "c", F.coalesce(F.sum("held").over(along), F.lit(0)).alias("start"))
    )
    inside = Window.partitionBy("source", "cell").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    left = F.floor(F.col("target") - F.col("epochs") * F.col("source_size")) - F.col("start") - F.coalesce(F.sum("size").over(inside), F.lit(0))
    return placed.join(cells, F.col("source").eqNullSafe(F.col("s")) & (F.col("cell") == F.col("c")), "left").select(
        "doc_id", "source", "size", "key", "source_size", "target", "epochs", F.greatest(F.lit(0), F.least("size", left)).cast("long").alias("part")
    )


def mix_sources(
    documents: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
    id: str = "doc_id",
    source: str = "source",
    text: str = "text",
    seed: str = "",
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """``doc_id, source, size, source_size, target, epochs, taken`` for each row of ``documents``.

    ``size`` counts words; a null text has none. ``taken`` words come from the document: ``epochs`` whole
    copies and, up to the source's budget, more in the order of the hash key (the document on the cut gives
    part of its words). A null source is a source of its own. Rows with equal keys go by id, then size, so
    equal rows are interchangeable and reruns agree. Only the three named columns are read; an empty table
    gives an empty result.
    """
    placed = _placed(documents, weights, share, most, id, source, text, seed, rows_per_range)
    taken = (F.col("epochs") * F.col("size") + F.col("part")).alias("taken")
    return placed.select("doc_id", "source", "size", "source_size", "target", "epochs", taken)


def mixed_documents(
    documents: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
    id: str = "doc_id",
    source: str = "source",
    text: str = "text",
    seed: str = "",
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """The mix of ``mix_sources`` itself: the rows of ``documents``, each as often as it is taken.

    The document on a source's cut gives its first words. What is taken follows from one row per source, the first that is
    not taken whole, so texts meet that small table and are not shuffled. Equal rows on a cut are cut alike.
    """
    placed = _placed(documents, weights, share, most, id, source, text, seed, rows_per_range)
    whole, epochs, at, part, s, words = unused(documents, "whole", "epochs", "at", "part", "of_source", "words")
    no_id = F.lit(-(1 << 63))
    not_whole = F.when(F.col("part") < F.col("size"), F.struct(F.struct("key", F.coalesce("doc_id", no_id), "size").alias("at"), "part"))
    cuts = (
        placed.groupBy(F.col("source").alias(s)).agg(F.max("epochs").alias(epochs), F.min(not_whole).alias("cut"))
        .select(s, epochs, F.col("cut.at").alias(at), F.col("cut.part").alias(part))
    )
    size = F.col(whole)
    place = F.struct(hash_key(id, seed), F.coalesce(F.col(id).cast("long"), no_id), size)
    extra = F.when(F.col(at).isNull() | (place < F.col(at)), size).when(place == F.col(at), F.col(part)).otherwise(0)
    copies = F.concat(F.array_repeat(size, F.col(epochs).cast("int")), F.array(extra.cast("long")))
    return (
        documents.withColumn(whole, word_count(text))
        .join(checked_broadcast(stored(cuts, "cuts"), 10_000), F.col(source).eqNullSafe(F.col(s)))
        .withColumn(words, F.explode(F.filter(copies, lambda n: n > 0)))
        .withColumn(text, F.when(F.col(words) < size, first_words(text, F.col(words))).otherwise(F.col(text)))
        .select(*documents.columns)
    )


def first_words(text: str, n: Column) -> Column:
    """The text up to the end of its ``n``-th word."""
    pieces = F.split(F.col(text), r"(?<=[\x20\x09-\x0D])(?=[^\x20\x09-\x0D])")
    lead = F.when(F.col(text).rlike(r"^[\x20\x09-\x0D]"), 1).otherwise(0)
    return F.regexp_replace(F.array_join(F.slice(pieces, 1, (n + lead).cast("int")), ""), r"[\x20\x09-\x0D]+$", "")


#: The same rows in SQL, for the default parameters and unique ids.
SQL = r"""
WITH rows AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5(doc_id::VARCHAR), 1, 15))::BIGINT AS key
  FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS nth FROM rows GROUP BY source),
weighed AS (SELECT *, CASE (nth - 1) % 3 WHEN 0 THEN 3e0 WHEN 1 THEN 1e0 ELSE 2e0 END AS weight, 2e0 * source_size AS cap FROM sources),
levels AS (
  SELECT *, (1.5e0 * sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
  FROM weighed WINDOW before AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (SELECT source, source_size, least(cap, max(level) OVER () * weight) AS target FROM levels),
epochs AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS epochs FROM targets),
prior AS (
  SELECT doc_id, source, size, coalesce(sum(size) OVER (
    PARTITION BY source ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prior FROM rows)
SELECT doc_id, size, source_size, target,
       (epochs * size + greatest(0, least(size, floor(target - epochs * source_size) - prior)))::BIGINT AS taken
FROM prior JOIN epochs ON prior.source IS NOT DISTINCT FROM epochs.source
"""
