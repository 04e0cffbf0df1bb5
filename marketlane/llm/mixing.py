"""Mixing sources to target weights along a time-varying curriculum. DataFrame functions only.

Sources share a budget by weight; a source stops at a multiple of its own words and the
excess goes to the others by weight until none is above. Training time runs from 0 to 1.
Each source has a weight schedule over that time, a line through given points; its
integral, scaled to the source's target, is the source's cumulative word demand. A
source's documents stand in a fixed shuffled order and supply words one after another,
over again when the target exceeds what there is. The time at which demand reaches a
document's place in that supply is its training position, by inverting the integral.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from marketlane.llm.common import fresh_name, scratch, stored, without

WORD = r"[^\x20\x09-\x0D]+"
Schedule = tuple[tuple[float, float], ...]

ADDED = ("size", "source_size", "target", "taken", "position", "second_position")


@dataclass(frozen=True)
class Curriculum:
    """Weights and schedules repeat over the sources in code point order, null last."""

    weights: tuple[float, ...] = (3.0, 1.0, 2.0)
    share: float = 1.5
    passes: int = 2
    schedules: tuple[Schedule, ...] = (
        ((0.0, 1.0), (1.0, 1.0)),
        ((0.0, 0.25), (0.5, 1.0), (1.0, 1.75)),
        ((0.0, 1.75), (0.5, 1.0), (1.0, 0.25)),
    )
    bucket_digits: int = 5


def words_in(text: str | Column) -> Column:
    """Runs of characters other than ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sums: DataFrame, curriculum: Curriculum) -> DataFrame:
    """One row per source from sums of parts of it: ``number, source_size, target``.

    With sources by ascending ratio of limit to weight, the level at which the rest
    shares what the first i leave is ``(budget - limits of i) / (weights of the others)``;
    the true level is the largest of these. Only one row per source passes the window.
    """
    per = sums.groupBy("_source").agg(F.sum("_sum").alias("source_size"))
    everything = Window.orderBy(F.asc_nulls_last("_source"))
    n = len(curriculum.weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in curriculum.weights]), ((F.col("number") - 1) % n + 1).cast("int"))
    per = per.withColumn("number", F.row_number().over(everything)).withColumn("_weight", weight)
    per = per.withColumn("_limit", F.col("source_size").cast("double") * float(curriculum.passes))
    ahead = Window.orderBy(F.col("_limit") / F.col("_weight"), "number").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    budget = F.sum("source_size").over(whole).cast("double") * curriculum.share
    level = (budget - F.coalesce(F.sum("_limit").over(ahead), F.lit(0.0))) / (
        F.sum("_weight").over(whole) - F.coalesce(F.sum("_weight").over(ahead), F.lit(0.0))
    )
    per = per.withColumn("_level", level).withColumn("_level", F.max("_level").over(whole))
    return per.select(
        "_source", "number", "source_size",
        F.least("_limit", F.col("_level") * F.col("_weight")).alias("target"),
    )


def _integrals(schedule: Schedule) -> list[float]:
    sums = [0.0]
    for (t0, w0), (t1, w1) in zip(schedule, schedule[1:], strict=False):
        sums.append(sums[-1] + (w0 + w1) / 2 * (t1 - t0))
    return sums


def time_of(fraction: Column, number: Column, schedules: Sequence[Schedule]) -> Column:
    """When a source has asked for this fraction of its words: the inverted integral."""
    out = F.lit(None).cast("double")
    for i, schedule in enumerate(schedules):
        sums = _integrals(schedule)
        asked = fraction * sums[-1]
        own = F.lit(float(schedule[-1][0]))
        segments = list(zip(schedule, schedule[1:], sums, sums[1:], strict=False))
        for (t0, w0), (t1, w1), below, above in reversed(segments):
            slope, rest = (w1 - w0) / (t1 - t0), asked - below
            root = F.sqrt(F.greatest(F.lit(w0 * w0) + 2 * slope * rest, F.lit(0.0)))
            inside = F.lit(float(t0)) + F.coalesce(F.try_divide(2 * rest, F.lit(float(w0)) + root), F.lit(0.0))
            own = F.when(asked < above, inside).otherwise(own)
        out = F.when((number - 1) % len(schedules) == i, own).otherwise(out)
    return F.round(out, 9)


def placed(
    docs: DataFrame, curriculum: Curriculum | None = None, key: str = "doc_id",
    source: str = "source", text: str = "text",
) -> DataFrame:
    """All rows and columns plus ``size, source_size, target, taken, position, second_position``.

    ``taken`` counts the words the mix takes from a document, repeats included; it never
    exceeds ``passes`` (at most 2) times the size, and a source's sum is its target to the
    nearest word: the last document may be taken in part. Positions are null where a pass
    takes nothing. Null or empty texts have size 0 and give nothing; a null source is a
    source of its own. Documents of one key and text tie and are interchangeable, so
    reruns agree. Columns already called so are replaced; an empty table gives no rows.

    Running sums are taken in buckets of the shuffled order, 16**``bucket_digits`` for each
    source, and shifted by the sums of the buckets before: no task holds a source.
    """
    curriculum = curriculum or Curriculum()
    docs = without(docs, [c for c in ADDED if c.lower() not in {key.lower(), source.lower(), text.lower()}])
    order = fresh_name(docs, "_order")
    sized = docs.withColumn("size", words_in(F.col(text))).withColumn(order, shuffled_order(key, text))
    return _placed(sized, curriculum, source, order)


def shuffled_order(key: str, text: str) -> Column:
    """A digest of key and text: rows of one key lie apart unless their texts are the same too."""
    of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return F.md5(F.concat(of(key), F.lit(":"), F.md5(of(text).cast("binary"))).cast("binary"))


def _placed(sized: DataFrame, curriculum: Curriculum, source: str, order: str) -> DataFrame:
    wishes = ("_bucket", "_number", "_own", "_before", "_source", "_at")
    temp = {n: fresh_name(sized, n) for n in wishes}
    names = [c for c in sized.columns if c not in ("size", order)]
    bucket, number = temp["_bucket"], temp["_number"]
    # The first digits of the shuffled order are the bucket.
    rows = sized.withColumn(bucket, F.substring(order, 1, curriculum.bucket_digits))
    with scratch(sized.sparkSession) as keep:
        offsets = keep(_offsets(rows, source, bucket, curriculum, temp))
    inside = Window.partitionBy(source, bucket).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn(temp["_own"], F.coalesce(F.sum("size").over(inside), F.lit(0)))
    rows = rows.join(
        offsets, F.col(source).eqNullSafe(F.col(temp["_source"])) & (F.col(bucket) == F.col(temp["_at"]))
    )

    place = F.col(temp["_own"]) + F.col(temp["_before"])
    goal = F.floor(F.col("target") + 0.5).cast("bigint")
    zero = F.lit(0).cast("bigint")
    first = F.greatest(zero, F.least(F.col("size"), goal - place))
    second = F.greatest(zero, F.least(F.col("size"), goal - F.col("source_size") - place)) if curriculum.passes > 1 else zero
    when = lambda at, part: F.when(part > 0, time_of(at / goal, F.col(number), curriculum.schedules))
    return rows.select(
        *[f"`{n}`" for n in names], "size", "source_size", "target", (first + second).alias("taken"),
        when(place, first).alias("position"), when(place + F.col("source_size"), second).alias("second_position"),
    )


def _offsets(rows: DataFrame, source: str, bucket: str, curriculum: Curriculum, temp: dict[str, str]) -> DataFrame:
    """Words before each bucket of each source, with the source's number and target."""
    sums = rows.groupBy(F.col(source).alias("_source"), F.col(bucket).alias("_b")).agg(F.sum("size").alias("_sum"))
    sums = stored(sums.withColumn("_wide", F.substring("_b", 1, curriculum.bucket_digits // 2)), "bucket-sums")
    per = stored(source_targets(sums, curriculum), "source-targets")

    def before(window: WindowSpec) -> Column:
        return F.coalesce(F.sum("_sum").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    # Two levels: buckets inside a range of them, then the ranges of a source.
    inner = sums.withColumn("_near", before(Window.partitionBy("_source", "_wide").orderBy("_b")))
    ranges = sums.groupBy("_source", "_wide").agg(F.sum("_sum").alias("_sum"))
    ranges = ranges.withColumn("_far", before(Window.partitionBy("_source").orderBy("_wide")))
    ranges = ranges.select(F.col("_source").alias("_s"), F.col("_wide").alias("_w"), "_far")
    shifts = inner.join(ranges, F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_wide") == F.col("_w")))
    shifts = shifts.select("_s", "_b", (F.col("_near") + F.col("_far")).alias("_shift"))
    offsets = per.join(shifts, F.col("_source").eqNullSafe(F.col("_s"))).select(
        F.col("_source").alias(temp["_source"]), F.col("_b").alias(temp["_at"]), F.col("number").alias(temp["_number"]),
        "source_size", "target", F.col("_shift").alias(temp["_before"]),
    )
    return stored(offsets, "bucket-offsets")


def mixed(docs: DataFrame, curriculum: Curriculum | None = None, key: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """``placed``, range-sorted by training position; documents the mix leaves out come last."""
    rows = placed(docs, curriculum, key, source, text)
    order = [F.asc_nulls_last("position"), F.asc_nulls_last(key)]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order)


def training_order(docs: DataFrame, curriculum: Curriculum | None = None, key: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """One row per document and pass, with ``position`` and ``words`` taken, in training order."""
    rows = placed(docs, curriculum, key, source, text)
    first = F.least("taken", "size")
    passes = F.array(
        F.struct(F.col("position").alias("at"), first.alias("words")),
        F.struct(F.col("second_position").alias("at"), (F.col("taken") - first).alias("words")),
    )
    names = [f"`{c}`" for c in rows.columns if c not in ("position", "second_position", "taken")]
    part = fresh_name(rows, "_pass")
    out = rows.select(*names, F.explode(F.filter(passes, lambda p: p["words"] > 0)).alias(part))
    out = out.select(*names, F.col(f"{part}.at").alias("position"), F.col(f"{part}.words").alias("words"))
    order = [F.col("position"), F.asc_nulls_last(key)]
    return out.repartitionByRange(*order).sortWithinPartitions(*order)


def digest(docs: DataFrame) -> DataFrame:
    """Per document: sizes, its source's target, the words taken and the first position.

    Sizes are counted once and stored; texts go no further.
    """
    order = shuffled_order("doc_id", "text").alias("_order")
    sized = stored(docs.select("doc_id", "source", words_in("text").alias("size"), order), "sizes")
    rows = _placed(sized, Curriculum(), "source", "_order")
    order = [F.asc_nulls_last("position"), F.asc_nulls_last("doc_id")]
    rows = rows.select("doc_id", "size", "source_size", "target", "taken", "position")
    return rows.repartitionByRange(*order).sortWithinPartitions(*order)


#: The same result in DuckDB, from the closed form of the level and the inverted integrals.
DIGEST_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))) AS shuffled FROM documents
), per AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS number
  FROM sized GROUP BY source
), weighed AS (
  SELECT *, [3.0, 1.0, 2.0][(number - 1) % 3 + 1]::DOUBLE AS weight, 2.0::DOUBLE * source_size AS most,
         1.5::DOUBLE * (SELECT sum(source_size) FROM per)::DOUBLE AS budget FROM per
), levels AS (
  SELECT *, (budget - coalesce(sum(most) OVER ahead, 0)) /
            ((SELECT sum(weight) FROM weighed) - coalesce(sum(weight) OVER ahead, 0)) AS level
  FROM weighed WINDOW ahead AS (ORDER BY most / weight, number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targets AS (
  SELECT source, number, source_size, least(most, (SELECT max(level) FROM levels) * weight) AS target FROM levels
), places AS (
  SELECT doc_id, size, source_size, target, number, floor(target + 0.5)::BIGINT AS goal,
         coalesce(sum(size) OVER (PARTITION BY number ORDER BY shuffled
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS place
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source
), parts AS (
  SELECT *, greatest(0, least(size, goal - place)) AS a, greatest(0, least(size, goal - source_size - place)) AS b,
         place / goal AS u FROM places
)
SELECT doc_id, size, source_size, target, (a + b)::BIGINT AS taken,
  CASE WHEN a > 0 THEN round(CASE (number - 1) % 3
    WHEN 0 THEN 2 * u / (1 + sqrt(greatest(1.0 + 2 * 0.0 * u, 0)))
    WHEN 1 THEN CASE WHEN u < 0.3125 THEN 2 * u / (0.25 + sqrt(greatest(0.0625 + 2 * 1.5 * u, 0)))
                     ELSE 0.5 + 2 * (u - 0.3125) / (1 + sqrt(greatest(1.0 + 2 * 1.5 * (u - 0.3125), 0))) END
    ELSE CASE WHEN u < 0.6875 THEN 2 * u / (1.75 + sqrt(greatest(3.0625 - 2 * 1.5 * u, 0)))
              ELSE 0.5 + 2 * (u - 0.6875) / (1 + sqrt(greatest(1.0 - 2 * 1.5 * (u - 0.6875), 0))) END
  END, 9) END AS position
FROM parts
"""
