"""Normalisation and enrichment of raw event records.

- ``normalise_code``: zero-padded string code, so ``5``, ``'5'`` and
  ``'05'`` join with each other.
- ``date_parts``: parsed event date plus year/month/day, never raising.
- ``enrich_left_join``: keep every event, attach dimension columns;
  ``enrich_large_dimension``: the same for a dimension above broadcast size.
- ``unmatched_keys``: event codes the dimension does not know, with counts.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epilake.functions.columns import as_date
from epilake.functions.columns import normalise_code as code_expr


def normalise_code(df: DataFrame, src: str, out: str = "code", width: int = 2) -> DataFrame:
    """Add ``out`` = ``src`` as a zero-padded string code."""
    return df.withColumn(out, code_expr(src, width))


def date_parts(df: DataFrame, src: str, date_out: str = "event_date",
               year: str = "year", month: str = "month", day: str = "day") -> DataFrame:
    """Add the parsed date and its parts; unparseable input gives nulls."""
    parsed = as_date(src, df.schema[src].dataType)
    return df.withColumns({date_out: parsed}).withColumns({
        year: F.year(date_out),
        month: F.month(date_out),
        day: F.dayofmonth(date_out),
    })


def enrich_left_join(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str,
                     dim_columns: Mapping[str, str], width: int = 2) -> DataFrame:
    """Left outer join of events to a dimension on a normalised code.

    ``dim_columns`` maps dimension column -> output name (the dimension key
    itself may be included). Every event row is kept once; misses get nulls.
    Dimension rows whose keys are equal once normalised count as one (the
    greatest row), so they multiply no event. The planner chooses the join
    by the dimension's measured bytes.
    """
    k = "__join_key"
    right = dim.select(code_expr(dim_key, width).alias(k),
                       *[F.col(c).alias(o) for c, o in dim_columns.items()])
    right = (right.groupBy(k).agg(F.max(F.struct(*dim_columns.values())).alias("__dim"))
             .select(k, "__dim.*"))
    left = fact.withColumn(k, code_expr(fact_key, width))
    return left.join(right, on=k, how="left").drop(k)


#: Most bits of a key filter: 8 MB, sent to every task.
FILTER_BITS = 1 << 26


def key_filter(keys: DataFrame, key: str, bits: int) -> DataFrame:
    """A Bloom filter of two hashes over the values of ``key``, as a table
    (``word``, ``set``) of at most ``bits / 64`` rows, or-ed together on the
    map side first."""
    places = F.array(*[F.pmod(F.xxhash64(F.lit(i), F.col(key)), F.lit(bits)) for i in range(2)])
    return (keys.filter(F.col(key).isNotNull()).select(F.explode(places).alias("place"))
            .select(F.floor(F.col("place") / 64).alias("word"),
                    F.expr("shiftleft(1L, CAST(place % 64 AS INT))").alias("bit"))
            .groupBy("word").agg(F.bit_or("bit").alias("set")))


def _maybe_known(df: DataFrame, key: str, words: DataFrame, bits: int, out: str) -> DataFrame:
    """``out``: false where ``key`` is null or certainly not in the filter."""
    known = F.col(key).isNotNull()
    for i in range(2):
        place = F.pmod(F.xxhash64(F.lit(i), F.col(key)), F.lit(bits))
        side = F.broadcast(words.select(F.col("word").alias(f"__word{i}"), F.col("set").alias(f"__set{i}")))
        df = (df.withColumn(f"__at{i}", F.floor(place / 64)).withColumn(f"__bit{i}", (place % 64).cast("int"))
              .join(side, F.col(f"__at{i}") == F.col(f"__word{i}"), "left"))
        known = known & (F.expr(f"shiftrightunsigned(coalesce(__set{i}, 0L), __bit{i}) & 1L") == 1)
    return df.withColumn(out, known).drop(*[f"__{c}{i}" for c in ("at", "bit", "word", "set") for i in range(2)])


def enrich_large_dimension(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str,
                           dim_columns: Mapping[str, str], width: int = 2, salts: int = 16,
                           hot: int | None = None) -> DataFrame:
    """:func:`enrich_left_join` for a dimension above broadcast size.

    Events whose code is null or not in a Bloom filter of the dimension's
    keys stay where they are: nothing is shuffled for a match that can't be.
    The filter has about 16 bits a key, at most ``FILTER_BITS``; beyond that
    more unmatched events take part in the join, to the same result. Of the rest,
    a code with more than ``hot`` events (default: a sixteenth of a shuffle
    partition's even share, so there are at most 16 such codes per shuffle
    partition) is dealt over ``salts`` tasks, and its dimension row with it.
    Two small jobs count the keys and the hot codes when the DataFrame is
    built, over the code column alone.
    """
    spark = fact.sparkSession
    k, salt = "__join_key", "__salt"
    right = dim.select(code_expr(dim_key, width).alias(k),
                       *[F.col(c).alias(o) for c, o in dim_columns.items()])
    right = (right.groupBy(k).agg(F.max(F.struct(*dim_columns.values())).alias("__dim"))
             .select(k, "__dim.*"))
    bits = min(FILTER_BITS, max(1 << 10, 1 << (16 * right.count()).bit_length()))
    words = key_filter(right, k, bits)
    left = _maybe_known(fact.withColumn(k, code_expr(fact_key, width)), k, words, bits, "__maybe")
    hopeful, hopeless = left.filter("__maybe").drop("__maybe"), left.filter("NOT __maybe").drop("__maybe")

    per_code = hopeful.select(k).groupBy(k).agg(F.count(F.lit(1)).alias("__n"))
    if hot is None:
        partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
        hot = max(1, (per_code.agg(F.sum("__n")).first()[0] or 0) // (16 * partitions))
    hot_codes = per_code.filter(F.col("__n") > hot).select(F.col(k).alias("__hot"))
    dealt = F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int")
    hopeful = (hopeful.join(F.broadcast(hot_codes), F.col(k) == F.col("__hot"), "left")
               .withColumn(salt, F.when(F.col("__hot").isNotNull(), dealt).otherwise(0)).drop("__hot"))
    right = (right.join(F.broadcast(hot_codes), F.col(k) == F.col("__hot"), "left")
             .withColumn(salt, F.explode(F.when(F.col("__hot").isNotNull(), F.sequence(F.lit(0), F.lit(salts - 1)))
                                         .otherwise(F.array(F.lit(0))))).drop("__hot"))
    joined = hopeful.join(right, [k, salt], "left").drop(k, salt)
    nulls = {o: F.lit(None).cast(dim.schema[c].dataType) for c, o in dim_columns.items()}
    return joined.unionByName(hopeless.drop(k).withColumns(nulls))


def unmatched_keys(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str,
                   width: int = 2, out_key: str = "code", out_count: str = "events") -> DataFrame:
    """Normalised event codes with no dimension row, and how many events
    carry each. Events are aggregated per code first (map-side partial
    aggregation), so the anti join only sees one row per code."""
    per_code = (fact.select(code_expr(fact_key, width).alias(out_key))
                .groupBy(out_key).agg(F.count(F.lit(1)).alias(out_count)))
    keys = dim.select(code_expr(dim_key, width).alias(out_key))
    return per_code.join(keys, on=out_key, how="left_anti")


def trusted_cases(cases: DataFrame, dim: DataFrame, raw_code: str = "region_raw",
                  dim_key: str = "code", date_col: str = "report_date", large_dim: bool = False) -> DataFrame:
    """Raw events + dimension columns (``dim_code``, ``dim_name``,
    ``population``) + parsed ``event_date`` and its year/month/day.
    ``large_dim`` joins by :func:`enrich_large_dimension`."""
    enriched = (enrich_large_dimension if large_dim else enrich_left_join)(
        cases, dim, raw_code, dim_key,
        {dim_key: "dim_code", "name": "dim_name", "population": "population"})
    return date_parts(enriched, date_col)
