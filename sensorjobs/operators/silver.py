"""The silver core: time repair from a continuity cursor, value validation, deduplicated facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Minutes between two messages of a cursor source (a fixed value of the devices).
STEP_MINUTES = 5
#: Cursors of a block, about four months of one station at that interval.
BLOCK = 36_000
#: Blocks that are scanned together.
GROUP = 256


def _ordered(tie: Sequence[str]) -> list[Column]:
    return [F.col("cursor_id"), *[F.col(c) for c in tie]]


def running_last_valid(rows: DataFrame, tie: Sequence[str] = ("extracted_at", "source_row_id")) -> DataFrame:
    """``last_valid_ts`` and ``last_valid_cursor``: running maxima over the valid rows of a station, by cursor.

    The two maxima are separate and may come from different rows where clocks run backwards.
    """
    w = Window.partitionBy("station_code").orderBy(*_ordered(tie)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    valid = F.col("is_measured_at_valid")
    return rows.withColumns({
        "last_valid_ts": F.max(F.when(valid, F.col("measured_at_parsed"))).over(w),
        "last_valid_cursor": F.max(F.when(valid, F.col("cursor_id"))).over(w),
    })


def carried(ends: DataFrame, per: int = GROUP) -> DataFrame:
    """What the blocks before each block of a station add: ``carried_ts`` and ``carried_cursor``, null for the first.

    ``ends``: station_code, block, ts, cursor. Blocks are scanned in groups of ``per``; what earlier groups add comes from one row a
    group. A station has few groups (at five minutes one covers decades), so no task holds all blocks of a station.
    """
    cut = ends.select("station_code", "block", "ts", "cursor", F.floor(F.col("block") / per).alias("g"))
    totals = cut.groupBy("station_code", "g").agg(F.max("ts").alias("t"), F.max("cursor").alias("c"))
    earlier = totals.select(F.col("station_code").alias("s"), F.col("g").alias("h"), "t", "c")
    groups = totals.select("station_code", "g").join(earlier, (F.col("station_code") == F.col("s")) & (F.col("h") < F.col("g")))
    groups = groups.groupBy("station_code", "g").agg(F.max("t").alias("t"), F.max("c").alias("c"))
    before = Window.partitionBy("station_code", "g").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inner = cut.select("station_code", "g", "block", F.max("ts").over(before).alias("ti"), F.max("cursor").over(before).alias("ci"))
    both = inner.join(groups, ["station_code", "g"], "left")
    return both.select("station_code", "block", F.greatest("ti", "t").alias("carried_ts"), F.greatest("ci", "c").alias("carried_cursor"))


def last_valid_in_blocks(rows: DataFrame, tie: Sequence[str] = ("extracted_at", "source_row_id")) -> DataFrame:
    """The running maxima of rows that have ``block`` and what is carried into it; those three columns go."""
    valid = F.col("is_measured_at_valid")
    w = Window.partitionBy("station_code", "block").orderBy(*_ordered(tie)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = rows.withColumns({"__t": F.max(F.when(valid, F.col("measured_at_parsed"))).over(w), "__c": F.max(F.when(valid, F.col("cursor_id"))).over(w)})
    return own.withColumns({"last_valid_ts": F.greatest("__t", "carried_ts"), "last_valid_cursor": F.greatest("__c", "carried_cursor")}).drop("__t", "__c", "carried_ts", "carried_cursor", "block")


def running_last_valid_blocks(rows: DataFrame, block: int, tie: Sequence[str] = ("extracted_at", "source_row_id")) -> DataFrame:
    """As ``running_last_valid`` for stations with very long histories.

    A station is cut into blocks of ``block`` cursors: maxima run within a block, and what earlier
    blocks add comes from one row a block. Work spreads over (station, block), not stations alone.
    """
    cut = rows.withColumn("block", F.floor(F.col("cursor_id") / block))
    return last_valid_in_blocks(cut.join(carried(block_ends(rows, block)), ["station_code", "block"]), tie)


def impute_timestamps(rows: DataFrame) -> DataFrame:
    """``measured_at_silver``, ``is_time_imputed`` and ``imputation_method`` for rows with the running maxima."""
    valid = F.coalesce(F.col("is_measured_at_valid"), F.lit(False))
    anchored = F.col("last_valid_ts").isNotNull() & F.col("last_valid_cursor").isNotNull()
    fixed = F.expr(f"timestampadd(MINUTE, CAST({STEP_MINUTES} * (cursor_id - last_valid_cursor) AS INT), last_valid_ts)")
    return rows.withColumns({
        "measured_at_silver": F.when(valid, F.col("measured_at_parsed")).when(anchored, fixed),
        "is_time_imputed": ~valid & anchored,
        "imputation_method": F.when(valid, F.lit(None).cast("string")).when(anchored, F.lit("fiuna_id_5min")).otherwise(F.lit("unfixable_no_anchor")),
    }).drop("last_valid_ts", "last_valid_cursor")


def passthrough_timestamps(rows: DataFrame) -> DataFrame:
    """The same columns for sources without a cursor: valid times stay, others are null."""
    valid = F.coalesce(F.col("is_measured_at_valid"), F.lit(False))
    return rows.withColumns({
        "measured_at_silver": F.when(valid, F.col("measured_at_parsed")),
        "is_time_imputed": F.lit(False),
        "imputation_method": F.when(~valid, F.lit("invalid_timestamp_no_imputation")),
    })


def anchors(rows: DataFrame) -> DataFrame:
    """The state a later run needs: one row a station with both running maxima over its valid rows."""
    valid = F.col("is_measured_at_valid")
    return rows.groupBy("station_code").agg(F.max(F.when(valid, F.col("measured_at_parsed"))).alias("anchor_ts"), F.max(F.when(valid, F.col("cursor_id"))).alias("anchor_cursor"))


def carry_anchor(new_rows: DataFrame, state: DataFrame, block: int = BLOCK) -> DataFrame:
    """Repair new rows (all later than the state's) from their own valid rows and the stations' carried maxima.

    In blocks of cursors, as ``repair``: an anchor is what is carried into all blocks of its station.
    """
    cut = new_rows.withColumn("block", F.floor(F.col("cursor_id") / block)).join(carried(block_ends(new_rows, block)), ["station_code", "block"])
    run = cut.join(state.withColumnRenamed("station_code", "__s"), F.col("station_code") == F.col("__s"), "left")
    run = run.withColumns({"carried_ts": F.greatest("carried_ts", "anchor_ts"), "carried_cursor": F.greatest("carried_cursor", "anchor_cursor")})
    return impute_timestamps(last_valid_in_blocks(run.drop("__s", "anchor_ts", "anchor_cursor")))


def repair(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """Time repair of all sources: by cursor where there is one, else passed through. Work spreads over blocks of cursors."""
    with_cursor = F.col("cursor_id").isNotNull()
    return impute_timestamps(running_last_valid_blocks(rows.filter(with_cursor), block)).unionByName(passthrough_timestamps(rows.filter(~with_cursor)))


def block_ends(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """The state that runs on new and late rows need: both maxima over the valid rows of each station and block of cursors."""
    valid = F.col("is_measured_at_valid")
    cut = rows.filter(F.col("cursor_id").isNotNull()).withColumn("block", F.floor(F.col("cursor_id") / block))
    return cut.groupBy("station_code", "block").agg(F.max(F.when(valid, F.col("measured_at_parsed"))).alias("ts"), F.max(F.when(valid, F.col("cursor_id"))).alias("cursor"))


def validate_values(rows: DataFrame, rules: DataFrame, time: str = "measured_at_silver") -> DataFrame:
    """``is_value_valid`` and ``value_silver`` by the variable's rule; no rule: valid. Only rows with a time.

    ``rules`` has one row a variable and is joined as Spark sees fit (it is far below its broadcast limit).
    """
    rule = rules.withColumnRenamed("variable_code", "__v")
    v = F.col("value_parsed")
    fits = F.coalesce(v >= F.col("min_value"), F.lit(True)) & F.coalesce(v <= F.col("max_value"), F.lit(True))
    valid = F.when(F.col("__v").isNull(), F.lit(True)).when(v.isNull(), F.coalesce(F.col("allow_null"), F.lit(False))).otherwise(fits)
    out = rows.filter(F.col(time).isNotNull()).join(rule, F.col("variable_code") == F.col("__v"), "left").withColumn("is_value_valid", valid)
    return out.withColumn("value_silver", F.when(F.col("is_value_valid"), v)).drop("__v", "min_value", "max_value", "allow_null")


def silver_fact(rows: DataFrame, streams: DataFrame, time: str = "measured_at_silver") -> DataFrame:
    """Valid values of known streams: source_row_id, stream_id, timestamp, value_parsed, ingested_at."""
    valid = rows.filter(F.col("is_value_valid") & F.col("value_silver").isNotNull())
    return valid.join(streams, ["station_code", "variable_code", "data_source_name"]).select(
        "source_row_id", "stream_id", F.col(time).alias("timestamp"), F.col("value_silver").alias("value_parsed"), F.col("extracted_at").alias("ingested_at")
    )


def dedupe_latest(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order`` of each key; combined before the shuffle, unlike a ranking window."""
    rest = [c for c in rows.columns if c not in (*keys, *order)]
    best = rows.groupBy(*keys).agg(F.max_by(F.struct(*order, *rest) if rest else F.struct(*order), F.struct(*order)).alias("__x"))
    return best.select(*keys, "__x.*").select(*rows.columns)
