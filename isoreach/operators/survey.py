"""Survey legs and trips: flags, trip building, persons' cascades.

Everything about a trip is one aggregate by trip over its legs in order; a trip
has few legs, so the windows and ordered aggregates stay small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isoreach.functions import survey as S
from isoreach.sources.store import stash

# Speed envelopes in km/h by mode, and the limits (s, m) of trip plausibility.
SPEEDS = {"walk": (2.0, 8.0), "rbike": (5.0, 30.0), "ebike25": (7.0, 32.0), "ebike45": (7.0, 47.0), "anybike": (5.0, 32.0), "anyebike": (7.0, 47.0), "car": (5.0, 130.0)}
BIKES = ("rbike", "ebike25", "ebike45")
FAST_CHECK_S, MIN_LINE_M, DETOUR_FLOOR_M = 600.0, 100.0, 500.0
UNEXPLAINED_S, UNEXPLAINED_FLOOR_S = 1800.0, 600.0
OTHER_LEG_S, TRANSIT_OTHER_LEG_S = 900.0, 1800.0


def _speed(bound: int) -> Column:
    out = F.lit(None).cast("double")
    for m, b in SPEEDS.items():
        out = F.when(F.col("mode") == m, F.lit(b[bound])).otherwise(out)
    return out


def sequence_number(leg_id: Column) -> Column:
    """The number that ends a leg id: legs follow it, not the text."""
    return F.regexp_extract(leg_id.cast("string"), r"([0-9]+)$", 1).cast("int")


def speed_sides(legs: DataFrame) -> DataFrame:
    """too_slow and too_fast: whether even the fastest (slowest) speed that a rounded report can stand for is out of bounds."""
    i = S.report_interval(F.col("time_measured"))
    lo, hi = F.when(i["on_step"], i["rounded_lo"]).otherwise(i["exact_lo"]), F.when(i["on_step"], i["rounded_hi"]).otherwise(i["exact_hi"])
    km = F.col("dist_measured") / 1000.0
    slow = F.when(lo > 0, km / (lo / 3600.0) < _speed(0))
    fast = km / (hi / 3600.0) > _speed(1)
    return legs.withColumns({"too_slow": F.coalesce(slow, F.lit(False)), "too_fast": F.coalesce(fast, F.lit(False))})


def positions(legs: DataFrame) -> DataFrame:
    """pos within the trip from 0, and the first and last transit leg's positions."""
    w = Window.partitionBy("trip_id")
    legs = legs.where("trip_id is not null").withColumn("pos", F.row_number().over(w.orderBy(sequence_number(F.col("leg_id")), "leg_id")) - 1)
    at = F.when(F.col("mode") == "transit", F.col("pos"))
    return legs.withColumns({"first_t": F.min(at).over(w), "last_t": F.max(at).over(w)})


def drop_causes(legs: DataFrame) -> DataFrame:
    """trip_id, cause: 'legs missing', 'other leg combination', or null for trips that are kept."""
    p = positions(legs)
    walk, transit = F.col("mode") == "walk", F.col("mode") == "transit"
    feeder = ~walk & ~transit
    g = p.groupBy("trip_id").agg(
        F.count("*").alias("present"),
        F.min_by("n_legs_in_trip", "pos").alias("wanted"),
        F.count_if(walk).alias("walks"),
        F.count_if(transit).alias("transits"),
        F.count_if(feeder).alias("feeders"),
        F.count_if(feeder & (F.col("pos") > F.col("first_t")) & (F.col("pos") < F.col("last_t"))).alias("between"),
        F.count_if(feeder & (F.col("pos") < F.col("first_t"))).alias("before"),
        F.count_if(feeder & (F.col("pos") > F.col("last_t"))).alias("after"),
    )
    fine = "(present = 1 and walks = 1) or (transits = 0 and feeders = 1) or (transits >= 1 and between = 0 and before <= 1 and after <= 1)"
    return g.select("trip_id", F.expr(f"case when present <> wanted then 'legs missing' when not ({fine}) then 'other leg combination' end").alias("cause"))


def trips(legs: DataFrame) -> DataFrame:
    """Door-to-door trips of the legs: ends, times, main mode, counts, plausibility flags, gap and unexplained time.

    legs: leg_id, trip_id, mode, n_legs_in_trip, dist_measured, time_measured,
    departure, arrival (seconds), orig_x/y, dest_x/y, is_valid_dist_time.
    """
    kept = drop_causes(legs).where("cause is null").select("trip_id")
    p = speed_sides(positions(legs.join(kept, "trip_id", "left_semi")))
    walk, transit = F.col("mode") == "walk", F.col("mode") == "transit"
    rank = F.when(transit, 0).when(~walk, 1).otherwise(2)
    first, last, main = (lambda c: F.min_by(c, "pos")), (lambda c: F.max_by(c, "pos")), (lambda c: F.min_by(c, F.struct(rank.alias("r"), "pos")))
    main_mode = p.groupBy("trip_id").agg(main("mode").alias("main_mode"))
    p = p.join(main_mode, "trip_id")
    is_main = F.col("mode") == F.col("main_mode")
    i = S.report_interval(F.col("time_measured"))
    excess = F.greatest(F.lit(0.0), F.least(i["exact_lo"], F.coalesce(i["rounded_lo"], i["exact_lo"])) - F.col("dist_measured") / (_speed(0) / 3.6))
    bikes, cars = F.bool_or(F.col("mode").isin(*BIKES)), F.bool_or(F.col("mode") == "car")
    every_main = lambda ok: F.bool_and(ok | ~is_main)
    g = p.groupBy("trip_id").agg(
        F.first("main_mode").alias("mode"),
        first("orig_x").alias("orig_x"), first("orig_y").alias("orig_y"), last("dest_x").alias("dest_x"), last("dest_y").alias("dest_y"),
        first("departure").alias("departure"), last("arrival").alias("arrival"),
        F.sum("dist_measured").alias("dist_measured"), F.sum("time_measured").alias("explained"),
        F.sum(F.when(is_main, 0.0).otherwise(F.coalesce(excess, F.lit(0.0)))).alias("excess"),
        F.max(F.when(is_main, 0.0).otherwise(F.col("time_measured"))).alias("longest_other"),
        every_main(F.col("is_valid_dist_time") == 1).alias("valid_main"), every_main(~F.col("too_slow")).alias("not_slow"),
        every_main(~(F.col("too_fast") & (F.col("time_measured") >= FAST_CHECK_S))).alias("not_fast"),
        F.count("*").alias("n_legs_in_trip"), F.count_if(transit).alias("n_transit_legs"), F.count_if(walk).alias("walks"),
        F.when(bikes & cars, "bike_car").when(bikes, "bike").when(cars, "car").otherwise("walk").alias("feeder"),
    )
    span = F.col("arrival") - F.col("departure")
    g = g.withColumns({"time_measured": F.when(span >= 0, span).otherwise(span + 86_400.0), "dist_line": F.hypot(F.col("dest_x") - F.col("orig_x"), F.col("dest_y") - F.col("orig_y"))})
    g = g.withColumn("time_gap", F.col("time_measured") - F.col("explained")).withColumn("time_unexplained", F.col("time_gap") + F.col("excess"))
    most = F.least(F.lit(UNEXPLAINED_S), F.greatest(F.lit(UNEXPLAINED_FLOOR_S), F.col("time_measured") - F.col("time_unexplained")))
    other = F.when(F.col("mode") == "transit", TRANSIT_OTHER_LEG_S).otherwise(OTHER_LEG_S)
    flags = {
        "is_valid_time": F.col("time_measured") > 0,
        "is_valid_main_legs": F.col("valid_main"),
        "is_main_above_min_speed": F.col("not_slow"),
        "is_main_below_max_speed": F.col("not_fast"),
        "is_above_min_dist_line": F.col("dist_line") >= MIN_LINE_M,
        "is_within_detour_ratio": F.col("dist_measured") / F.greatest(F.col("dist_line"), F.lit(DETOUR_FLOOR_M)) <= S.MAX_DETOUR,
        "is_within_unexplained_time": ~((F.col("time_gap") < S.MIN_GAP_S) | (F.col("time_unexplained") > most)),
        "is_within_other_legs_time": F.col("longest_other") <= other,
    }
    out = g.withColumns({k: v.cast("int") for k, v in flags.items()})
    out = out.withColumn("n_walk_legs", F.col("walks") - (F.col("mode") == "walk").cast("int")).withColumn("transit_feeder", F.when(F.col("mode") == "transit", F.col("feeder")))
    return out.drop("explained", "excess", "longest_other", "valid_main", "not_slow", "not_fast", "walks", "feeder")


def person_cascade(rows: DataFrame, person: str, bad: Column) -> DataFrame:
    """All rows of persons without any bad row."""
    return rows.join(rows.where(bad).select(person).distinct(), person, "left_anti")


def detailed_weights(rows: DataFrame, group: str, weight: str, listed: str, detailed: Column) -> DataFrame:
    """Weights of the rows in detail, raised by the number listed over the number in detail in their group."""
    w = Window.partitionBy(group)
    return rows.withColumn("_d", F.count_if(detailed).over(w)).where(detailed).withColumn(weight, F.col(weight) * F.col(listed) / F.col("_d")).drop("_d")


def first_seen_codes(rows: DataFrame, column: str, order: str, out: str) -> DataFrame:
    """Whole-number codes in the order in which the values first come up; null is -1.

    The values are sorted by ranges and numbered within each; only the ranges'
    sizes come together in one place.
    """
    spark = rows.sparkSession
    seen = rows.where(F.col(column).isNotNull()).groupBy(column).agg(F.min(order).alias("_first"))
    seen = stash(spark, seen.repartitionByRange("_first", column).select(F.col(column).alias("_v"), "_first", F.spark_partition_id().alias("_part")), "first-seen")
    sizes = {r["_part"]: r["count"] for r in seen.groupBy("_part").count().collect()}  # one row a range
    before, starts = 0, []
    for part in sorted(sizes):
        starts.append((part, before))
        before += sizes[part]
    starts = spark.createDataFrame(starts, "_sp int, _before long")
    at = F.row_number().over(Window.partitionBy("_part").orderBy("_first", "_v"))
    codes = seen.join(starts, F.col("_part") == F.col("_sp")).select("_v", (F.col("_before") + at - 1).cast("int").alias(out))
    return rows.join(codes, F.col(column) == F.col("_v"), "left").drop("_v").withColumn(out, F.coalesce(out, F.lit(-1)))


def weighted_means(rows: DataFrame, weight: str, prefix: str = "sd_") -> DataFrame:
    """One row: the weighted mean of every column of the prefix, nulls left out."""
    cols = [c for c in rows.columns if c.startswith(prefix)]
    return rows.agg(*[(F.sum(F.col(c) * F.col(weight)) / F.nullif(F.sum(F.when(F.col(c).isNotNull(), F.col(weight))), F.lit(0))).alias(c) for c in cols])


def dummies(rows: DataFrame, column: str, vocabulary: list[str], prefix: str = "sd_cat_") -> DataFrame:
    """A 0/1 column for each word of the vocabulary, present or not."""
    return rows.withColumns({f"{prefix}{v}": F.coalesce(F.col(column) == v, F.lit(False)).cast("int") for v in vocabulary})


def legs_in_order(rows: DataFrame, person: str, key: str, time: str, value: str) -> DataFrame:
    """A person's records as legs: leg_id, leg_no from 1, n_legs, minutes since the leg before, and the value's change from it."""
    w = Window.partitionBy(person).orderBy(time, key)
    seconds = F.col(time).cast("timestamp").cast("double")
    return rows.withColumns(
        {
            "leg_id": F.col(key),
            "leg_no": F.row_number().over(w),
            "n_legs": F.count("*").over(Window.partitionBy(person)),
            "gap_min": (seconds - F.lag(seconds).over(w)) / 60,
            "change": F.col(value) - F.lag(value).over(w),
        }
    )


def standard_journeys(raw: DataFrame, year: str, person: str, order: list[str], source: str, categories: dict[str, tuple[str, dict[str, str], str]], numbers: dict[str, tuple[str, list[float]]]) -> DataFrame:
    """A year's raw records in the standard form: person_id and journey_id made of the year, the person and a running number,
    categories (column, code -> word, word for the rest), and numbers (column, codes that mean missing)."""
    w = Window.partitionBy(person).orderBy(*order)
    number = F.row_number().over(w)
    out = {"person_id": F.concat_ws("_", F.lit(year), person), "journey_id": F.concat_ws("_", F.lit(year), person, number), "source_id": F.col(source)}
    for name, (column, words, rest) in categories.items():
        word = F.lit(rest)
        for code, value in words.items():
            word = F.when(F.col(column) == code, value).otherwise(word)
        out[name] = word
    for name, (column, missing) in numbers.items():
        out[name] = F.when(~F.col(column).isin(*missing) & (F.col(column) > 0), F.col(column))
    return raw.select(*[c.alias(k) for k, c in out.items()])
