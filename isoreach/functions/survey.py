"""Scalar functions for survey tables: decoding raw codes, flags, times, intervals."""

from __future__ import annotations

import math
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Hour sets, seasons, speed envelopes (km/h) and limits (s) that results depend on.
PEAK_WEEKDAY = (8, 16, 17, 18)
NIGHT_WEEKDAY = (0, 1, 2, 3, 4, 5, 6, 20, 21, 22, 23)
NIGHT_WEEKEND = (0, 1, 2, 3, 4, 5, 6, 7, 8, 20, 21, 22, 23)
LATE_NIGHT = (0, 1, 2, 3, 4)
CIVIL_TWILIGHT = -6.0
SEASONS = {"winter": (12, 1, 2), "spring": (3, 4, 5), "summer": (6, 7, 8), "fall": (9, 10, 11)}
MAX_DETOUR = 3.0
MIN_GAP_S, MAX_GAP_S, GAP_FLOOR_S, GAP_SHARE = -300.0, 1800.0, 300.0, 0.5
MISSING_TEXT = ("", ".", "-97", "-98", "-99")
MISSING_COORD = (-97, -98, -99, -997, -999)


def to_float(c: Column) -> Column:
    """Text as a number, with a point or comma; empty text, '.' and anything else unreadable is null."""
    return F.replace(F.trim(c.cast("string")), F.lit(","), F.lit(".")).try_cast("double")


def num(c: Column, missing: Iterable[float] = (), allow_negative: bool = False) -> Column:
    """A number without its missing codes; negative ones are missing unless allowed."""
    x = to_float(c)
    bad = x.isin(*missing) if missing else F.lit(False)
    if not allow_negative:
        bad = bad | (x < 0)
    return F.when(~bad, x)


def coord(c: Column) -> Column:
    return num(c, MISSING_COORD, allow_negative=True)


def text(c: Column) -> Column:
    """Trimmed text without a trailing '.0'; missing codes are null."""
    t = F.regexp_replace(F.trim(c.cast("string")), r"\.0$", "")
    return F.when(~t.isin(*MISSING_TEXT), t)


def category(c: Column, codes: dict) -> Column:
    """The category of a code; codes that aren't listed, or listed with None, are null."""
    x = to_float(c)
    return reduce(lambda acc, kv: F.when(x == kv[0], F.lit(kv[1])).otherwise(acc), codes.items(), F.lit(None).cast("string"))


def flag(c: Column, yes: Iterable[float] = (1,), no: Iterable[float] = (2,)) -> Column:
    x = to_float(c)
    return F.when(x.isin(*yes), 1).when(x.isin(*no), 0)


def any_flag(*flags: Column) -> Column:
    """1 if any is 1, 0 if all are known to be 0, else null: OR of three values."""
    return reduce(lambda a, b: a | b, [f == 1 for f in flags]).cast("int")


def bands(c: Column, codes: dict) -> Column:
    """struct<lo, hi> of a banded answer; an open top has a null hi."""
    x = to_float(c)
    pick = lambda k: reduce(lambda acc, kv: F.when(x == kv[0], F.lit(None if kv[1] is None or kv[1][k] is None else float(kv[1][k])).cast("double")).otherwise(acc), codes.items(), F.lit(None).cast("double"))
    return F.struct(pick(0).alias("lo"), pick(1).alias("hi"))


def hhmm_minutes(c: Column) -> Column:
    """HHMM as minutes after midnight; minutes of 60 or more, or hours beyond 36, are null."""
    x = num(c)
    h, m = F.floor(x / 100), F.pmod(x, F.lit(100.0))
    return F.when((m < 60) & (h <= 36), h * 60 + m)


def numbers(*cols: Column) -> Column:
    """The positive whole numbers of a row, joined by ';', null without any."""
    xs = F.array(*[F.when(num(c) > 0, num(c).cast("long").cast("string")) for c in cols])
    return F.nullif(F.array_join(xs, ";"), F.lit(""))


def hours(hour: Column, weekday: Column) -> dict[str, Column]:
    """hour_peak, hour_night, hour_base and peak_str; weekday is 0 or 1."""
    is_weekday = F.coalesce(weekday == 1, F.lit(False))
    at = lambda among: F.coalesce(hour.isin(*among), F.lit(False))
    peak = at(PEAK_WEEKDAY) & is_weekday
    night = (is_weekday & at(NIGHT_WEEKDAY)) | (~is_weekday & at(NIGHT_WEEKEND))
    base = ~peak & ~night
    return {"hour_peak": peak.cast("int"), "hour_night": night.cast("int"), "hour_base": base.cast("int"), "peak_str": F.when(peak, "peak").when(base, "base").otherwise("night")}


def season(month: Column) -> Column:
    return reduce(lambda acc, kv: F.when(month.isin(*kv[1]), F.lit(kv[0])).otherwise(acc), SEASONS.items(), F.lit(None).cast("string"))


def solar_altitude(utc: Column, lat: Column, lon: Column) -> Column:
    """The sun's altitude in degrees, by Spencer's series (error about 0.1 degree)."""
    h = F.hour(utc) + F.minute(utc) / 60.0 + F.second(utc) / 3600.0
    g = F.lit(2 * math.pi / 365) * (F.dayofyear(utc) - 1 + (h - 12) / 24.0)
    # fixed values: Spencer's coefficients
    equation = F.lit(229.18) * (0.000075 + 0.001868 * F.cos(g) - 0.032077 * F.sin(g) - 0.014615 * F.cos(2 * g) - 0.040849 * F.sin(2 * g))
    tilt = 0.006918 - 0.399912 * F.cos(g) + 0.070257 * F.sin(g) - 0.006758 * F.cos(2 * g) + 0.000907 * F.sin(2 * g) - 0.002697 * F.cos(3 * g) + 0.00148 * F.sin(3 * g)
    angle = F.radians((h * 60 + equation + 4 * lon) / 4.0 - 180.0)
    s = F.sin(F.radians(lat)) * F.sin(tilt) + F.cos(F.radians(lat)) * F.cos(tilt) * F.cos(angle)
    return F.degrees(F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), s))))


def daylight(utc: Column, lat: Column, lon: Column) -> Column:
    """1 while the sun is above civil twilight, else 0; null without time or place."""
    return (solar_altitude(utc, lat, lon) > CIVIL_TWILIGHT).cast("int")


def report_interval(seconds: Column) -> Column:
    """Bounds (s) of the true time of a report: exact to half a minute; on 5-minute steps rounded to 2.5, and '5' down to 0."""
    m = F.rint(seconds / 60.0)
    step = F.pmod(m, F.lit(5.0)) == 0
    return F.struct(
        (F.greatest(m - 0.5, F.lit(0.0)) * 60.0).alias("exact_lo"),
        ((m + 0.5) * 60.0).alias("exact_hi"),
        F.when(step, F.when(m == 5, 0.0).otherwise(F.greatest(m - 2.5, F.lit(0.0)) * 60.0)).alias("rounded_lo"),
        F.when(step, (m + 2.5) * 60.0).alias("rounded_hi"),
        step.alias("on_step"),
    )


def within_gap(gap: Column, explained: Column) -> Column:
    """Whether the time between legs is plausible for their summed time."""
    most = F.least(F.lit(MAX_GAP_S), F.greatest(F.lit(GAP_FLOOR_S), GAP_SHARE * explained))
    return ((gap >= MIN_GAP_S) & (gap <= most)).cast("int")


def within_detour(measured: Column, line: Column) -> Column:
    """Whether the way is at most three times the straight line; unknown passes."""
    return (~F.coalesce(measured / F.nullif(line, F.lit(0.0)) > MAX_DETOUR, F.lit(False))).cast("int")


def bin_labels(edges: list[int]) -> list[str]:
    """Names of right-closed bins between whole-number edges."""
    out = []
    for k, (lo, hi) in enumerate(zip(edges, edges[1:], strict=False)):
        if k == 0:
            out.append("0" if hi == 0 else f"leq{hi}")
        elif k == len(edges) - 2:
            out.append(f"{lo + 1}+")
        else:
            out.append(f"{hi}" if lo + 1 == hi else f"{lo + 1}to{hi}")
    return out


def binned(c: Column, edges: list[int]) -> Column:
    """The label of a value's right-closed bin, null outside."""
    out = F.lit(None).cast("string")
    for lo, hi, name in zip(edges, edges[1:], bin_labels(edges), strict=False):
        out = F.when((c > lo) & (c <= hi), F.lit(name)).otherwise(out)
    return out


def swiss_to_wgs84(e: Column, n: Column) -> Column:
    """struct<lon, lat> of LV95 coordinates by the closed approximation (about 1 m)."""
    y, x = (e - 2_600_000.0) / 1e6, (n - 1_200_000.0) / 1e6
    # fixed values: coefficients of the published approximation
    lon = 2.6779094 + 4.728982 * y + 0.791484 * y * x + 0.1306 * y * x * x - 0.0436 * y * y * y
    lat = 16.9023892 + 3.238272 * x - 0.270978 * y * y - 0.002528 * x * x - 0.0447 * y * y * x - 0.0140 * x * x * x
    return F.struct((lon * 100 / 36).alias("lon"), (lat * 100 / 36).alias("lat"))


DATE_FORMATS = ("dd.MM.yyyy", "MM/dd/yyyy", "dd/MM/yyyy", "yyyy-MM-dd", "yyyyMMdd")


def parsed_dates(c: Column) -> list[Column]:
    """The text read under each known date format, null where it doesn't parse."""
    t = F.split(F.trim(c), " ")[0]
    return [F.try_to_timestamp(t, F.lit(f)).cast("date") for f in DATE_FORMATS]


def elevation_ok(a: Column, b: Column, top: float = 1000.0) -> Column:
    """Whether both ends lie between 0 and top metres; unknown fails."""
    inside = lambda z: F.coalesce((z > 0) & (z < top), F.lit(False))
    return (inside(a) & inside(b)).cast("int")


def all_valid(*flags: Column) -> Column:
    """1 if all flags are 1, else 0; unknown counts as 0."""
    return reduce(lambda a, b: a & b, [F.coalesce(f == 1, F.lit(False)) for f in flags]).cast("int")


def conditions(daylight_flag: Column, season_name: Column) -> dict[str, Column]:
    """Condition columns of the choice model; an unknown one stays null."""
    return {"cond_dark": 1 - daylight_flag, **{f"cond_{s}": (season_name == s).cast("int") for s in ("winter", "spring", "fall")}}


def metric_parts(name: Column) -> Column:
    """struct<dest, param> of a metric column's name, the parameter being its last part."""
    return F.struct(F.regexp_extract(name, "^(.*)_[^_]+$", 1).alias("dest"), F.regexp_extract(name, "_([^_]+)$", 1).alias("param"))


def speed_prior(motorway: Column, ramp: Column, urban: Column) -> Column:
    """First guess of a speed (km/h) from the road class."""
    return F.when(motorway & ~ramp, 100.0).when(ramp, 60.0).when(urban, 40.0).otherwise(70.0)


def plug_in(fuel: Column, co2: Column) -> Column:
    """Hybrids below 70 g/km, but above none, are plug-ins; electric cars have no emissions."""
    return F.when(fuel == "electric", "electric").when((fuel == "hybrid") & (co2 > 0) & (co2 < 70), "plugin").otherwise(fuel)


def file_name(name: str, leg_set: str) -> str:
    """A survey file's name for a leg set: the main one as it is, trips renamed, others with a suffix."""
    if leg_set == "main":
        return name
    if leg_set == "trips":
        if "survey_leg" not in name:
            raise ValueError(f"{name} has no form for trips")
        return name.replace("survey_leg", "survey_trip")
    stem, _, ending = name.rpartition(".")
    return f"{stem}_{leg_set}.{ending}"


def normalised_density(density: Column) -> Column:
    """Square root of a density over 10,000, which brings dense and sparse places nearer."""
    return F.sqrt(density / 10_000.0)
