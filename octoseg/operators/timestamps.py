"""Timestamps in mixed formats, precisions and zones, brought to UTC instants.

Each value is read under every format that gives a valid date. A mixture of formats per source is fitted by
expectation-maximisation; posteriors choose among the readings, and what stays undecided is marked. All but the fit,
which sees a few dozen rows a source, are built-in expressions.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from octoseg.runtime import broadcast_if_small, stage, table

#: Offsets in minutes of European and North American zone abbreviations.
ABBREVIATIONS = {
    "UTC": 0, "GMT": 0, "UT": 0, "Z": 0, "WET": 0, "WEST": 60, "BST": 60, "IST": 60, "CET": 60, "CEST": 120, "MET": 60, "MEST": 120,
    "EET": 120, "EEST": 180, "MSK": 180, "NST": -210, "NDT": -150, "AST": -240, "ADT": -180, "EST": -300, "EDT": -240, "CST": -360,
    "CDT": -300, "MST": -420, "MDT": -360, "PST": -480, "PDT": -420, "AKST": -540, "AKDT": -480, "HST": -600, "HDT": -540,
}
#: English month names as they are abbreviated.
MONTHS = ["JAN", "FEB", "MAR", "APR", "MAY", "JUN", "JUL", "AUG", "SEP", "OCT", "NOV", "DEC"]

_TIME = r"(?:[T ]\s*(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,](\d+))?)?\s*([AaPp][Mm])?)?"
_ZONE = r"\s*(Z|z|[+-]\d{2}(?::?\d{2})?|\[[A-Za-z_/+\-0-9]+\]|[A-Za-z]{1,5})?"
_ISO = rf"^(\d{{4}})-(\d{{1,2}})-(\d{{1,2}}){_TIME}{_ZONE}$"
_SLASH_Y = rf"^(\d{{4}})/(\d{{1,2}})/(\d{{1,2}}){_TIME}{_ZONE}$"
_DOTS = rf"^(\d{{1,2}})\.(\d{{1,2}})\.(\d{{4}}){_TIME}{_ZONE}$"
_SLASHES = rf"^(\d{{1,2}})/(\d{{1,2}})/(\d{{4}}){_TIME}{_ZONE}$"
_NAMED = rf"^(?:[A-Za-z]{{3,9}},?\s+)?(\d{{1,2}})[ -]([A-Za-z]{{3,9}})\.?[ -](\d{{4}}){_TIME}{_ZONE}$"
_BASIC = r"^(\d{4})(\d{2})(\d{2})[Tt](\d{2})(\d{2})(?:(\d{2})(?:[.,](\d+))?)?()" + _ZONE + "$"

#: Formats: name, pattern, groups of year, month and day. Two read the same text with day and month exchanged.
FORMATS = [
    ("iso", _ISO, 1, 2, 3),
    ("ymd_slash", _SLASH_Y, 1, 2, 3),
    ("dmy_dot", _DOTS, 3, 2, 1),
    ("mdy_dot", _DOTS, 3, 1, 2),
    ("mdy_slash", _SLASHES, 3, 1, 2),
    ("dmy_slash", _SLASHES, 3, 2, 1),
    ("named", _NAMED, 3, 2, 1),
    ("basic", _BASIC, 1, 2, 3),
]
#: Digits only: the lengths that are dates or Unix times, with the microseconds of a unit.
DIGITS = {"digits_date": (8, None), "unix_s": (10, 1_000_000), "unix_ms": (13, 1_000), "unix_us": (16, 1)}
#: The conventions of TESTDATA.md: with the year last, dots mean day first and slashes month first.
DAY_DOTS_MONTH_SLASHES = {"mdy_dot": 0.0, "dmy_slash": 0.0}


def _int(v: Column) -> Column:
    return v.try_cast("int")


def _month(v: Column) -> Column:
    """A number, or an English month name or its first three letters."""
    named = None
    for i, m in enumerate(MONTHS, 1):
        named = F.when(F.upper(F.substring(v, 1, 3)) == m, F.lit(i)) if named is None else named.when(F.upper(F.substring(v, 1, 3)) == m, F.lit(i))
    return F.coalesce(_int(v), named)


def _reading(x: Column) -> Column:
    """One reading of a candidate (format, g, y, m, d): local microseconds as if in UTC, the zone text and whether there is a time; null if it isn't valid."""
    g = lambda i: F.nullif(F.get(x["g"], i), F.lit(""))
    hour, minute, second, fraction, half, zone = (g(F.lit(i)) for i in range(3, 9))
    day = F.try_make_timestamp_ntz(_int(g(x["y"] - 1)), _month(g(x["m"] - 1)), _int(g(x["d"] - 1)), F.lit(0), F.lit(0), F.lit(0).cast("decimal(16,6)"))
    days = F.datediff(day.cast("date"), F.lit("1970-01-01").cast("date")).cast("long")
    h = _int(hour)
    h24 = F.when(half.isNull(), h).when((h >= 1) & (h <= 12), h % 12 + F.when(F.upper(half) == "PM", 12).otherwise(0))
    s = F.coalesce(_int(second), F.lit(0))
    us = F.coalesce(_int(F.substring(F.rpad(fraction, 6, "0"), 1, 6)), F.lit(0))
    clock = F.when(hour.isNull(), F.lit(0).cast("long")).when((h24 <= 23) & (_int(minute) <= 59) & (s <= 59), ((h24 * 3600 + _int(minute) * 60 + s).cast("long") * 1_000_000 + us))
    local = days * 86_400_000_000 + clock
    return F.when(local.isNotNull(), F.struct(x["format"].alias("format"), local.alias("local_us"), zone.alias("zone"), hour.isNotNull().alias("timed"), F.lit(False).alias("instant")))


def readings(value: str | Column) -> Column:
    """All valid readings of a text: an array of (format, local_us, zone, timed, instant); empty if there is none.

    Outer blanks don't count. Digits finer than a microsecond are cut. instant marks Unix times. A pattern that matches
    is taken apart once; the parts are read in one place for all formats.
    """
    v = F.regexp_replace(F.col(value) if isinstance(value, str) else value, r"(?U)^\s+|\s+$", "")
    parts = "|".join(f"${i}" for i in range(1, 10))
    found = [F.when(v.rlike(p), F.struct(F.lit(n).alias("format"), F.split(F.regexp_replace(v, p, parts), r"\|").alias("g"), F.lit(y).alias("y"), F.lit(m).alias("m"), F.lit(d).alias("d"))) for n, p, y, m, d in FORMATS]
    out = F.transform(F.filter(F.array(*found), lambda x: x.isNotNull()), _reading)
    day = F.try_make_timestamp_ntz(_int(F.substring(v, 1, 4)), _int(F.substring(v, 5, 2)), _int(F.substring(v, 7, 2)), F.lit(0), F.lit(0), F.lit(0).cast("decimal(16,6)"))
    units = F.create_map(*(F.lit(x) for n, u in DIGITS.values() for x in (n, 0 if u is None else u)))
    names = F.create_map(*(F.lit(x) for k, (n, _) in DIGITS.items() for x in (n, k)))
    unit = units[F.length(v)]
    local = F.when(unit == 0, F.datediff(day.cast("date"), F.lit("1970-01-01").cast("date")).cast("long") * 86_400_000_000).otherwise(v.try_cast("long") * unit)
    digits = F.when(v.rlike(r"^\d+$") & local.isNotNull(), F.struct(names[F.length(v)].alias("format"), local.alias("local_us"), F.lit(None).cast("string").alias("zone"), (unit > 0).alias("timed"), (unit > 0).alias("instant")))
    return F.filter(F.concat(out, F.array(digits)), lambda x: x.isNotNull())


def offset_minutes(zone: Column) -> Column:
    """Minutes of an offset or abbreviation; null for a zone name or none, and for letters of no known zone."""
    o = F.regexp_extract(zone, r"^([+-])(\d{2}):?(\d{2})?$", 0)
    sign = F.when(zone.startswith("-"), F.lit(-1)).otherwise(F.lit(1))
    hours = _int(F.substring(zone, 2, 2))
    minutes = F.coalesce(_int(F.nullif(F.regexp_extract(zone, r"^[+-]\d{2}:?(\d{2})$", 1), F.lit(""))), F.lit(0))
    names = F.create_map(*(F.lit(x) for kv in ABBREVIATIONS.items() for x in kv))
    return F.when((F.length(o) > 0) & (hours <= 18) & (minutes <= 59), sign * (hours * 60 + minutes)).otherwise(names[F.upper(zone)])


def known_zones(spark) -> list[str]:
    """The zone names this Java knows; any other would end a query."""
    return sorted(str(spark._jvm.java.time.ZoneId.getAvailableZoneIds().toString()).strip("[]").split(", "))


def local_to_utc(local_us: Column, zone: Column) -> Column:
    """Microseconds UTC of a local time in an IANA zone: the first of two, null if the clocks skip it."""
    local = F.timestamp_micros(local_us)  # the local time as if it were UTC, whatever the session's zone
    utc = F.unix_micros(F.to_utc_timestamp(local, zone))
    # One hour's change is the rule, half an hour's and two hours' occur: an earlier instant of the same local time wins.
    back = [utc - m * 60_000_000 for m in (120, 60, 30)]
    same = [F.when(F.unix_micros(F.from_utc_timestamp(F.timestamp_micros(b), zone)) == local_us, b) for b in back]
    return F.coalesce(*same, F.when(F.unix_micros(F.from_utc_timestamp(F.timestamp_micros(utc), zone)) == local_us, utc))


def start_of_day(local_us: Column, zone: Column) -> Column:
    """The first instant of a local day: midnight, or the end of the skip where the clocks leave midnight out."""
    noon = F.unix_micros(F.to_utc_timestamp(F.timestamp_micros(local_us), zone))
    return F.coalesce(local_to_utc(local_us, zone), local_to_utc(local_us + 30 * 60_000_000, zone), local_to_utc(local_us + 60 * 60_000_000, zone), noon)


def format_weights(read: DataFrame, source: str, declared: dict[str, float] | None = None, steps: int = 50, smooth: float = 0.5) -> DataFrame:
    """(source, format, weight): the mixture of formats of each source by expectation-maximisation.

    read has source and readings. Values count once for each set of valid formats, combined map-side, so a source comes
    as a few dozen (set, count) rows whatever the number of its values, and sources are fitted side by side. declared
    gives prior factors; 0 rules a format out. Each format has `smooth` values more than were seen.
    """
    sets = read.where(F.size("readings") > 0).groupBy(source, F.transform("readings", lambda x: x["format"]).alias("fs")).agg(F.count("*").alias("k"))
    given = dict(declared or {})

    def fit(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        names = sorted({f for fs in pdf["fs"] for f in fs})
        prior = np.array([float(given.get(f, 1.0)) for f in names])
        valid = np.array([[f in fs for f in names] for fs in map(set, pdf["fs"])]) * prior
        k, w = pdf["k"].to_numpy(dtype=float), np.ones(len(names))
        for _ in range(steps):
            part = valid * w
            total = part.sum(axis=1, keepdims=True)
            post = np.divide(part, total, out=np.zeros_like(part), where=total > 0)
            mass = (post * k[:, None]).sum(axis=0) + smooth * prior
            new = mass / max(mass.sum(), 1e-300)
            if np.abs(new - w).max() < 1e-12:
                break
            w = new
        return pd.DataFrame({source: [key[0]] * len(names), "format": names, "weight": w * prior})

    return sets.groupBy(source).applyInPandas(fit, f"`{source}` string, format string, weight double")


def normalise(df: DataFrame, value: str, source: str, zone: str, declared: dict[str, float] | None = None, sure: float = 0.9) -> DataFrame:
    """df with utc_us, format, posterior and state of each row's timestamp text.

    state: `ok`; `ambiguous` (two readings that differ, none with a posterior of sure or more; utc_us is null); `invalid`
    (no valid reading, or a letter zone that isn't known); `no_zone` (local time without a known zone); `skipped` (a local
    time that the clocks leave out). A zone, offset or abbreviation in the text holds over the column `zone`; a date
    alone is the start of the local day. Columns of these names in df are replaced; an empty table stays empty.
    """
    own = ["utc_us", "format", "posterior", "state", "readings", "_w", "_r", "_src", "_there", "_zn"]
    base = df.drop(*[c for c in df.columns if c in own and c not in (value, source, zone)])
    read = base.withColumn("readings", F.coalesce(readings(value), F.array()))
    read = read.withColumn("_src", F.coalesce(F.col(source).cast("string"), F.lit("")))
    read = stage(read, "readings")  # two readers follow; the patterns are matched once
    weights = format_weights(read.select("_src", "readings"), "_src", declared)
    maps = weights.groupBy("_src").agg(F.map_from_entries(F.collect_list(F.struct("format", "weight"))).alias("_w"))
    j = read.join(broadcast_if_small(maps), "_src", "left")
    scored = F.transform("readings", lambda x: F.struct(F.coalesce(F.col("_w")[x["format"]], F.lit(0.0)).alias("p"), x["format"].alias("format"), x["local_us"].alias("local_us"), x["zone"].alias("zone"), x["timed"].alias("timed"), x["instant"].alias("instant")))
    live = F.filter(scored, lambda x: x["p"] > 0)
    j = j.withColumn("_r", F.reverse(F.array_sort(live)))
    best, total = F.get("_r", F.lit(0)), F.aggregate("_r", F.lit(0.0), lambda a, x: a + x["p"])
    agree = F.size(F.array_distinct(F.transform("_r", lambda x: x["local_us"]))) <= 1
    j = j.withColumn("posterior", F.when(F.size("_r") > 0, F.when(agree, F.lit(1.0)).otherwise(best["p"] / total))).withColumn("_r", best)
    z = F.col("_r.zone")
    named = F.when(z.startswith("["), F.regexp_replace(z, r"[\[\]]", ""))
    off = F.when(named.isNull(), offset_minutes(z))
    local = F.col("_r.local_us")
    zones = df.sparkSession.createDataFrame([(x,) for x in known_zones(df.sparkSession)], "_zn string")
    j = j.withColumn("_there", F.coalesce(named, F.col(zone))).join(F.broadcast(zones), F.col("_there") == F.col("_zn"), "left")  # the zone names of Java, about 600
    there = F.col("_zn")
    utc = (
        F.when(F.col("_r.instant"), local)
        .when(off.isNotNull(), local - off.cast("long") * 60_000_000)
        .when(z.isNotNull() & named.isNull(), F.lit(None))
        .when(there.isNull(), F.lit(None))
        .when(F.col("_r.timed"), local_to_utc(local, there))
        .otherwise(start_of_day(local, there))
    )
    state = (
        F.when(F.col("_r").isNull() | (z.isNotNull() & named.isNull() & off.isNull() & ~F.col("_r.instant")) | (named.isNotNull() & there.isNull()), "invalid")
        .when(F.col("posterior") < sure, "ambiguous")
        .when(~F.col("_r.instant") & off.isNull() & there.isNull(), "no_zone")
        .when(utc.isNull(), "skipped")
        .otherwise("ok")
    )
    j = j.withColumns({"state": state, "utc_us": utc, "format": F.col("_r.format")})
    return j.withColumn("utc_us", F.when(F.col("state") == "ok", F.col("utc_us"))).drop("readings", "_w", "_r", "_src", "_there", "_zn")


def isolate_dates(sequences: DataFrame, sites: DataFrame, declared: dict[str, float] | None = None) -> DataFrame:
    """normalise() of each isolate's collection date, once; the source is its site, the zone the site's."""
    site = F.get_json_object("metadata_json", "$.site")
    seq = sequences.where("sequence_id is not null").groupBy("sequence_id").agg(F.max("collection_date").alias("collection_date"), F.max(site).alias("site_code"))
    zones = sites.where("site_code is not null").groupBy("site_code").agg(F.max("tz_name").alias("tz_name"))
    return normalise(seq.join(broadcast_if_small(zones), "site_code", "left"), "collection_date", "site_code", "tz_name", declared)


def p4_found(spark, sf_dir: str) -> DataFrame:
    d = isolate_dates(table(spark, sf_dir, "sequences"), table(spark, sf_dir, "collection_sites"), DAY_DOTS_MONTH_SLASHES)
    return d.where("state = 'ok'").select("sequence_id", "utc_us")


def p4_states(spark, sf_dir: str) -> DataFrame:
    """Every isolate's reading without any convention declared: the mixture of its site decides, doubt is marked."""
    d = isolate_dates(table(spark, sf_dir, "sequences"), table(spark, sf_dir, "collection_sites"))
    return d.select("sequence_id", "format", "state", "utc_us", F.round("posterior", 4).alias("posterior"))
