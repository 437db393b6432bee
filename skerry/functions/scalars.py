"""Scalar functions: dates, times, frames, rates, confidences, fingerprints, statuses."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def iso_or_empty(c: Column) -> Column:
    """d/m/yyyy or yyyy-mm-dd as an ISO string; '' if it is neither."""
    t = F.trim(c)
    day_first = F.when(t.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$"), F.try_to_date(t, "d/M/yyyy"))
    iso = F.when(t.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), F.try_to_date(t, "yyyy-M-d"))
    return F.coalesce(F.date_format(F.coalesce(day_first, iso), "yyyy-MM-dd"), F.lit(""))


def iso_or_error(c: Column) -> Column:
    """The same, but blank gives null and anything else is an error."""
    found = iso_or_empty(c)
    return F.when(F.trim(F.coalesce(c, F.lit(""))) == "", F.lit(None).cast("string")).when(found != "", found).otherwise(F.raise_error(F.concat(F.lit("unsupported date "), c)))


def six_digits(x: Column) -> Column:
    """Rounded to six significant digits; the double's exact value decides, its ties go to even (Java's formatter rounds the shortest decimal, ties up)."""

    @F.pandas_udf("double")
    def rounded(column: pd.Series) -> pd.Series:
        return pd.Series([float(f"{v:.5e}") for v in column], dtype="float64")

    return rounded(x)


def frame_of(pts: Column, fps: Column) -> Column:
    """floor(pts to six digits * fps), not below 0; null for times or rates that are not usable."""
    usable = pts.isNotNull() & ~F.isnan(pts) & (F.abs(pts) < float("inf")) & (fps > 0) & (fps < float("inf"))
    return F.when(usable, F.greatest(F.lit(0).cast("long"), F.floor(six_digits(pts) * fps)))


def frame_or(value: Column, fallback: Column) -> Column:
    number = value.try_cast("long")
    return F.coalesce(F.when(number >= 0, number), fallback)


def _two(x: Column) -> Column:
    return F.lpad(x.cast("string"), 2, "0")


def clock(seconds: Column) -> Column:
    """HH:MM:SS.mmm, milliseconds rounded half to even."""
    ms = F.bround(seconds * 1000).cast("long")
    hours = (ms - F.pmod(ms, F.lit(3_600_000))) / 3_600_000
    return F.concat(
        F.when(hours < 100, _two(hours.cast("long"))).otherwise(hours.cast("long").cast("string")), F.lit(":"), _two(F.floor(F.pmod(ms, F.lit(3_600_000)) / 60_000)), F.lit(":"),
        _two(F.floor(F.pmod(ms, F.lit(60_000)) / 1000)), F.lit("."), F.lpad(F.pmod(ms, F.lit(1000)).cast("string"), 3, "0"),
    )


def short_clock(seconds: Column) -> Column:
    """MM:SS, cut off."""
    whole = F.floor(seconds)
    minutes = F.floor(whole / 60)
    return F.concat(F.when(minutes < 100, _two(minutes)).otherwise(minutes.cast("string")), F.lit(":"), _two(F.pmod(whole, F.lit(60))))


def rate(c: Column) -> Column:
    """'num/den' as a number; null if it is none or the denominator is 0."""
    p = F.split(F.trim(c), "/")
    return F.try_divide(F.get(p, F.lit(0)).try_cast("double"), F.coalesce(F.get(p, F.lit(1)), F.lit("1")).try_cast("double"))


def first_number(*columns: Column) -> Column:
    return F.coalesce(*[c.cast("string").try_cast("double") for c in columns])


def frame_count(declared: Column, timeline: Column, duration: Column, fps: Column) -> Column:
    """struct(count, method, estimated): declared, else counted, else duration times rate."""
    estimate = F.bround(duration * fps).cast("long")
    return F.struct(
        F.coalesce(declared, timeline, estimate).alias("count"),
        F.when(declared.isNotNull(), "container").when(timeline.isNotNull(), "timeline").when(estimate.isNotNull(), "duration_x_fps").otherwise("unknown").alias("method"),
        (declared.isNull() & timeline.isNull() & estimate.isNotNull()).alias("estimated"),
    )


def acoustic_metrics(logits: Column, blank: int) -> Column:
    """struct(blank_argmax_ratio, mean_posterior, normalized_entropy) over steps of an array<array<double>>."""
    steps = F.transform(logits, lambda row: F.transform(row, lambda x: F.exp(x - F.array_max(row))))
    p = F.transform(steps, lambda row: F.transform(row, lambda x: x / F.aggregate(row, F.lit(0.0), lambda a, y: a + y)))
    mean = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x) / F.size(a)
    entropy = F.transform(p, lambda row: -F.aggregate(row, F.lit(0.0), lambda a, x: a + F.when(x > 0, x * F.log(x)).otherwise(0.0)) / F.log(F.size(row)))
    blanks = F.transform(p, lambda row: F.when(F.array_position(row, F.array_max(row)) == blank + 1, 1.0).otherwise(0.0))
    return F.struct(mean(blanks).alias("blank_argmax_ratio"), mean(F.transform(p, lambda row: F.array_max(row))).alias("mean_posterior"), mean(entropy).alias("normalized_entropy"))


def _clamped(c: Column) -> Column:
    """c within 0..1; null stays null, which least and greatest alone would skip."""
    return F.when(c.isNotNull(), F.least(F.lit(1.0), F.greatest(F.lit(0.0), c)))


def bounded_ratio(a: Column, b: Column) -> Column:
    return _clamped(F.try_divide(a, b))


def band(start: Column, end: Column, low: float, high: float, most: int) -> Column:
    """Distinct evenly spaced whole numbers in a band (shares low..high) of start..end, rounded half to even: as many as lie in it, most at most; for one the middle."""
    a, b = start + (end - start) * low, start + (end - start) * high
    n = F.least(F.lit(most), F.greatest(F.lit(1), F.floor(b) - F.ceil(a) + 1)).cast("int")
    spaced = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.bround(a + (b - a) * i / F.greatest(n - 1, F.lit(1))).cast("long"))
    return F.when(n == 1, F.array(F.bround((a + b) / 2).cast("long"))).otherwise(F.array_distinct(spaced))


def tile_grid(width: Column, height: Column, most: int) -> Column:
    """struct(columns, rows) with the aspect ratio nearest width / height, more tiles on ties, then the earlier in order."""
    ratio = width / height
    grids = [(c, r) for c in range(1, most + 1) for r in range(1, most + 1) if c * r <= most]
    options = F.array(*[F.struct(F.abs(F.lit(c / r) - ratio).alias("off"), F.lit(-c * r).alias("tiles"), F.lit(k).alias("at"), F.lit(c).alias("columns"), F.lit(r).alias("rows")) for k, (c, r) in enumerate(grids)])
    best = F.array_min(options)
    return F.struct(best["columns"].alias("columns"), best["rows"].alias("rows"))


def lenient_json(c: Column, schema: str) -> Column:
    """The outermost {...} of a text, parsed; null if there is none."""
    return F.from_json(F.nullif(F.regexp_extract(c, r"(?s)(\{.*\})", 1), F.lit("")), schema)


def fingerprint(*columns: Column) -> Column:
    """sha256 of the values as JSON, keys in the order given."""
    return F.sha2(F.to_json(F.struct(*columns)), 256)


def confidence(c: Column) -> Column:
    return _clamped(c.try_cast("double"))


def cost(*columns: Column) -> Column:
    """The first cost that is there, empty strings being none; 1 by default. 0 is a cost."""
    return F.coalesce(*[F.nullif(F.trim(c.cast("string")), F.lit("")).try_cast("double") for c in columns], F.lit(1.0))


def speech_status(asr: Column, words: Column) -> Column:
    s = F.trim(asr)
    return (
        F.when(s.isin("no_audio", "no_speech"), "no_speech").when(s == "low_confidence", "unavailable")
        .when(s == "pass", F.when(words > 0, "available").otherwise("unavailable")).otherwise(F.raise_error(F.concat(F.lit("unknown status "), s)))
    )


def probe_status(*facts: Column) -> Column:
    known = sum((F.when(f.isNotNull(), 1).otherwise(0) for f in facts), F.lit(0))
    return F.when(known == len(facts), "pass").when(known == 0, "failed").otherwise("partial")


def domain_value(c: Column, values: list[str]) -> Column:
    v = F.lower(F.trim(c))
    return F.when(v.isin(values), v).otherwise(F.raise_error(F.concat(F.lit("not in the domain: "), F.coalesce(v, F.lit("null")))))


def mock_vector(c: Column, size: int = 4) -> Column:
    """Bytes of the sha256 over 255, rounded to six places."""
    h = F.sha2(c, 256)
    return F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: F.round(F.conv(F.substring(h, i * 2 + 1, F.lit(2)), 16, 10).cast("double") / 255, 6))
