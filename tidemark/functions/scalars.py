"""Column expressions shared by the flows. All are built-in expressions (no Python rows)."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Age bounds and labels, monitoring threshold, ratio bounds.
ADOLESCENT_BELOW = 18
ADULT_UP_TO = 65
AGE_LABELS = ("Adolescent", "Adult", "Older Adult")
UNDER_THRESHOLD = 0.85
RATIO_BOUNDS = (0.0, 2.0)
SLOT_MINUTES = 15

# Risk-score weights and scales, failure curve, life span.
RISK_WEIGHTS = {"age": 0.30, "vibration": 0.25, "temperature": 0.20, "oil": 0.15, "service": 0.10}
HOURS_PER_YEAR = 8760
DAYS_PER_YEAR = 365
TEMPERATURE_BASE, TEMPERATURE_SPAN = 520, 100
OIL_BASE, OIL_SPAN = 65, 40
FAILURE_STEEPNESS, FAILURE_MIDPOINT = 10, 0.65
HOURS_PER_SERVICE = 2000


def known(c: Column) -> Column:
    """A floating column with NaN turned into NULL, the only form of missing used here."""
    return F.when(~F.isnan(c), c)


def to_number(c: Column) -> Column:
    """Numeric value of a text cell; anything unparsable is missing."""
    return known(c.try_cast("double"))


def rounded(c: Column, digits: int) -> Column:
    """Half-up rounding through a decimal, so that equal inputs give equal outputs
    on engines whose binary rounding differs."""
    return F.round(c.cast("decimal(30,8)"), digits).cast("double")


def clip(c: Column, low: float, high: float) -> Column:
    """Bound a value; missing stays missing (``greatest`` alone would return the bound)."""
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(low)), F.lit(high)))


def age_group(age: Column) -> Column:
    """Age bracket label; a missing age has none."""
    young, adult, older = (F.lit(label) for label in AGE_LABELS)
    return (
        F.when(age < ADOLESCENT_BELOW, young)
        .when(age <= ADULT_UP_TO, adult)
        .when(age.isNotNull(), older)
    )


def status(ratio: Column, threshold: float = UNDER_THRESHOLD) -> Column:
    """``Under`` below the threshold, else ``Normal`` (also when the ratio is missing)."""
    return F.when(ratio < threshold, "Under").otherwise("Normal")


def performance_ratio(actual: Column, predicted: Column) -> Column:
    """Actual over predicted within fixed bounds; a zero prediction gives no ratio."""
    return clip(actual / F.nullif(predicted, F.lit(0.0)), *RATIO_BOUNDS)


def percentage_error(actual: Column, predicted: Column) -> Column:
    """Absolute error in percent of the actual value; a zero actual gives none."""
    return F.abs(actual - predicted) / F.nullif(actual, F.lit(0.0)) * 100


def split_once(c: Column, separator: str = "_") -> tuple[Column, Column]:
    """Text before and after the first separator; without one the second part is missing."""
    at = F.instr(c, separator)
    head = F.when(at > 0, F.substring(c, F.lit(1), at - 1)).otherwise(c)
    tail = F.when(at > 0, F.substring(c, at + len(separator), F.length(c)))
    return head, tail


def commas_to_spaces(c: Column) -> Column:
    return F.translate(c, ",", " ")


def underscores_to_spaces(c: Column) -> Column:
    return F.translate(c, "_", " ")


def prefix(c: Column, n: int) -> Column:
    return F.substring(c, 1, n)


def pair_label(x: Column, y: Column) -> Column:
    return F.concat_ws(" -> ", x, y)


def fixed_decimals(c: Column, digits: int = 4) -> Column:
    return F.format_string(f"%.{digits}f", c)


def machine_label(number: Column) -> Column:
    return F.format_string("GEN_%04d", number)


#: Layouts of timestamps: year first, or day first.
TIMESTAMP_LAYOUTS = tuple(
    f"{date}{between}{time}"
    for date, between in (("yyyy-MM-dd", " "), ("yyyy-MM-dd", "'T'"), ("dd-MM-yyyy", " "), ("dd/MM/yyyy", " "))
    for time in ("HH:mm:ss", "HH:mm")
)


def unparsed_count(text: Column, parsed: Column) -> Column:
    """How many cells hold a text that gave no value; nothing is lost without being counted."""
    return F.count(F.when(text.isNotNull() & parsed.isNull(), 1))


def _shape(pattern: str) -> str | None:
    """The text that a pattern of fixed widths matches, with every digit 0; else None."""
    bare = pattern.replace("'", "")
    runs = [m.group() for m in re.finditer(r"([A-Za-z])\1*", pattern.replace("'T'", ""))]
    return None if any(x not in ("yyyy", "MM", "dd", "HH", "mm", "ss") for x in runs) else re.sub(r"[yMdHms]", "0", bare)


def parse_timestamp(c: Column, patterns: Sequence[str] = TIMESTAMP_LAYOUTS) -> Column:
    """Zone-free timestamp of a text in any of ``patterns``; ISO text is never day-swapped.

    The digits and separators of a text tell which patterns of fixed widths it can have, so a
    cell is parsed once; patterns of other kinds are tried in their order after those.
    """
    shapes: dict[str, list[str]] = {}
    for p in patterns:
        shapes.setdefault(_shape(p), []).append(p)
    tried = {s: F.coalesce(*[F.try_to_timestamp(c, F.lit(p)) for p in of]) for s, of in shapes.items()}
    others = tried.pop(None, F.lit(None).cast("timestamp"))
    if not tried:
        return others.cast("timestamp_ntz")
    shape, found = F.translate(c, "123456789", "0" * 9), F
    for s, value in tried.items():
        found = found.when(shape == s, value)
    return F.coalesce(found, others).cast("timestamp_ntz")


def minute_of_day(ts: Column) -> Column:
    return F.hour(ts) * 60 + F.minute(ts)


def quarter_hour_slot(ts: Column) -> Column:
    return F.floor(minute_of_day(ts) / SLOT_MINUTES).cast("int")


def slot_label(slot: Column) -> Column:
    minutes = slot * SLOT_MINUTES
    return F.format_string(
        "%02d:%02d", F.floor(minutes / 60).cast("int"), F.pmod(minutes, F.lit(60)).cast("int")
    )


def hour_start(ts: Column) -> Column:
    """Timestamp of the full hour, zone-free."""
    return F.date_trunc("hour", ts).cast("timestamp_ntz")


def date_and_hour(date: Column, hour: Column) -> Column:
    """Zone-free timestamp of a date and an hour of day."""
    zero = F.lit(0)
    return F.make_timestamp_ntz(F.year(date), F.month(date), F.dayofmonth(date), hour, zero, zero)


def risk_score(
    hours: Column,
    vibration: Column,
    max_vibration: Column,
    temperature: Column,
    oil_temperature: Column,
    days_since_service: Column,
) -> Column:
    """Weighted sum of scaled sensor readings, between 0 and 1."""
    weights = RISK_WEIGHTS
    total = (
        weights["age"] * (hours / HOURS_PER_YEAR)
        + weights["vibration"] * (vibration / max_vibration)
        + weights["temperature"]
        * clip((temperature - TEMPERATURE_BASE) / TEMPERATURE_SPAN, 0.0, 1.0)
        + weights["oil"] * clip((oil_temperature - OIL_BASE) / OIL_SPAN, 0.0, 1.0)
        + weights["service"] * (days_since_service / DAYS_PER_YEAR)
    )
    return clip(total, 0.0, 1.0)


def failure_probability(score: Column) -> Column:
    return 1 / (1 + F.exp(-FAILURE_STEEPNESS * (score - FAILURE_MIDPOINT)))


def failure_flag(probability: Column, threshold: float = 0.5) -> Column:
    return F.when(probability >= threshold, 1).when(probability.isNotNull(), 0)


def remaining_days(score: Column) -> Column:
    """Whole days left, from a risk score."""
    days = F.round(((1 - score) * DAYS_PER_YEAR).cast("decimal(30,8)")).cast("double")
    return clip(days, 0.0, float(DAYS_PER_YEAR)).cast("int")


def service_count(hours: Column) -> Column:
    return F.floor(hours / HOURS_PER_SERVICE).cast("int")


def hash_order(keys: Sequence[Column], seed: int) -> Column:
    """Reproducible pseudo-random text order of rows, from their key and a seed."""
    return F.md5(F.concat_ws("|", *[k.cast("string") for k in keys], F.lit(str(seed))))
