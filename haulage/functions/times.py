"""Time expressions as Columns: windows, delta texts, durations and printed forms."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, functions as F

# Units an offset may use, with their length in microseconds (fixed values).
UNIT_MICROS = {
    "weeks": 604_800_000_000,
    "days": 86_400_000_000,
    "hours": 3_600_000_000,
    "minutes": 60_000_000,
    "seconds": 1_000_000,
    "milliseconds": 1_000,
    "microseconds": 1,
}

# Short names accepted in duration texts (fixed values).
UNIT_ALIASES = {
    "d": "days", "day": "days",
    "h": "hours", "hr": "hours",
    "m": "minutes", "min": "minutes",
    "s": "seconds", "sec": "seconds",
}


def moment(value, kind: str = "timestamp_ntz") -> Column:
    """A timestamp constant. Text keeps it free of driver time zones and lets it reach the scan as a filter."""
    if isinstance(value, Column):
        return value
    if isinstance(value, dt.datetime):
        value = value.isoformat(sep=" ")
    return F.lit(str(value)).cast(kind)


def moment_or_default(text: Column, default: str = "1970-01-01 00:00:00") -> Column:
    """A time text as a timestamp; the default where it is missing or no time."""
    return F.coalesce(F.try_to_timestamp(text).cast("timestamp_ntz"), moment(default))


def micros(amount) -> Column:
    """An interval of so many microseconds."""
    amount = amount if isinstance(amount, Column) else F.lit(amount)
    secs = (amount.cast("decimal(24,0)") / F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(18,6)")
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), secs)


def seconds(amount) -> Column:
    """An interval of whole seconds; ``amount`` may be a number or a Column."""
    amount = amount if isinstance(amount, Column) else F.lit(amount)
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), amount.cast("decimal(18,6)"))


def minutes(amount) -> Column:
    amount = amount if isinstance(amount, Column) else F.lit(amount)
    return seconds(amount * F.lit(60))


# Kinds of steps in a delta text: the pattern of a part, tried in this order, and the step it stands for.
_CLOCK = r"[+-]?\d+(?::[+-]?\d+)*"
STEPS = [
    (rf"time\s*=\s*({_CLOCK})", "clock"),
    (r"date\s*=\s*([\d.-]+)", "day"),
    (r"weekday\s*=\s*([+-]?\d+)", "weekday"),
    (rf"({_CLOCK})", "later"),
    (r"\w+\s*=\s*[+-]*\d+|[+-]*\d+\s+\w+", "amount"),
]
# Names of the fields in a date, by its separator.
DATE_FIELDS = {".": ("day", "month", "year"), "-": ("year", "month", "day")}


def _midnight(ts: Column) -> Column:
    return F.date_trunc("day", ts).cast("timestamp_ntz")


def _to_day(ts: Column, fields: dict[str, Column]) -> Column:
    """The same clock time on another day; fields that are not given, or NULL, stay."""
    own = [F.coalesce(fields.get(name, F.lit(None).cast("int")), getattr(F, of)(ts)) for name, of in (("year", "year"), ("month", "month"), ("day", "dayofmonth"))]
    day = F.try_to_timestamp(F.format_string("%04d-%02d-%02d", *own), F.lit("yyyy-MM-dd")).cast("timestamp_ntz")
    return day + (ts - _midnight(ts))


# What a step does to a moment; the argument is a Column, or a dict of Columns for a day.
MOVES = {
    "clock": lambda ts, sec: _midnight(ts) + seconds(sec),
    "day": _to_day,
    "weekday": lambda ts, number: ts + F.make_dt_interval(number - F.weekday(ts)),
    "later": lambda ts, sec: ts + seconds(sec),
    "amount": lambda ts, us: ts + micros(us),
}


def _argument(kind: str, part: str):
    """The argument of a step as a constant."""
    value = part.split("=")[-1].strip()
    if kind in ("clock", "later"):
        return F.lit(sum(int(v) * unit for v, unit in zip(value.split(":"), (3600, 60, 1))))
    if kind == "weekday":
        return F.lit(int(value))
    if kind == "day":
        sep = "." if "." in value else "-"
        return {name: F.lit(int(v)) for name, v in zip(DATE_FIELDS[sep], value.split(sep))}
    number, unit = re.search(r"[+-]*\d+", part)[0], re.search(r"[a-z_]+", part)
    unit = (unit[0].rstrip("s") if unit else "") + "s"
    if unit not in UNIT_MICROS:
        raise ValueError(f"unknown unit in delta text: {part!r}")
    return F.lit(int(number) * UNIT_MICROS[unit])


def shift(ts: Column, expression: str | None) -> Column:
    """Apply a delta text known when the plan is built; it compiles to plain arithmetic.

    The text is a comma list of ``time=H[:M[:S]]``, ``date=Y-M-D`` or ``date=D.M.Y`` (short forms allowed),
    ``weekday=N`` (0 is Monday, same week), ``unit=±N``, ``N unit`` and ``H:M:S`` (added); other parts do nothing.
    The result has whole seconds.
    """
    if expression is None:
        return ts
    steps = []
    for part in map(str.strip, expression.lower().split(",")):
        kind = next((kind for pattern, kind in STEPS if re.fullmatch(pattern, part)), None)
        if kind:
            steps.append((kind, _argument(kind, part)))
    out = ts.cast("timestamp_ntz")
    for kind, argument in steps:
        out = MOVES[kind](out, argument)
    return F.date_trunc("second", out).cast("timestamp_ntz")


def shift_by_column(ts: Column, expression: Column) -> Column:
    """The same steps as :func:`shift` with a different text on every row, still evaluated inside the JVM.

    Parts that :func:`shift` would reject give NULL.
    """
    def piece(text: Column, at: int, sep: str) -> Column:
        return F.split_part(text, F.lit(sep), F.lit(at)).try_cast("int")

    def argument(kind: str, part: Column):
        value = F.trim(F.element_at(F.split(part, "="), -1))
        if kind in ("clock", "later"):
            return sum((F.coalesce(piece(value, at, ":"), F.lit(0)) * unit for at, unit in ((2, 60), (3, 1))), F.coalesce(piece(value, 1, ":"), F.lit(0)) * 3600)
        if kind == "weekday":
            return value.try_cast("int")
        if kind == "day":
            dotted = value.contains(".")
            place = {sep: {name: at for at, name in enumerate(names, 1)} for sep, names in DATE_FIELDS.items()}
            return {name: F.when(dotted, piece(value, place["."][name], ".")).otherwise(piece(value, place["-"][name], "-")) for name in DATE_FIELDS["-"]}
        unit = F.concat(F.regexp_replace(F.regexp_extract(part, "[a-z_]+", 0), "s+$", ""), F.lit("s"))
        number = F.regexp_replace(F.regexp_extract(part, r"[+-]*\d+", 0), r"^\++", "").try_cast("bigint")
        return number * F.coalesce(*[F.when(unit == k, F.lit(v).cast("bigint")) for k, v in UNIT_MICROS.items()])

    def step(acc: Column, raw: Column) -> Column:
        part, moved = F.trim(raw), None
        for pattern, kind in STEPS:
            fits, there = part.rlike(f"^(?:{pattern})$"), MOVES[kind](acc, argument(kind, part))
            moved = F.when(fits, there) if moved is None else moved.when(fits, there)
        return moved.otherwise(acc)

    start = ts.cast("timestamp_ntz")
    done = F.aggregate(F.split(F.lower(expression), ","), start, step, lambda acc: F.date_trunc("second", acc).cast("timestamp_ntz"))
    return F.when(expression.isNull(), start).otherwise(done)


def duration(text: Column) -> Column:
    """``hours=1,minutes=5`` as an interval. Aliases are known, other parts count as nothing."""
    parts = {unit: [unit] + [a for a, u in UNIT_ALIASES.items() if u == unit] for unit in UNIT_MICROS}
    total = F.lit(0).cast("bigint")
    for unit, names in parts.items():
        pattern = rf"(?:^|,)\s*(?:{'|'.join(names)})\s*=\s*([+-]?\d+)\s*(?=,|=|$)"
        found = F.regexp_extract_all(F.lower(text), F.lit(pattern), F.lit(1))
        total = total + F.aggregate(found, F.lit(0).cast("bigint"), lambda a, x: a + x.cast("bigint")) * F.lit(UNIT_MICROS[unit]).cast("bigint")
    return micros(total)


def minutes_or_duration(text: Column) -> Column:
    """A bare number means minutes, anything else is a duration text."""
    bare = text.rlike(r"^\s*[+-]?\d+\s*$")
    return F.when(bare, micros(F.trim(text).try_cast("bigint") * F.lit(UNIT_MICROS["minutes"]).cast("bigint"))).otherwise(duration(text))


def stamp(ts: Column) -> Column:
    """``YYYYMMDDHHMISS`` as used in package names."""
    return F.date_format(ts, "yyyyMMddHHmmss")


def iso_millis(ts: Column, offset: str = "+00:00") -> Column:
    """``YYYY-MM-DDTHH:MM:SS.mmm+00:00``."""
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit(offset))


def clock_text(ts: Column) -> Column:
    """``YYYY-MM-DD HH:MM:SS``."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def elapsed_seconds(later: Column, earlier: Column) -> Column:
    return F.timestamp_diff("SECOND", earlier, later)


def elapsed_text(later: Column, earlier: Column) -> Column:
    """``[D d ]HH:MM`` between two moments; the day part only when there is one."""
    secs = elapsed_seconds(later, earlier)
    days = F.floor(secs / 86400)
    clock = F.format_string("%02d:%02d", F.floor(F.pmod(secs, F.lit(86400)) / 3600), F.floor(F.pmod(secs, F.lit(3600)) / 60))
    return F.when(days != 0, F.concat(days.cast("string"), F.lit(" d "), clock)).otherwise(clock)


def day_window_start(now: Column, days: int) -> Column:
    """Midnight ``days`` days before ``now``."""
    return F.date_trunc("day", now - F.make_dt_interval(F.lit(days))).cast("timestamp_ntz")
