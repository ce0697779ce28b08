"""Column expressions shared by the operators (all JVM-side, codegen-able)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def seconds_between(start, end, ntz: bool = True) -> Column:
    """(end - start) in float seconds, microsecond exact.  For
    TIMESTAMP_NTZ this is a wall-clock difference, as for naive datetimes."""
    return (epoch_micros(end, ntz) - epoch_micros(start, ntz)).cast("double") / F.lit(1e6)


def epoch_micros(c, ntz: bool = True) -> Column:
    """Microseconds since 1970-01-01 00:00.  For TIMESTAMP_NTZ this is
    wall-clock arithmetic on the value's own fields (date, hour, minute,
    seconds with fraction), so it never depends on the session time zone;
    casts and ``timestamp_diff`` on NTZ go through that zone and are not
    monotone across a daylight-saving jump."""
    t = col(c)
    if ntz:
        secs = F.unix_date(F.to_date(t)).cast("long") * 86400 + F.hour(t) * 3600 + F.minute(t) * 60
        return secs * 1_000_000 + (F.date_part(F.lit("SECOND"), t) * 1_000_000).cast("long")
    return F.unix_micros(t)


def is_ntz(df, c: str) -> bool:
    from pyspark.sql import types as T
    return isinstance(df.schema[c].dataType, T.TimestampNTZType)


def time_bucket(c, seconds: float, ntz: bool = True) -> Column:
    """Monotone coarse time bucket used to split hot ordered groups."""
    return F.floor(epoch_micros(c, ntz) / F.lit(int(seconds * 1_000_000))).cast("long")


def flag(cond: Column) -> Column:
    """Boolean condition as 0/1 bigint (null counts as 0)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0)).cast("long")


def ratio(num, den, floor: float | None = None) -> Column:
    """num / den as double; with ``floor`` the denominator is max(den, floor)."""
    d = col(den).cast("double")
    if floor is not None:
        d = F.greatest(d, F.lit(float(floor)))
    return col(num).cast("double") / d


def safe_ratio(num, den) -> Column:
    """num / den, 0 when den is 0 or null (no ANSI divide-by-zero)."""
    return F.when(col(den) > 0, col(num).cast("double") / col(den).cast("double")).otherwise(F.lit(0.0))


def between_flag(c, lo, hi) -> Column:
    return flag(col(c).between(lo, hi))


def in_flag(c, values) -> Column:
    return flag(col(c).isin(list(values)))


def round_doubles(df, digits: int = 6):
    """Round every double column (presentation / engine comparison only)."""
    out = []
    for f in df.schema.fields:
        if f.dataType.typeName() in ("double", "float"):
            # round(x * 10^d) / 10^d: the same IEEE product in every engine,
            # so ties are broken identically (half away from zero)
            scale = float(10 ** digits)
            out.append((F.round(F.col(f.name) * F.lit(scale), 0) / F.lit(scale)).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)
