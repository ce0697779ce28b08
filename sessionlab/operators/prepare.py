"""Splitting, cleaning, calendar columns, scaling, outliers, sampling.

P1/P2 temporal split, P3/P4 cleaning, P5 event calendar, P6/P7 scaling fit
on train and applied to any split, P9 IQR outlier filter, P10 feature
matrix, P11/P12 prediction clipping, K3/J3 first-N-sessions sample.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionlab.functions.exprs import epoch_micros
from sessionlab.functions.quantiles import exact_quantiles, quantiles, select_ranks
from sessionlab.functions.ranking import global_row_index
from sessionlab.schema import SESSION, TARGET, TIME, tie_columns
from sessionlab.sources.store import stage

# Default validation split date of the test data, fill token.
DEFAULT_SPLIT_DATE = "2024-01-24"
UNKNOWN = "UNKNOWN"
ID_COLUMNS = ("product_id", "category_id", "user_id")


def event_date(c: str = TIME) -> Column:
    """Calendar date of an event (not persisted on the log)."""
    return F.to_date(F.col(c))


def temporal_split(clicks: DataFrame, split_date: str = DEFAULT_SPLIT_DATE) -> tuple[DataFrame, DataFrame]:
    """Event-level split, date < D train, date >= D validation.  A
    session crossing D keeps its earlier rows in train, later in validation.
    Both are plain filters, pushed to the scan when the log is parquet."""
    d = F.lit(_dt.date.fromisoformat(split_date))
    return clicks.filter(event_date() < d), clicks.filter(event_date() >= d)


train_val_split = temporal_split


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    """Drop fully identical rows."""
    return df.dropDuplicates()


def clean_clicks(df: DataFrame) -> DataFrame:
    """P3 + P4: dedupe, then target nulls -> exact median of the deduped
    target, id nulls -> 'UNKNOWN'."""
    df = drop_duplicate_rows(df)
    fills = {c: F.coalesce(F.col(c), F.lit(UNKNOWN)) for c in ID_COLUMNS if c in df.columns}
    if TARGET in df.columns:
        med = exact_quantiles(df, [TARGET], [0.5])[TARGET][0]
        if med is not None:
            fills[TARGET] = F.coalesce(F.col(TARGET), F.lit(float(med)))
    return df.withColumns(fills) if fills else df


def event_calendar(df: DataFrame) -> DataFrame:
    """P5: hour, day_of_week (Mon=0), is_weekend (bool), month, day."""
    t = F.col(TIME)
    dow = F.weekday(t)
    return df.withColumns({"hour": F.hour(t), "day_of_week": dow, "is_weekend": dow.isin(5, 6),
                           "month": F.month(t), "day": F.dayofmonth(t)})


def numeric_columns(df: DataFrame, exclude=(SESSION, "user_id", TARGET)) -> list[str]:
    """Numeric, non-boolean columns (bool is not scaled)."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


@dataclass
class ScalerModel:
    """P6/P7 fitted statistics: (center, scale) per column."""
    method: str
    stats: dict = field(default_factory=dict)

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: (F.col(c).cast("double") - F.lit(m)) / F.lit(s)
                               for c, (m, s) in self.stats.items()})


def fit_scaler(train: DataFrame, cols: list[str] | None = None, method: str = "robust",
               exact: bool = True) -> ScalerModel:
    """Robust: (x - median) / (q75 - q25), exact quantiles (``exact=False``:
    one approximate pass), IQR 0 -> 1.  Otherwise standard: (x - mean) /
    population std, std 0 -> 1."""
    cols = cols or numeric_columns(train)
    stats = {}
    if method == "robust":
        q = quantiles(train, cols, [0.25, 0.5, 0.75], exact)
        for c in cols:
            q1, med, q3 = q[c]
            iqr = (q3 - q1) if q1 is not None else 0.0
            stats[c] = (med if med is not None else 0.0, iqr if iqr else 1.0)
    else:
        aggs = []
        for c in cols:
            aggs += [F.avg(F.col(c).cast("double")).alias(f"m_{c}"),
                     F.stddev_pop(F.col(c).cast("double")).alias(f"s_{c}")]
        r = train.agg(*aggs).first()
        for c in cols:
            m, s = r[f"m_{c}"], r[f"s_{c}"]
            stats[c] = (m if m is not None else 0.0, s if s else 1.0)
    return ScalerModel(method, stats)


def scale_features(train: DataFrame, *others: DataFrame, method: str = "robust",
                   cols: list[str] | None = None, exact: bool = True) -> tuple:
    """Fit on train, apply to train and every other split."""
    model = fit_scaler(train, cols, method, exact)
    return tuple(model.transform(d) for d in (train, *others))


def iqr_bounds(df: DataFrame, target: str = TARGET, factor: float = 1.5,
               exact: bool = True) -> tuple[float | None, float | None]:
    """Lower and upper bound; none without a non-null value."""
    q1, q3 = quantiles(df, [target], [0.25, 0.75], exact)[target]
    if q1 is None or q3 is None:
        return None, None
    iqr = q3 - q1
    return q1 - factor * iqr, q3 + factor * iqr


def remove_outliers(df: DataFrame, target: str = TARGET, method: str = "iqr",
                    factor: float = 1.5, exact: bool = True) -> DataFrame:
    """Keep rows with target in [q1 - f*iqr, q3 + f*iqr] (nulls drop)."""
    if method != "iqr":
        raise ValueError(f"unsupported outlier method {method!r}")
    lo, hi = iqr_bounds(df, target, factor, exact)
    if lo is None:
        return df.filter(F.lit(False))
    return df.filter(F.col(target).between(F.lit(lo), F.lit(hi)))


def feature_matrix(features: DataFrame, cols: list[str], keep=(SESSION, TARGET)) -> DataFrame:
    """P10: selected features with nulls as 0, plus id and target."""
    extra = [c for c in keep if c in features.columns]
    return features.select(*extra, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in cols])


def clip(c, lo: float | None = None, hi: float | None = None) -> Column:
    """least(greatest(c, lo), hi)."""
    e = F.col(c) if isinstance(c, str) else c
    if lo is not None:
        e = F.greatest(e, F.lit(float(lo)))
    if hi is not None:
        e = F.least(e, F.lit(float(hi)))
    return e


def session_starts(clicks: DataFrame) -> DataFrame:
    """user_session, start = first (time, tie) of the session."""
    order = F.struct(F.col(TIME), *[F.col(c) for c in tie_columns(clicks)])
    return clicks.filter(F.col(SESSION).isNotNull()).groupBy(SESSION).agg(F.min(order).alias("start"))


def first_session_starts(clicks: DataFrame, n: int) -> DataFrame:
    """K3: (user_session, start) of the first ``n`` sessions in time order, ties
    by the tie columns and the session id; a start without a time comes first.

    The start time of the n-th session is found by selection
    (``functions.quantiles``) over the session starts, which are written once;
    the rest is a filter.  Only sessions that start exactly then are ordered."""
    starts = stage(session_starts(clicks), "session_starts")
    total = starts.count()
    if n >= total or n <= 0:
        return starts if n > 0 else starts.limit(0)
    at = F.col(f"start.{TIME}")
    micros = epoch_micros(at, isinstance(starts.schema["start"].dataType[TIME].dataType, T.TimestampNTZType))
    micros = F.coalesce(micros.cast("double"), F.lit(float("-inf")))
    cut = select_ranks(starts, {"t": micros}, lambda _: [n - 1], [n / total])[1]["t"][n - 1]
    before = starts.where(micros < cut)
    ties = global_row_index(starts.where(micros == cut), ["start", SESSION])
    return before.unionByName(ties.where(F.col("row_index") < n - before.count()).drop("row_index"))


def first_sessions(clicks: DataFrame, n: int) -> DataFrame:
    """K3: the ids of the first ``n`` sessions."""
    return first_session_starts(clicks, n).select(SESSION)


def sample_sessions(clicks: DataFrame, n: int, max_broadcast_rows: int = 2_000_000) -> DataFrame:
    """K3 + J3: the click rows of the first ``n`` sessions (semi-join).  The
    sample has at most ``n`` rows, so it is broadcast when ``n`` is below the
    limit; the click rows are never shuffled for it."""
    sample = first_sessions(clicks, n)
    if n <= max_broadcast_rows:
        sample = F.broadcast(sample)
    return clicks.join(sample, SESSION, "left_semi")


def load_and_split(spark, train_path: str, test_path: str, split_date: str = DEFAULT_SPLIT_DATE,
                   fmt: str = "csv") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Read train and test logs (S1) and split train by date."""
    from sessionlab.sources.clicklog import load_raw_data
    train, test = load_raw_data(spark, train_path, test_path, fmt)
    tr, va = temporal_split(train, split_date)
    return tr, va, test

