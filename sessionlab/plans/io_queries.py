"""Sources and sinks: every query writes to the shared folder and returns what
is read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from sessionlab.functions.exprs import round_doubles
from sessionlab.functions.ranking import global_row_index
from sessionlab.operators import prepare as P
from sessionlab.operators import select as S
from sessionlab.plans import oracle as O
from sessionlab.plans.catalog import _splits, _ws, register
from sessionlab.plans.eval_queries import TOP_K, _base_ctes, _pred, _sql_pred, _tc_ctes
from sessionlab.schema import CLICK_SCHEMA, SESSION, TARGET, TIME
from sessionlab.sources import clicklog, sinks
from sessionlab.sources.store import new_folder

COLUMNS = [f.name for f in CLICK_SCHEMA.fields]
_COLS = ", ".join(COLUMNS)
# Fixed rule of the queries: a product is missing in every seventh event, and
# every eleventh category has a quote and a comma in its name.
_ODD_SQL = f"""odd_ as (select event_id, event_time, event_type, case when event_id % 7 = 0 then null else product_id end as product_id,
  case when event_id % 11 = 0 then concat('a "', category_id, '", b') else category_id end as category_id,
  user_id, user_session, session_value from clicks)"""


def _odd(clicks):
    named = F.concat(F.lit('a "'), F.col("category_id"), F.lit('", b'))
    return clicks.withColumns({"product_id": F.when(F.col("event_id") % 7 != 0, F.col("product_id")),
                               "category_id": F.when(F.col("event_id") % 11 == 0, named).otherwise(F.col("category_id"))})


@register("csv_click_log", O.compose(O.head_ctes(False) + [_ODD_SQL], f"select {_COLS} from odd_"))
def q_csv(spark, sf_dir):
    """S1 + S2: the log as CSV, with missing fields, quotes and separators."""
    clicks, _, _ = _splits(spark, sf_dir)
    path = new_folder(spark, "csv_click_log")
    clicklog.write_clicks(_odd(clicks), path)
    return clicklog.read_clicks(spark, path)


@register("load_and_split", O.compose(O.head_ctes(False), f"""
select case when cast(event_time as date) < date '{O.SPLIT_DATE}' then 'train' else 'validation' end as split, {_COLS}
from clicks where event_time is not null
union all select 'test', {_COLS.replace(TARGET, 'null')} from val_clicks"""))
def q_load_and_split(spark, sf_dir):
    """P2 with S1: the train and test logs read from CSV, train split by date;
    the test log (here the validation events) has no target."""
    clicks, _, val = _splits(spark, sf_dir)
    train_path, test_path = new_folder(spark, "train_log"), new_folder(spark, "test_log")
    clicklog.write_clicks(clicks, train_path)
    clicklog.write_clicks(val.drop(TARGET), test_path)
    train, validation, test = P.load_and_split(spark, train_path, test_path)
    named = lambda df, name: df.select(F.lit(name).alias("split"), *df.columns)
    return (named(train, "train").unionByName(named(validation, "validation"))
            .unionByName(named(test, "test"), allowMissingColumns=True))


@register("sorted_click_log", O.compose(O.head_ctes(False), """
select event_id, event_time, row_number() over (order by event_time, event_id) - 1 as position from clicks"""))
def q_sorted(spark, sf_dir):
    """S3: the time-ordered log, written and read back with its line numbers."""
    clicks, _, _ = _splits(spark, sf_dir)
    path = new_folder(spark, "sorted_log")
    sinks.write_table(clicklog.sorted_log(clicks), path)
    # the files are in order of time: numbers by file and place must agree with numbers by time
    kept = spark.read.parquet(path).withColumn("file", F.input_file_name()).withColumn("at", F.monotonically_increasing_id())
    by_place = global_row_index(kept.select("event_id", "event_time", "file", "at"), ["file", "at"], "position")
    return by_place.select("event_id", "event_time", "position")


@register("processed_sets", O.compose(O.head_ctes(False) + [_ODD_SQL], " union all ".join(
    f"select '{fmt}' as fmt, '{split}' as split, event_id, {_COLS.replace(TARGET, target)} from odd_ where {cond}"
    for fmt in ("parquet", "csv") for split, cond, target in (
        ("train", O.TRAIN_COND, TARGET), ("validation", O.VAL_COND, TARGET), ("test", O.VAL_COND, f"null as {TARGET}")))))
def q_processed(spark, sf_dir):
    """The three processed sets, as parquet and as CSV."""
    _, train, val = _splits(spark, sf_dir)
    train, val = _odd(train), _odd(val)
    out = None
    for fmt in ("parquet", "csv"):
        path = new_folder(spark, "processed")
        sinks.save_processed(train, val, val.drop(TARGET), path, fmt)
        for split in ("train", "validation", "test"):
            back = sinks.read_processed(spark, path, split, fmt, train.schema)
            back = back.select(F.lit(fmt).alias("fmt"), F.lit(split).alias("split"), "event_id", *COLUMNS)
            out = back if out is None else out.unionByName(back)
    return out


@register("feature_list", O.compose(_tc_ctes(), f"""
select cast(rank - 1 as integer) as position, feature from (
  select feature, row_number() over (order by round(abs(corr) * 1e{S.TIE_DECIMALS}) desc, position) as rank
  from tc_ where corr is not null) x where rank <= {TOP_K}"""))
def q_feature_list(spark, sf_dir):
    """The selected names as a plain text file, one per line."""
    path = new_folder(spark, "selected_features")
    sinks.write_feature_list(spark, S.top_k_by_correlation(_ws(spark, sf_dir).features("train"), TOP_K), path)
    return spark.createDataFrame(list(enumerate(sinks.read_feature_list(spark, path))), "position int, feature string")


@register("validation_predictions", O.compose(_base_ctes(), " union all ".join(
    f"select '{fmt}' as fmt, user_session, {O.rnd('session_value')} as actual, {O.rnd(_sql_pred('signed'))} as predicted from va_"
    for fmt in ("parquet", "csv"))))
def q_predictions(spark, sf_dir):
    """(user_session, actual, predicted), as parquet and as CSV."""
    va = _ws(spark, sf_dir).features("val", ["base"]).withColumn("prediction", _pred("signed"))
    out = None
    for fmt in ("parquet", "csv"):
        path = new_folder(spark, "validation_predictions")
        sinks.write_predictions(va, path, fmt=fmt)
        back = sinks.read_table(spark, path, fmt, f"{SESSION} string, actual double, predicted double")
        back = back.select(F.lit(fmt).alias("fmt"), "*")
        out = back if out is None else out.unionByName(back)
    return round_doubles(out)


@register("submission", O.compose(_base_ctes(), f"""
select user_session, {O.rnd(f'greatest({_sql_pred("signed")}, 0.0)')} as session_value from va_"""))
def q_submission(spark, sf_dir):
    """S9 + P12: the submission file, floored at 0, written and read back."""
    va = _ws(spark, sf_dir).features("val", ["base"]).withColumn("prediction", _pred("signed"))
    path = new_folder(spark, "submission")
    sinks.create_submission(va, path)
    return round_doubles(sinks.read_table(spark, path, "csv", f"{SESSION} string, {TARGET} double"))


@register("feature_matrix", O.compose(_base_ctes(), """
select user_session, session_value, cast(coalesce(nullif(unique_products, 2), 0) as double) as unique_products,
       coalesce(nullif(duration_minutes, 0), 0) as duration_minutes, cast(total_events as double) as total_events from (
  select user_session, round(session_value * 1000000.0) / 1000000.0 as session_value, unique_products, total_events,
         round(duration_minutes * 1000000.0) / 1000000.0 as duration_minutes from va_) x"""))
def q_matrix(spark, sf_dir):
    """P10: selected features with missing values as 0."""
    va = _ws(spark, sf_dir).features("val", ["base"])
    holes = va.withColumns({"unique_products": F.nullif("unique_products", F.lit(2)),
                            "duration_minutes": F.nullif("duration_minutes", F.lit(0.0))})
    return round_doubles(P.feature_matrix(holes, ["unique_products", "duration_minutes", "total_events"]))
