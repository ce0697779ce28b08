"""FIXTURES.md section 4 edge inputs: Spark features against the plain
window / group-by SQL (DuckDB) on a small hand-made click log."""
import datetime as dt

import duckdb
import pandas as pd
import pytest

from sessionlab.operators.features import FAMILIES, build_features
from sessionlab.operators.rates import fit_rates
from sessionlab.plans import oracle as O
from compare import rows_of
from sessionlab.schema import CLICK_SCHEMA

T0 = dt.datetime(2024, 1, 10, 12, 0, 0)


def _rows():
    r = []

    def add(i, s, sec, et, p, c, v=10.0, u="U1"):
        r.append((i, T0 + dt.timedelta(seconds=sec), et, p, c, u, s, v))
    add(1, "A", 0, "VIEW", "P1", "C1")
    add(2, "A", 300, "ADD_CART", "P1", "C1")            # gap exactly 300: no long pause
    add(3, "A", 310, "BUY", "P2", "C2")                 # gap exactly 10: no quick action
    add(4, "B", 0, "VIEW", None, "C1", 5.0)             # null product
    add(5, "B", 5, "VIEW", None, None, 5.0)             # null product and category
    add(6, "B", 5, "BUY", "P3", "C9", 5.0)              # tie on time, unseen category C9
    add(7, "C", 0, "ADD_CART", "P4", "C3", 0.0)
    add(8, "C", 0, "ADD_CART", "P4", "C3", 0.0)         # duplicate event at the same time
    add(9, "C", 900, "REMOVE_CART", "P4", "C3", 0.0)
    add(10, None, 50, "VIEW", "P5", "C1")               # no session: dropped
    add(11, "D", 0, "VIEW", "P6", "C4", u=None)        # null user
    return r


TRAIN_IDS = {1, 2, 3, 4, 5, 7, 8, 9, 10}                # C9 never seen in train


@pytest.fixture(scope="module")
def frames(spark):
    rows = _rows()
    cols = ["event_id", "event_time", "event_type", "product_id", "category_id", "user_id",
            "user_session", "session_value"]
    schema = "event_id long, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in CLICK_SCHEMA.fields)
    ordered = [(r[0], r[1], r[2], r[3], r[4], r[5], r[6], r[7]) for r in rows]
    sp = spark.createDataFrame([(r[0], r[1], r[2], r[3], r[4], r[5], r[6], r[7]) for r in ordered], schema)
    pdf = pd.DataFrame(ordered, columns=cols)
    return sp, pdf


def test_features_equal_plain_sql(spark, frames):
    sp, pdf = frames
    train = sp.filter(sp.event_id.isin(list(TRAIN_IDS)))
    got = build_features(sp, FAMILIES, fit_rates(train), bucket_seconds=120)
    con = duckdb.connect()
    con.register("fx_clicks", pdf)
    con.register("fx_train", pdf[pdf.event_id.isin(TRAIN_IDS)])
    ctes = [O.rates_ctes("fx_train").strip(), O.stats_ctes("fx_clicks", True).strip()]
    cols = ["user_session", "user_id"] + [O.r6(e, n, O.is_double_expr(e)) for n, e in O.feature_exprs(FAMILIES)]
    sql = O.compose(ctes, "select " + ", ".join(cols) + f", {O.rnd('session_value')} as session_value from st")
    want = con.execute(sql).fetchdf()
    from sessionlab.functions.exprs import round_doubles
    g = round_doubles(got).toPandas()
    assert sorted(g.columns) == sorted(want.columns)
    c = sorted(g.columns)
    gr = rows_of(g.astype(object).where(g.notna(), None).to_dict("records"), c)
    wr = rows_of(want.astype(object).where(want.notna(), None).to_dict("records"), c)
    assert gr == wr


def test_edge_values(spark, frames):
    sp, _ = frames
    train = sp.filter(sp.event_id.isin(list(TRAIN_IDS)))
    ft = {r["user_session"]: r for r in build_features(sp, FAMILIES, fit_rates(train)).collect()}
    assert set(ft) == {"A", "B", "C", "D"}                       # null session dropped
    assert ft["A"]["has_long_pause"] == 0 and ft["A"]["has_quick_actions"] == 0
    assert ft["B"]["unique_products"] == 1 and ft["B"]["unique_categories"] == 2
    assert ft["B"]["category_changes"] == 2                                         # C1 -> missing -> C9
    assert ft["B"]["has_comparison_pattern"] == 1 and ft["B"]["is_explorer"] == 0   # set() keeps the null
    assert ft["B"]["max_product_interactions"] == 1
    assert ft["C"]["total_events"] == 3 and ft["C"]["product_revisits"] == 2
    assert ft["D"]["user_id"] is None


def _stats_brute(events):
    """Order-dependent statistics of one session, row by row."""
    import statistics
    n, out = len(events), {}
    types, cats, times = ([e[i] for e in events] for i in (1, 2, 0))
    gaps = [(b - a).total_seconds() for a, b in zip(times, times[1:]) if a is not None and b is not None]
    pair = lambda *t: sum(tuple(types[i:i + len(t)]) == t for i in range(n - len(t) + 1))
    out["n"] = n
    out["n_addcart_buy"], out["n_view_buy"] = pair("ADD_CART", "BUY"), pair("VIEW", "BUY")
    out["n_addcart_remove"], out["n_view_addcart_buy"] = pair("ADD_CART", "REMOVE_CART"), pair("VIEW", "ADD_CART", "BUY")
    out["n_category_changes"] = sum(a is None or b is None or a != b for a, b in zip(cats, cats[1:]))
    out["first_type"], out["last_type"] = types[0], types[-1]
    out["first_buy_rn"] = next((i + 1 for i, t in enumerate(types) if t == "BUY"), None)
    out["gap_max"] = max(gaps, default=None)
    out["gap_avg"] = sum(gaps) / len(gaps) if gaps else None
    out["gap_std"] = statistics.stdev(gaps) if len(gaps) > 1 else None
    out["n_long_gap"], out["n_quick_gap"] = sum(g > 300 for g in gaps), sum(g < 10 for g in gaps)
    return out


@pytest.mark.parametrize("bucket", [5.0, 61.0, 3600.0, 1e8])
def test_states_merge_to_the_plain_statistics(spark, bucket):
    """Bucket states of any width give the statistics of the whole session:
    a hot session, events without a time, missing types and categories."""
    import random
    from sessionlab.operators.sessions import main_stats
    rnd = random.Random(4)
    base, rows, now = dt.datetime(2024, 3, 1), [], {}
    for i in range(900):
        s = "hot" if i % 3 == 0 else f"s{rnd.randrange(60)}"
        now[s] = now.get(s, base) + dt.timedelta(microseconds=rnd.choice([0, 10 ** 6, 9_999_999, 10 ** 7, 3 * 10 ** 8, 301 * 10 ** 6]))
        t = None if rnd.random() < 0.05 else now[s]
        rows.append((i, t, rnd.choice(["VIEW", "ADD_CART", "BUY", "REMOVE_CART", None]),
                     rnd.choice(["C1", "C2", None]), "P1", "U1", s, 1.0))
    rows.append((9999, base, "VIEW", "C1", "P1", "U1", None, 1.0))
    df = spark.createDataFrame(rows, "event_id long, event_time timestamp_ntz, event_type string, category_id string, "
                                     "product_id string, user_id string, user_session string, session_value double")
    got = {r["user_session"]: r for r in main_stats(df, bucket).collect()}
    by = {}
    for i, t, e, c, *_, s, _ in rows:
        if s is not None:
            by.setdefault(s, []).append((t is None, t or base, i, (t, e, c)))
    assert set(got) == set(by)
    for s, events in by.items():
        for name, value in _stats_brute([x[-1] for x in sorted(events)]).items():
            assert got[s][name] == (pytest.approx(value, abs=1e-9) if isinstance(value, float) else value), (s, name)
