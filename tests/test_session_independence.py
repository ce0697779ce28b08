"""Queries do not depend on the library's session defaults: with Spark's
default 200 shuffle partitions and a daylight-saving session time zone they
still equal the DuckDB oracle (sf0.001)."""
import pytest

from sessionlab.plans import catalog
from sessionlab.plans import workspace as W
from compare import compare, duck
from conftest import SF001

NAMES = ["feature_table", "temporal_split_counts", "robust_scale", "temporal_folds", "selected_features"]


@pytest.fixture()
def foreign_session(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone")}
    W.release(spark)                                  # nothing computed under the test defaults is reused
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)
    W.release(spark)


def test_queries_without_library_defaults(foreign_session):
    con = duck(SF001)
    for name in NAMES:
        r = compare(catalog.QUERIES[name](foreign_session, SF001), con, catalog.ORACLE[name])
        assert r["match"] and r["columns_match"], (name, r)
