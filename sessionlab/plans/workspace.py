"""Per-session workspace: derived tables built once and shared by queries.

The adapted click log, the rates fitted on its training split and the
feature tables are staged as parquet in the shared checkpoint folder
(``sources.store.stage``) the first time a query needs them, keyed by the
application, the data folder and the input files' fingerprint (so changed
inputs rebuild).  This is the in-process form of the feature cache (S5).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sessionlab.operators.features import FAMILIES, build_features, feature_names
from sessionlab.operators.prepare import train_val_split
from sessionlab.operators.rates import RateModel, fit_rates
from sessionlab.sources.adapter import load_clicks
from sessionlab.sources.sinks import input_fingerprint
from sessionlab.schema import SESSION, TARGET
from sessionlab.sources.store import stage

_WORKSPACES: dict = {}


class Workspace:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._clicks: DataFrame | None = None
        self._rates: dict = {}
        self._features: dict = {}
        self.ensemble = None              # fitted by the model queries

    @property
    def clicks(self) -> DataFrame:
        if self._clicks is None:
            self._clicks = stage(load_clicks(self.spark, self.sf_dir), "clicks")
        return self._clicks

    def split(self, name: str) -> DataFrame:
        train, val = train_val_split(self.clicks)
        return {"train": train, "val": val, "all": self.clicks}[name]

    def rates(self, with_page_values: bool = False) -> RateModel:
        if with_page_values not in self._rates:
            self._rates[with_page_values] = fit_rates(self.split("train"), with_page_values=with_page_values)
        return self._rates[with_page_values]

    def features(self, split: str, families=FAMILIES) -> DataFrame:
        key = (split, tuple(families))
        if key not in self._features:
            # a staged table of the same split with more families: project it
            for (sp, fams), table in self._features.items():
                if sp == split and set(families) <= set(fams):
                    have = set(table.columns)
                    return table.select(*[c for c in build_columns(families) if c in have])
            fam = set(families)
            rates = None
            if "research" in fam or "page_value" in fam:
                rates = self.rates(with_page_values="page_value" in fam)
            self._features[key] = stage(build_features(self.split(split), families, rates),
                                        f"features_{split}")
        return self._features[key]


def workspace(spark: SparkSession, sf_dir: str) -> Workspace:
    stamp = input_fingerprint(spark.read.parquet(f"{sf_dir}/events.parquet"))
    key = (spark.sparkContext.applicationId, sf_dir, stamp)
    if key not in _WORKSPACES:
        _WORKSPACES[key] = Workspace(spark, sf_dir)
    return _WORKSPACES[key]


def build_columns(families) -> list[str]:
    """Columns of ``build_features(..., families)`` in its order."""
    return [SESSION, "user_id", *feature_names(families), TARGET]


def release(spark: SparkSession) -> int:
    """Forget this application's workspaces and delete the tables they (and
    anything else) staged; the next query rebuilds what it needs."""
    from sessionlab.sources import store
    app = spark.sparkContext.applicationId
    for key in [k for k in _WORKSPACES if k[0] == app]:
        del _WORKSPACES[key]
    return store.release(spark)
