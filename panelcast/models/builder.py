"""Feature builder as a ``pyspark.ml`` Estimator / Model.

``fit`` writes the state the serving path needs: sums and counts per (series,
year, week) for the prior-year value, and per (dept, date) and (store, date)
for the frozen averages (T8). ``update`` adds the sums of new weeks, so a week's
run reads the new rows and the state, not all history; fitting on A and
updating with B is fitting on A and B. ``transform`` merges exogenous tables,
cleans, derives calendar and holiday features and looks the state up by key.
The state is checkpointed once when it is made and joined, never collected. A
custom writer stores it as parquet so the stage round-trips inside a saved
``PipelineModel``.
"""

from __future__ import annotations

import json
import os

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param.shared import Param, Params, TypeConverters
from pyspark.ml.util import MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import days_to_nearest_holiday, holiday_flags
from ..operators import features as FE
from ..operators import frozen as FZ
from ..operators import prep as P
from ..session import materialize

# The reference's full (24) and pruned (16) feature lists, in
# library column names.
ALL_FEATURES = [
    "store", "dept", "type", "size", "temperature", "fuel_price", "cpi", "unemployment",
    "markdown1", "markdown2", "markdown3", "markdown4", "markdown5", "year", "month", "week",
    "sales_lag_52wk", "is_superbowl", "is_labor_day", "is_thanksgiving", "is_christmas",
    "days_to_nearest_holiday", "dept_avg_sales_expanding", "store_avg_sales_expanding",
]
PRUNED_FEATURES = [
    "store", "dept", "type", "size", "temperature", "fuel_price", "cpi", "unemployment",
    "markdown3", "month", "week", "sales_lag_52wk", "is_thanksgiving",
    "days_to_nearest_holiday", "dept_avg_sales_expanding", "store_avg_sales_expanding",
]
CATEGORICAL = ["store", "dept", "type"]
PASSTHROUGH = ["store", "dept", "date", "is_holiday", "weekly_sales"]


def calendar_features(df: DataFrame, holidays) -> DataFrame:
    """H2 + H11 + H12: year, month, ISO week, named holiday flags, proximity."""
    flags = holiday_flags("date", holidays)
    return df.select("*", F.year("date").alias("year"), F.month("date").alias("month"),
                     F.weekofyear("date").alias("week"),
                     *[c.alias(k) for k, c in flags.items()],
                     days_to_nearest_holiday("date", holidays).alias("days_to_nearest_holiday"))


def feature_table(sales: DataFrame, features: DataFrame, stores: DataFrame, holidays,
                  mode: str = "expanding") -> DataFrame:
    """Flat-frame features (T17 ``expanding`` mode): every row sees its own
    past through windows, validation rows included, as in the reference's CV."""
    if mode != "expanding":
        raise ValueError("flat feature tables are built in 'expanding' mode; use the builder for 'frozen'")
    df = P.clean_data(P.merge_all(sales, features, stores))
    df = FE.add_prior_year_sales(df)
    df = calendar_features(df, holidays)
    df = FE.add_expanding_dept_avg(df)
    return FE.add_expanding_store_avg(df)


class _BuilderParams(Params):
    holidays = Param(Params._dummy(), "holidays", "JSON list of [name, date] pairs", TypeConverters.toString)
    outputFeatures = Param(Params._dummy(), "outputFeatures", "feature columns emitted", TypeConverters.toListString)

    def __init__(self):
        super().__init__()
        self._setDefault(outputFeatures=PRUNED_FEATURES)

    def holiday_list(self):
        return [tuple(x) for x in json.loads(self.getOrDefault(self.holidays))]


class PanelFeatureBuilder(Estimator, _BuilderParams, MLWritable, MLReadable):
    """K2: Estimator over (store, dept, date, is_holiday, weekly_sales) rows."""

    @keyword_only
    def __init__(self, features: DataFrame | None = None, stores: DataFrame | None = None,
                 holidays: str | None = None, outputFeatures: list[str] | None = None):
        """``holidays`` is required before fitting: a calendar that covers the data's dates."""
        super().__init__()
        self.features_df = features
        self.stores_df = stores
        kwargs = {k: v for k, v in self._input_kwargs.items() if k in ("holidays", "outputFeatures")}
        self._set(**kwargs)

    def _fit(self, dataset: DataFrame) -> "PanelFeatureModel":
        m = PanelFeatureModel(self.features_df, self.stores_df, **{k: materialize(v) for k, v in state_of(dataset).items()})
        return self._copyValues(m)

    def write(self):
        return _StateWriter(self, {"features": self.features_df, "stores": self.stores_df})

    @classmethod
    def read(cls):
        return _StateReader(cls)


STATE_KEYS = {"history": ["store", "dept", "_year", "_week"], "dept_sums": ["dept", "date"], "store_sums": ["store", "date"]}


def state_of(rows: DataFrame) -> dict[str, DataFrame]:
    """The builder's state of some rows: sums and counts, which add up over any split of the rows."""
    history = (rows.groupBy("store", "dept", (F.year("date") + 1).alias("_year"), F.weekofyear("date").alias("_week"))
               .agg(F.sum("weekly_sales").alias("total"), F.count("weekly_sales").alias("n")))
    return {"history": history, "dept_sums": FZ.date_sums(rows, "dept"), "store_sums": FZ.date_sums(rows, "store")}


class PanelFeatureModel(Model, _BuilderParams, MLWritable, MLReadable):
    """K2 fitted state (``state_of``) plus the dimension tables."""

    def __init__(self, features: DataFrame | None = None, stores: DataFrame | None = None, history: DataFrame | None = None,
                 dept_sums: DataFrame | None = None, store_sums: DataFrame | None = None):
        super().__init__()
        self.features_df, self.stores_df = features, stores
        self.history_df, self.dept_sums_df, self.store_sums_df = history, dept_sums, store_sums

    def state(self) -> dict[str, DataFrame]:
        return {"history": self.history_df, "dept_sums": self.dept_sums_df, "store_sums": self.store_sums_df}

    def update(self, rows: DataFrame) -> "PanelFeatureModel":
        """A model whose state also covers ``rows`` (rows that the state has not seen yet)."""
        new = state_of(rows)
        added = {k: materialize(FZ.add_sums(old, new[k], STATE_KEYS[k])) for k, old in self.state().items()}
        return self._copyValues(PanelFeatureModel(self.features_df, self.stores_df, **added))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        df = dataset
        if self.features_df is not None and self.stores_df is not None:
            df = P.clean_data(P.merge_all(df, self.features_df, self.stores_df))
        df = calendar_features(df, self.holiday_list())
        keyed = df.withColumn("_year", F.year("date")).withColumn("_week", F.weekofyear("date"))
        prior = self.history_df.select(*STATE_KEYS["history"], F.try_divide("total", F.col("n")).alias("sales_lag_52wk"))
        df = keyed.join(prior, STATE_KEYS["history"], "left").drop("_year", "_week")
        df = FZ.lookup_snapshot(df, FZ.frozen_from_sums(self.dept_sums_df, "dept"), "dept")
        df = FZ.lookup_snapshot(df, FZ.frozen_from_sums(self.store_sums_df, "store"), "store")
        feats = self.getOrDefault(self.outputFeatures)
        keep = [c for c in PASSTHROUGH if c in df.columns and c not in feats]
        return df.select(*keep, *feats)

    def write(self):
        return _StateWriter(self, {"features": self.features_df, "stores": self.stores_df, **self.state()})

    @classmethod
    def read(cls):
        return _StateReader(cls)


class _StateWriter(MLWriter):
    """Params as JSON metadata plus every state table as parquet."""

    def __init__(self, instance, tables: dict[str, DataFrame | None]):
        super().__init__()
        self.instance, self.tables = instance, tables

    def saveImpl(self, path: str) -> None:
        from pyspark.ml.util import DefaultParamsWriter
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession,
                                         extraMetadata={"tables": [k for k, v in self.tables.items() if v is not None]})
        for name, df in self.tables.items():
            if df is not None:
                df.write.mode("overwrite").parquet(os.path.join(path, name))


class _StateReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str):
        from pyspark.ml.util import DefaultParamsReader
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession.sparkContext)
        spark: SparkSession = self.sparkSession
        t = {n: spark.read.parquet(os.path.join(path, n)) for n in meta.get("tables", [])}
        if self.cls is PanelFeatureModel:
            inst = PanelFeatureModel(t.get("features"), t.get("stores"), **{k: t.get(k) for k in STATE_KEYS})
        else:
            inst = PanelFeatureBuilder(features=t.get("features"), stores=t.get("stores"))
        DefaultParamsReader.getAndSetParams(inst, meta)
        inst._resetUid(meta["uid"])
        return inst
