"""Feature logic and a defect model as one object, so that training and scoring cannot drift apart."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from devicelens.operators.columns import one_hot
from devicelens.operators.ordered import ROWS_PER_BLOCK, ordered
from devicelens.plans.features import feature_frame
from devicelens.plans.forecast import DEFAULT_ORDER, Order, arima_forecast
from devicelens.plans.forest import KeyedForest
from devicelens.plans.models import score
from devicelens.sources.sensor import KEY, ORDER, airflow, assign_trips


@dataclass(frozen=True)
class ComboModel:
    """Raw readings in, features with a temperature forecast out, and a prediction if there is a model.

    ``predict`` is any function from frame to frame: a fitted model's scoring, or a per-key one.
    """

    vocab: Mapping[str, Sequence[str]]
    order: Order = DEFAULT_ORDER
    trip_grain: str = "day"
    predict: Callable[[DataFrame], DataFrame] | None = None
    rows_per_block: int = ROWS_PER_BLOCK
    model: PipelineModel | KeyedForest | None = None

    def features(self, readings: DataFrame) -> DataFrame:
        frame = assign_trips(ordered(readings, KEY, ORDER, self.rows_per_block), grain=self.trip_grain)
        frame = airflow(frame, "rotation_speed", "air_pressure", within=["trip_id"])
        frame = feature_frame(frame)
        return one_hot(arima_forecast(frame, "temperature", self.order, "predicted_temp"), self.vocab)

    def transform(self, readings: DataFrame) -> DataFrame:
        df = self.features(readings)
        return self.predicted(df)

    def predicted(self, features: DataFrame) -> DataFrame:
        """Features with a prediction; rows of keys that have no model get null."""
        if self.predict:
            return self.predict(features)
        if isinstance(self.model, KeyedForest):
            return self.model.score(features, "prediction")
        return score(features, self.model, "prediction") if self.model else features

    def save(self, spark: SparkSession, path: str) -> str:
        """Write vocabulary, order, trip grain and fitted model (one, or one per key) below ``path``; a bare function cannot be saved."""
        if self.predict:
            raise ValueError("only a fitted model can be saved, not a function")
        parts = {"vocab": {k: list(v) for k, v in self.vocab.items()}, "order": list(self.order), "trip_grain": self.trip_grain, "rows_per_block": self.rows_per_block, "fitted": self.model is not None, "per_key": isinstance(self.model, KeyedForest)}
        spark.createDataFrame([(json.dumps(parts),)], "config string").coalesce(1).write.parquet(f"{path}/config")
        if isinstance(self.model, KeyedForest):
            self.model.save(f"{path}/model")
        elif self.model:
            self.model.write().save(f"{path}/model")
        return path

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> ComboModel:
        parts = json.loads(spark.read.parquet(f"{path}/config").first()["config"])
        model = None
        if parts["fitted"]:
            model = KeyedForest.load(spark, f"{path}/model") if parts.get("per_key") else PipelineModel.load(f"{path}/model")
        return cls(parts["vocab"], tuple(parts["order"]), parts["trip_grain"], None, parts["rows_per_block"], model)
