"""Runs, model versions and stages kept as append-only Parquet tables in a shared folder.

One writer at a time is assumed. Rows are few (one per run, version or stage change);
queries on them are ordinary DataFrame queries.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from devicelens.operators.profile import binary_metrics
from devicelens.plans.combo import ComboModel
from devicelens.plans.models import importances, score
from devicelens.sources.tables import rows, write_path

TEXTS = T.MapType(T.StringType(), T.StringType())
RUNS = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("parent_run_id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("logged_at", T.TimestampType()),
        T.StructField("params", TEXTS),
        T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("tags", TEXTS),
        T.StructField("model_path", T.StringType()),
        T.StructField("signature", T.StringType()),
        T.StructField("input_example", T.StringType()),
    ]
)
#: Tag of a run whose model goes all the way from raw readings.
KIND, COMPOSITE = "kind", "composite"
VERSIONS = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("version", T.IntegerType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("registered_at", T.TimestampType()),
    ]
)
STAGES = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("version", T.IntegerType()),
        T.StructField("stage", T.StringType()),
        T.StructField("at", T.TimestampType()),
        T.StructField("seq", T.LongType()),
    ]
)


def best_run(runs: DataFrame, metric: str, highest: bool = True) -> DataFrame:
    """The run with the best value of the metric; runs without it come last, ties go by run id."""
    value = F.col("metrics")[metric]
    return runs.orderBy(value.desc_nulls_last() if highest else value.asc_nulls_last(), "run_id").limit(1)


def run_tree(runs: DataFrame) -> DataFrame:
    """Each run that has a parent, beside the name of the parent."""
    parents = runs.select(F.col("run_id").alias("parent_run_id"), F.col("name").alias("parent_name"))
    return runs.where(F.col("parent_run_id").isNotNull()).join(parents, "parent_run_id")


def current_stage(changes: DataFrame, order: Sequence[str] = ("at", "seq")) -> DataFrame:
    """The latest stage of each model version: one aggregation, combined before the shuffle."""
    return changes.groupBy("name", "version").agg(F.max_by("stage", F.struct(*order)).alias("stage"))


def signature(df: DataFrame) -> str:
    """The columns and types a model expects, as JSON."""
    return df.schema.json()


def check_signature(df: DataFrame, expected: str) -> None:
    """Raise if a column of the signature is absent or has another type."""
    have = dict(df.dtypes)
    wanted = T.StructType.fromJson(json.loads(expected))
    wrong = [f"{f.name} {f.dataType.simpleString()}" for f in wanted if have.get(f.name) != f.dataType.simpleString()]
    if wrong:
        raise ValueError(f"columns absent or of another type: {', '.join(wrong)}")


class Ledger:
    """Runs, versions and stages below a folder. As there is one writer at a time, it remembers the numbers it has given out."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self._readable: set[str] = set()
        self._highest: dict[str, int] | None = None
        self._seq: int | None = None

    def _path(self, name: str) -> str:
        return os.path.join(self.root, name)

    def _read(self, name: str, schema: T.StructType) -> DataFrame:
        if name not in self._readable:
            # An empty first file makes the folder readable before anything is logged.
            self.spark.createDataFrame([], schema).write.mode("ignore").parquet(self._path(name))
            self._readable.add(name)
        return self.spark.read.schema(schema).parquet(self._path(name))

    def _append(self, name: str, schema: T.StructType, row: Mapping) -> None:
        frame = self.spark.createDataFrame([tuple(row[f] for f in schema.fieldNames())], schema)
        frame.coalesce(1).write.mode("append").parquet(self._path(name))

    # -- runs -------------------------------------------------------------------------

    def log_run(
        self,
        name: str,
        params: Mapping[str, object] | None = None,
        metrics: Mapping[str, float] | None = None,
        tags: Mapping[str, str] | None = None,
        model_path: str | None = None,
        parent_run_id: str | None = None,
        inputs: DataFrame | None = None,
        run_id: str | None = None,
    ) -> str:
        """Append a run. ``inputs`` gives the signature and five example rows."""
        run_id = run_id or uuid.uuid4().hex
        example = None if inputs is None else json.dumps([r.asDict() for r in inputs.limit(5).collect()], default=str)
        self._append(
            "runs",
            RUNS,
            {
                "run_id": run_id,
                "parent_run_id": parent_run_id,
                "name": name,
                "logged_at": dt.datetime.now(),
                "params": {k: str(v) for k, v in (params or {}).items()},
                "metrics": {k: float(v) for k, v in (metrics or {}).items()},
                "tags": dict(tags or {}),
                "model_path": model_path,
                "signature": None if inputs is None else signature(inputs),
                "input_example": example,
            },
        )
        return run_id

    def log_model_run(
        self,
        model: PipelineModel,
        train: DataFrame,
        label: str,
        columns: Sequence[str],
        name: str,
        parent_run_id: str | None = None,
        tags: Mapping[str, str] | None = None,
        test: DataFrame | None = None,
    ) -> str:
        """Save a fitted model and log what can be logged by itself: parameters, metrics, signature.

        With held-out rows the metrics are those on them (``test_recall``); else on the training rows (``training_recall``).
        """
        run_id = uuid.uuid4().hex
        path = self._path(f"models/{run_id}")
        model.write().save(path)
        judged, part = (train, "training") if test is None else (test, "test")
        found = rows(binary_metrics(score(judged, model, "_p"), "_p", label))[0].asDict()
        params = {p.name: v for p, v in model.stages[-1].extractParamMap().items()}
        metrics = {f"{part}_{k}": v for k, v in found.items()}
        return self.log_run(name, params, metrics, tags, path, parent_run_id, train.select(*columns), run_id)

    def log_saved(self, save: Callable[[str], object], name: str, run_id: str | None = None, **run) -> str:
        """Append a run whose model ``save`` writes to the path it is given."""
        run_id = run_id or uuid.uuid4().hex
        path = self._path(f"models/{run_id}")
        save(path)
        return self.log_run(name, model_path=path, run_id=run_id, **run)

    def log_composite(self, combo: ComboModel, raw: DataFrame, name: str, metrics: Mapping[str, float] | None = None, **run) -> str:
        """Append a run with the whole way from raw readings to a prediction; the signature is that of the raw readings."""
        tags = {**run.pop("tags", {}), KIND: COMPOSITE}
        params = {"order": combo.order, "trip_grain": combo.trip_grain, **run.pop("params", {})}
        return self.log_saved(lambda path: combo.save(self.spark, path), name, metrics=metrics, params=params, tags=tags, inputs=raw, **run)

    def append_runs(self, runs: DataFrame) -> None:
        """Append many runs in one job; columns that ``runs`` lacks are null."""
        now = F.lit(dt.datetime.now())
        have = {c: F.col(c) for c in runs.columns} | ({} if "logged_at" in runs.columns else {"logged_at": now})
        runs.select(*[have.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in RUNS]).write.mode("append").parquet(self._path("runs"))

    def model_path(self, run_id: str) -> str:
        return rows(self.runs().where(F.col("run_id") == run_id).select("model_path"))[0]["model_path"]

    def runs(self) -> DataFrame:
        return self._read("runs", RUNS)

    def best(self, metric: str, highest: bool = True) -> str:
        return rows(best_run(self.runs(), metric, highest))[0]["run_id"]

    def model_map(self, parent_run_id: str, tag: str = "model_id", cap: int = 10_000) -> dict[str, str]:
        """Model path by tag value of all runs below a parent."""
        found = self.runs().where((F.col("parent_run_id") == parent_run_id) & F.col("tags")[tag].isNotNull())
        return {r["t"]: r["model_path"] for r in rows(found.select(F.col("tags")[tag].alias("t"), "model_path"), cap)}

    def log_table(self, run_id: str, name: str, df: DataFrame) -> str:
        """Keep a small table (importances, say) with a run."""
        path = self._path(f"tables/{run_id}/{name}")
        write_path(df.coalesce(1), path)
        return path

    def log_importances(self, run_id: str, model: PipelineModel, columns: Sequence[str]) -> str:
        return self.log_table(run_id, "importances", importances(self.spark, model, columns))

    # -- versions and stages ----------------------------------------------------------

    def versions(self) -> DataFrame:
        return self._read("versions", VERSIONS)

    def register(self, name: str, run_id: str) -> int:
        """A new version of the named model: one more than the highest so far."""
        if self._highest is None:
            self._highest = {r["name"]: r["v"] for r in rows(self.versions().groupBy("name").agg(F.max("version").alias("v")), 1_000_000)}
        version = self._highest[name] = self._highest.get(name, 0) + 1
        row = {"name": name, "version": version, "run_id": run_id, "registered_at": dt.datetime.now()}
        self._append("versions", VERSIONS, row)
        return version

    def set_stage(self, name: str, version: int, stage: str) -> None:
        if self._seq is None:
            self._seq = self._read("stages", STAGES).agg(F.max("seq")).first()[0] or 0
        self._seq += 1
        self._append("stages", STAGES, {"name": name, "version": version, "stage": stage, "at": dt.datetime.now(), "seq": self._seq})

    def stages(self) -> DataFrame:
        return current_stage(self._read("stages", STAGES), ["seq"])

    def in_stage(self, name: str, stage: str = "Production") -> Row:
        """Model path and signature of the highest version that is in the stage now."""
        here: Column = (F.col("name") == name) & (F.col("stage") == stage)
        found = (
            self.stages().where(here)
            .join(self.versions(), ["name", "version"])
            .join(self.runs(), "run_id")
            .orderBy(F.col("version").desc())
            .select("model_path", "signature", "tags")
            .limit(1)
        )
        row = rows(found)
        if not row:
            raise LookupError(f"no version of {name} in stage {stage}")
        return row[0]

    def resolve(self, name: str, stage: str = "Production") -> str:
        return self.in_stage(name, stage)["model_path"]

    def load(self, name: str, stage: str = "Production") -> PipelineModel | ComboModel:
        return self._load(self.in_stage(name, stage))

    def _load(self, row: Row) -> PipelineModel | ComboModel:
        if (row["tags"] or {}).get(KIND) == COMPOSITE:
            return ComboModel.load(self.spark, row["model_path"])
        return PipelineModel.load(row["model_path"])

    def score(self, df: DataFrame, name: str, stage: str = "Production", out: str = "predictions") -> DataFrame:
        """Predictions by the model in the stage; refuses a frame that does not have the columns of its signature.

        A composite takes raw readings and gives its features beside the prediction.
        """
        row = self.in_stage(name, stage)
        if row["signature"]:
            check_signature(df, row["signature"])
        model = self._load(row)
        if isinstance(model, ComboModel):
            return model.transform(df).withColumnRenamed("prediction", out)
        return score(df, model, out)
