"""The feature table of a stream of raw readings: the state of each device goes from micro-batch to micro-batch.

What the batch way gets from windows over a whole series, a stream gets from a few numbers per device: the trip it is in,
the last rotation speeds, the decayed sums of both smoothed columns, and the last values that fill gaps. The state is the
query's own, kept in its checkpoint, so a restarted query goes on as if it had never stopped. A call from Spark costs
milliseconds, so devices share a fixed number of groups: there are no more calls per micro-batch, however many devices report.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout

from devicelens.plans.features import DENSITY_SPAN, TEMPERATURE_COM

#: Readings that rotation speed is behind pressure in the airflow.
LAG = 5
#: Groups of devices. It must stay the same as long as a checkpoint is used.
GROUPS = 2_048
FILLED = ("airflow_rate", "rotation_speed", "air_pressure", "temperature", "delay", "density", "rolling_mean_temp", "temp_difference")


class DeviceState:
    """What must be known of a device's earlier readings; missing numbers are NaN."""

    def __init__(self, trip: int = -(1 << 62), trip_id: int = 0, rotation: Sequence[float] = (), sums: Sequence[float] = (0.0,) * 4, last: Sequence[float] = (float("nan"),) * len(FILLED)):
        self.trip, self.trip_id = trip, trip_id
        self.rotation, self.sums, self.last = list(rotation), list(sums), list(last)

    #: Numbers of a device beside its trip: how many rotation speeds, these, the sums, and the last values.
    WIDTH = 1 + LAG + 4 + len(FILLED)

    def numbers(self) -> list[float]:
        return [float(len(self.rotation)), *self.rotation, *[0.0] * (LAG - len(self.rotation)), *self.sums, *self.last]

    @classmethod
    def restored(cls, trip: int, trip_id: int, numbers: Sequence[float]) -> DeviceState:
        return cls(trip, trip_id, numbers[1 : 1 + int(numbers[0])], numbers[1 + LAG : 5 + LAG], numbers[5 + LAG :])

    def step(self, trip: int, rotation: float, pressure: float, temperature: float, delay: float, density: float) -> tuple:
        """Take one reading; its trip number, the filled columns, and the smoothed density."""
        if trip != self.trip:
            self.trip, self.trip_id = trip, self.trip_id + 1
            self.rotation, self.last = [], [float("nan")] * len(FILLED)
            self.sums[:2] = [0.0, 0.0]
        # Means look at earlier readings only; a missing reading lets both sums decay alike, which repeats the mean.
        n, d, dense_n, dense_d = self.sums
        mean = n / d if d else float("nan")
        dense = dense_n / dense_d if dense_d else 0.0
        airflow = self.rotation[0] / pressure if len(self.rotation) == LAG and pressure else float("nan")
        now = (airflow, rotation, pressure, temperature, delay, density, mean, mean - temperature)
        self.last = [x if x == x else before for x, before in zip(now, self.last)]
        filled = [x if x == x else 0.0 for x in self.last]
        self.rotation = [*self.rotation[-(LAG - 1) :], rotation]
        keep, slow = 1 - 1 / (1 + TEMPERATURE_COM), 1 - 2 / (DENSITY_SPAN + 1)
        known = temperature == temperature
        self.sums[:2] = [n * keep + (temperature if known else 0.0), d * keep + known]
        # The density is smoothed after its gaps are filled.
        self.sums[2:] = [dense_n * slow + filled[5], dense_d * slow + 1.0]
        return self.trip_id, *filled, dense


def stream_features(readings: DataFrame, key: str = "device_id", order_by: Sequence[str] = ("ts", "event_id"), grain: str = "week", keep: Sequence[str] = ("factory_id", "model_id", "defect")) -> DataFrame:
    """The columns of the batch feature table (before one-hot columns) for a stream of raw readings.

    Readings of a device must come in their order: those of a micro-batch are sorted, later micro-batches hold later
    readings. Devices share ``GROUPS`` groups by a hash. Memory per task is a micro-batch's rows of one group and the states of its devices.
    """
    columns = ["_group", key, *order_by, "_trip", "rotation_speed", "air_pressure", "temperature", "delay", "density", *keep]
    numbers = ["rotation_speed", "air_pressure", "temperature", "delay", "density"]
    doubles = [F.col(c).cast("double").alias(c) for c in numbers]
    day = F.unix_micros(F.date_trunc(grain, order_by[0]).cast("timestamp"))
    group = F.pmod(F.xxhash64(key), F.lit(GROUPS)).cast("int").alias("_group")
    rows = readings.select(group, key, *order_by, day.alias("_trip"), *doubles, *keep).select(*columns)
    fields = [rows.schema[c] for c in [key, *order_by, *keep]]
    made = [T.StructField(c, T.DoubleType()) for c in (*FILLED, "rolling_mean_density")]
    schema = T.StructType([*fields, T.StructField("trip_id", T.IntegerType()), *made])

    kept = T.StructType(
        [
            T.StructField("devices", T.ArrayType(rows.schema[key].dataType)),
            T.StructField("trips", T.ArrayType(T.LongType())),
            T.StructField("trip_ids", T.ArrayType(T.IntegerType())),
            T.StructField("numbers", T.ArrayType(T.DoubleType())),
        ]
    )
    width = DeviceState.WIDTH

    def run(_key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        devices: dict = {}
        if state.exists:
            names, trips, trip_ids, flat = state.get
            for i, (name, trip, trip_id) in enumerate(zip(names, trips, trip_ids)):
                devices[name] = DeviceState.restored(trip, trip_id, flat[i * width : (i + 1) * width])
        batch = pd.concat(list(frames), ignore_index=True).sort_values(list(order_by), ignore_index=True)
        # Plain numbers, and None for no device: the state goes back to Spark.
        names = batch[key].astype(object).where(batch[key].notna(), None).tolist()
        values = [batch[c].to_numpy(dtype=float).tolist() for c in numbers]
        found = []
        for name, trip, row in zip(names, batch["_trip"].tolist(), zip(*values)):
            device = devices.get(name)
            if device is None:
                device = devices[name] = DeviceState()
            found.append(device.step(trip, *row))
        state.update((list(devices), [d.trip for d in devices.values()], [d.trip_id for d in devices.values()], [x for d in devices.values() for x in d.numbers()]))
        made = dict(zip((*FILLED, "rolling_mean_density"), np.array([f[1:] for f in found]).T))
        out = pd.DataFrame({**{c: batch[c] for c in (key, *order_by, *keep)}, "trip_id": np.array([f[0] for f in found], np.int32), **made})
        yield out[schema.names]

    return rows.groupBy("_group").applyInPandasWithState(run, schema, kept, "append", GroupStateTimeout.NoTimeout)


def write_features(stream: DataFrame, sink: str, checkpoint: str, name: str | None = None, finish: Callable[[DataFrame], DataFrame] = lambda df: df):
    """Start a query that appends the features of all available readings to a Parquet folder, once per reading."""
    from devicelens.streaming.score import score_stream

    return score_stream(stream_features(stream), finish, sink, checkpoint, name=name)
