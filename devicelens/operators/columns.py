"""Column-wise operators: selection, casts, alignment, one-hot encoding, stacking."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

import pandas as pd
from pyspark.ml.feature import CountVectorizerModel, VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from devicelens.session import cut

MAX_CATEGORIES = 1000


def columns_like(df: DataFrame, part: str) -> list[str]:
    """Names that contain the given text."""
    return [c for c in df.columns if part in c]


def with_constant(df: DataFrame, name: str, value) -> DataFrame:
    return df.withColumn(name, F.lit(value))


def cast_columns(df: DataFrame, types: Mapping[str, str], strict: bool = True) -> DataFrame:
    """Cast columns; values that do not fit raise an error, or become null when not strict."""
    return df.withColumns({c: F.col(c).cast(t) if strict else F.col(c).try_cast(t) for c, t in types.items()})


def drop_nulls(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.dropna(subset=list(columns) if columns else None)


def hstack(df: DataFrame, blocks: Mapping[str, Column]) -> DataFrame:
    """Put further columns beside the present ones; no join, as the rows are the same."""
    return df.select("*", *[c.alias(n) for n, c in blocks.items()])


def stack_frames(frames: Sequence[DataFrame]) -> DataFrame:
    """Put frames below each other by column name; absent columns are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def align_columns(df: DataFrame, expected: Sequence[str], fill: float = 0.0) -> DataFrame:
    """Exactly the expected columns in their order; absent ones hold the fill value."""
    return df.select(*[F.col(c) if c in df.columns else F.lit(fill).alias(c) for c in expected])


def fit_vocab(df: DataFrame, columns: Sequence[str], max_categories: int = MAX_CATEGORIES) -> dict[str, list[str]]:
    """Sorted distinct values per column; refuses columns with too many. Fit it on training rows and keep it."""
    columns = list(columns)
    pairs = F.array(*[F.struct(F.lit(i).alias("i"), F.col(c).cast("string").alias("v")) for i, c in enumerate(columns)])
    values = df.select(F.inline(pairs)).where("v is not null").distinct()
    found = values.limit((max_categories + 1) * len(columns)).collect()  # one scan; more rows than this: some column has too many
    vocab = {c: sorted(r.v for r in found if r.i == i) for i, c in enumerate(columns)}
    for column, known in vocab.items():
        if len(known) > max_categories:
            raise ValueError(f"{column} has more than {max_categories} values: not a categorical column")
    return vocab


def one_hot(df: DataFrame, vocab: Mapping[str, Sequence[str]], prefix: str = "ohe_") -> DataFrame:
    """One double column per known value and no source column; unseen or null values give zeros."""
    encoded = {
        prefix + v: F.coalesce((F.col(c) == v).cast("double"), F.lit(0.0)) for c, values in vocab.items() for v in values
    }
    return hstack(df, encoded).drop(*vocab)


#: Parts in which the values of a column are ranked before the best of all parts meet.
RANKED_IN = 256


def fit_top_vocab(df: DataFrame, columns: Sequence[str], n: int, slack: int | None = None) -> dict[str, list[str]]:
    """The ``n`` most frequent values of each column (as text; ties: the smaller value first), however many values there are.

    All values are counted, each task's own before the shuffle, and ranked in parts, so that no task gets all values of a column.
    With ``slack`` only likely values are counted: a summary of bounded size per task (heavy hitters by Misra and Gries, merged) leaves
    out those that stand in less than one of ``slack * n`` rows. A value above that share is never missed, a rarer one may be.
    """
    columns = list(columns)
    pairs = F.array(*[F.struct(F.lit(i).alias("i"), F.col(c).cast("string").alias("v")) for i, c in enumerate(columns)])
    values = df.select(F.inline(pairs)).where("v is not null")
    if slack is not None:
        values = values.join(F.broadcast(_likely(values, slack * n)), ["i", "v"])
    best = values.groupBy("i", "v").count().withColumn("p", F.pmod(F.xxhash64("v"), F.lit(RANKED_IN)))
    for part in (["i", "p"], ["i"]):
        in_order = Window.partitionBy(*part).orderBy(F.col("count").desc(), "v")
        best = best.withColumn("r", F.row_number().over(in_order)).where(F.col("r") <= n)
    found = best.orderBy("i", "r").collect()  # n rows per column
    return {c: [r.v for r in found if r.i == i] for i, c in enumerate(columns)}


def _likely(values: DataFrame, room: int) -> DataFrame:
    """Of each column up to ``room`` values, among them all that stand in one of ``room`` rows or more."""

    def summaries(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.Series] = []
        size = 0
        for pdf in frames:
            held.append(pdf.groupby(["i", "v"])["n"].sum() if "n" in pdf else pdf.value_counts(["i", "v"]))
            size += len(held[-1])
            if size > 2 * room:  # merging seldom keeps the work linear in the rows
                held = [heavy(pd.concat(held).groupby(level=[0, 1]).sum())]
                size = 0
        if held:
            found = heavy(pd.concat(held).groupby(level=[0, 1]).sum())
            yield found.rename("n").rename_axis(["i", "v"]).reset_index().astype({"n": "int64"})

    def heavy(counts: pd.Series) -> pd.Series:
        """Of each column the largest ``room`` counts, less the largest one that goes."""
        kept = []
        for _, part in counts.groupby(level=0):
            if len(part) > room:
                part = part.sort_values(ascending=False, kind="stable")
                part = part.iloc[:room] - part.iloc[room]
            kept.append(part[part > 0])
        return pd.concat(kept)

    schema = "i int, v string, n long"
    # The summaries of all tasks merge on all cores, then in one task: rows are bounded by tasks and cores, not by values.
    cores = max(1, values.sparkSession.sparkContext.defaultParallelism)
    found = values.mapInPandas(summaries, schema).repartition(cores).mapInPandas(summaries, schema)
    return cut(found.coalesce(1).mapInPandas(summaries, schema).select("i", "v"))


def sparse_one_hot(df: DataFrame, vocab: Mapping[str, Sequence[str]], out: str = "ohe") -> tuple[DataFrame, list[str]]:
    """A sparse vector with one place per known value, and one per column for all others; and the names of its places.

    Nulls have no place. The source columns stay; the vector takes the room of the values a row has, not of the vocabulary.
    """
    names = [f"{c}={v}" for c, values in vocab.items() for v in values] + [f"{c}≠" for c in vocab]
    tokens = []
    for c, values in vocab.items():
        value = F.col(c).cast("string")
        tokens.append(F.when(value.isin(list(values)), F.concat(F.lit(f"{c}="), value)).when(value.isNotNull(), F.lit(f"{c}≠")))
    model = CountVectorizerModel.from_vocabulary(names, inputCol="_tokens", outputCol=out)
    return model.transform(df.withColumn("_tokens", F.array_compact(F.array(*tokens)))).drop("_tokens"), names


def with_params(df: DataFrame, grid: Sequence[Mapping[str, float]]) -> DataFrame:
    """Each row once per parameter set. The grid is a literal array: no join, no shuffle."""
    if len(grid) > MAX_CATEGORIES:
        raise ValueError(f"more than {MAX_CATEGORIES} parameter sets")
    sets = F.array(*[F.struct(*[F.lit(v).alias(k) for k, v in point.items()]) for point in grid])
    return df.select("*", F.inline(sets))


def features_label(df: DataFrame, label: str, features: Sequence[str], keep: Sequence[str] = (), out: str = "features") -> DataFrame:
    """Key columns, a feature vector and the label as double. Rows with null features raise an error when fitted."""
    assembled = VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="error").transform(df)
    return assembled.select(*keep, out, F.col(label).cast("double").alias(label))
