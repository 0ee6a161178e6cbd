"""Hard negatives: for each anchor and each of its positives, the best rows of other labels within a window of scores.

Rows are whole numbers, so scores are exact. They lie in blocks, sorted by label, and anchors in tiles. A tile meets a block
by a threshold join in the manner of L2AP: the block's inverted index lists its rows by axis, the heaviest axes first, and leaves
out of each row the axes behind the point where the norm of what follows can no longer reach the lowest threshold; partial
scores are summed axis by axis, and rows are dropped as soon as their sum and the norms that remain stay below it. Thresholds start where
a few rows are expected in each window, and are lowered for the windows that do not fill, down to their lower ends.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from devicelens.llm.support import small_batches
from devicelens.session import cut

#: Rows of a block, anchors of a tile, blocks that travel together, axes added per step.
BLOCK, TILE, GROUP, STEP = 2_048, 512, 8, 8
#: Rows expected above the first threshold, as a multiple of what a window asks for; and by how much more each further round expects.
FIRST, MORE = 4, 16
#: Beyond all scores: squared norms stay below 2**62.
FAR = 1 << 62


def whole_vector(vector: Column, scale: int) -> Column:
    """``floor(scale * x)`` of every component; null if the vector is null, holds null or non-finite components, or its square reaches 2**62."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < 2.0**62 / scale))
    numbers = F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))
    square = F.aggregate(numbers, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    return F.when(vector.isNotNull() & F.coalesce(good, F.lit(False)), F.when(square < 2.0**62, numbers))


# --- inside a task --------------------------------------------------------------------------------------------------------


def rest_norms(x: np.ndarray) -> np.ndarray:
    """Norms of what follows each axis, from the whole vector down to nothing; a little too large rather than too small."""
    square = np.cumsum(np.square(x[:, ::-1], dtype=np.float64), axis=1)[:, ::-1]
    return np.concatenate([np.sqrt(square) * (1 + 1e-9), np.zeros((len(x), 1))], axis=1)


def scores_from(anchors: np.ndarray, least: np.ndarray, rows: np.ndarray, step: int = STEP, worked: list | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places (anchor, row) and inner product of all pairs with at least the anchor's threshold.

    ``worked`` takes the number of products that were added, for tests.
    """
    none = np.zeros(0, np.int64)
    if not len(anchors) or not len(rows) or not anchors.shape[1]:
        a, r = np.nonzero((least <= 0)[:, None] & np.ones(len(rows), bool))
        return a, r, np.zeros(len(a), np.int64)
    heavy = np.argsort(-np.square(rows, dtype=np.float64).sum(0), kind="stable")
    anchors, rows = anchors[:, heavy], rows[:, heavy]
    d = rows.shape[1]
    rest_a, rest_r = rest_norms(anchors), rest_norms(rows)
    # Sums of at most 2**53 are exact in double precision.
    kind = np.float64 if rest_a[:, 0].max() * rest_r[:, 0].max() < 2**53 else np.int64
    x, y = anchors.astype(kind), rows.astype(kind)
    # Axes of a row that the index holds: those before the point where the rest is below every threshold.
    open_ends = (rest_r * rest_a.max(0) >= max(0, int(least.min()))) if least.min() > 0 else np.ones((len(rows), d + 1), bool)
    open_ends[:, d] = False
    held = np.where(open_ends.any(1), d + 1 - np.argmax(open_ends[:, ::-1], axis=1), 0)
    held = np.minimum(-(-held // step) * step, d)
    order = np.argsort(-held, kind="stable")
    order = order[held[order] > 0]
    place, held = order, held[order]
    who, total = np.arange(len(anchors)), np.zeros((len(anchors), len(place)), kind)
    limit = least.astype(np.float64) if kind is np.float64 else least
    for k in range(0, d, step):
        posted = int(np.searchsorted(-held, -k))  # rows with more than k axes in the index come first
        if not posted:
            break
        total[:, :posted] += x[who, k : k + step] @ y[place[:posted], k : k + step].T
        if worked is not None:
            worked.append(len(who) * posted * min(step, d - k))
        end = np.minimum(held, min(k + step, d))
        reach = total + rest_a[who][:, end] * rest_r[place, end]
        may = reach >= limit[who][:, None]
        keep_a, keep_r = may.any(1), may.any(0)
        if not keep_a.any():
            return none, none, none
        if keep_a.mean() * keep_r.mean() < 0.8:
            total = total[np.ix_(keep_a, keep_r)]
            who, place, held = who[keep_a], place[keep_r], held[keep_r]
    reach = total + rest_a[who][:, held] * rest_r[place, held]
    a, r = np.nonzero(reach >= limit[who][:, None])
    score, left = total[a, r].astype(np.int64), held[r] < d
    # What the index leaves out is added for the pairs that are still in question.
    for at in range(0, len(a), 1 << 17):
        part = np.arange(at, min(at + (1 << 17), len(a)))
        part = part[left[part]]
        for end in np.unique(held[r[part]]):
            mine = part[held[r[part]] == end]
            score[mine] += np.einsum("ij,ij->i", anchors[who[a[mine]], end:].astype(np.int64), rows[place[r[mine]], end:].astype(np.int64))
    good = score >= least[who[a]]
    return who[a[good]], place[r[good]], score[good]


def best_of(anchor: np.ndarray, score: np.ndarray, ident: np.ndarray, k: int) -> np.ndarray:
    """Places of the first k of each anchor, by falling score, then by id."""
    order = np.lexsort((ident, -score, anchor))
    sorted_ = anchor[order]
    first = np.concatenate([[True], sorted_[1:] != sorted_[:-1]]) if len(order) else np.zeros(0, bool)
    start = np.maximum.accumulate(np.where(first, np.arange(len(order)), 0)) if len(order) else np.zeros(0, int)
    return order[np.arange(len(order)) - start < k]


def _numbers(x: np.ndarray) -> tuple[str, bytes]:
    """Whole numbers in the narrowest type that holds them."""
    most = int(np.abs(x).max()) if x.size else 0
    kind = "<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<i8"
    return kind, x.astype(kind).tobytes()


def _array(row: dict, prefix: str = "") -> np.ndarray:
    return np.frombuffer(row[prefix + "data"], row[prefix + "kind"]).reshape(row[prefix + "n"], row["d"])


_PACKED = "d int, {p}n int, {p}ids binary, {p}labels array<string>, {p}label_of binary, {p}kind string, {p}data binary, {p}norm double"


def _packed(p: str, size: int, more: str, extra):
    """A function that packs the sorted rows (d, label, id, vector, …) of a partition, so many at a time, all of one dimension."""
    schema = to_arrow_schema(_schema(f"place long, {_PACKED.format(p=p)}{more}"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        made, held, count = TaskContext.get().partitionId() << 32, [], 0

        def flush() -> pa.RecordBatch:
            nonlocal made, held, count
            rows = pa.Table.from_batches(held)
            d = rows.column(0)[0].as_py()
            x = np.array(pc.list_flatten(rows.column(3)), np.int64).reshape(rows.num_rows, d)
            labels = rows.column(1).combine_chunks().dictionary_encode()
            kind, data = _numbers(x)
            row = {"place": made, "d": d, p + "n": rows.num_rows, p + "ids": np.array(rows.column(2), np.int64).tobytes(), p + "labels": labels.dictionary.to_pylist()}
            row |= {p + "label_of": np.array(labels.indices, np.int32).tobytes(), p + "kind": kind, p + "data": data, p + "norm": float(np.sqrt(np.square(x, dtype=np.float64).sum(1).max()))}
            made, held, count = made + 1, [], 0
            return pa.RecordBatch.from_pylist([row | extra(rows)], schema=schema)

        for batch in batches:
            at, dims = 0, np.array(batch.column(0))
            while at < len(dims):
                if held and held[0].column(0)[0].as_py() != dims[at]:
                    yield flush()
                other = np.nonzero(dims[at:] != dims[at])[0]
                take = min(size - count, int(other[0]) if len(other) else len(dims) - at)
                held.append(batch.slice(at, take))
                count, at = count + take, at + take
                if count == size:
                    yield flush()
        if held:
            yield flush()

    return pack


def _schema(ddl: str):
    from pyspark.sql.types import StructType

    return StructType.fromDDL(ddl)


def _ordered(rows: DataFrame, size: int) -> DataFrame:
    """Rows in ranges of dimension, label and id, some eight packs of them in each."""
    parts = max(1, -(-rows.count() // (size * GROUP)))
    return rows.repartitionByRange(parts, "d", "label", "id").sortWithinPartitions("d", "label", "id")


# --- over all rows ----------------------------------------------------------------------------------------------------------


def pack_blocks(rows: DataFrame, size: int = BLOCK) -> DataFrame:
    """Blocks of the rows (d, label, id, vector), and the group that each travels in."""
    pack = _packed("", size, "", lambda rows: {})
    blocks = _ordered(rows.select("d", "label", "id", "vector"), size).mapInArrow(pack, f"place long, {_PACKED.format(p='')}")
    return cut(blocks.withColumn("group", F.floor(F.col("place") / GROUP).cast("long")))


def _tail(x: Column) -> Column:
    """About the share of a normal distribution above x: 0.5 exp(-0.717 x - 0.416 x²), for either sign."""
    a = F.abs(x)
    upper = 0.5 * F.exp(-0.717 * a - 0.416 * a * a)
    return F.when(x >= 0, upper).otherwise(1 - upper)


def _above(share: Column) -> Column:
    """The x that leaves so much above it, by the inverse of :func:`_tail`."""
    upper = F.least(share, 1 - share)
    x = (-0.717 + F.sqrt(0.717**2 - 4 * 0.416 * F.log(2 * F.greatest(upper, F.lit(1e-300))))) / (2 * 0.416)
    return F.when(share <= 0.5, x).otherwise(-x)


def _start(window: Column, spread: Column, among: Column, want: float) -> Column:
    """The threshold above which so many rows of the window are expected; its lower end where most rows are."""
    high = F.least(window["high"].cast("double") / F.greatest(spread, F.lit(1.0)), F.lit(30.0))
    share = _tail(high) + want / F.greatest(among, F.lit(1))
    guess = F.floor(_above(F.least(share, F.lit(0.9))) * F.least(spread, F.lit(2.0**60))).cast("long")
    return F.when(share >= 0.9, window["low"]).otherwise(F.greatest(window["low"], guess))


def fill(requests: DataFrame, blocks: DataFrame, k: int, same_label: bool, tile: int = TILE) -> DataFrame:
    """``anchor, w, rank, id, score``: the first k rows of every window of every request.

    A request has ``d, label, id, vector``, the ``spread`` of its scores, among how many rows they are (``among``), and ``windows`` (w, low,
    high; whole numbers, both ends included). With ``same_label`` rows of the anchor's label are searched, but for those of
    its own id, else rows of all others. Each round is a threshold join; a window is done if k rows were found at or above its
    threshold, or if that is its lower end.
    """
    spark = requests.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    want, done, open_ = FIRST * k, [], requests

    def windows_of(rows: pa.Table) -> dict:
        w = rows.column(4).combine_chunks()
        flat = pc.list_flatten(w)
        made = {n: np.array(flat.field(n), np.int64) for n in ("w", "t", "high")}
        return {"of": np.array(pc.list_parent_indices(w), np.int32).tobytes(), "floor": int(made["t"].min())} | {n: x.tobytes() for n, x in made.items()}

    more = ", of binary, w binary, t binary, high binary, floor long"
    pack = _packed("a_", tile, more, windows_of)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                anchors, rows = _array(row, "a_"), _array(row)
                anchor_ids, ids = np.frombuffer(row["a_ids"], np.int64), np.frombuffer(row["ids"], np.int64)
                of = np.frombuffer(row["of"], np.int32)
                w, t, high = (np.frombuffer(row[n], np.int64) for n in ("w", "t", "high"))
                least = np.full(len(anchors), FAR, np.int64)
                np.minimum.at(least, of, t)
                names = {label: n for n, label in enumerate(row["labels"])}
                label_of, anchor_label = np.frombuffer(row["label_of"], np.int32), np.frombuffer(row["a_label_of"], np.int32)
                anchor_label = np.array([names.get(label, -1) for label in row["a_labels"]], np.int32)[anchor_label]
                if same_label:
                    pieces = []
                    for label in np.unique(anchor_label[anchor_label >= 0]):
                        mine, its = np.nonzero(anchor_label == label)[0], np.nonzero(label_of == label)[0]
                        a, r, s = scores_from(anchors[mine], least[mine], rows[its])
                        pieces.append((mine[a], its[r], s))
                    a, r, s = (np.concatenate(x) for x in zip(*pieces)) if pieces else (np.zeros(0, np.int64),) * 3
                    good = anchor_ids[a] != ids[r]
                else:
                    a, r, s = scores_from(anchors, least, rows)
                    good = anchor_label[a] != label_of[r]
                a, r, s = a[good], r[good], s[good]
                for number in np.unique(w):
                    low, top = np.full(len(anchors), FAR, np.int64), np.full(len(anchors), -FAR, np.int64)
                    here = w == number
                    low[of[here]], top[of[here]] = t[here], high[here]
                    inside = np.nonzero((s >= low[a]) & (s <= top[a]))[0]
                    inside = inside[best_of(a[inside], s[inside], ids[r[inside]], k)]
                    if len(inside):
                        yield pa.RecordBatch.from_arrays([pa.array(anchor_ids[a[inside]]), pa.array(np.full(len(inside), number, np.int32)), pa.array(ids[r[inside]]), pa.array(s[inside])], ["anchor", "w", "id", "score"])

    narrow = blocks.select("d", "group", "labels").distinct() if same_label else blocks.select("d", "group").distinct()
    while True:
        started = F.transform("windows", lambda x: F.struct(x["w"].alias("w"), x["low"].alias("low"), x["high"].alias("high"), _start(x, F.col("spread"), F.col("among"), want).alias("t")))
        open_ = cut(open_.withColumn("windows", started))
        tiles = _ordered(open_.select("d", "label", "id", "vector", "windows"), tile).mapInArrow(pack, f"place long, {_PACKED.format(p='a_')}{more}")
        tiles = cut(tiles.withColumnRenamed("place", "tile"))
        if same_label:
            asked = tiles.select("d", "tile", F.explode("a_labels").alias("label"))
            visits = asked.join(narrow.select("d", "group", F.explode("labels").alias("label")).distinct(), ["d", "label"]).select("tile", "group").distinct()
        else:
            # Every tile meets every group of blocks: the stated anchors against all rows, in blocks.
            asked = tiles.select("d", "tile", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))
            visits = asked.join(narrow.withColumn("part", F.pmod(F.xxhash64("group"), F.lit(parts)).cast("int")), ["d", "part"]).select("tile", "group")
        near = (F.col("d") == F.col("a_d")) & (F.col("norm") * F.col("a_norm") * (1 + 1e-9) >= F.col("floor"))
        if same_label:
            near = near & F.arrays_overlap("labels", "a_labels")
        met = visits.join(tiles.withColumnRenamed("d", "a_d"), "tile").join(blocks.drop("place"), "group").where(near)
        columns = ["d", *[f.split()[0] for f in _PACKED.format(p="").split(", ")[1:-1]], *[f.split()[0] for f in _PACKED.format(p="a_").split(", ")[1:-1]], "of", "w", "t", "high"]
        hits = met.select(*columns).mapInArrow(probe, "anchor long, w int, id long, score long")
        best = W.partitionBy("anchor", "w").orderBy(F.col("score").desc(), "id")
        with small_batches(spark):
            ranked = cut(hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k))
        found = ranked.groupBy(F.col("anchor").alias("id"), "w").count()
        asked = open_.select("id", F.explode("windows").alias("x")).select("id", "x.w", "x.low", "x.high", "x.t")
        short = asked.join(found, ["id", "w"], "left").where((F.coalesce("count", F.lit(0)) < k) & (F.col("t") > F.col("low")))
        again = cut(short.groupBy("id").agg(F.collect_list(F.struct("w", "low", "high")).alias("windows")))
        if again.isEmpty():
            done.append(ranked)
            break
        unfilled = again.select(F.col("id").alias("anchor"), F.explode("windows.w").alias("w"))
        done.append(ranked.join(unfilled, ["anchor", "w"], "left_anti"))
        open_ = open_.drop("windows").join(again, "id")
        want *= MORE
    result = done[0]
    for more in done[1:]:
        result = result.unionByName(more)
    return result.select("anchor", "w", "rank", "id", "score")


def hard_negatives(
    rows: DataFrame, anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, scale: int = 256,
    id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label", block: int = BLOCK, tile: int = TILE,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for every row for which ``anchor`` holds.

    Components become ``floor(scale * x)``; a score is the integer inner product. An anchor's positives are the first rows of its label, its
    own id aside, by falling score, then id; their negatives the first rows of other labels whose score is between ``low`` and
    ``high`` hundredths of the positive's. Fewer rows give all of them, so an anchor without positives or a positive
    without negatives has no rows. Rows with a null id, label or vector or a null or non-finite component take no part, nor do those
    whose squared norm reaches 2**62, as scores would not fit a long. Vectors of unlike length are not compared. Of rows
    with one id that of the smallest label, then vector, counts. ``anchor`` is a condition on the columns of ``rows``; others are not
    read. An empty table gives no rows.
    """
    base = rows.select(
        F.col(id_column).cast("long").alias("id"), F.col(label_column).cast("string").alias("label"), whole_vector(F.col(vector_column).cast("array<double>"), scale).alias("vector"),
        F.coalesce(anchor, F.lit(False)).alias("asked"),
    ).where("id is not null and label is not null and vector is not null")
    base = base.groupBy("id").agg(F.min(F.struct("label", "vector", "asked")).alias("r")).select("id", "r.label", "r.vector", "r.asked")
    base = cut(base.withColumn("d", F.size("vector")))
    blocks = pack_blocks(base, block)
    square = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    spread = base.groupBy("d").agg(F.avg(square).alias("square"), F.count("*").alias("rows"))
    peers = base.groupBy("d", "label").agg(F.count("*").alias("peers"))
    asked = base.where("asked").join(peers, ["d", "label"]).join(spread, "d")
    asked = asked.withColumn("spread", F.sqrt(square * F.col("square") / F.greatest("d", F.lit(1))))
    window = lambda w, a, b: F.struct(F.lit(w).alias("w"), a.cast("long").alias("low"), b.cast("long").alias("high"))
    asked = cut(asked.select("d", "label", "id", "vector", "spread", "peers", "rows"))
    first = fill(asked.withColumn("among", F.col("peers")).withColumn("windows", F.array(window(0, F.lit(-FAR), F.lit(FAR)))), blocks, positives, True, tile)
    first = cut(first.select("anchor", F.col("rank").alias("w"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")))
    # Ends of the window without numbers that could overflow: hundredths of the quotient and of the remainder by 100.
    score = F.col("positive_score")
    lower = F.expr("positive_score div 100") * low + F.expr(f"((positive_score % 100) * {low} + 99) div 100")
    upper = F.expr("positive_score div 100") * high + F.expr(f"((positive_score % 100) * {high}) div 100")
    wanted = first.where(score >= 0).select(F.col("anchor").alias("id"), F.struct("w", lower.alias("low"), upper.alias("high")).alias("x")).where("x.low <= x.high")
    wanted = wanted.groupBy("id").agg(F.sort_array(F.collect_list("x")).alias("windows"))
    requests = asked.join(wanted, "id").withColumn("among", F.col("rows"))
    last = fill(requests, blocks, negatives, False, tile)
    both = last.select("anchor", "w", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score")).join(first, ["anchor", "w"])
    return both.select(F.col("anchor").alias("anchor_id"), "positive_id", "rank", "negative_id", "positive_score", "negative_score")
