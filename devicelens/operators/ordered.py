"""Ordered per-key operators that stay parallel when one key holds most of the rows.

A plain ``Window.partitionBy(key)`` puts every row of a key in one task. Here the
rows of a busy key are first cut into *blocks*: ranges of the sort order with about
``rows_per_block`` rows each. Windows then run per (key, block), and what a block
must know of its predecessors (a count, the last values, a decayed sum) comes from a
carry table with one row per block.

* Cut points come from a hash sample of (key, order columns): one narrow scan, no
  shuffle of the data. They cover the full sort tuple, so equal timestamps split too.
* Every row finds its block by binary search in its key's sorted cut points, in short
  pieces that are joined to the rows: by broadcast as long as they are small, else by one shuffle.
* Keys below ``rows_per_block`` have no cut points. If there are none at all, every
  operator below is an ordinary window over the key, with no carry and no join.
* On a frame with blocks operators wait until the rows are asked for, and then run in *waves*: all that do not read each
  other's results compute what their blocks know by themselves in one pass, which is stored; one aggregation sums up the state of
  all of them per block; the states are folded; and one join brings each block what came before. So a chain costs
  a few jobs per wave, however many operators it has.

The block of a row depends on its values only, never on its partition, so retried
tasks and repeated branches agree.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from devicelens.operators.lookup import lookup, null_safe
from devicelens.session import cut, stored

__all__ = ["OrderedFrame", "nth_difference", "null_safe", "ordered"]

ROWS_PER_BLOCK = 2_000_000
SAMPLE_PER_BLOCK = 32
FAN = 512
#: Blocks of a key whose states one task folds; beyond it chunks of so many are folded first, then the chunks.
FOLD = 1_024

BLOCK = "_block"
HOT = "_hot"
ALL = "_all"


def count_at_or_below(df: DataFrame, cuts: str, probe: Column, longest: int, out: str) -> DataFrame:
    """Add the number of entries of a sorted array column that are <= probe; 0 where there is no array.

    A binary search in jumps of falling powers of two, unrolled into plain expressions: they
    compile with the rest of the stage, a lambda over the array would not.
    """
    df = df.withColumn(out, F.lit(0))
    for power in reversed(range(longest.bit_length())):
        jump = 2**power
        further = F.get(F.col(cuts), F.col(out) + (jump - 1)) <= probe
        df = df.withColumn(out, F.col(out) + F.when(further, jump).otherwise(0))
    return df


def _cut_points(df, keys, order_by, rows_per_block) -> tuple[DataFrame, int]:
    """Cut tuples of the busy keys, numbered 1, 2, … per key as ``_i``, and the highest number."""
    modulus = max(1, rows_per_block // SAMPLE_PER_BLOCK)
    stride = max(1, rows_per_block // modulus)
    columns = [*keys, *order_by]
    sample = df.select(*columns)
    if modulus > 1:
        sample = sample.where(F.pmod(F.xxhash64(*columns), F.lit(modulus)) == 0)
    in_order = Window.partitionBy(*keys).orderBy(*order_by)
    points = cut(
        sample.withColumn("_n", F.row_number().over(in_order))
        .where(F.col("_n") % stride == 0)
        .withColumn("_i", (F.col("_n") / stride).cast("int"))
        .drop("_n")
    )
    return points, points.agg(F.max("_i")).first()[0] or 0


def _with_block(df: DataFrame, points: DataFrame, keys, order_by, highest: int) -> DataFrame:
    """Add the block of each row and whether its key was cut.

    The cut points of a key are searched in two steps, every ``FAN``-th one first, so that a row
    meets two short arrays and never all cut points of its key.
    """
    tuple_ = F.struct(*order_by)
    points = points.withColumn("_g", (F.col("_i") / FAN).cast("int"))
    is_coarse = F.col("_i") % FAN == 0
    df = df.withColumn("_top", F.lit(0))
    if highest >= FAN:
        coarse = points.where(is_coarse).groupBy(*keys).agg(F.array_sort(F.collect_list(tuple_)).alias("_cuts"))
        df = lookup(df.drop("_top"), coarse, keys)
        df = count_at_or_below(df, "_cuts", tuple_, highest // FAN, "_top").drop("_cuts")
    # Each group has a row, if only for its first, coarse point; that one is not listed again.
    fine = points.groupBy(*keys, F.col("_g").alias("_top")).agg(F.array_sort(F.collect_list(F.when(~is_coarse, tuple_))).alias("_cuts"))
    df = lookup(df, fine, [*keys, "_top"])
    df = count_at_or_below(df, "_cuts", tuple_, min(highest, FAN - 1), BLOCK)
    df = df.withColumns({BLOCK: F.col("_top") * FAN + F.col(BLOCK), HOT: F.col("_cuts").isNotNull()})
    return df.drop("_cuts", "_top")


def ordered(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], rows_per_block: int = ROWS_PER_BLOCK) -> OrderedFrame:
    """Prepare ``df`` for ordered operators per ``keys`` (none: one series over the whole table).

    ``order_by`` are column names, ascending, and should end in a unique column: the order
    of rows with equal tuples is undefined, and such rows share a block.
    """
    keys = list(keys)
    if not keys:
        df, keys = df.withColumn(ALL, F.lit(0)), [ALL]
    order_by = list(order_by)
    points, highest = _cut_points(df, keys, order_by, rows_per_block)
    if highest:
        df = _with_block(df, points, keys, order_by, highest)
    return OrderedFrame(df, tuple(keys), tuple(order_by), bool(highest), rows_per_block)


# -- operators: what a block knows, what it hands on, and how both make the result ----------------------


@dataclass(frozen=True)
class _Scan:
    """An operator on a frame with blocks.

    ``local`` are expressions per (key, block) in stages, ``summary`` what a block hands on, ``carry`` turns the table of all
    summaries into what each block gets, ``final`` has the results. ``value`` is an expression of unknown columns that it reads.
    """

    reads: frozenset[str]
    within: tuple[str, ...]
    local: list[dict[str, Column]]
    summary: dict[str, Column]
    carry: Callable[[DataFrame], DataFrame]
    carried: tuple[str, ...]
    final: dict[str, Column]
    value: Column | None = None
    fold: tuple | None = None

    @property
    def writes(self) -> set[str]:
        return set(self.final)


@dataclass(frozen=True)
class _Change:
    """A step that needs its own row only; ``value`` if all it does is to add one column."""

    apply: Callable[[DataFrame], DataFrame]
    writes: set[str]
    value: Column | None = None


def _mentions(value: Column, names: set[str]) -> bool:
    """Whether an expression may read one of the columns: its text has the name, or is shortened."""
    text = str(value).removeprefix("Column<'")
    words = set(re.findall(r"\w+", text))
    return "more fields" in text or any(name in (words if name.isidentifier() else text) for name in names)


@dataclass(frozen=True)
class OrderedFrame:
    """A frame whose rows have a defined order within ``keys``.

    All methods return a new frame with the named columns added. ``within`` names further
    columns that cut the series of a key into contiguous runs (a trip inside a device):
    the operator then restarts at each run, with no further shuffle.
    """

    base: DataFrame
    keys: tuple[str, ...]
    order_by: tuple[str, ...]
    split: bool
    rows_per_block: int = ROWS_PER_BLOCK
    pending: tuple = ()
    _made: list = field(default_factory=list, compare=False, repr=False)

    # -- plumbing ---------------------------------------------------------------------

    @property
    def df(self) -> DataFrame:
        """The rows with all results, and with bookkeeping columns."""
        if not self.pending:
            return self.base
        if not self._made:
            self._made.append(self._flush())
        return self._made[0]

    @property
    def _home(self) -> list[str]:
        return [*self.keys, BLOCK] if self.split else list(self.keys)

    def _window(self, within: Sequence[str] = (), reverse: bool = False):
        order = [F.col(c).desc() for c in self.order_by] if reverse else list(self.order_by)
        return Window.partitionBy(*self._home, *within).orderBy(*order)

    def _so_far(self, within: Sequence[str] = (), reverse: bool = False):
        return self._window(within, reverse).rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def with_df(self, df: DataFrame) -> OrderedFrame:
        return replace(self, base=df, pending=(), _made=[])

    def _then(self, step) -> OrderedFrame:
        return replace(self, pending=(*self.pending, step), _made=[])

    def _change(self, apply: Callable[[DataFrame], DataFrame], writes: Sequence[str], value: Column | None = None) -> OrderedFrame:
        if not self.pending:
            return self.with_df(apply(self.base))
        return self._then(_Change(apply, set(writes), value))

    def with_column(self, name: str, value: Column) -> OrderedFrame:
        return self._change(lambda df: df.withColumn(name, value), [name], value)

    def without(self, *names: str) -> OrderedFrame:
        return self._change(lambda df: df.drop(*names), names)

    def result(self) -> DataFrame:
        """The frame without bookkeeping columns."""
        return self.df.drop(BLOCK, HOT, ALL)

    @property
    def _tag(self) -> str:
        """A prefix for the working columns of the next step."""
        return f"_s{len(self.pending)}_"

    def _earlier(self, within: Sequence[str], depth: int | None = None):
        start = Window.unboundedPreceding if depth is None else -depth
        return Window.partitionBy(*self.keys, *within).orderBy(BLOCK).rowsBetween(start, -1)

    def _later(self, within: Sequence[str]):
        back = Window.partitionBy(*self.keys, *within).orderBy(F.col(BLOCK).desc())
        return back.rowsBetween(Window.unboundedPreceding, -1)

    def _position(self, within: Sequence[str]) -> dict[str, Column]:
        """Position in the block from 0; operators of a wave share it."""
        return {self._position_name(within): F.row_number().over(self._window(within)) - 1}

    @staticmethod
    def _position_name(within: Sequence[str]) -> str:
        return "_at_" + "_".join(within)

    def _scan(self, reads, within, local, summary, final, carry=lambda pieces: pieces, carried=(), value=None, fold=None) -> OrderedFrame:
        return self._then(_Scan(frozenset(reads) | set(within), tuple(within), local, summary, carry, tuple(carried), final, value, fold))

    # -- waves ------------------------------------------------------------------------

    def _flush(self) -> DataFrame:
        df, todo = self.base, list(self.pending)
        while todo:
            if isinstance(todo[0], _Change):
                df = todo.pop(0).apply(df)
                continue
            wave, rest, late, waiting = [], [], set(), set()
            for step in todo:
                if isinstance(step, _Change) and step.value is not None and not step.writes & (set(df.columns) | waiting | late):
                    if not _mentions(step.value, late):
                        df = step.apply(df)  # a new column that no operator of this wave makes
                        continue
                ready = isinstance(step, _Scan) and not step.reads & late
                ready = ready and (step.value is None or not _mentions(step.value, late))
                # What waits may still read a column as it was.
                ready = ready and not (rest and step.writes & (waiting | set(df.columns)))
                (wave if ready else rest).append(step)
                late |= step.writes
                if not ready:
                    waiting |= step.writes
            df, todo = self._wave(df, wave), rest
        return df

    def _wave(self, df: DataFrame, wave: list[_Scan]) -> DataFrame:
        """Results of operators that do not depend on each other."""
        columns, working = df.columns, []
        for stage in range(max(len(op.local) for op in wave)):
            added = {n: c for op in wave if stage < len(op.local) for n, c in op.local[stage].items()}
            df = df.withColumns(added)
            working += list(added)
        df = stored(df, "blocks")
        for within in dict.fromkeys(op.within for op in wave):
            mine = [op for op in wave if op.within == within]
            group = [*self.keys, *within]
            names = [n for op in mine for n in op.carried]
            summaries = {n: c for op in mine for n, c in op.summary.items()}
            pieces = df.where(F.col(HOT)).groupBy(*group, BLOCK).agg(*[c.alias(n) for n, c in summaries.items()])
            several = F.count(F.lit(1)).over(Window.partitionBy(*group))
            pieces = pieces.withColumn("_several", several).where(F.col("_several") > 1).drop("_several")
            for op in mine:
                pieces = op.carry(pieces)
            folds = [op.fold for op in mine if op.fold]
            if folds:
                pieces = _folded(pieces, group, folds)
            carries = cut(pieces.select(*group, BLOCK, *names))
            df = lookup(df, carries, [*group, BLOCK], materialise=False)
            working += names
        results = {n: c for op in wave for n, c in op.final.items()}
        # A result may replace a column that another one reads: all are made at once.
        kept = [results.pop(c).alias(c) if c in results else F.col(c) for c in columns]
        return df.select(*kept, *[c.alias(n) for n, c in results.items()])

    # -- positions --------------------------------------------------------------------

    def row_number(self, out: str, within: Sequence[str] = ()) -> OrderedFrame:
        """1, 2, 3 … in order."""
        if not self.split:
            return self.with_column(out, F.row_number().over(self._window(within)).cast("long"))
        n, before, at = self._tag + "n", self._tag + "before", self._position_name(within)
        return self._scan(
            (), within, [self._position(within)], {n: F.count(F.lit(1))}, {out: F.col(at) + 1 + F.coalesce(F.col(before), F.lit(0).cast("long"))},
            lambda pieces: pieces.withColumn(before, F.sum(n).over(self._earlier(within))), [before],
        )

    def dense_rank(self, value: Column, out: str) -> OrderedFrame:
        """Number of distinct values of a column that rises with the order (a date of the timestamp)."""
        tag = self._tag if self.split else "_"
        v, new, local = tag + "v", tag + "new", tag + "rank"
        # A count of changes needs the order of the frame only; dense_rank() would sort once more.
        window = self._window()
        changed = (F.row_number().over(window) == 1) | ~F.col(v).eqNullSafe(F.lag(v).over(window))
        stages = [{v: value}, {new: changed.cast("int")}, {local: F.sum(new).over(self._so_far())}]
        if not self.split:
            df = self.df
            for stage in stages:
                df = df.withColumns(stage)
            return self.with_df(df.withColumn(out, F.col(local).cast("int")).drop(v, new, local))
        n, first, last, before = (tag + x for x in ("n", "first", "last", "before"))
        summary = {
            n: F.max(local),
            first: F.when(~F.bool_or(F.col(v).isNull()), F.min(v)),  # nulls come first in the order
            last: F.max(v),
        }

        def carry(pieces: DataFrame) -> DataFrame:
            by_block = Window.partitionBy(*self.keys).orderBy(BLOCK)
            # A value, or a run of nulls, that continues from the previous block must not count twice.
            again = (F.row_number().over(by_block) > 1) & F.lag(last).over(by_block).eqNullSafe(F.col(first))
            pieces = pieces.withColumn("_again", again.cast("int")).withColumn("_more", F.col(n) - F.col("_again"))
            return pieces.withColumn(before, F.sum("_more").over(self._earlier(())) - F.col("_again")).drop("_again", "_more")

        rank = (F.col(local) + F.coalesce(F.col(before), F.lit(0).cast("long"))).cast("int")
        return self._scan((), (), stages, summary, {out: rank}, carry, [before], value)

    def running_sum(self, column: str, out: str, within: Sequence[str] = ()) -> OrderedFrame:
        """Sum of the column up to and including the row."""
        so_far = F.sum(column).over(self._so_far(within))
        if not self.split:
            return self.with_column(out, so_far)
        local, total, before = (self._tag + x for x in ("sum", "total", "before"))
        # Nulls at the head of a block leave the sum of the blocks before.
        value = F.coalesce(F.col(local) + F.col(before), F.col(local), F.col(before))
        return self._scan(
            [column], within, [{local: so_far}], {total: F.sum(column)}, {out: value},
            lambda pieces: pieces.withColumn(before, F.sum(total).over(self._earlier(within))), [before],
        )

    def group_sum(self, value: Column, out: str, within: Sequence[str] = ()) -> OrderedFrame:
        """Sum over the whole run, on each of its rows."""
        tag = self._tag if self.split else "_"
        v, local, total, whole = (tag + x for x in ("v", "sum", "total", "whole"))
        stages = [{v: value}, {local: F.sum(v).over(Window.partitionBy(*self._home, *within))}]
        if not self.split:
            df = self.df.withColumns(stages[0]).withColumns(stages[1])
            return self.with_df(df.withColumn(out, F.col(local)).drop(v, local))
        over = Window.partitionBy(*self.keys, *within)
        return self._scan(
            (), within, stages, {total: F.sum(v)}, {out: F.coalesce(F.col(whole), F.col(local))},
            lambda pieces: pieces.withColumn(whole, F.sum(total).over(over)), [whole], value,
        )

    def scaled_position(self, out: str, scale: float = 10.0, within: Sequence[str] = ()) -> OrderedFrame:
        """Position in the run from 0 (first row) to ``scale`` (last row)."""
        frame = self.row_number("_pos", within).group_sum(F.lit(1), "_len", within)
        position = F.when(F.col("_len") > 1, (F.col("_pos") - 1) * scale / (F.col("_len") - 1)).otherwise(F.lit(0.0))
        return frame.with_column(out, position).without("_pos", "_len")

    # -- earlier values ---------------------------------------------------------------

    def lags(self, outputs: Mapping[str, tuple[str, int]], within: Sequence[str] = ()) -> OrderedFrame:
        """Add ``{out: (column, n)}``: the value n rows earlier, all in one pass."""
        window = self._window(within)
        local = {out: F.lag(column, n).over(window) for out, (column, n) in outputs.items()}
        if not self.split:
            return self.with_df(self.df.withColumns(local))
        tag, at = self._tag, self._position_name(within)
        size, own, tail = tag + "size", tag + "own", tag + "tail"
        depth = max(n for _, n in outputs.values())
        columns = sorted({column for column, _ in outputs.values()})
        stage = {tag + out: value for out, value in local.items()}
        stage |= self._position(within) | {size: F.count(F.lit(1)).over(Window.partitionBy(*self._home, *within))}
        # The last `depth` rows of each block, newest first.
        back = F.col(size) - F.col(at)
        newest = F.when(back <= depth, F.struct(back.alias("_back"), *[F.col(c).alias("v_" + c) for c in columns]))
        # Each block has at least one row, so `depth` earlier blocks are enough.
        before = F.flatten(F.reverse(F.collect_list(own).over(self._earlier(within, depth))))
        final = {
            out: F.when(F.col(at) >= n, F.col(tag + out)).otherwise(F.get(F.col(tail), F.lit(n - 1) - F.col(at))["v_" + column])
            for out, (column, n) in outputs.items()
        }
        return self._scan(
            columns, within, [stage], {own: F.array_sort(F.collect_list(newest))}, final,
            lambda pieces: pieces.withColumn(tail, F.slice(before, 1, depth)), [tail],
        )

    def lag(self, column: str, n: int, out: str, within: Sequence[str] = ()) -> OrderedFrame:
        return self.lags({out: (column, n)}, within)

    def difference(self, column: str, d: int, out: str, within: Sequence[str] = ()) -> OrderedFrame:
        """d-th difference, from d lags and alternating binomial weights; null in the first d rows."""
        if d == 0:
            return self.with_column(out, F.col(column))
        names = [f"_d{i}" for i in range(1, d + 1)]
        frame = self.lags({name: (column, i) for i, name in enumerate(names, 1)}, within)
        return frame.with_column(out, nth_difference([F.col(column), *map(F.col, names)], d)).without(*names)

    # -- fills ------------------------------------------------------------------------

    def _fill_from(self, columns, within, reverse: bool) -> OrderedFrame:
        window = self._so_far(within, reverse)
        nearest = {c: F.last(c, ignorenulls=True).over(window) for c in columns}
        if not self.split:
            return self.with_df(self.df.withColumns(nearest))
        tag, at = self._tag, F.col(self._position_name(within))
        pick = F.min_by if reverse else F.max_by
        # The position in the block orders the values: numbers, unlike tuples, aggregate by hash.
        edges = {f"{tag}e_{c}": pick(c, F.when(F.col(c).isNotNull(), at)) for c in columns}
        side = self._later(within) if reverse else self._earlier(within)
        return self._scan(
            columns, within, [{f"{tag}l_{c}": value for c, value in nearest.items()} | self._position(within)], edges,
            {c: F.coalesce(F.col(f"{tag}l_{c}"), F.col(f"{tag}f_{c}")) for c in columns},
            lambda pieces: pieces.withColumns({f"{tag}f_{c}": F.last(f"{tag}e_{c}", ignorenulls=True).over(side) for c in columns}),
            [f"{tag}f_{c}" for c in columns],
        )

    def fill(self, columns: Sequence[str], methods: Sequence[str | float] = ("ffill", 0), within: Sequence[str] = ()):
        """Replace nulls by each method in turn: 'ffill', 'bfill' or a constant."""
        frame, columns = self, list(columns)
        for method in methods:
            if method in ("ffill", "bfill"):
                frame = frame._fill_from(columns, within, reverse=method == "bfill")
            else:
                frame = frame._change(lambda df, constant=method: df.fillna(constant, subset=columns), columns)
        return frame

    # -- exponentially weighted mean --------------------------------------------------

    def ewma(
        self,
        column: str,
        out: str,
        com: float | None = None,
        span: float | None = None,
        shift: int = 1,
        within: Sequence[str] = (),
    ) -> OrderedFrame:
        """Exponentially weighted mean with bias adjustment; null rows repeat the last mean.

        ``y_t = Σ r^(t-i) x_i / Σ r^(t-i)`` over the non-null ``i <= t``, where ``r = 1 - alpha`` and
        ``alpha`` is ``1/(1+com)`` or ``2/(span+1)``. ``shift`` lags the input first.

        Running sums of ``r^-i x_i`` overflow, so they restart every ``stride`` rows. The stride is
        the number of rows over which a weight falls to 1e-150: only the stride before the current
        one can still matter.
        """
        if (com is None) == (span is None):
            raise ValueError("give either com or span")
        alpha = 1.0 / (1.0 + com) if com is not None else 2.0 / (span + 1.0)
        r = 1.0 - alpha
        stride = max(1, int(150 * math.log(10) / -math.log(r))) if r > 0 else 1
        tag = self._tag if self.split else "_"
        x, run, off, n, d, pn, pd_, at = (tag + c for c in ("x", "run", "off", "n", "d", "pn", "pd", "pos"))
        home = [*self._home, *within]
        known = F.col(x).isNotNull()
        grow, shrink, zero = F.pow(F.lit(r), -F.col(off)), F.pow(F.lit(r), F.col(off)), F.lit(0.0)
        in_run = Window.partitionBy(*home, run).orderBy(off).rowsBetween(Window.unboundedPreceding, 0)
        last_run = Window.partitionBy(*home).orderBy(run).rangeBetween(-1, -1)
        # A run with a successor is complete, so its totals stand in its last row. Reading them from
        # the running sums also lets both windows, and the last one below, share one sort.
        at_end = F.col(off) == stride - 1
        before = shrink * F.lit(r**stride)
        # Lagging the input is the same as lagging the mean: the frame ends that much earlier.
        upto = shift if shift <= 1 else 0
        in_order = Window.partitionBy(*home).orderBy(run, off).rowsBetween(Window.unboundedPreceding, -upto)
        latest = lambda c: F.last(F.when(known, c), ignorenulls=True).over(in_order)
        stages = [
            {x: F.col(column).cast("double"), at: F.row_number().over(self._window(within)) - 1},
            {run: (F.col(at) / stride).cast("int"), off: F.col(at) % stride},
            {n: F.coalesce(F.sum(F.when(known, grow * F.col(x))).over(in_run), zero), d: F.coalesce(F.sum(F.when(known, grow)).over(in_run), zero)},
            {p: F.sum(F.when(at_end, F.col(c))).over(last_run) for p, c in ((pn, n), (pd_, d))},
            {c: F.col(c) * shrink + F.coalesce(F.col(p) * before, zero) for p, c in ((pn, n), (pd_, d))},
        ]
        if not self.split:
            df = self.df
            for stage in stages:
                df = df.withColumns(stage)
            frame = self.with_df(df.withColumn(out, latest(F.col(n) / F.col(d))).drop(x, run, off, n, d, pn, pd_, at))
            return frame if upto == shift else frame.lag(out, shift, out, within)
        ln, ld, lp, cn, cd, gap = (tag + c for c in ("ln", "ld", "lp", "cn", "cd", "gap"))
        stages.append({ln: latest(F.col(n)), ld: latest(F.col(d)), lp: latest(F.col(at))})
        known_at = F.when(known, F.col(at))
        summary = {
            tag + "en": F.max_by(n, known_at),
            tag + "ed": F.max_by(d, known_at),
            tag + "at": F.max(known_at).cast("long"),
            tag + "len": F.count(F.lit(1)),
        }
        weight = F.pow(F.lit(r), F.col(gap) + F.col(lp) + 1)
        numer, denom = (F.col(a) + F.coalesce(F.col(c) * weight, zero) for a, c in ((ln, cn), (ld, cd)))
        mean = F.coalesce(numer / denom, F.col(cn) / F.col(cd))
        frame = self._scan([column], within, stages, summary, {out: mean}, carried=[cn, cd, gap], fold=(tag, r))
        return frame if upto == shift else frame.lag(out, shift, out, within)


# -- fold of decayed sums -----------------------------------------------------------------------------------


def _join_pieces(r: float, state: tuple, piece: tuple) -> tuple:
    """The decayed sums of two stretches of rows: sums at the last known row, its place, and the length."""
    (en, ed, at, length), (fn, fd, place, more) = state, piece
    if place is None:
        return en, ed, at, length + more
    weight = 0.0 if at is None else r ** (length - 1 - at + place + 1)
    return fn + (en or 0.0) * weight, fd + (ed or 0.0) * weight, length + place, length + more


_START = (None, None, None, 0)


def _pieces_of(pdf: pd.DataFrame, tag: str) -> list[tuple]:
    at = [None if pd.isna(a) else int(a) for a in pdf[tag + "at"]]
    return list(zip(pdf[tag + "en"], pdf[tag + "ed"], at, pdf[tag + "len"].astype(int)))


def _before(pdf: pd.DataFrame, folds: list[tuple[str, float]], start: Callable[[str], tuple]) -> pd.DataFrame:
    """Per row of the sorted pieces, the state of all rows before it."""
    out = {}
    for tag, r in folds:
        state, states = start(tag), []
        for piece in _pieces_of(pdf, tag):
            states.append(state)
            state = _join_pieces(r, state, piece)
        out[tag + "cn"] = pd.Series([s[0] for s in states], index=pdf.index, dtype="float64")
        out[tag + "cd"] = pd.Series([s[1] for s in states], index=pdf.index, dtype="float64")
        # Rows since the last known one; before the first one there is none, and no weight.
        out[tag + "gap"] = pd.Series([s[3] - 1 - s[2] if s[2] is not None else 0 for s in states], index=pdf.index, dtype="int64")
        out[tag + "done"] = pd.Series([s[2] if s[2] is not None else -1 for s in states], index=pdf.index, dtype="int64")
        out[tag + "rows"] = pd.Series([s[3] for s in states], index=pdf.index, dtype="int64")
    return pdf.assign(**out)


def _folded(pieces: DataFrame, group: list[str], folds: list[tuple[str, float]]) -> DataFrame:
    """Add to each block the decayed sums of the blocks before: a linear recurrence over one small row per block.

    A stretch of blocks is summed up as a block is, so chunks of ``FOLD`` blocks are folded by themselves, then the chunks,
    and no task ever has all blocks of a key that has very many.
    """
    state = [(tag + c, t) for tag, _ in folds for c, t in (("cn", T.DoubleType()), ("cd", T.DoubleType()), ("gap", T.LongType()), ("done", T.LongType()), ("rows", T.LongType()))]
    added = T.StructType([*pieces.schema.fields, *[T.StructField(n, t) for n, t in state]])
    drop = [n for n, _ in state if n.endswith(("done", "rows"))]
    empty = lambda tag: _START
    longest = pieces.agg(F.max(BLOCK)).first()[0] or 0 if FOLD < 1 << 20 else 0
    if longest < FOLD:
        found = pieces.groupBy(*group).applyInPandas(lambda pdf: _before(pdf.sort_values(BLOCK), folds, empty), added)
        return found.drop(*drop)
    pieces = cut(pieces.withColumn("_chunk", F.floor(F.col(BLOCK) / FOLD).cast("int")))
    whole = [T.StructField("_chunk", T.IntegerType())]
    whole += [pieces.schema[tag + c] for tag, _ in folds for c in ("en", "ed", "at", "len")]
    whole = T.StructType([*[pieces.schema[g] for g in group], *whole])

    def total(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(BLOCK)
        out = pdf[[*group, "_chunk"]].iloc[:1].copy()
        for tag, r in folds:
            state = _START
            for piece in _pieces_of(pdf, tag):
                state = _join_pieces(r, state, piece)
            out[tag + "en"], out[tag + "ed"], out[tag + "len"] = pd.Series([state[0]], index=out.index, dtype="float64"), pd.Series([state[1]], index=out.index, dtype="float64"), state[3]
            out[tag + "at"] = pd.Series([state[2]], index=out.index, dtype="Int64")
        return out[whole.names]

    chunks = pieces.groupBy(*group, "_chunk").applyInPandas(total, whole)
    with_state = T.StructType([*whole.fields, *[T.StructField(n, t) for n, t in state]])
    chunks = chunks.groupBy(*group).applyInPandas(lambda pdf: _before(pdf.sort_values("_chunk"), folds, empty), with_state)
    starts = chunks.select(*group, "_chunk", *[F.col(n).alias("c" + n) for n, _ in state])
    joined = lookup(pieces, starts, [*group, "_chunk"])

    def inside(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(BLOCK)
        first = pdf.iloc[0]

        def start(tag: str) -> tuple:
            done = int(first["c" + tag + "done"])
            if done < 0:
                return None, None, None, int(first["c" + tag + "rows"])
            return float(first["c" + tag + "cn"]), float(first["c" + tag + "cd"]), done, int(first["c" + tag + "rows"])

        return _before(pdf, folds, start)[added.names]

    return joined.groupBy(*group, "_chunk").applyInPandas(inside, added).drop(*drop)


def nth_difference(values: Sequence[Column], d: int) -> Column:
    """d-th difference of (x_t, x_{t-1}, …, x_{t-d})."""
    total = values[0]
    for i in range(1, d + 1):
        weight = float(math.comb(d, i) * (-1) ** i)
        total = total + values[i] * F.lit(weight)
    return total
