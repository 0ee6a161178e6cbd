"""SimHash near-duplicates through a Gray-ordered hierarchical index.

Fingerprints that differ in at most ``distance`` bits agree on at least ``agree`` of ``distance + agree`` bit
blocks. Each choice of ``agree`` blocks is one grouping; its key (the bits of these blocks) deals the
fingerprints over the cluster, and only fingerprints of one key can link there. ``agree`` rises with the number of
distinct fingerprints so that a key keeps a few hundred of them.

Within a task the fingerprints of a key stand in Gray order, where neighbours differ in few bits. A tree is
put over them: a node has the bits on which all below agree (mask and pattern), less those that its parent
already has. A search adds up the differences level by level and leaves a node, with everything below,
when they exceed the distance; where the differences and the open bits together can't exceed it, everything
below links at once. Subtrees already known to be in the searcher's component are left too, so a group of
thousands of near copies costs no more than its links to others. Only a spanning forest leaves the task.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from devicelens.llm.components import components, lowest_labels
from devicelens.llm.support import forget_memo
from devicelens.session import cut

WORDS, SEED, BITS, FANOUT = 4, 42, 64, 8
#: Distinct fingerprints of one key that one task searches together, and rows that it reads at a time.
TILE, BATCH, SEARCHERS = 100_000, 200_000, 8_192


def fingerprint(text: str | None, words_per_shingle: int = WORDS, seed: int = SEED) -> int:
    """Majority of the bits of the shingles' XXH64, repeats included; 0 without words. Unsigned."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) <= words_per_shingle:
        return xxh64_intdigest(b" ".join(words), seed)
    line = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - words_per_shingle + 1].tolist()
    ends = ends[words_per_shingle - 1 :].tolist()
    count, total = np.zeros(BITS, np.int64), len(starts)
    for at in range(0, total, 1 << 16):
        found = [xxh64_intdigest(line[a:b], seed) for a, b in zip(starts[at : at + (1 << 16)], ends[at : at + (1 << 16)])]
        bits = np.unpackbits(np.array(found, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        count += bits.sum(axis=0, dtype=np.int64)
    return int(sum(1 << i for i in np.flatnonzero(2 * count > total).tolist()))


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", with_sha: bool = False) -> DataFrame:
    """The id and ``fp`` (the fingerprint as a signed long) of every row, ``sha`` (see :func:`text_sha`) if asked for; a null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_memo()
        for batch in batches:
            found = np.array([fingerprint(t.as_py()) for t in batch.column(1)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64), pa.int64()), *batch.columns[2:]], [id_column, "fp", *batch.schema.names[2:]])

    narrow = docs.select(F.col(id_column).cast("long"), text_column, *([text_sha(F.col(text_column)).alias("sha")] if with_sha else []))
    return narrow.mapInArrow(run, f"`{id_column}` long, fp long" + (", sha string" if with_sha else ""))


def text_sha(text: Column) -> Column:
    """SHA-256 of the text in hexadecimal; null has the empty string."""
    return F.coalesce(F.sha2(text.cast("binary"), 256), F.lit(""))


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Place of each code in the order of the reflected Gray code."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class Tree:
    """The index over codes in Gray order within groups that lie one after the other."""

    def __init__(self, codes: np.ndarray, group: np.ndarray):
        n = len(codes)
        every = np.uint64(0xFFFFFFFFFFFFFFFF)
        levels = [(codes, np.full(n, every), group, group, np.arange(n))]
        while len(levels[-1][0]) > FANOUT:
            pattern, mask, low, high, last = levels[-1]
            at = np.arange(0, len(pattern), FANOUT)
            one = np.bitwise_and.reduceat(mask & pattern, at)
            zero = np.bitwise_and.reduceat(mask & ~pattern, at)
            levels.append((one, one | zero, low[at], np.maximum.reduceat(high, at), last[np.minimum(at + FANOUT, len(last)) - 1]))
        self.levels = levels[::-1]
        self.own = []  # of each level: the bits that a node adds to what its parent has
        for k, level in enumerate(self.levels):
            if k:
                above = np.repeat(self.levels[k - 1][1], FANOUT)[: len(level[1])]
                self.own.append(level[1] & ~above)
            else:
                self.own.append(level[1])
        self.codes, self.group = codes, group

    def links(self, searchers: np.ndarray, distance: int, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of places (searcher, first place of what links with it) enough to join all that is within the distance."""
        n = len(self.codes)
        spans = []
        for level in self.levels:
            width = -(-n // len(level[0])) if len(level[0]) < n else 1
            spans.append(width)
        found_a, found_b = [], []
        q = np.repeat(searchers, len(self.levels[0][0]))
        node = np.tile(np.arange(len(self.levels[0][0])), len(searchers))
        differ = np.zeros(len(q), np.int64)
        width = FANOUT ** (len(self.levels) - 1)
        for k, (pattern, mask, low, high, last) in enumerate(self.levels):
            at = np.arange(0, n, width)
            lowest, highest = np.minimum.reduceat(label, at), np.maximum.reduceat(label, at)
            fits = (low[node] <= self.group[q]) & (high[node] >= self.group[q]) & (last[node] > q)
            fits &= (lowest[node] != label[q]) | (highest[node] != label[q])
            q, node, differ = q[fits], node[fits], differ[fits]
            differ = differ + np.bitwise_count((self.codes[q] ^ pattern[node]) & self.own[k][node])
            near = differ <= distance
            q, node, differ = q[near], node[near], differ[near]
            if width == 1:
                found_a.append(q)
                found_b.append(node)
                break
            # All below is within the distance, and of the searcher's group: one link joins it, as all of it links with each other too.
            sure = (differ + BITS - np.bitwise_count(mask[node]).astype(np.int64) <= distance) & (low[node] == high[node])
            found_a.append(q[sure])
            found_b.append(node[sure] * width)
            q, node, differ = q[~sure], node[~sure], differ[~sure]
            below = len(self.levels[k + 1][0])
            q, differ = np.repeat(q, FANOUT), np.repeat(differ, FANOUT)
            node = (node[:, None] * FANOUT + np.arange(FANOUT)).ravel()
            real = node < below
            q, node, differ = q[real], node[real], differ[real]
            width //= FANOUT
        return np.concatenate(found_a), np.concatenate(found_b)

    def inner_links(self, distance: int) -> tuple[np.ndarray, np.ndarray]:
        """Links inside nodes all of whose members are within the distance of each other."""
        n, width = len(self.codes), FANOUT ** (len(self.levels) - 1)
        first = np.arange(n)
        for _, mask, low, high, _ in self.levels:
            tight = (BITS - np.bitwise_count(mask).astype(np.int64) <= distance) & (low == high)
            head = np.repeat(np.where(tight, np.arange(len(mask)) * width, -1), width)[:n]
            first = np.where((head >= 0) & (head < first), head, first)
            width //= FANOUT
        return np.arange(n), first


def forest(codes: np.ndarray, group: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (code, code) that span the components among codes of the same group."""
    order = np.lexsort((gray_rank(codes), group))
    codes, group = codes[order], group[order]
    tree = Tree(codes, group)
    a, b = tree.inner_links(distance)
    label = lowest_labels(len(codes), a, b)
    beside = np.flatnonzero((group[1:] == group[:-1]) & (np.bitwise_count(codes[1:] ^ codes[:-1]) <= distance))
    label = lowest_labels(len(codes), beside, beside + 1, label)
    for at in range(0, len(codes), SEARCHERS):
        a, b = tree.links(np.arange(at, min(len(codes), at + SEARCHERS)), distance, label)
        label = lowest_labels(len(codes), a, b, label)
    away = label != np.arange(len(codes))
    return codes[away], codes[label[away]]


def groupings(distance: int, agree: int) -> list[int]:
    """The bits (as masks) of each choice of ``agree`` among ``distance + agree`` blocks."""
    blocks = np.array_split(np.arange(BITS), distance + agree)
    return [sum(1 << int(i) for block in choice for i in block) for choice in combinations(blocks, agree)]


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def linked(distinct: DataFrame, count: int, distance: int = 4, tile: int = TILE) -> DataFrame:
    """Links ``a``, ``b`` that join all distinct fingerprints (column ``fp``, long) within the distance.

    A key with more than ``tile`` fingerprints is dealt into parts; each pair of parts is searched by its own
    task, so no task gets more than two parts however many fingerprints share the key.
    """
    agree = 1
    while agree < 4 and count / 2 ** (BITS * agree / (distance + agree)) > 1_000:
        agree += 1
    masks = groupings(distance, agree)
    choice = F.explode(F.array(*[F.struct(F.lit(i).alias("g"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("key")) for i, m in enumerate(masks)])).alias("c")
    rows = distinct.select("fp", choice).select("fp", "c.g", "c.key")
    large = rows.groupBy("g", "key").agg(F.count("*").alias("n")).where(F.col("n") > tile).select("g", "key", F.ceil(F.col("n") / tile).cast("int").alias("parts"))
    rows = rows.join(large, ["g", "key"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    part = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    other: Column = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    rows = rows.withColumn("own", part).withColumn("other", other)
    pair = rows.select("g", "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def flush(upto_last_group: bool):
            group, code = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])
            held.clear()
            if upto_last_group:
                rest = group == group[-1]
                held.append((group[rest], code[rest]))
                group, code = group[~rest], code[~rest]
            if len(code):
                a, b = forest(code.view(np.uint64), group, distance)
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        before, number, size = None, 0, 0
        for batch in batches:
            g, key, i, j, fp = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(5))
            if not len(fp):
                continue
            new = np.ones(len(fp), bool)
            new[1:] = (g[1:] != g[:-1]) | (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
            new[0] = before != (g[0], key[0], i[0], j[0])
            before = (g[-1], key[-1], i[-1], j[-1])
            group = number + np.cumsum(new)
            number = int(group[-1])
            held.append((group, fp))
            size += len(fp)
            if size >= BATCH:
                yield from flush(True)
                size = sum(len(h[1]) for h in held)
        if held:
            yield from flush(False)

    dealt = pair.repartition("g", "key", "i", "j").sortWithinPartitions("g", "key", "i", "j")
    return dealt.mapInArrow(run, "a long, b long")


def grouped(distinct: DataFrame, distance: int, tile: int = TILE) -> DataFrame:
    """``component`` of each fingerprint of a table of distinct ones (``fp``, ``least``)."""
    distinct = cut(distinct)
    found = components(linked(distinct, distinct.count(), distance, tile))
    named = distinct.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    return named.select("component", "fp", "least")


def near_duplicates(docs: DataFrame, distance: int = 4, id_column: str = "doc_id", text_column: str = "text", tile: int = TILE) -> DataFrame:
    """The id, ``fingerprint`` (16 hexadecimal digits) and ``component_id`` of every row.

    Shingles are of four words (see README for why not five); fingerprints link at ``distance`` or fewer bits,
    equal ones always, and so do those of texts without words (fingerprint zero). ``component_id`` is the smallest
    id reachable. Rows with a null id get the component of their fingerprint, null if it has no id at all.
    Repeated rows are given back as they came, an empty table gives no rows, other columns are not read.
    """
    own = cut(fingerprints(docs, id_column, text_column).withColumnRenamed(id_column, "id"))
    named = grouped(own.groupBy("fp").agg(F.min("id").alias("least")), distance, tile)
    lowest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    of_fp = named.join(lowest, "component").select("fp", "component_id")
    return own.join(of_fp, "fp").select(F.col("id").alias(id_column), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_per_group(docs: DataFrame, distance: int = 4, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` less all near-duplicates: of each component the row of smallest id stays.

    Rows are told apart by id and SHA-256 of the text. A row without an id stands behind all rows with one; of equal ids, and
    of rows without one, the smallest SHA-256 is first. Rows of one id with unlike texts are different rows, of
    rows equal in id and text one stays.
    """
    own = fingerprints(docs, id_column, text_column, with_sha=True)
    row = F.struct(F.col(id_column).isNull().alias("none"), F.coalesce(id_column, F.lit(0)).alias("id"), F.col("sha"))
    named = grouped(own.groupBy("fp").agg(F.min(row).alias("least")), distance)
    kept = named.groupBy("component").agg(F.min("least").alias("least")).select(F.col("least.none").alias("_none"), F.col("least.id").alias("_id"), F.col("least.sha").alias("_sha"))
    key = ["_none", "_id", "_sha"]
    id_ = F.col(id_column).cast("long")
    rows = docs.select(id_.isNull().alias("_none"), F.coalesce(id_, F.lit(0)).alias("_id"), text_sha(F.col(text_column)).alias("_sha"), F.struct("*").alias("_row"))
    return rows.join(kept, key, "left_semi").dropDuplicates(key).select("_row.*")
