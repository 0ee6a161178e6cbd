"""Exact removal of repeated byte strings through sorted suffix runs.

Any window of ``length`` bytes contains an anchor: the ``gram`` bytes in it of smallest hash (the leftmost if equal).
As the window alone decides where, equal windows have their anchors at the same place, so it suffices to sort the
suffixes that begin at anchors, about one in thirty. An anchor answers for the run of windows that chose it; its
context is all bytes of these windows.

1. Equal texts are one text, in the name of the smallest id; texts are dealt into chunks, a table bucketed by chunk.
2. Chunks send the hashes of their anchors' grams; those that occur once in all need no sorting.
3. Each chunk sorts the suffixes at the other anchors and sends them as runs, front-coded: what a suffix shares with
   the one before is a number, only the rest is bytes. Equal contexts of a chunk send their first place only.
4. The runs of a part are merged by a tree of losers that knows the common prefix of every suffix with the last one
   out: of two suffixes the one that shares more is smaller, and only where they share as much are bytes compared, from
   there on. In the merged order suffixes with equal grams stand together, and windows that also occur
   earlier become spans.
5. A gram with more than ``HOT`` anchors in all goes another way, as its suffixes would be one group in one task: chunks
   send the SHA-256 of each of its windows, equal windows of a group of texts once, and Spark takes the first place of each.
6. Spans go back to their chunk, which cuts them out.
"""

from __future__ import annotations

import bisect
import hashlib
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devicelens.llm.support import forget_memo
from devicelens.session import cut, scratch_path

#: Bytes of a repeated string, of the gram that anchors compare, of a chunk's texts, and of texts hashed at a time.
LENGTH, GRAM, CHUNK, PIECE = 100, 32, 8_000_000, 500_000
#: Anchors of one gram that one task compares, at most, and windows of other grams that a chunk sends as one row.
HOT, WINDOWS = 100_000, 5_000
NO_ID = (1 << 63) - 1


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """Mixed 64-bit hash of the ``gram`` bytes from each place on; shorter at the end."""
    n = len(data)
    part, power, width = data.astype(np.uint64) + np.uint64(1), np.uint64(0x9E3779B97F4A7C15), 1
    total, done = np.zeros(n, np.uint64), 0
    with np.errstate(over="ignore"):
        factor, rest = np.uint64(1), gram
        while rest:
            if rest & 1:  # part covers `width` bytes; append it after the `done` bytes already there
                total[: n - done] += part[done:] * factor
                factor = factor * power
                done += width
            rest >>= 1
            if rest:
                longer = part.copy()
                longer[: n - width] += part[width:] * power
                part, power, width = longer, power * power, width * 2
        total ^= total >> np.uint64(29)
        total *= np.uint64(0xBF58476D1CE4E5B9)
        total ^= total >> np.uint64(32)
    return total


def anchors(texts: list[bytes], length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of texts laid end to end: text, place, first and last window start, and gram hash of every anchor."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(sizes) - sizes
    n, span = len(data), length - gram + 1
    none = np.zeros(0, np.int64)
    if n < length or not (sizes >= length).any():
        return none, none, none, none, np.zeros(0, np.uint64)
    hashed = gram_hashes(data, gram)
    bits = np.uint64(max(1, int(n).bit_length()))
    best = ((hashed >> bits) << bits) | np.arange(n, dtype=np.uint64)  # smallest hash first, then the leftmost
    width = 1
    while width * 2 <= span:
        best[: n - width] = np.minimum(best[: n - width], best[width:])
        width *= 2
    if span > width:
        best[: n - (span - width)] = np.minimum(best[: n - (span - width)], best[span - width :])
    chosen = (best & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    valid = np.zeros(n + 1, np.int64)  # windows that lie within one text
    whole = sizes >= length
    np.add.at(valid, starts[whole], 1)
    np.add.at(valid, starts[whole] + sizes[whole] - length + 1, -1)
    window = np.flatnonzero(np.cumsum(valid[:-1]) > 0)
    anchor = chosen[window]
    first = np.ones(len(window), bool)
    first[1:] = anchor[1:] != anchor[:-1]
    last = np.append(first[1:], True)
    place, low, high = anchor[first], window[first], window[last]
    text = np.searchsorted(starts, low, side="right") - 1
    return text, place - starts[text], low - starts[text], high - starts[text], hashed[place]


def pieces_of(texts: list[bytes], most: int) -> Iterator[tuple[int, list[bytes]]]:
    """Texts in groups of about ``most`` bytes, each with the number of its first text."""
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) <= most):
            size += len(texts[end])
            end += 1
        yield at, texts[at:end]
        at = end


class Run:
    """A sorted run as bytes: per suffix its shared prefix, sizes, place and the bytes that are new."""

    HEAD = "<BBBqIqIH"  # shared, rest, left, doc, row, place, chunk, least distance to the anchor

    @staticmethod
    def pack(records: list[tuple[bytes, bytes, int, int, int, int, int]]) -> bytes:
        out, before = [], b""
        for right, left, doc, row, place, chunk, near in records:
            shared = common(before, right, 0)
            out += (struct.pack(Run.HEAD, shared, len(right) - shared, len(left), doc, row, place, chunk, near), right[shared:], left)
            before = right
        return b"".join(out)

    def __init__(self, data: bytes):
        self.data, self.at, self.right = data, 0, b""
        self.shared, self.record = 0, None

    def advance(self) -> bool:
        """Read the next suffix; its shared prefix is with the one before in this run."""
        if self.at >= len(self.data):
            self.record = None
            return False
        self.shared, rest, left, doc, row, place, chunk, near = struct.unpack_from(Run.HEAD, self.data, self.at)
        at = self.at + struct.calcsize(Run.HEAD)
        self.right = self.right[: self.shared] + self.data[at : at + rest]
        self.at = at + rest + left
        self.record = (self.right, self.data[at + rest : self.at], doc, row, place, chunk, near)
        return True


def common(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix; the first ``known`` bytes are known to be equal and not looked at."""
    n = min(len(a), len(b))
    x = int.from_bytes(a[known:n], "big") ^ int.from_bytes(b[known:n], "big")
    return n - (x.bit_length() + 7) // 8


def merge(runs: list[Run]) -> Iterator[tuple[int, tuple]]:
    """All suffixes of the runs in order, each with the length of the prefix it shares with the one before.

    ``known[i]`` is what the head of run i shares with the last suffix out, or at a tree node, the loser with the winner
    that passed there. Heads that share more with the last one out are smaller, so bytes decide equal lengths only.
    """
    runs = [r for r in runs if r.advance()]
    size = 1
    while size < len(runs):
        size *= 2
    known = [0] * len(runs)

    def beats(i: int, j: int) -> bool:
        """Whether head i goes before head j; the loser's known prefix becomes what it shares with the winner."""
        if j < 0:
            return True
        if i < 0:
            return False
        a, b = known[i], known[j]
        if a != b:
            return a > b
        x, y = runs[i].right, runs[j].right
        shared = common(x, y, a)
        first = shared == len(x) if shared == len(x) or shared == len(y) else x[shared] < y[shared]
        known[j if first else i] = shared
        return first

    losers = [-1] * size

    def build(node: int) -> int:
        if node >= size:
            return node - size if node - size < len(runs) else -1
        i, j = build(2 * node), build(2 * node + 1)
        if beats(i, j):
            losers[node] = j
            return i
        losers[node] = i
        return j

    winner = build(1) if runs else -1
    while winner >= 0:
        run = runs[winner]
        yield known[winner], run.record
        if run.advance():
            known[winner] = run.shared
            i = winner
        else:
            i = -1
        node = (winner + size) // 2
        while node:
            if beats(losers[node], i) if losers[node] >= 0 else False:
                losers[node], i = i, losers[node]
            node //= 2
        winner = i


def repeated(group: list[tuple], length: int) -> Iterator[tuple[int, int, int, int]]:
    """(chunk, row, start, end) of the windows in a group of equal grams that also occur earlier.

    One distance from window start to anchor at a time: windows of equal bytes have it in common.
    """
    most = max(len(r[1]) for r in group)
    hits: list[list[int]] = [[] for _ in group]
    for distance in range(min(r[6] for r in group), most + 1):
        first: dict[bytes, tuple[int, int]] = {}
        here = []
        for k, (right, left, doc, _, place, _, near) in enumerate(group):
            if near <= distance <= len(left):
                window = left[len(left) - distance :] + right[: length - distance]
                where = (doc, place - distance)
                here.append((k, window, where))
                old = first.get(window)
                if old is None or where < old:
                    first[window] = where
        if len(first) < len(here):
            for k, window, where in here:
                if where > first[window]:
                    hits[k].append(distance)
    for k, found in enumerate(hits):
        if found:
            _, _, _, row, place, chunk, _ = group[k]
            # Distances that follow each other are windows side by side: one span.
            low = found[0]
            for before, d in zip(found, [*found[1:], None]):
                if d is None or d != before + 1:
                    yield chunk, row, place - before, place - low + length
                    low = d


#: A window of a hot gram: its SHA-256, document, first byte, and row in the chunk.
WINDOW = np.dtype([("sha", "S32"), ("doc", "<i8"), ("place", "<i8"), ("row", "<i8")])


def hashed_windows(texts: list[bytes], rows: list[tuple[int, int, int]], doc: list[int], base: int, length: int) -> np.ndarray:
    """The windows of contexts (row, first and last window start) of a group of texts whose first row is ``base``."""
    total = sum(high - low + 1 for row, low, high in rows)
    out, at = np.zeros(total, WINDOW), 0
    for row, low, high in rows:
        data, n = texts[row - base], high - low + 1
        part = out[at : at + n]
        part["sha"] = [hashlib.sha256(data[k : k + length]).digest() for k in range(low, high + 1)]
        part["doc"], part["place"], part["row"] = doc[row], np.arange(low, high + 1), row
        at += n
    return out


def window_spans(windows: np.ndarray, length: int) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """Of some windows: the first by hash, ties of document and place included, and spans (row, start, end) of the later ones."""
    # Bytes of type S lose zeros at their end: all 32 are compared as four numbers.
    sha = np.ascontiguousarray(windows["sha"]).view("S1").reshape(len(windows), 32).view("<u8") if len(windows) else np.zeros((0, 4), np.uint64)
    order = np.lexsort((windows["row"], windows["place"], windows["doc"], *sha.T))
    windows, sha = windows[order], sha[order]
    new = np.ones(len(windows), bool)
    new[1:] = (sha[1:] != sha[:-1]).any(1)
    head = np.maximum.accumulate(np.where(new, np.arange(len(windows)), 0))
    first = (windows["doc"] == windows["doc"][head]) & (windows["place"] == windows["place"][head])
    later = windows[~first]
    spans: list[tuple[int, int, int]] = []
    for row, place in sorted(zip(later["row"].tolist(), later["place"].tolist())):  # windows that meet are one span
        if spans and spans[-1][0] == row and place <= spans[-1][2]:
            spans[-1] = (row, spans[-1][1], place + length)
        else:
            spans.append((row, place, place + length))
    return windows[first], spans


def _texts(chunk: pa.Table) -> tuple[list[int], list[bytes]]:
    """Ids and bytes of a chunk's texts, in an order that every pass finds again."""
    forget_memo()
    chunk = chunk.sort_by([("doc", "ascending"), ("sha", "ascending")])
    return chunk.column("doc").to_pylist(), [t.encode("utf-8", "surrogatepass") for t in chunk.column("text").to_pylist()]


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, id_column: str = "doc_id", text_column: str = "text", chunk_bytes: int = CHUNK, with_text: bool = False, hot: int = HOT) -> DataFrame:
    """Per row the id, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` (and ``kept_text`` if asked for).

    Texts are UTF-8 bytes, null is empty. A byte goes if it lies in a string of ``length`` bytes that also starts earlier:
    in a document of smaller id, or in the same one before. Null ids come after all others. Rows of equal id are versions of
    one document: at equal starts none is earlier, so repeated rows give equal results. ``kept_text`` leaves out characters
    that lost a byte. An empty table gives no rows; only the two named columns are read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(id_column).cast("long"), F.lit(NO_ID)).alias("doc"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    rows = rows.withColumn("sha", F.sha2(F.col("text").cast("binary"), 256))
    narrow = cut(rows.select("id", "doc", "sha", F.octet_length("text").cast("long").alias("n_bytes")))
    firsts = narrow.groupBy("sha").agg(F.min("doc").alias("doc"), F.first("n_bytes").alias("n_bytes"))
    total = firsts.agg(F.sum("n_bytes")).first()[0] or 0
    chunks = max(1, -(-total // chunk_bytes))
    unique = rows.groupBy("sha").agg(F.min("doc").alias("doc"), F.first("text").alias("text"))
    name = f"suffix_chunks_{uuid.uuid4().hex}"
    bucketed = unique.withColumn("chunk", F.pmod(F.xxhash64("sha"), F.lit(chunks)).cast("int")).repartition(chunks, "chunk")
    bucketed.write.option("compression", "zstd").bucketBy(chunks, "chunk").saveAsTable(name)
    texts = spark.table(name).select("chunk", "doc", "sha", "text")
    try:
        # Columnar and in the shared folder: what comes back no longer needs the bucketed table.
        path = scratch_path(spark, "suffix-kept")
        kept = _without_repeats(texts, chunks, length, gram, with_text, hot)
        kept.write.option("compression", "zstd").parquet(path)
        done = spark.read.schema(kept.schema).parquet(path)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    joined = narrow.join(firsts.select("sha", F.col("doc").alias("first")), "sha").join(done, "sha")
    later = F.col("doc") > F.col("first")
    copy = later & (F.col("n_bytes") >= length)
    columns = [
        F.col("id").alias(id_column),
        "n_bytes",
        F.when(copy, F.col("n_bytes")).when(later, 0).otherwise(F.col("removed")).alias("n_removed"),
        F.when(copy, 1).when(later, 0).otherwise(F.col("spans")).cast("long").alias("n_spans"),
        F.when(copy, F.sha2(F.lit("").cast("binary"), 256)).when(later, F.col("sha")).otherwise(F.col("digest")).alias("kept_sha256"),
    ]
    if with_text:
        # A later copy shorter than the length loses nothing, nor did the first one.
        columns += [F.when(copy, F.lit("")).otherwise(F.col("kept")).alias("kept_text"), "sha"]
    return joined.select(*columns)


def _without_repeats(texts: DataFrame, parts: int, length: int, gram: int, with_text: bool, hot: int) -> DataFrame:
    """``sha``, ``removed``, ``spans``, ``digest``, ``kept`` of each text of the chunks."""

    def grams_of(chunk: pa.Table) -> pa.Table:
        """The chunk's gram hashes by part, sorted, and how often it has each."""
        _, found = _texts(chunk)
        each = [anchors(group, length, gram)[4] for _, group in pieces_of(found, PIECE)]
        keys, count = np.unique(np.concatenate(each), return_counts=True) if each else (np.zeros(0, np.uint64), np.zeros(0, int))
        part = (keys % np.uint64(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        keys, count, part = keys[order], count[order], part[order]
        cuts = np.flatnonzero(np.diff(part)) + 1
        number = chunk.column("chunk")[0].as_py()
        out = [(number, int(p[0]), k.tobytes(), c.astype(np.uint32).tobytes()) for p, k, c in zip(np.split(part, cuts), np.split(keys, cuts), np.split(count, cuts)) if len(p)]
        return pa.table([pa.array([r[i] for r in out], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.binary(), pa.binary()))], names=["chunk", "part", "keys", "more"])

    hashes = texts.groupBy("chunk").applyInArrow(grams_of, "chunk int, part int, keys binary, more binary")

    def shared_of(part: pa.Table) -> pa.Table:
        """The hashes that occur more than once in all, for each chunk that has them."""
        number, blobs, more = (part.column(c).to_pylist() for c in ("chunk", "keys", "more"))
        keys = np.frombuffer(b"".join(blobs), np.uint64)
        owner = np.repeat(np.arange(len(blobs)), [len(b) // 8 for b in blobs])
        _, place, count = np.unique(keys, return_inverse=True, return_counts=True)
        total = np.bincount(place, np.frombuffer(b"".join(more), np.uint32), len(count))
        keep = (total > 1)[place]
        keys, owner, many = keys[keep], owner[keep], (total > hot)[place][keep]
        cuts = np.flatnonzero(np.diff(owner)) + 1
        out = [(number[o[0]], k.tobytes(), k[m].tobytes()) for o, k, m in zip(np.split(owner, cuts), np.split(keys, cuts), np.split(many, cuts)) if len(o)]
        return pa.table([pa.array([r[i] for r in out], t) for i, t in enumerate((pa.int32(), pa.binary(), pa.binary()))], names=["chunk", "keys", "hot"])

    # Cut, as it is looked at for hot grams first: a few bytes per anchor.
    shared = cut(hashes.groupBy("part").applyInArrow(shared_of, "chunk int, keys binary, hot binary"))
    any_hot = bool(shared.where("octet_length(hot) > 0").head(1))

    def runs_of(key: tuple, chunk: pa.Table, known: pa.Table) -> pa.Table:
        """Sorted runs of the chunk's suffixes at anchors with a shared gram, by part; part -1 has spans found within the chunk, part -2 the windows of hot grams."""
        number = key[0].as_py()
        out: list[tuple[int, bytes, bytes]] = []
        if chunk.num_rows and known.num_rows:
            doc, found = _texts(chunk)
            keys = np.sort(np.frombuffer(b"".join(known.column("keys").to_pylist()), np.uint64))
            first: dict[tuple, tuple] = {}
            spans: list[tuple[int, int, int]] = []
            bases, groups = [], []
            for base, group in pieces_of(found, PIECE):
                bases.append(base)
                groups.append(group)
                text, place, low, high, value = anchors(group, length, gram)
                at = np.minimum(np.searchsorted(keys, value), len(keys) - 1)
                keep = keys[at] == value
                for t, a, i, j, v in zip(*(x[keep].tolist() for x in (text, place, low, high, value))):
                    row = base + t
                    data = group[t]
                    context = (data[a : j + length], data[i:a], a - j)
                    mine = (doc[row], a, row, v, i, j)
                    old = first.setdefault(context, mine)
                    if old is mine:
                        continue
                    # Of two equal contexts the later one is covered whole; versions of a document at the same place both stay.
                    if old[:2] == mine[:2]:
                        first[*context, row] = mine
                        continue
                    if mine[:2] < old[:2]:
                        first[context] = mine
                    spans.append((max(mine, old)[2], max(mine, old)[4], max(mine, old)[5] + length))
            many = set(np.frombuffer(b"".join(known.column("hot").to_pylist()), np.uint64).tolist())
            # Windows of hot grams: hashed and settled group by group, and sent as they are.
            held: dict[int, list] = {}
            for (right, left, *_), (d, _, row, v, i, j) in first.items():
                if v in many:
                    held.setdefault(bisect.bisect_right(bases, row) - 1, []).append((row, i, j))
            for number_of, rows in sorted(held.items()):
                group = groups[number_of]
                least, found_here = window_spans(hashed_windows(group, rows, doc, bases[number_of], length), length)
                spans += found_here
                for at in range(0, len(least), WINDOWS):
                    some = least[at : at + WINDOWS]
                    places = np.stack([np.full(len(some), number), some["doc"], some["place"], some["row"]], 1)
                    out.append((-2, np.ascontiguousarray(some["sha"]).view("S1").tobytes(), places.astype(np.int64).tobytes()))
            by_part: dict[int, list] = {}
            for (right, left, near, *_), (d, a, row, v, _, _) in first.items():
                if v not in many:
                    by_part.setdefault(v % parts, []).append((right, left, d, row, a, number, near))
            del first
            out += [(p, Run.pack(sorted(records)), b"") for p, records in by_part.items()]
            if spans:
                out.append((-1, b"", np.array([(number, *s) for s in spans], np.int64).tobytes()))
        return pa.table([pa.array([number] * len(out), pa.int32()), *(pa.array([r[i] for r in out], t) for i, t in enumerate((pa.int32(), pa.binary(), pa.binary())))], names=["chunk", "part", "run", "spans"])

    runs = cut(texts.groupBy("chunk").cogroup(shared.groupBy("chunk")).applyInArrow(runs_of, "chunk int, part int, run binary, spans binary"))

    def by_chunk(spans: list[tuple[int, int, int, int]]) -> pa.Table:
        found = np.array(spans, np.int64).reshape(-1, 4)
        found = found[np.argsort(found[:, 0], kind="stable")]
        cuts = np.flatnonzero(np.diff(found[:, 0])) + 1
        out = [(int(s[0, 0]), s[:, 1:].tobytes()) for s in np.split(found, cuts) if len(s)]
        return pa.table([pa.array([r[0] for r in out], pa.int32()), pa.array([r[1] for r in out], pa.binary())], names=["chunk", "spans"])

    def merged(part: pa.Table) -> pa.Table:
        spans: list[tuple[int, int, int, int]] = []
        group: list[tuple] = []
        for known, record in merge([Run(r) for r in part.column("run").to_pylist()]):
            if group and known < gram:
                if len(group) > 1:
                    spans.extend(repeated(group, length))
                group = []
            group.append(record)
        if len(group) > 1:
            spans.extend(repeated(group, length))
        return by_chunk(spans)

    between = runs.where("part >= 0").select("part", "run").groupBy("part").applyInArrow(merged, "chunk int, spans binary")
    # A span of a chunk's own begins with the number of the chunk; the others don't.
    inside = runs.where("part = -1").select("chunk", "spans")

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.frombuffer(s, np.int64).reshape(-1, 4)[:, 1:].tobytes() for s in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["chunk", "spans"])

    spans = between.unionByName(inside.mapInArrow(own, "chunk int, spans binary"))

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row per window of the hot grams."""
        for batch in batches:
            for windows, places in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                each = np.frombuffer(places, np.int64).reshape(-1, 4)
                hashed = pa.array([windows[i : i + 32] for i in range(0, len(windows), 32)], pa.binary())
                yield pa.RecordBatch.from_arrays([hashed, *(pa.array(c) for c in each.T.copy())], ["window", "chunk", "doc", "place", "row"])

    def covered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chunk, row, place = (c.to_numpy() for c in batch.columns)
            found = np.stack([chunk, row, place, place + length], 1)
            yield from by_chunk(found).to_batches()

    if any_hot:
        # At most a row per window and group of texts: equal windows of a group are settled there. Minima are combined before the shuffle.
        each = runs.where("part = -2").select("run", "spans").mapInArrow(opened, "window binary, chunk long, doc long, place long, row long")
        each = each.withColumn("at", F.struct("doc", "place"))
        least_of = each.groupBy("window").agg(F.min("at").alias("least"))
        # Both sides are shuffled: joined by broadcast, a task would have the Python workers of both functions at once.
        lost = each.join(least_of.hint("merge"), "window").where(F.col("at") > F.col("least")).select("chunk", "row", "place")
        spans = spans.unionByName(lost.mapInArrow(covered, "chunk int, spans binary"))

    def cut_out(key: tuple, chunk: pa.Table, found: pa.Table) -> pa.Table:
        chunk = chunk.sort_by([("doc", "ascending"), ("sha", "ascending")])
        data = [t.encode("utf-8", "surrogatepass") for t in chunk.column("text").to_pylist()]
        cover = np.frombuffer(b"".join(found.column("spans").to_pylist()), np.int64).reshape(-1, 3)
        cover = cover[np.argsort(cover[:, 0], kind="stable")]
        bounds = np.searchsorted(cover[:, 0], np.arange(len(data) + 1))
        removed, n_spans, digest, text = [], [], [], []
        for row, value in enumerate(data):
            mine = cover[bounds[row] : bounds[row + 1]]
            kept = value
            count = 0
            if len(mine):
                depth = np.zeros(len(value) + 1, np.int64)
                np.add.at(depth, mine[:, 1], 1)
                np.add.at(depth, mine[:, 2], -1)
                gone = np.cumsum(depth[:-1]) > 0
                count = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                kept = np.frombuffer(value, np.uint8)[~gone].tobytes()
            removed.append(len(value) - len(kept))
            n_spans.append(count)
            digest.append(hashlib.sha256(kept).hexdigest())
            text.append(kept.decode("utf-8", "ignore") if with_text else None)
        return pa.table([chunk.column("sha"), pa.array(removed, pa.int64()), pa.array(n_spans, pa.int64()), pa.array(digest, pa.string()), pa.array(text, pa.string())], names=["sha", "removed", "spans", "digest", "kept"])

    return texts.groupBy("chunk").cogroup(spans.groupBy("chunk")).applyInArrow(cut_out, "sha string, removed long, spans long, digest string, kept string")
