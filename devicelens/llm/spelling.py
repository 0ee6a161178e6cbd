"""Spelling variants: words one edit apart, found by search schemes over a bidirectional FM-index.

If two words differ by one edit, one half of the first stands unchanged in the second: its first half at the start or its second
half at the end. So words are dealt twice, by their first and by their last three letters, into shards; a shard holds the FM-index of
its words, each between delimiters, and that of the mirrored text. A search matches the whole half from its inner edge to the
delimiter, then turns round and goes on across the other half with one error. Both steps keep the same suffix-rank interval
in both indexes, and all words of a shard are searched at once.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devicelens.session import cut, stored

#: Letters of a word: those of ASCII, and what stands between U+00C0 and U+00FF.
RUN = "[A-Za-zÀ-ÿ]+"
#: Letters that two words share at an end if an unchanged half has at least so many; words are at least twice as long.
EDGE = 3
#: Code points of a shard's words; what is beyond it at one key is searched part by part.
SHARD = 300_000
#: Different words, and code points of them, that a task keeps before it hands their counts on; and the longest piece of a text.
KEPT_WORDS, KEPT_CHARS, PIECE = 200_000, 8_000_000, 1_000_000
#: Codes of the text's end and of the delimiter.
END, DELIMITER = 0, 1
_LOWER = {u: u + 32 for u in range(ord("A"), ord("Z") + 1)}


def pieces(text: str, run: re.Pattern, size: int = PIECE) -> Iterator[str]:
    """The text in pieces of about ``size``, none of which ends inside a run."""
    at = 0
    while at < len(text):
        end = at + size
        if end < len(text):
            inside = run.match(text, end)
            end = inside.end() if inside else end
        yield text[at:end]
        at = end


def count_words(docs: DataFrame, slip: int = 0, shortest: int = 6, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``word, n``: how often each run of letters occurs, A-Z in lower case, of at least ``shortest`` code points.

    With ``slip`` a run whose ``crc32("<id>:<run>")`` it divides loses one code point, that at the sum's remainder by the run's
    length. A null text has no words, a null id is empty. Counts are summed per task first.
    """

    def run_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, total, chars = re.compile(RUN), Counter(), 0

        def handed_on() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"])
            total.clear()
            return made

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                start = zlib.crc32(b":" if doc is None else f"{doc}:".encode())
                for piece in pieces(text or "", run):
                    for word, n in Counter(run.findall(piece)).items():
                        word = word.lower() if word.isascii() else word.translate(_LOWER)
                        if slip:
                            h = zlib.crc32(word.encode(), start)
                            if h % slip == 0:
                                word = word[: h % len(word)] + word[h % len(word) + 1 :]
                        if len(word) >= shortest:
                            chars += len(word) if word not in total else 0
                            total[word] += n
                    if len(total) > KEPT_WORDS or chars > KEPT_CHARS:
                        chars = 0
                        yield handed_on()
        if total:
            yield handed_on()

    return docs.select(id_column, F.col(text_column).cast("string")).mapInArrow(run_counts, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


# --- the index ------------------------------------------------------------------------------------------------------


def suffix_order(text: np.ndarray, width: int) -> np.ndarray:
    """Places of all suffixes in order, by prefix doubling; symbols have ``width`` bits and the last is unique."""
    n, known = len(text), max(1, 62 // width)
    key = np.zeros(n, np.int64)
    padded = np.concatenate([text.astype(np.int64), np.zeros(known, np.int64)])
    for k in range(known):
        key = (key << width) | padded[k : k + n]
    while True:
        order = np.argsort(key, kind="stable")
        ranked = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(ranked[1:] != ranked[:-1])])
        if rank[order[-1]] == n - 1:
            return order
        after = np.zeros(n, np.int64)
        if known < n:
            after[: n - known] = rank[known:] + 1
        key, known = rank * (n + 1) + after, known * 2


class Wavelet:
    """Wavelet matrix of a text: for many ranges at once, where a symbol's occurrences go and how many symbols are smaller."""

    def __init__(self, codes: np.ndarray, width: int):
        self.width, self.ones, self.zeros = width, [], []
        first = np.searchsorted(np.sort(codes), np.arange(1 << width))
        for bit in range(width - 1, -1, -1):
            one = (codes >> bit) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(one)]).astype(np.int32))
            self.zeros.append(len(codes) - int(one.sum()))
            codes = np.concatenate([codes[one == 0], codes[one == 1]])
        symbols = np.arange(1 << width)
        self.shift = np.zeros(1 << width, np.int64)
        nothing = np.zeros(len(symbols), np.int64)
        self.shift = first - self._down(nothing, nothing, symbols)[0]

    def _down(self, low, high, symbol):
        smaller = np.zeros(len(low), np.int64)
        for ones, zeros, bit in zip(self.ones, self.zeros, range(self.width - 1, -1, -1)):
            a, b = ones[low], ones[high]
            one = ((symbol >> bit) & 1).astype(bool)
            smaller += np.where(one, (high - low) - (b - a), 0)
            low, high = np.where(one, zeros + a, low - a), np.where(one, zeros + b, high - b)
        return low, high, smaller

    def step(self, low, high, symbol):
        """Rank interval of the symbol put before each range's strings, and how many symbols of the range are smaller."""
        at = self.shift[symbol]
        low, high, smaller = self._down(low, high, symbol)
        return low + at, high + at, smaller

    def all_steps(self, low, high):
        """As :meth:`step` for every symbol that occurs in a range: place of the range, symbol, interval, smaller ones."""
        place, symbol, smaller = np.arange(len(low)), np.zeros(len(low), np.int64), np.zeros(len(low), np.int64)
        for ones, zeros in zip(self.ones, self.zeros):
            a, b = ones[low], ones[high]
            left = (high - low) - (b - a)
            z, o = left > 0, b > a
            place = np.concatenate([place[z], place[o]])
            symbol = np.concatenate([symbol[z] * 2, symbol[o] * 2 + 1])
            smaller = np.concatenate([smaller[z], (smaller + left)[o]])
            low, high = np.concatenate([(low - a)[z], (zeros + a)[o]]), np.concatenate([(high - b)[z], (zeros + b)[o]])
        at = self.shift[symbol]
        return place, symbol, low + at, high + at, smaller


class TwoWayIndex:
    """FM-indexes of delimited words and of their mirror image. A state is an interval in each, of one size."""

    def __init__(self, words: list[str]):
        letters = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        self.alphabet = np.unique(letters)
        length = np.fromiter(map(len, words), np.int64, len(words))
        self.starts = np.concatenate([[0], np.cumsum(length + 1)])
        text = np.full(self.starts[-1] + 2, DELIMITER, np.int64)
        text[np.delete(np.arange(len(text) - 1), self.starts)] = self.coded(letters)
        text[-1] = END
        width = int(len(self.alphabet) + DELIMITER + 1).bit_length()
        self.order = suffix_order(text, width)
        mirror = np.concatenate([text[-2::-1], [END]])
        self.sides = (Wavelet(text[self.order - 1], width), Wavelet(mirror[suffix_order(mirror, width) - 1], width))
        self.size = len(text)

    def coded(self, letters: np.ndarray) -> np.ndarray:
        """Codes in code-point order; a letter that no word has gets the last code, which occurs nowhere."""
        place = np.searchsorted(self.alphabet, letters)
        known = self.alphabet[np.minimum(place, len(self.alphabet) - 1)] == letters
        return np.where(known, place, len(self.alphabet)) + DELIMITER + 1

    def extend(self, side: int, state, symbol):
        """The states with the symbol put at that side (0: before, 1: after); a state is a pair of lower ends and a size."""
        lows, size = state
        low, high, smaller = self.sides[side].step(lows[side], lows[side] + size, symbol)
        other = lows[1 - side] + smaller
        return ((low, other) if side == 0 else (other, low)), high - low

    def branch(self, side: int, state):
        """The states with any letter put at that side: place of the state before, letter, state."""
        lows, size = state
        place, symbol, low, high, smaller = self.sides[side].all_steps(lows[side], lows[side] + size)
        letter = symbol > DELIMITER
        place, symbol, low, high = place[letter], symbol[letter], low[letter], high[letter]
        other = lows[1 - side][place] + smaller[letter]
        return place, symbol, ((low, other) if side == 0 else (other, low)), high - low

    def word_at(self, low: np.ndarray) -> np.ndarray:
        """The word that the suffix of that rank starts with, delimiter first."""
        return np.searchsorted(self.starts, self.order[low])


def _kept(which, of, lows, size):
    return of[which], (lows[0][which], lows[1][which]), size[which]


def one_error(index: TwoWayIndex, words: np.ndarray, exact: int, side: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``words`` (codes, all of one length) and the index's words that differ from them by one edit behind the first ``exact`` letters.

    With ``side`` 1 rows are read as they are and the half that may differ lies to the right; with ``side`` 0 rows are mirrored.
    Edits that give the same word are tried once: a letter of a run is left out at the run's start and put in at its end.
    """
    length = words.shape[1]
    start = np.zeros(len(words), np.int64)
    state = ((start, start), np.full(len(words), index.size))
    for k in range(exact - 1, -1, -1):
        state = index.extend(1 - side, state, words[:, k])
    lows, size = index.extend(1 - side, state, np.full(len(words), DELIMITER))
    of, lows, size = _kept(size > 0, np.arange(len(words)), lows, size)
    pool = [(of[:0], (lows[0][:0], lows[1][:0]), size[:0])]
    for k in range(exact, length + 1):
        last = k == length
        here = np.full(len(of), DELIMITER) if last else words[of, k]
        # A letter put in before place k, then those that replace the one at k.
        place, letter, put, put_size = index.branch(side, (lows, size))
        other = letter != here[place]
        pool.append(_kept(other, of[place], put, put_size))
        waiting = tuple(np.concatenate(x) for x in ([p[0] for p in pool], [p[1][0] for p in pool], [p[1][1] for p in pool], [p[2] for p in pool]))
        who = waiting[0]
        symbol = np.full(len(who), DELIMITER) if last else words[who, k]
        gone, gone_size = index.extend(side, ((waiting[1], waiting[2]), waiting[3]), symbol)
        pool = [_kept(gone_size > 0, who, gone, gone_size)]
        if last:
            break
        pool.append(_kept(other, of[place], put, put_size))
        first = np.ones(len(of), bool) if k == exact else here != words[of, k - 1]
        pool.append(_kept(first, of, lows, size))
        lows, size = index.extend(side, (lows, size), here)
        of, lows, size = _kept(size > 0, of, lows, size)
    who, found, _ = pool[0]
    pairs = np.unique(np.stack([who, index.word_at(found[0])]), axis=1)
    return pairs[0], pairs[1]


def near_words(indexed: list[str], asked: list[str], last: bool, index: TwoWayIndex | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Places (in ``asked``, in ``indexed``) of the words one edit apart whose first half (``last``: only their second half) stands unchanged."""
    none = np.zeros(0, np.int64)
    if not indexed or not asked:
        return none, none
    index = index or TwoWayIndex(indexed)
    length = np.fromiter(map(len, asked), np.int64, len(asked))
    left, right = [none], [none]
    for n in np.unique(length):
        rows = np.nonzero(length == n)[0]
        letters = np.frombuffer("".join(asked[r] for r in rows).encode("utf-32-le"), np.uint32).reshape(len(rows), n)
        codes, half = index.coded(letters), int(n) // 2
        who, found = one_error(index, codes[:, ::-1] if last else codes, int(n) - half if last else half, 0 if last else 1)
        if last:
            good = np.fromiter((asked[rows[w]][:half] != indexed[f][:half] for w, f in zip(who, found)), bool, len(who))
            who, found = who[good], found[good]
        left.append(rows[who])
        right.append(found)
    return np.concatenate(left), np.concatenate(right)


# --- over all words ---------------------------------------------------------------------------------------------------


def near_pairs(words: DataFrame, shard: int = SHARD) -> DataFrame:
    """``word, near, near_n``: each word of ``words`` (word, n; no word twice) with each other that is one edit away.

    Words shorter than six code points are not searched. Shards of an end's letters hold at most about ``shard`` code points: ends that have
    more are cut into parts, and each part is asked for the words of each.
    """
    words = words.where(F.length("word") >= 2 * EDGE)
    ends = F.array(
        F.struct(F.lit(False).alias("last"), F.substring("word", 1, EDGE).alias("edge")), F.struct(F.lit(True).alias("last"), F.substring("word", -EDGE, EDGE).alias("edge"))
    )
    dealt = words.select("word", "n", F.explode(ends).alias("end")).select("word", "n", "end.last", "end.edge")
    loads = cut(dealt.groupBy("last", "edge").agg(F.sum(F.length("word") + 1).alias("chars")))
    shards = int(-(-2 * (loads.agg(F.sum("chars")).first()[0] or 0) // shard)) or 1
    loads = loads.select("last", "edge", F.ceil(F.col("chars") / shard).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("word"), F.col("parts")).cast("int")
    row = lambda i, j, index, ask: F.struct(i.alias("i"), j.alias("j"), index.alias("index"), ask.alias("ask"))
    as_index = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda j: row(part, j, F.lit(True), j == part))
    as_question = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda i: row(i, part, F.lit(False), F.lit(True)))
    rows = F.when(F.col("parts") == 1, F.array(row(F.lit(0), F.lit(0), F.lit(True), F.lit(True)))).otherwise(
        F.concat(as_index, F.filter(as_question, lambda r: r["i"] != r["j"]))
    )
    shard_of = F.when(F.col("parts") == 1, F.concat(F.lit("#"), F.pmod(F.xxhash64("edge"), F.lit(shards)).cast("string"))).otherwise(F.col("edge"))
    placed = dealt.join(loads, ["last", "edge"]).select("word", "n", "last", shard_of.alias("shard"), F.explode(rows).alias("row"))
    placed = placed.select("word", "n", "last", "shard", "row.i", "row.j", "row.index", "row.ask")

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        index, asked = pdf[pdf["index"]], pdf[pdf["ask"]]
        indexed, questions = index["word"].tolist(), asked["word"].tolist()
        who, found = near_words(indexed, questions, bool(pdf["last"].iloc[0]))
        n = index["n"].to_numpy()
        return pd.DataFrame({"word": [questions[w] for w in who], "near": [indexed[f] for f in found], "near_n": n[found] if len(found) else np.zeros(0, np.int64)})

    return placed.groupBy("last", "shard", "i", "j").applyInPandas(search, "word string, near string, near_n long")


def roots(forms: DataFrame) -> DataFrame:
    """``word, root``: the last word that is reached from each word along ``form`` (word, form; no circles), by doubled steps."""
    up = cut(forms.select("word", F.col("form").alias("root")))
    while True:
        above = up.select(F.col("word").alias("root"), F.col("root").alias("above"))
        up = cut(up.join(above, "root", "left").select("word", F.coalesce("above", "root").alias("root"), F.col("above").isNotNull().alias("moved")))
        moved = up.agg(F.max("moved")).first()[0]
        up = up.select("word", "root")
        if not moved:
            return up


def spelling_groups(docs: DataFrame, least: int = 5, shortest: int = 6, ratio: int = 5, slip: int = 0, shard: int = SHARD, **columns: str) -> DataFrame:
    """``word, n, form, form_n, n_near, root`` of every word of ``docs`` with at least ``shortest`` code points and ``least`` occurrences.

    ``n_near`` counts the words one inserted, deleted or replaced code point away. ``form`` is the most frequent of them (ties: the
    smallest in code-point order) if it occurs at least ``ratio`` times as often, else null; ``root`` ends the chain of forms that starts at
    the word. ``ratio`` is above 1, so that a chain ends, and ``shortest`` at least 6. Words are those of :func:`count_words`; null
    and empty texts have none, an empty table gives no rows, a repeated row counts again.
    """
    if ratio <= 1 or shortest < 2 * EDGE:
        raise ValueError(f"ratio must be above 1 and shortest at least {2 * EDGE}")
    words = stored(count_words(docs, slip, shortest, **columns).where(F.col("n") >= least), "words")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form")))
    near = near_pairs(words, shard).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    far = words.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.col("best.form").alias("form"), (-F.col("best.less")).alias("form_n"))
    enough = F.col("form_n") >= F.lit(ratio) * F.col("n")
    far = stored(far.select("word", "n", "n_near", F.when(enough, F.col("form")).alias("form"), F.when(enough, F.col("form_n")).alias("form_n")), "forms")
    ends = roots(far.where("form is not null"))
    return far.join(ends, "word", "left").select("word", "n", "form", "form_n", "n_near", F.coalesce("root", "word").alias("root"))
