"""Toxicity of texts whose writers hide words: restore by a noisy channel, then score.

A writer's word goes through a channel that swaps letters for look-alikes, puts marks or spaces between letters,
and repeats letters. Words that show such traces become a lattice: each character may stand for several
letters or for none, at a cost. Viterbi decoding finds the likeliest reading under a character language model, whose
counts of four characters in a row come from all documents. A logistic model over words and word beginnings
scores the text together with what was restored.
"""

from __future__ import annotations

import heapq
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devicelens.llm.quality import labelled_sample
from devicelens.llm.support import Memo, fold, forget_memo, worker_memo
from devicelens.session import cut

#: Symbols of the language model: 0 is a word's edge, 1-26 are a-z, 27 is any other letter.
SYMBOLS = 28
#: The letters that each look-alike may stand for.
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i",
}
#: Marks that may stand between letters, and those that may also hide one.
MARKS, WILD = set(".-_~=/\\,;:'`^·​‌‍­*#%&"), set("*#%&")
#: Log costs of the channel: a look-alike, a mark dropped, a mark for a hidden letter.
SWAP, DROP, HIDE = -0.7, -0.3, -4.0
#: Log costs of keeping or dropping a letter that equals the one before: in a pair, as second and as later letter of a longer run.
PAIR, SECOND, LATER = (0.0, -8.0), (-0.7, -0.5), (-4.0, -0.1)
#: The same for a pair where a writer doubles letters, and where no pair is a repeat; such readings stand beside the plain one.
DOUBLED, KEPT = (-1.0, -1.0), (0.0, -np.inf)
#: Labelled documents that the scorer is fitted on, at most, and features that it may use.
FIT_DOCUMENTS, FEATURES = 10_000, 600
#: Bytes of known tokens that a worker keeps, and contexts that decoding follows at each character.
MEMO, BEAM = 24 << 20, 256
_EDGE = "\"'`.,;:!?()[]{}<>*#%&$|~_-+=/\\«»“”‘’¿¡…"
_PLAIN = re.compile(r"[^\W\d_]+\Z")
_TWICE = re.compile(r"([^\W\d_])\1")
_THRICE = re.compile(r"([^\W\d_])\1\1")
_TWICE_ALIKE = re.compile(rf"([{re.escape(''.join(LOOKALIKES))}])\1")
_RUN = re.compile(rb"\x01{2,}")
#: Edge characters that stand for no letter.
_PUNCT = "".join(c for c in _EDGE if c not in LOOKALIKES)


def _symbols() -> np.ndarray:
    """Symbol of each code point below 0x250; letters with marks count as letters of their own class."""
    out = np.zeros(0x251, np.int64)
    for c in range(0x250):
        s = chr(c).lower()
        out[c] = ord(s) - 96 if "a" <= s <= "z" and len(s) == 1 else 27 if s.isalpha() else 0
    out[0x250] = 27
    return out


def symbol(letter: str) -> int:
    return ord(letter) - 96 if "a" <= letter <= "z" else 27


def count_grams(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """``gram``, ``n``: how often each four symbols follow each other, over all rows; each task sends its sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_memo()
        table, total = _symbols(), np.zeros(SYMBOLS**4, np.int64)
        for batch in batches:
            held, size = [], 0
            for i, text in enumerate(batch.column(0)):
                held.append(text.as_py() or "")
                size += len(held[-1])
                if size > 1_000_000 or i + 1 == batch.num_rows:
                    codes = np.frombuffer(("   " + "    ".join(held) + "   ").encode("utf-32-le", "surrogatepass"), np.uint32)
                    s = table[np.minimum(codes, 0x250)]
                    total += np.bincount(((s[:-3] * SYMBOLS + s[1:-2]) * SYMBOLS + s[2:-1]) * SYMBOLS + s[3:], minlength=SYMBOLS**4)
                    held, size = [], 0
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])], ["gram", "n"])

    return docs.select(text_column).mapInArrow(run, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n"))


class Letters:
    """The language model: log probability of a symbol after the three before it, backing off to fewer."""

    def __init__(self, counts: np.ndarray):
        c4 = counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS, SYMBOLS).astype(float)
        c3, c2, c1 = c4.sum(0), c4.sum((0, 1)), c4.sum((0, 1, 2))
        p = (c1 + 1) / (c1.sum() + SYMBOLS)
        p = (c2 + 5 * p) / (c2.sum(-1, keepdims=True) + 5)
        p = (c3 + 5 * p) / (c3.sum(-1, keepdims=True) + 5)
        p = (c4 + 5 * p) / (c4.sum(-1, keepdims=True) + 5)
        self.log = memoryview(np.log(p).astype(np.float32).ravel())

    def decode(self, word: str, pair: tuple[float, float] = PAIR, hide: bool = True, firm: bool = False) -> str:
        """The likeliest reading of a word of letters, look-alikes and marks, by Viterbi over its lattice.

        At each character the ``BEAM`` likeliest contexts are followed; without marks that hide letters there are never so many.

        A space between letters may be dropped or be the edge of a word, which then is a space of the reading. ``pair`` has
        the costs of the letters of a pair; without ``hide`` a mark stands for no letter; ``firm`` look-alikes are letters,
        but for those that often are punctuation.
        """
        beam: dict[int, tuple[float, tuple]] = {0: (0.0, ())}  # last three symbols to (score, letters as (those before, last))
        before = ""
        for place, c in enumerate(word):
            ways: list[tuple[str, float]] = []
            if c.isalpha():
                if c != before:
                    ways.append((c, 0.0))
                else:
                    third = word[place - 2 : place - 1] == c
                    keep, drop = LATER if third else SECOND if word[place + 1 : place + 2] == c else pair
                    ways += [(c, keep), ("", drop)]
            elif c == " ":
                ways += [("", DROP), (" ", 0.0)]
            else:
                ways += [(x, SWAP) for x in LOOKALIKES.get(c, "")]
                if c in MARKS or c in ("!(" if firm else "$!|(+"):
                    ways.append(("", DROP if c in MARKS else SWAP + DROP))
                if c in WILD and hide:
                    ways += [(chr(x), HIDE) for x in range(97, 123)]
                if c == before and c in LOOKALIKES:
                    longer = word[place - 2 : place - 1] == c or word[place + 1 : place + 2] == c
                    ways.append(("", SECOND[1] if longer else pair[1]))
                if not ways:
                    ways.append(("", DROP))
            grown: dict[int, tuple[float, tuple]] = {}
            for context, (score, letters) in beam.items():
                for letter, cost in ways:
                    if letter:
                        at = context * SYMBOLS + (0 if letter == " " else symbol(letter))
                        key, value = at % SYMBOLS**3, score + cost + self.log[at]
                    else:
                        key, value = context, score + cost
                    if key not in grown or grown[key][0] < value:
                        grown[key] = (value, (letters, letter) if letter else letters)
            if len(grown) > BEAM:  # only where marks hide letters: each opens 26 ways
                grown = dict(heapq.nlargest(BEAM, grown.items(), key=lambda x: (x[1][0], -x[0])))
            beam, before = grown, c
        letters = max((score + self.log[context * SYMBOLS], context, letters) for context, (score, letters) in beam.items())[2]
        out = []
        while letters:
            letters, letter = letters
            out.append(letter)
        return "".join(out[::-1])


def strip_edges(token: str) -> str:
    """The token without punctuation at its ends; one look-alike mark at either end stays, runs of them go."""
    core = token.strip(_EDGE)
    if not core:
        return ""
    start = token.find(core)
    lead, tail = token[:start], token[start + len(core) :]
    keep_lead = lead if len(lead) == 1 and lead in "@$(|¡" else ""
    keep_tail = tail if len(tail) == 1 and tail in "@$|+" else ""
    return keep_lead + core + keep_tail


def readings(token: str, letters: Letters) -> list[str]:
    """The words that a token (in lower case) may stand for: what stands there, and what is restored if it looks changed.

    Look-alikes at the ends are read both as punctuation and as letters, doubled letters both as written and as repeats.
    """
    core, full = strip_edges(token), token.strip(_PUNCT)
    if not any(c.isalpha() or c in LOOKALIKES for c in full):
        return []
    mostly = sum(map(str.isalpha, core)) * 3 >= len(core) and "://" not in core
    # Of a word in pieces only the longer pieces are words; in a number or an address all of them may be.
    out = [core] if _PLAIN.match(core) else [x for x in re.findall(r"[^\W\d_]+", core) if len(x) > 2 or not mostly]
    # A long mask between few letters hides what no lattice can tell: there marks are dropped only.
    if core and (not _PLAIN.match(core) or _THRICE.search(core)):
        out.append(letters.decode(core, hide=mostly))
    if _TWICE.search(core) or _TWICE_ALIKE.search(core):
        out.append(letters.decode(core, DOUBLED, mostly))
    if full != core or _TWICE_ALIKE.search(full) or any(c in "$|+" for c in full):
        out += [letters.decode(full, pair, mostly, True) for pair in (KEPT, DOUBLED)]
    return list(dict.fromkeys(x for x in out if x))


def alone(token: str) -> str:
    """The only character of a token besides punctuation at its ends, if there is one."""
    for edge in (_PUNCT, _EDGE):
        core = token.strip(edge)
        if len(core) == 1:
            return core
    return ""


def features(word: str) -> list[str]:
    return [word, word[:4] + "*", word[:5] + "*"] if len(word) >= 6 else [word]


class Restorer:
    """Features of whole texts; keeps the readings of changed tokens it has met, up to a bound."""

    def __init__(self, letters: Letters, known: dict[str, int] | None = None):
        self.letters, self.known = letters, known
        self.memo = Memo(lambda token: self._of_words(readings(token, letters)), MEMO)
        self.starts = None if known is None else {f[:4].rstrip("*") for f in known}

    def _of_words(self, words: list[str]) -> tuple:
        found = [f for word in words for f in features(word)]
        return tuple(found if self.known is None else [self.known[f] for f in found if f in self.known])

    def of_text(self, text: str | None) -> set:
        """Distinct features of a text: of each word, and of words spelled with spaces between their letters."""
        text = (text or "").lower()
        tokens = text.split()
        out: set = set()
        starts = self.starts
        lone: dict[str, str] = {}  # tokens of one character, besides punctuation, and that character
        for token in set(tokens):
            if len(token) == 1:
                lone[token] = token
            elif not token.isalpha() and (letter := alone(token)):
                lone[token] = letter
            core = token if token.isalpha() else token.strip(_PUNCT)
            if core.isalpha() and not _TWICE.search(core):
                if starts is None or core[:4] in starts:
                    out.update(self._of_words([core]))
            elif core:
                out.update(self.memo[core])
        single = bytes([t in lone for t in tokens]) if lone else b""
        for run in _RUN.finditer(single):
            self._spelled([lone[t] for t in tokens[run.start() : run.end()]], out)
        return out

    def _spelled(self, parts: list[str], out: set) -> None:
        """Add the features of what letters with spaces between them may spell: one word, or several."""
        if sum(p.isalpha() or p in LOOKALIKES for p in parts) < 2:
            return
        words = set(readings("".join(parts), self.letters))
        for spelled in " ".join(parts), " ".join(p for p in parts if p.isalpha() or p in LOOKALIKES):
            words.update(self.letters.decode(spelled).split())
        out.update(self._of_words(sorted(words)))


@dataclass
class Model:
    """The language model's counts, the features with their places, their weights and the bias."""

    counts: np.ndarray
    known: dict[str, int]
    weights: np.ndarray
    bias: float


def fit_logistic(rows: list[list[int]], labels: np.ndarray, size: int, penalty: float = 0.3, steps: int = 400) -> tuple[np.ndarray, float]:
    """Weights and bias of a penalised logistic model over sets of features, by accelerated gradient steps."""
    n = len(rows)
    width = np.array([len(r) for r in rows])
    flat = np.array([f for r in rows for f in r], dtype=np.int64)
    row = np.repeat(np.arange(n), width)
    scale = 4.0 / (1 + max(1, width.max(initial=1)))
    w, b = np.zeros(size), float(np.log((labels.sum() + 0.5) / (n - labels.sum() + 0.5)))
    pw, pb = w.copy(), b
    for step in range(steps):
        k = step / (step + 3)
        yw, yb = w + k * (w - pw), b + k * (b - pb)
        pw, pb = w, b
        z = yb + np.bincount(row, yw[flat], n)
        slope = (labels - 1 / (1 + np.exp(-np.clip(z, -30, 30)))) / n
        w = yw + scale * (np.bincount(flat, slope[row], size) - penalty / n * yw)
        b = yb + scale * slope.sum()
    return w, b


def fit_toxicity(docs: DataFrame, labels: DataFrame, most: int = FIT_DOCUMENTS, label: str = "toxic", id_column: str = "doc_id", text_column: str = "text") -> Model:
    """Count symbols over all of ``docs``; fit the scorer on at most ``most`` labelled documents.

    Features are chosen by how much more often they stand in documents of one label (chi square), counted by Spark;
    the driver gets the model's fixed table of counts, ``FEATURES`` names, and the sample's sets of places.
    """
    counts = np.zeros(SYMBOLS**4, np.int64)
    for r in count_grams(docs, text_column).toPandas().itertuples(index=False):
        counts[r.gram] = r.n
    letters_of = docs.sparkSession.sparkContext.broadcast(counts)

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(Letters(letters_of.value))
        for batch in batches:
            for text, y in zip(batch.column(0), batch.column(1)):
                found = sorted(restorer.of_text(text.as_py()))
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array([y.as_py()] * len(found), pa.int32())], ["feature", "y"])

    sample = cut(labelled_sample(docs, labels, label, most, id_column, text_column))
    n, positive = sample.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0))).first()
    bias = float(np.log((positive + 0.5) / (n - positive + 0.5)))
    if not 0 < positive < n:
        return Model(counts, {}, np.zeros(0), bias)
    seen = sample.mapInArrow(explode, "feature string, y int").groupBy("feature").agg(F.count("*").alias("all"), F.sum("y").alias("pos")).where("all >= 3")
    lift = F.pow(F.col("pos") - F.col("all") * (positive / n), 2) / (F.col("all") + 2.0)
    chosen = [r.feature for r in seen.orderBy(lift.desc(), "feature").limit(FEATURES).collect()]
    known = {f: i for i, f in enumerate(chosen)}

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(Letters(letters_of.value), known)
        for batch in batches:
            sets = [sorted(restorer.of_text(t.as_py())) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(sets, pa.list_(pa.int32())), batch.column(1)], ["places", "y"])

    rows = sorted((r.y, r.places) for r in sample.mapInArrow(places, "places array<int>, y int").collect())
    weights, bias = fit_logistic([p for _, p in rows], np.array([y for y, _ in rows], float), len(chosen))
    return Model(counts, known, weights, bias)


def score_toxicity(docs: DataFrame, model: Model, threshold: float = 0.5, id_column: str = "doc_id", text_column: str = "text", keep: bool = False) -> DataFrame:
    """The id, ``score`` and ``predicted`` (1 from the threshold on) of every row; with ``keep``, the rows of ``docs`` below the threshold.

    A null or empty text has no features: its score is the model's bias. Rows are scored one by one, so repeated rows
    get equal scores; an empty table gives no rows; columns that are not named are passed on (``keep``) or not read.
    """
    # Plain values: a broadcast names its classes, and executors need no copy of this package.
    shared = docs.sparkSession.sparkContext.broadcast((model.counts, model.known, model.weights.tolist(), model.bias))
    name = f"toxicity-{uuid.uuid4().hex}"

    def scores(texts: pa.Array) -> np.ndarray:
        counts, known, weights, bias = shared.value
        restorer = worker_memo(name, lambda: Restorer(Letters(counts), known))
        z = np.array([bias + sum([weights[i] for i in sorted(restorer.of_text(t.as_py()))]) for t in texts], dtype=float)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    if keep:
        place = docs.columns.index(text_column)

        def passed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array(scores(batch.column(place)) < threshold))

        return docs.mapInArrow(passed, docs.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = scores(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s), pa.array((s >= threshold).astype(np.int32))], [id_column, "score", "predicted"])

    narrow = docs.select(id_column, text_column)
    return narrow.mapInArrow(run, f"`{id_column}` {narrow.schema[id_column].dataType.simpleString()}, score double, predicted int")


def toxicity(docs: DataFrame, labels: DataFrame, most: int = FIT_DOCUMENTS) -> DataFrame:
    """Fit on rows out of the held-out fold (``crc32(doc_id) % 5 = 0``), score all rows."""
    model = fit_toxicity(docs, labels.where(fold(F.col("doc_id"), 5) != 0), most)
    return score_toxicity(docs, model).select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted")
