"""Byte-level BPE as a transducer: encoding with bounded lookahead, decoding in a stream.

A sequence of tokens is the BPE encoding of its bytes if and only if each adjacent pair is *stable*:
encoding the bytes of the two tokens gives the same two tokens back. So the encodings of all texts are
the paths of a nondeterministic transducer: a configuration is (last token, node of the token trie),
reading a byte goes down the trie, and where the node is a token stable after the last one, the path
may also emit it and go back to the root. :class:`Transducer` determinises that machine lazily, state
by state as texts need them. A state is a set of configurations, each with the tokens it still owes;
what all of them owe in common is emitted at once. As every prefix has one encoding, a state never has
more configurations than the longest token has bytes: that is the bound of the lookahead. Making a state costs
as much as many steps of its configurations, and most steps of rare words are needed once only. So a step near the end of
a piece is determinised at its ``NEEDS``-th need; before, the configurations go to that end by themselves.

Whether a pair is stable is read off the two tokens' histories: how the last part of the one and the first part of
the other grow, and at which rank each merge comes.

Texts are cut by the pattern first; pieces are encoded separately, so the machine starts anew in each.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from devicelens.llm.support import Memo, worker_memo

#: A worker forgets its known words or pieces at so many bytes, its machine states (about 700 bytes each) or stable pairs at so many; they are
#: made again on demand.
MEMO_WORDS, MEMO_PIECES, MEMO_STATES, MEMO_PAIRS = 100 << 20, 40 << 20, 120_000, 400_000
#: Bytes that configurations may go by themselves, and needs of a step before it is determinised; the cost of a pair that never merges.
STRETCH, NEEDS, NEVER = 64, 64, 1 << 40
#: Bytes of token ids that wait in a worker before they are handed on.
HELD = 2 << 20
LACKING = "the ranks lack a token for a byte or for a step of a merge"


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a ``.tiktoken`` file: a token in base64 and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


class _State(dict):
    """A state of the machine: byte to (next state, emitted tokens), or to how often texts needed the step so far."""

    __slots__ = ("configurations", "final")

    def __init__(self, configurations: tuple):
        self.configurations, self.final = configurations, None


class Transducer:
    """The lazily determinised machine of a table of ranks."""

    def __init__(self, ranks: dict[bytes, int], memo: float = 1.0):
        self.ranks, self.memo = ranks, memo
        self.token = {r: t for t, r in ranks.items()}
        # The trie: a child by node and byte, a token (or -1) and whether anything is below by node; the root is 0.
        self.child: dict[int, int] = {}
        self.ends, self.inner, self.depth = [-1], [True], [0]
        for token, rank in ranks.items():
            node = 0
            for byte in token:
                self.inner[node] = True
                key = node << 8 | byte
                node = self.child.get(key, 0)
                if not node:
                    node = self.child[key] = len(self.ends)
                    self.ends.append(-1)
                    self.inner.append(False)
                    self.depth.append(self.depth[key >> 8] + 1)
            self.ends[node] = rank
        # By token: its length, and the longest other token that it begins with (or -1). Nodes come after their parents.
        self.sizes, self.shorter = [0] * (max(self.token, default=-1) + 1), [-1] * (max(self.token, default=-1) + 1)
        above = [-1] * len(self.ends)
        for key, node in self.child.items():
            parent = key >> 8
            above[node] = self.ends[parent] if self.ends[parent] >= 0 else above[parent]
            if self.ends[node] >= 0:
                self.sizes[self.ends[node]], self.shorter[self.ends[node]] = self.depth[node], above[node]
        self.stable_pairs: dict[int, bool] = {}
        self.histories: dict[int, tuple | None] = {}
        self._clear()

    def _clear(self) -> None:
        first = ((-1, 0, ()),)
        self.start = _State(first)
        self.number: dict[tuple, _State] = {first: self.start}

    def _state(self, configurations: tuple) -> _State:
        found = self.number.get(configurations)
        if found is None:
            if len(self.number) >= MEMO_STATES * self.memo:
                self._clear()  # also within a piece: the state it is in goes on by itself
            found = self.number[configurations] = _State(configurations)
        return found

    def merge(self, data: bytes, steps: list | None = None) -> list[int]:
        """Plain BPE: join the adjacent pair of lowest rank until no pair has one. ``steps`` gets each merge's rank, first and last part."""
        get = self.ranks.get
        parts = [data[i : i + 1] for i in range(len(data))]
        costs = [get(a + b, NEVER) for a, b in zip(parts, parts[1:])]
        while costs:
            best = min(costs)
            if best == NEVER:
                break
            at = costs.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del costs[at]
            if at < len(costs):
                costs[at] = get(parts[at] + parts[at + 1], NEVER)
            if at:
                costs[at - 1] = get(parts[at - 1] + parts[at], NEVER)
            if steps is not None:
                steps.append((best, parts[0], parts[-1]))
        return [self.ranks[p] for p in parts]

    def _history(self, token: int) -> tuple | None:
        """How the first and the last part of a token grow: each part with the rank of the merge that ends it.

        None if the token's merges do not come in the order of their ranks, or do not give the token.
        """
        data, steps = self.token[token], []
        if self.merge(data, steps) != [token] or any(a[0] > b[0] for a, b in zip(steps, steps[1:])):
            found = None
        else:
            found = []
            for side, part in ((1, data[:1]), (2, data[-1:])):
                grown = []
                for step in steps:
                    if step[side] != part:
                        grown.append((part, step[0]))
                        part = step[side]
                found.append((*grown, (part, NEVER)))
            found = tuple(found)
        self.histories[token] = found
        return found

    def _stable(self, left: int, right: int) -> bool:
        """Whether the bytes of two tokens are encoded as these tokens.

        Until a merge goes across the border, both sides merge as they would alone, the lower rank first, the left side at a tie. So the pair
        is stable if at no time the two parts at the border have a lower rank than the merge that ends one of them; between two
        ends of parts ranks only rise.
        """
        histories = self.histories
        one = histories[left] if left in histories else self._history(left)
        two = histories[right] if right in histories else self._history(right)
        if one is None or two is None:
            found = self.merge(self.token[left] + self.token[right]) == [left, right]
        else:
            get, ends, starts = self.ranks.get, iter(one[1]), iter(two[0])
            (a, until), (b, up_to) = next(ends), next(starts)
            while True:
                across = get(a + b, NEVER)
                if until <= up_to:
                    if across < until or until == NEVER:
                        found = across == NEVER
                        break
                    a, until = next(ends)
                elif across <= up_to:
                    found = False
                    break
                else:
                    b, up_to = next(starts)
        self.stable_pairs[left << 32 | right] = found
        return found

    def advance(self, configurations: tuple, byte: int) -> tuple[_State, tuple[int, ...]]:
        """Make the step of a state on a byte: the next state, and what is emitted."""
        child, ends, inner, pairs = self.child, self.ends, self.inner, self.stable_pairs
        moved, owing = [], True
        for last, node, owed in configurations:
            node = child.get(node << 8 | byte, 0)
            if not node:
                continue
            token = ends[node]
            if token >= 0:
                good = last < 0 or pairs.get(last << 32 | token)
                if good or (good is None and self._stable(last, token)):
                    moved.append((token, 0, (*owed, token)))
            if inner[node]:
                moved.append((last, node, owed))
                owing = owing and owed
        emitted: tuple[int, ...] = ()
        if moved and owing:
            shortest = min([m[2] for m in moved], key=len)
            common = len(shortest)
            while common and any(m[2][:common] != shortest[:common] for m in moved):
                common -= 1
            if common:
                emitted = shortest[:common]
                moved = [(last, node, owed[common:]) for last, node, owed in moved]
        return self._state(tuple(moved)), emitted

    def _to_end(self, configurations: tuple, data: bytes) -> tuple[int, ...]:
        """What configurations still emit up to the end of a piece, without states.

        Each goes down the trie as far as it can and emits the longest token that is stable; where no way goes on from there, the next
        shorter one. As every prefix has one encoding, no place is entered twice.
        """
        child, ends, pairs, sizes, shorter = self.child.get, self.ends, self.stable_pairs.get, self.sizes, self.shorter
        size = len(data)
        entered = bytearray(size + 1)
        for last, node, owed in reversed(configurations):
            trail, at, rest = [], -self.depth[node], data
            while True:
                token = -1
                for byte in rest:
                    node = child(node << 8 | byte, 0)
                    if not node:
                        break
                    if ends[node] >= 0:
                        token = ends[node]
                while True:
                    end = at + sizes[token] if token >= 0 else 0
                    if end <= 0:
                        if not trail:
                            break
                        at, last, token = trail.pop()
                    elif not entered[end]:
                        good = last < 0 or pairs(last << 32 | token)
                        if good or (good is None and self._stable(last, token)):
                            break
                    token = shorter[token]
                if end <= 0:
                    break
                trail.append((at, last, token))
                if end == size:
                    return (*owed, *[step[2] for step in trail])
                entered[end] = 1
                at, last, node, rest = end, token, 0, data[end:]
        raise ValueError(LACKING)

    def encode(self, piece: bytes) -> list[int]:
        """Tokens of one piece."""
        if len(self.stable_pairs) > MEMO_PAIRS * self.memo:
            self.stable_pairs.clear()
        out: list[int] = []
        state, size = self.start, len(piece)
        for at, byte in enumerate(piece):
            move = state.get(byte, 0)
            if move.__class__ is int:
                if move + 1 < NEEDS and size - at <= STRETCH:
                    state[byte] = move + 1
                    out += self._to_end(state.configurations, piece[at:])
                    return out
                move = state[byte] = self.advance(state.configurations, byte)
            state, emitted = move
            if emitted:
                out += emitted
        if state.final is None:
            ends = [owed for _, node, owed in state.configurations if not node]
            if len(ends) != 1:
                raise ValueError(LACKING)
            state.final = ends[0]
        out += state.final
        return out

    def lookahead(self) -> int:
        """The most bytes that any state made so far has read past what it emitted."""
        return max(self.depth[node] + sum(len(self.token[t]) for t in owed) for s in self.number for _, node, owed in s)


class Utf8Stream:
    """Decodes a stream of byte chunks; a character cut by a chunk's end waits for the next chunk.

    The state is the unfinished sequence (three bytes at most): what is complete is decoded at once.
    Malformed bytes become U+FFFD, as ``errors="replace"`` does for whole texts.
    """

    def __init__(self) -> None:
        self.rest = b""

    @staticmethod
    def unfinished(data: bytes) -> int:
        """How many bytes at the end begin a sequence that more bytes could complete."""
        for back in range(1, min(3, len(data)) + 1):
            byte = data[-back]
            if byte >= 0xC0:
                need = 2 if 0xC2 <= byte < 0xE0 else 3 if 0xE0 <= byte < 0xF0 else 4 if 0xF0 <= byte < 0xF5 else 0
                if need <= back:
                    return 0
                if back > 1:
                    low, high = {0xE0: (0xA0, 0xBF), 0xED: (0x80, 0x9F), 0xF0: (0x90, 0xBF), 0xF4: (0x80, 0x8F)}.get(byte, (0x80, 0xBF))
                    if not low <= data[1 - back] <= high:
                        return 0
                return back
            if byte < 0x80:
                return 0
        return 0

    def feed(self, chunk: bytes) -> str:
        data = self.rest + chunk
        wait = self.unfinished(data)
        self.rest = data[len(data) - wait :] if wait else b""
        return data[: len(data) - wait].decode("utf-8", "replace")

    def close(self) -> str:
        rest, self.rest = self.rest, b""
        return rest.decode("utf-8", "replace")


def decode_stream(token_bytes: list[bytes], ids: Iterable[int], tokens_per_chunk: int = 65_536) -> Iterator[bytes]:
    """Bytes of the tokens in chunks."""
    chunk: list[bytes] = []
    for i in ids:
        chunk.append(token_bytes[i])
        if len(chunk) >= tokens_per_chunk:
            yield b"".join(chunk)
            chunk = []
    yield b"".join(chunk)


def decode_text(token_bytes: list[bytes], ids: Iterable[int], tokens_per_chunk: int = 65_536) -> str:
    """The text of the tokens, decoded chunk by chunk."""
    stream = Utf8Stream()
    return "".join([stream.feed(c) for c in decode_stream(token_bytes, ids, tokens_per_chunk)]) + stream.close()


#: Fixed value: the pattern for which words separated by single spaces can be cut apart first.
PATTERN_OF_WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

class Codec:
    """Encoder and decoder of a rank table and a pattern.

    No piece goes past a space that has another character on each side which isn't white space, so such
    texts are looked up word by word, each with the space before it; only new words are cut by the pattern.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str, memo: float = 1.0):
        import regex

        self.machine = Transducer(ranks, memo)
        # In the pattern's dialect white space is the Unicode property; Python's own class has four more characters.
        exact = pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")
        self.cut = regex.compile(exact).findall
        self.by_words = pattern == PATTERN_OF_WORDS
        self.pieces = Memo(self._piece, int(MEMO_PIECES * memo))
        self.words = Memo(self._word, int(MEMO_WORDS * memo))
        self.token_bytes = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.token_bytes[rank] = token

    def _piece(self, piece: str) -> bytes:
        return array("I", self.machine.encode(piece.encode("utf-8", "surrogatepass"))).tobytes()

    def _word(self, word: str) -> bytes | None:
        """Ids of a word and the space before it; none if white space is next to that space or to the next one.

        The piece that begins with the space is known as a word itself, or becomes one.
        """
        if not word or word[0].isspace() or word[-1].isspace():
            return None
        if word.isascii() and word.isalpha():
            return self._piece(" " + word)
        first, *rest = self.cut(" " + word)
        if not rest:
            return self._piece(first)
        known = self.words[first[1:]]
        return (self.pieces[first] if known is None else known) + b"".join(map(self.pieces.__getitem__, rest))

    def _whole(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, self.cut(text)))

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if self.by_words:
            first, *rest = text.split(" ")
            found = list(map(self.words.__getitem__, rest))
            if first and not first[-1].isspace() and None not in found:
                return self._whole(first) + b"".join(found)
        return self._whole(text)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.token_bytes.__getitem__, memoryview(ids).cast("I").tolist()))


def encoded(codec: Codec, batch: pa.RecordBatch, id_column: str, with_ids: bool = True) -> Iterator[pa.RecordBatch]:
    """Results for a batch of ids and texts, handed on whenever they hold ``HELD`` bytes of token ids."""
    names = [id_column, "n_tokens", "ids_sha256", "decoded_sha256", "decoded_chars", *["ids"] * with_ids]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()][: len(names) - 1]
    start, held, found = 0, 0, []
    for row, text in enumerate(batch.column(1), 1):
        ids = codec.encode(text.as_py() or "")
        stream, digest, count = Utf8Stream(), hashlib.sha256(), 0
        for at in range(0, len(ids), 1 << 20):
            chunk = codec.decode(ids[at : at + (1 << 20)])
            digest.update(chunk)
            count += len(stream.feed(chunk))
        count += len(stream.close())
        found.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), digest.hexdigest(), count, ids if with_ids else b""))
        held += len(ids)
        if held >= HELD or row == batch.num_rows:
            columns = [pa.array(values, kind) for values, kind in zip(zip(*found), kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, len(found)), *columns], names)
            start, held, found = row, 0, []


def encode_documents(docs: DataFrame, ranks: dict[bytes, int], pattern: str, id_column: str = "doc_id", text_column: str = "text", with_ids: bool = True, memo: float = 1.0) -> DataFrame:
    """One row per document: its ids and the digests of ids and decoded text.

    A null text is the empty text: no ids, and the digests of zero bytes. Each row stands for itself, so
    repeated rows give repeated results, a null id stays null, and an empty table gives no rows. Only the
    two named columns are read, so other columns may have any name. The rank table (one vocabulary, fixed
    size) is broadcast; a worker builds its machine once and keeps it. ``memo`` scales what it may remember: less takes
    less memory and more time, and changes no result.

    Columns: the id, ``n_tokens`` long, ``ids_sha256``, ``decoded_sha256`` string, ``decoded_chars`` long
    (code points that the streaming decoder gave), and ``ids`` binary (little-endian 32-bit) if asked for.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(ranks)
    name = f"bpe-{hashlib.sha256(repr((sorted(ranks.items())[:2000], len(ranks), pattern, memo)).encode()).hexdigest()}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = worker_memo(name, lambda: Codec(shared.value, pattern, memo))
        for batch in batches:
            yield from encoded(codec, batch, id_column, with_ids)

    narrow = docs.select(id_column, text_column)
    kind = narrow.schema[id_column].dataType.simpleString()
    schema = f"`{id_column}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string, decoded_chars long" + (", ids binary" if with_ids else "")
    return narrow.mapInArrow(run, schema)
