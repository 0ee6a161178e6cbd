"""BPE, SimHash, suffix dedup, mixing, toxicity and quality against brute force, exact round trips and held-out labels."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from devicelens.llm import bpe, mixing, quality, simhash, suffixes, toxicity
from devicelens.llm.components import components, lowest_labels
from devicelens.llm.support import auc, fold_of, table

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def fixture(spark, rows, schema="doc_id long, text string, source string, score double, component_id long"):
    """Rows (id, text, source) with two more columns whose names the results use too."""
    return spark.createDataFrame([(*r, 0.5, 7) for r in rows], schema).repartition(3)


ODD = [(1, "a b", "x"), (2, None, "x"), (3, "", None), (None, "a b", "y"), (4, "a b", "y"), (4, "a b", "y"), (5, "word " * 30_000, "x"), (6, " \t\n", None)]


# --- byte-level BPE ---------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def codec():
    import public_tokenizers

    return bpe.Codec(bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def tiktoken_encoding(codec):
    import public_tokenizers
    import tiktoken

    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.machine.ranks, special_tokens={})


def ids_of(blob):
    return np.frombuffer(blob, "<u4").tolist()


@pytest.mark.parametrize("alphabet", ["abthe 0123\n\t\x1c\x85 éß漢😀!?'sll  ", "abcdefghijklmnopqrstuvwxyz ", "a ", "\n \r\t.x", "'stremd ", "".join(map(chr, range(0x20, 0x2000, 7)))])
def test_bpe_equals_tiktoken(codec, tiktoken_encoding, alphabet):
    rng = random.Random(5)
    for _ in range(1_500):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40)))
        assert ids_of(codec.encode(text)) == tiktoken_encoding.encode_ordinary(text), repr(text)
        assert codec.decode(codec.encode(text)) == text.encode()


def test_bpe_forgets_and_makes_again(codec, tiktoken_encoding, monkeypatch):
    monkeypatch.setattr(bpe, "MEMO_STATES", 50)
    monkeypatch.setattr(bpe, "MEMO_PAIRS", 50)
    text = "Some antidisestablishmentarianism, internationalisation and words words."
    assert codec.machine.encode(text.split()[1].encode()) and ids_of(codec._whole(text)) == tiktoken_encoding.encode_ordinary(text)


def test_bpe_rare_words_make_few_states(codec, tiktoken_encoding):
    """What is needed once is not determinised, and a word is remembered once."""
    rng = random.Random(9)
    fresh = bpe.Codec(codec.machine.ranks, bpe.PATTERN_OF_WORDS)
    text = "The" + "".join(f" {''.join(rng.choice('aeinorstlé') for _ in range(rng.randint(5, 14)))}," for _ in range(3_000))
    assert ids_of(fresh.encode(text)) == tiktoken_encoding.encode_ordinary(text)
    assert len(fresh.machine.number) < 2_000 and len(fresh.pieces) < 50


def test_bpe_stable_pairs_equal_merges(codec):
    rng = random.Random(11)
    odd = {bytes([b]): i for i, b in enumerate(b"abcd")} | {t: 9 - i for i, t in enumerate([b"abc", b"bc", b"ab", b"cd", b"abcd"])}
    for ranks in (codec.machine.ranks, odd):
        machine = bpe.Transducer(ranks)
        names = list(machine.token)
        for _ in range(5_000):
            left, right = rng.choice(names), rng.choice(names)
            assert machine._stable(left, right) == (machine.merge(machine.token[left] + machine.token[right]) == [left, right])


def test_bpe_lookahead_is_bounded(codec):
    codec.encode("untold transubstantiation of incomprehensibilities")
    assert codec.machine.lookahead() <= 2 * max(map(len, codec.machine.ranks))


def test_utf8_stream_any_cut():
    rng = random.Random(2)
    for data in ["aé漢😀é".encode() * 3, bytes(rng.randrange(256) for _ in range(300)), b"\xf0\x9f", b"\xed\xa0\x80", b"\xe2\x28\xa1"]:
        for size in (1, 2, 3, 5):
            stream = bpe.Utf8Stream()
            got = "".join(stream.feed(data[i : i + size]) for i in range(0, len(data), size)) + stream.close()
            assert got == data.decode("utf-8", "replace")


def test_decode_text_in_chunks(codec):
    text = "漢字 and 😀 emoji " * 20
    assert bpe.decode_text(codec.token_bytes, ids_of(codec.encode(text)), 3) == text


def test_encode_documents_odd_rows(spark, codec, tiktoken_encoding):
    import public_tokenizers

    out = bpe.encode_documents(fixture(spark, ODD), codec.machine.ranks, public_tokenizers.PATTERN).toPandas()
    want = sorted((-1 if i is None else i, len(tiktoken_encoding.encode_ordinary(t or ""))) for i, t, _ in ODD)
    assert sorted((-1 if np.isnan(i) else int(i), n) for i, n in zip(out.doc_id, out.n_tokens)) == want
    empty = out[out.doc_id == 2].iloc[0]
    assert empty.ids_sha256 == empty.decoded_sha256 == hashlib.sha256(b"").hexdigest() and empty.ids == b""


def test_bpe_results_are_handed_on(codec):
    """A large batch is never held as a whole; rows keep their order and their ids."""
    import pyarrow as pa

    texts = ["some words " * 20_000, None, "a b"] * 40
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["doc_id", "text"])
    parts = list(bpe.encoded(codec, batch, "doc_id"))
    assert max(p.column("ids").nbytes for p in parts) < bpe.HELD + 200_000 < sum(p.column("ids").nbytes for p in parts)
    assert [i for p in parts for i in p.column("doc_id").to_pylist()] == list(range(len(texts)))
    assert [ids for p in parts for ids in p.column("ids").to_pylist()] == [codec.encode(t or "") for t in texts]
    assert not list(bpe.encoded(codec, batch.slice(0, 0), "doc_id"))


def test_op3_whole_table(spark, sf_dir, tiktoken_encoding):
    from devicelens.llm.queries import op3_byte_bpe

    got = {r.doc_id: r for r in op3_byte_bpe(spark, sf_dir).collect()}
    rows = table(spark, sf_dir, "documents").select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for r in rows:
        ids = np.array(tiktoken_encoding.encode_ordinary(r.text or ""), dtype="<u4").tobytes()
        assert got[r.doc_id].ids_sha256 == hashlib.sha256(ids).hexdigest()
        assert got[r.doc_id].decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()


# --- SimHash ----------------------------------------------------------------------------------------------------


def plain_fingerprint(text):
    """Bit by bit from the definition."""
    import re

    import xxhash

    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: bytes([m.group()[0] + 32]), (text or "").encode()))
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids, codes, distance=4):
    f = np.array(codes, np.uint64)
    i, j = np.nonzero(np.bitwise_count(f[:, None] ^ f[None, :]) <= distance)
    label = lowest_labels(len(f), i, j)
    low = {}
    for k, c in zip(ids, label):
        if k is not None:
            low[c] = min(low.get(c, k), k)
    return [low.get(c) for c in label]


def test_op5_whole_table(spark, sf_dir):
    from devicelens.llm.queries import op5_simhash

    rows = sorted((r.doc_id, r.text) for r in table(spark, sf_dir, "documents").collect())
    codes = [plain_fingerprint(t) for _, t in rows]
    got = {r.doc_id: r for r in op5_simhash(spark, sf_dir).collect()}
    for (i, _), code, component in zip(rows, codes, plain_components([i for i, _ in rows], codes)):
        assert (got[i].fingerprint, got[i].component_id) == (f"{code:016x}", component)


@pytest.mark.parametrize("tile", [100_000, 30])
def test_simhash_odd_rows_and_divided_keys(spark, tile):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(400)]
    base = [rng.choice(words) for _ in range(120)]
    rows = list(ODD)
    for i in range(150):
        text = base.copy()
        for _ in range(rng.randint(0, 3)):
            text[rng.randrange(len(text))] = rng.choice(words)
        rows.append((100 + i, " ".join(text), "z"))
    got = simhash.near_duplicates(fixture(spark, rows), tile=tile).collect()
    codes = [plain_fingerprint(t) for _, t, _ in rows]
    want = [(i, f"{c:016x}", k) for (i, _, _), c, k in zip(rows, codes, plain_components([r[0] for r in rows], codes))]
    assert sorted(map(str, want)) == sorted(str((r.doc_id, r.fingerprint, r.component_id)) for r in got)


def test_one_per_group_keys_rows_by_id_and_whole_text(spark):
    rng = random.Random(8)
    text = lambda: " ".join("".join(rng.choices("abcdefghij", k=6)) for _ in range(40))
    # Clean texts without an id whose hashes agree in the 31 bits that once were their stand-in id.
    low = {}
    for r in spark.range(200_000).select(F.concat(F.lit("t "), F.sha2(F.col("id").cast("string"), 256)).alias("t")).select("t", F.pmod(F.xxhash64("t"), F.lit(1 << 31)).alias("h")).collect():
        low.setdefault(r.h, []).append(r.t)
    twins = next(v for v in low.values() if len(v) > 1)
    near = text()
    versions = [(5, f"{near} {w}") for w in ("one", "two", "three", "four", "five", "six")]
    alone = [(5, text()) for _ in range(6)]
    rows = [(None, twins[0]), (None, twins[1]), (None, twins[1]), (1, near), *versions, *alone, (9, None), (None, ""), (8, "x y")]
    codes = [plain_fingerprint(t) for _, t in rows]
    f = np.array(codes, np.uint64)
    label = lowest_labels(len(f), *np.nonzero(np.bitwise_count(f[:, None] ^ f[None, :]) <= 4))
    least = {}
    for (i, t), c in zip(rows, label):
        mine = (i is None, i or 0, "" if t is None else hashlib.sha256(t.encode()).hexdigest(), i, t)
        least[c] = min(least.get(c, mine), mine)
    for parts in (1, 5):
        frame = spark.createDataFrame([(i, t, "s") for i, t in rows], "doc_id long, text string, source string").repartition(parts)
        got = simhash.one_per_group(frame)
        assert got.columns == frame.columns
        assert sorted(str((r.doc_id, r.text)) for r in got.collect()) == sorted(str(v[3:]) for v in least.values())


def test_forest_equals_brute_force(monkeypatch):
    rng = np.random.default_rng(0)
    for trial in range(25):
        monkeypatch.setattr(simhash, "SEARCHERS", int(rng.choice([5, 64, 8192])))
        n = int(rng.integers(1, 400))
        code = rng.integers(0, 2**63, max(1, n // 9), dtype=np.uint64)[rng.integers(0, max(1, n // 9), n)]
        for _ in range(trial % 6):
            code = code ^ (np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64))
        code = np.unique(code)
        a, b = simhash.forest(code, np.zeros(len(code), int), 4)
        place = {int(c): k for k, c in enumerate(code)}
        got = lowest_labels(len(code), np.array([place[int(x)] for x in a], int), np.array([place[int(x)] for x in b], int))
        i, j = np.nonzero(np.bitwise_count(code[:, None] ^ code[None, :]) <= 4)
        assert (got == lowest_labels(len(code), i, j)).all()


@pytest.mark.parametrize("distance,agree", [(4, 1), (4, 2), (4, 3)])
def test_groupings_meet_every_near_pair(distance, agree):
    rng = random.Random(1)
    masks = simhash.groupings(distance, agree)
    for _ in range(300):
        differ = sum(1 << b for b in rng.sample(range(64), distance))
        assert any(differ & m == 0 for m in masks)


@pytest.mark.parametrize("kind", ["chain", "star", "random", "none"])
def test_components(spark, kind):
    rng = random.Random(3)
    edges = {"chain": [(i, i + 1) for i in range(200)], "star": [(500, i) for i in range(200)], "random": [(rng.randrange(90), rng.randrange(90)) for _ in range(70)], "none": []}[kind]
    frame = spark.createDataFrame([*edges, (None, 3), (8, 8)], "a long, b long").repartition(5)
    got = {r.node: r.component for r in components(frame).collect()}
    real = [(a, b) for a, b in edges if a != b]
    label = lowest_labels(600, np.array([a for a, _ in real], int), np.array([b for _, b in real], int))
    assert got == {v: int(label[v]) for e in real for v in e}


# --- suffix dedup -----------------------------------------------------------------------------------------------


def plain_repeats(rows, length):
    docs = [(suffixes.NO_ID if i is None else i, (t or "").encode()) for i, t in rows]
    first = {}
    for d, b in docs:
        for s in range(len(b) - length + 1):
            w = b[s : s + length]
            first[w] = min(first.get(w, (d, s)), (d, s))
    out = []
    for (i, _), (d, b) in zip(rows, docs):
        gone = np.zeros(len(b), bool)
        for s in range(len(b) - length + 1):
            if (d, s) > first[b[s : s + length]]:
                gone[s : s + length] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        out.append((i, len(b), int(gone.sum()), int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(map(str, out))


@pytest.mark.parametrize("length,gram,chunk", [(40, 12, 300), (30, 7, 100_000), (100, 32, 1_500)])
def test_suffix_dedup_equals_brute_force(spark, length, gram, chunk):
    rng = random.Random(length)
    pool = ["".join(rng.choices("abcdefgh é", k=rng.randint(20, 120))) for _ in range(6)]
    rows = []
    for i in range(25):
        parts = [rng.choice(pool) if rng.random() < 0.6 else "".join(rng.choices("xyz ü", k=rng.randint(0, 40))) for _ in range(rng.randint(0, 7))]
        rows.append((rng.choice([i, i, i, max(0, i - 1), None]), "".join(parts)))
    rows += [*rows[:3], (90, None), (91, ""), (7777, "Und " * 400), (3, "Und " * 100)]
    frame = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, n_bytes int, sha int").repartition(4)
    got = suffixes.remove_repeats(frame, length, gram, chunk_bytes=chunk).collect()
    assert sorted(str(tuple(r)) for r in got) == plain_repeats(rows, length)


@pytest.mark.parametrize("hot,chunk", [(0, 700), (3, 300), (15, 1_500), (15, 100_000)])
def test_suffix_dedup_of_a_gram_in_very_many_contexts(spark, hot, chunk):
    """A common phrase with other words around it in most texts, whole passages that come again, and versions of one id."""
    rng = random.Random(hot + chunk)
    phrase, passage = "the phrase that stands in nearly all texts ", "a passage of some length with the phrase that stands in nearly all texts of it "
    rows = []
    for i in range(60):
        left, right = ("".join(rng.choices("xyz ü", k=rng.randint(0, 60))) for _ in range(2))
        rows.append((rng.choice([i, i, max(0, i - 1), None]), left + rng.choice([phrase, phrase, passage]) + right))
    rows += [*rows[:3], (7, "more " + rows[5][1]), (7, "some " + rows[5][1]), (3, passage * 3)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = suffixes.remove_repeats(frame, 60, 20, chunk_bytes=chunk, hot=hot).collect()
    assert sorted(str(tuple(r)) for r in got) == plain_repeats(rows, 60)


def test_op9_whole_table(spark, sf_dir):
    from devicelens.llm.queries import op9_suffix_dedup

    rows = [(r.doc_id, r.text) for r in table(spark, sf_dir, "documents").collect()]
    assert sorted(str(tuple(r)) for r in op9_suffix_dedup(spark, sf_dir).collect()) == plain_repeats(rows, 100)


def test_merge_of_runs_never_loses_a_prefix():
    rng = random.Random(2)
    for _ in range(200):
        runs, every = [], []
        for c in range(rng.randint(0, 7)):
            records = sorted((bytes(rng.choices(b"ab", k=rng.randint(1, 8))), b"", rng.randint(0, 9), 0, 0, c, 0) for _ in range(rng.randint(0, 9)))
            every += [r[0] for r in records]
            runs.append(suffixes.Run(suffixes.Run.pack(records)))
        got = list(suffixes.merge(runs))
        assert [r[0] for _, r in got] == sorted(every)
        for (known, b), (_, a) in zip(got[1:], got):
            assert known == suffixes.common(a[0], b[0], 0)


# --- mixing -----------------------------------------------------------------------------------------------------


def plain_targets(sizes, weights=(1, 2, 3), passes=3):
    """Round by round: what is above a limit is shared out again."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    fixed, total = {}, sum(sizes.values())
    while True:
        rest, free = total - sum(fixed.values()), [s for s in order if s not in fixed]
        share = {s: rest * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if share[s] > passes * sizes[s]]
        if not over:
            return fixed | share
        fixed |= {s: passes * sizes[s] for s in over}


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 5, "c": 1}, {"a": 10, None: 90, "b": 0, "é": 3, "z": 1}, {"a": 7}, {"x": 0}, {str(i): (i * 37) % 101 for i in range(25)}])
def test_targets(spark, sizes):
    got = {r.source: r.target for r in mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()}
    want = plain_targets(sizes)
    assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-6 for s in want)


@pytest.mark.parametrize("n", [1, 2, 7, 64, 1000])
def test_permutation(spark, n):
    rows = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("long"), F.lit(3), F.lit("k")).alias("p")).collect()
    assert sorted(r.p for r in rows) == list(range(n))


def test_mixed_odd_rows_and_reruns(spark):
    rng = random.Random(1)
    rows = [*ODD, *((100 + i, "w " * rng.randint(0, 300), rng.choice(["x", "y", "z", None, "é"])) for i in range(200))]
    frame = fixture(spark, rows)
    got = sorted(map(str, mixing.mixed(frame, block=16).collect()))
    assert got == sorted(map(str, mixing.mixed(frame.repartition(7), block=16).collect()))
    out = mixing.mixed(frame, block=16).toPandas()
    assert len(out) == len(rows) and (out.taken <= 3 * out["size"]).all()
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want = plain_targets(sizes)
    source = {i: s for i, _, s in rows}
    for name, target in want.items():
        mine = out[[source[None if np.isnan(i) else int(i)] == name for i in out.doc_id]]
        assert np.allclose(mine.target, target) and abs(mine.taken.sum() - target) <= 0.02 * target + 32


def test_mixed_documents_takes_what_mixed_says(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    taken = {r.doc_id: r.taken for r in mixing.mixed(docs).collect() if r.taken}
    got = {}
    rows = mixing.mixed_documents(docs)
    assert rows.columns == docs.columns
    for r in rows.collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + len(r.text.split())
        assert r.n_chars == len(r.text)
    assert got == taken


def test_mixing_needs_no_python(spark, sf_dir):
    plan = mixing.mixed(table(spark, sf_dir, "documents"))._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))


# --- toxicity and quality ---------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def scored(spark):
    """Both operators over the whole sf0.01 tables, with labels."""
    from devicelens.llm.queries import op6_toxicity, op10_quality

    sf_dir = "/root/testdata/sf0.01"
    labels = table(spark, sf_dir, "labels").toPandas()
    return {label: (q(spark, sf_dir).toPandas(), labels) for label, q in (("toxic", op6_toxicity), ("quality", op10_quality))}


@pytest.mark.parametrize("label,modulus,rest,least", [("toxic", 5, 0, 0.75), ("quality", 4, 2, 0.97)])
def test_held_out(scored, label, modulus, rest, least):
    out, labels = scored[label]
    assert len(out) == 1000 and out.score.between(0, 1).all()
    assert (out.held_out == [fold_of(i, modulus) == rest for i in out.doc_id]).all()
    held = out[out.held_out].merge(labels, on="doc_id")
    assert auc(held[label].to_numpy(), held.score.to_numpy()) > least
    assert (out.predicted == (out.score >= (0.5 if label == "toxic" else 0.7))).all()


def test_letters_restore_hidden_words(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    counts = np.zeros(toxicity.SYMBOLS**4, np.int64)
    for r in toxicity.count_grams(docs).collect():
        counts[r.gram] = r.n
    letters = toxicity.Letters(counts)
    for hidden, word in [("1d10t", "idiot"), ("m0r0n", "moron"), ("tra$h", "trash"), ("i.d.i.o.t", "idiot"), ("cl0wn", "clown"), ("l-o-s-e-r", "loser"), ("idiiiiot", "idiot"), ("sc_um", "scum")]:
        assert word in toxicity.readings(hidden, letters), hidden
    assert toxicity.readings("thing", letters) == ["thing"]
    restorer = toxicity.Restorer(letters)
    assert "idiot" in restorer.of_text("you i d i o t there") and restorer.of_text(None) == set()


@pytest.fixture(scope="module")
def letters(spark):
    counts = np.zeros(toxicity.SYMBOLS**4, np.int64)
    for r in toxicity.count_grams(table(spark, "/root/testdata/sf0.01", "documents")).collect():
        counts[r.gram] = r.n
    return toxicity.Letters(counts)


@pytest.mark.parametrize("text,words", [("what a m o r o n he is", "moron"), ("s c u m i d i o t", "scum idiot"), ("an i d i o t.", "idiot"), ("so s t u p i d, man", "stupid"), ("m . o . r . o . n!", "moron"), ("I a m a n i d i o t", "idiot")])
def test_spaced_words_beside_others(letters, text, words):
    assert set(words.split()) <= toxicity.Restorer(letters).of_text(text)


@pytest.mark.parametrize("hidden,word", [("1d107", "idiot"), ("h473", "hate"), ("i...d...i...o...t", "idiot"), ("iiddiioott", "idiot"), ("sttuppidd", "stupid"), ("idioot", "idiot"), ("a$$", "ass"), ("a$$!", "ass"), ("$$cum", "scum"), ("id!ot!!", "idiot")])
def test_no_token_is_kept_from_the_lattice(letters, hidden, word):
    restorer = toxicity.Restorer(letters)
    assert word in toxicity.readings(hidden, letters) and word in restorer.of_text(f"so {hidden}, he said")


@pytest.mark.parametrize("token,plain", [("letter", "letter"), ("10000km", "km"), ("(word", "word"), ("word!!", "word"), ("http://a.example/moron", "moron"), ("i##########d", "id")])
def test_plain_readings_stay(letters, token, plain):
    assert plain in toxicity.readings(token, letters)
    assert not toxicity.readings("--*--", letters)


def test_grams_count_everything(spark):
    rows = spark.createDataFrame([("ab",), (None,), ("",), ("ab",), ("é1 zz" * 10,)], "text string").repartition(2)
    total = sum(r.n for r in toxicity.count_grams(rows).collect())
    assert total >= 2 * 5 and total > 0


@pytest.mark.parametrize("op", [toxicity.toxicity, quality.quality])
def test_classifiers_odd_rows(spark, op):
    labels = spark.createDataFrame([(1, 0, 0), (4, 1, 1), (5, 1, None), (None, 1, 1), (4, 1, 1), (77, 0, 1), (2, 0, 1)], "doc_id long, quality int, toxic int")
    out = op(fixture(spark, ODD), labels).toPandas()
    assert len(out) == len(ODD) and out.score.between(0, 1).all()
    assert out[out.doc_id == 4].score.nunique() == 1
    nothing = op(fixture(spark, ODD), labels.limit(0)).toPandas()
    assert len(nothing) == len(ODD) and nothing.score.notna().all()


def test_field_marginals_equal_enumeration():
    from itertools import product

    rng = np.random.default_rng(0)
    width = len(quality.EDGES)
    field = quality.Field(rng.normal(size=(3, width, quality.BINS)), 0.3, rng.normal(size=(2, 2)))
    bins, lines = rng.integers(0, 7, (9, width)).astype(np.uint8), np.array([4, 1, 0, 4])
    near = quality.beside(bins, lines)
    good, moves = quality.marginals(field, near, lines)
    want_moves, at = np.zeros((2, 2)), 0
    for n in lines:
        score = [field.bias + sum(field.emit[s, f, near[s, at + i, f]] for s in range(3) for f in range(width)) for i in range(n)]
        weights = {y: np.exp(sum(s for s, v in zip(score, y) if v) + sum(field.move[a, b] for a, b in zip(y, y[1:]))) for y in product((0, 1), repeat=int(n))}
        z = sum(weights.values())
        for i in range(n):
            assert abs(good[at + i] - sum(w for y, w in weights.items() if y[i]) / z) < 1e-9
        for y, w in weights.items():
            for a, b in zip(y, y[1:]):
                want_moves[a, b] += w / z
        at += n
    assert np.allclose(moves, want_moves)


# --- empty tables -----------------------------------------------------------------------------------------------


def test_empty_tables(spark):
    import public_tokenizers

    docs = spark.createDataFrame([], DOCS)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    results = [
        bpe.encode_documents(docs, ranks, public_tokenizers.PATTERN), simhash.near_duplicates(docs), simhash.one_per_group(docs), suffixes.remove_repeats(docs),
        mixing.mixed(docs), mixing.mixed_documents(docs), toxicity.toxicity(docs, labels), quality.quality(docs, labels),
    ]
    assert [r.count() for r in results] == [0] * len(results)


# --- bounds of memory -----------------------------------------------------------------------------------------------


def test_memo_is_bounded_in_bytes():
    from devicelens.llm.support import Memo

    memo = Memo(lambda k: k.encode(), 10_000)
    for i in range(1_000):
        assert memo[f"word {i}"] == f"word {i}".encode()
    assert len(memo) <= 10_000 // Memo.ENTRY and memo.size <= 10_000
    assert memo["x" * 5_000] == b"x" * 5_000 and "x" * 5_000 not in memo


def test_bpe_counts_states_inside_a_piece(codec, tiktoken_encoding, monkeypatch):
    monkeypatch.setattr(bpe, "MEMO_STATES", 3_000)
    rng = random.Random(7)
    text = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(60_000))
    codec.machine._clear()
    assert ids_of(codec._whole(text)) == tiktoken_encoding.encode_ordinary(text)
    assert len(codec.machine.number) <= 3_000


def test_chunk_of_hot_grams_only(spark):
    """Every gram is hot: all windows go by their hashes, and the result is that of the merged runs."""
    rng = random.Random(8)
    base = "".join(rng.choice("abcd ") for _ in range(2_000))
    docs = [(i, base[rng.randrange(900) :][: rng.randint(150, 1_200)], "x") for i in range(60)]
    frame = fixture(spark, docs)
    plain, hot = (suffixes.remove_repeats(frame, chunk_bytes=9_000, hot=h).toPandas().sort_values("doc_id").reset_index(drop=True) for h in (suffixes.HOT, 0))
    assert plain.equals(hot) and plain.n_removed.sum() > 10_000


def test_labelled_sample_is_bounded(spark):
    docs = spark.createDataFrame([(1, f"text {i % 40}") for i in range(3_000)] + [(2, "other"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (3, 1)], "doc_id long, toxic int")
    assert quality.labelled_sample(docs, labels, "toxic", 10).count() == 10
    assert quality.labelled_sample(docs, labels, "toxic", 1_000).count() == 42


def test_beam_finds_the_best_of_all_readings(spark):
    """Against every path through the lattice of short words, and in bounded time on a long mask."""
    import itertools
    import time

    counts = np.zeros(toxicity.SYMBOLS**4, np.int64)
    for word in ["idiot", "hello", "stupid", "moron", "silly", "the", "boot"] * 50:
        symbols = [0, 0, 0, *[ord(c) - 96 for c in word], 0]
        for a in zip(symbols, symbols[1:], symbols[2:], symbols[3:]):
            counts[((a[0] * 28 + a[1]) * 28 + a[2]) * 28 + a[3]] += 1
    letters = toxicity.Letters(counts)

    def cost(word):
        symbols, total = [0, 0, 0, *[ord(c) - 96 for c in word], 0], 0.0
        for a in zip(symbols, symbols[1:], symbols[2:], symbols[3:]):
            total += letters.log[((a[0] * 28 + a[1]) * 28 + a[2]) * 28 + a[3]]
        return total

    for token in ["1d10t", "h3ll0", "st*pid", "m0r0n", "$1lly", "b.o.t", "i*io*"]:
        ways = []
        for c in token:
            if c.isalpha():
                ways.append([(c, 0.0)])
                continue
            mine = [(x, toxicity.SWAP) for x in toxicity.LOOKALIKES.get(c, "")]
            if c in toxicity.MARKS or c in "$!|(+":
                mine.append(("", toxicity.DROP if c in toxicity.MARKS else toxicity.SWAP + toxicity.DROP))
            if c in toxicity.WILD:
                mine += [(chr(x), toxicity.HIDE) for x in range(97, 123)]
            ways.append(mine)
        best = max((sum(w[1] for w in path) + cost("".join(w[0] for w in path)), "".join(w[0] for w in path)) for path in itertools.product(*ways))
        assert letters.decode(token) == best[1]
    start = time.time()
    assert letters.decode("a" + "*" * 60 + "b")
    assert time.time() - start < 5


def test_taken_is_what_the_slots_take(spark):
    """Per document, against a plain program over the slots: which words of it lie in the blocks they name."""
    rng = random.Random(21)
    rows = [(i if i % 9 else None, " ".join(["w"] * rng.randint(0, 400)), rng.choice(["a", "b", "c", "d", None, "hot", "hot", "hot"])) for i in range(240)]
    rows += [(500, "same text here", "a")] * 4 + [(None, "x " * 70, "hot")] * 3
    frame = fixture(spark, rows)
    named = frame.select(F.col("doc_id").alias("id"), "source", "text")
    row_table, found, aimed, every = mixing.plan(named, block=16)
    size = {r.source: r.source_size for r in aimed.collect()}
    # The pieces tile each source without gaps.
    spans: dict = {}
    for r in found.collect():
        spans.setdefault((r.source, r.block), []).append((r.words, bytes(r.key)))
    for source, n in size.items():
        blocks = [sum(w for w, _ in spans[source, b]) for b in range(-(-n // 16))]
        assert all(w == 16 for w in blocks[:-1]) and sum(blocks) == n
    # A pass takes each block once at most.
    slots = [(r.source, r["pass"], r.block) for r in every.collect()]
    assert len(slots) == len(set(slots)) and all(0 <= p < 3 for _, p, _ in slots)
    want: dict = {}
    for source, _, block in slots:
        for words, key in spans[source, block]:
            want[key] = want.get(key, 0) + words
    copies = {bytes(r.key): (r.id, r.source, r.size, r.copies) for r in row_table.collect()}
    expected = sorted((str(i), str(s), n, want.get(k, 0) // c) for k, (i, s, n, c) in copies.items() for _ in range(c))
    assert sorted((r[0], r[2], r[3]) for r in expected) == sorted((str(r.doc_id), r.size, r.taken) for r in mixing.mixed(frame, block=16).collect())


def test_row_keys_tell_rows_apart(spark):
    rows = [(1, "a", "b"), (1, "ab", ""), (1, None, "b"), (1, "", "b"), (None, "a", "b"), (11, "a", "b"), (1, "a", None), (1, "a", "1:b"), (1, "-", "b")]
    frame = spark.createDataFrame(rows, "id long, source string, text string")
    assert frame.select(mixing.row_key("id", "source", "text")).distinct().count() == len(rows)


def test_slots_are_made_all_over(spark):
    """One source has nearly all slots: its shards are still dealt over many tasks."""
    blocks = spark.createDataFrame([("hot", 400_000, 400_000), ("b", 10, 30)], "source string, n_blocks long, n_slots long")
    made = mixing.slots(blocks, 3)
    by_task = [r["count"] for r in made.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(by_task) == 400_030 and max(by_task) < 200_000
    assert made.where("source = 'hot'").select("block", "pass").distinct().count() == 400_000


def python_nodes_of_a_stage(frame) -> int:
    """The most Python functions that follow each other in the plan without a shuffle between them."""
    import re

    spark = frame.sparkSession
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = frame.select("*")._jdf.queryExecution().executedPlan().toString().split("\n")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    most, open_ = 0, []  # by depth in the tree: (indent, Python functions since the last exchange)
    for line in plan:
        indent = re.search(r"[A-Za-z*]", line)
        if indent is None:
            continue
        while open_ and open_[-1][0] >= indent.start():
            open_.pop()
        above = open_[-1][1] if open_ else 0
        here = 0 if "Exchange" in line else above + ("InArrow" in line or "InPandas" in line)
        open_.append((indent.start(), here))
        most = max(most, here)
    return most


def test_rounds_of_components_are_small(spark, monkeypatch):
    """A task never has the Python workers of two functions, and few links go in few parts, however many partitions there are."""
    from devicelens.llm import components as module
    from devicelens.llm import simhash

    frames = []

    def cut(frame):
        done = real(frame)
        frames.append((python_nodes_of_a_stage(frame), done.rdd.getNumPartitions()))
        return done

    real = module.cut
    monkeypatch.setattr(module, "cut", cut)
    conf = {"spark.sql.shuffle.partitions": "5", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        codes = [1, 3, 7, 15, 31, 63, 7 << 40, 7 << 40 | 1, 255 << 48]
        distinct = spark.createDataFrame([(c,) for c in codes], "fp long").repartition(3)
        found = {r.node: r.component for r in components(simhash.linked(distinct, len(codes), 1)).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert found == {**{c: 1 for c in codes[:6]}, 7 << 40: 7 << 40, 7 << 40 | 1: 7 << 40}
    assert max(nodes for nodes, _ in frames) == 1
    assert len(frames) > 2 and all(parts == 1 for _, parts in frames[1:])


def test_hot_windows_are_joined_by_a_shuffle(spark, monkeypatch):
    """The rows of hot windows come from one Python function and go to another: a shuffle lies between them."""
    from devicelens.llm import suffixes

    seen = []
    real = suffixes._without_repeats

    def watched(*args):
        out = real(*args)
        out.collect()
        seen.append(out._jdf.queryExecution().executedPlan().toString())  # the plan as it ran
        return out

    monkeypatch.setattr(suffixes, "_without_repeats", watched)
    text = hashlib.sha512(b"a").hexdigest() + hashlib.sha512(b"b").hexdigest()
    docs = spark.createDataFrame([(i, f"{i} {text} {i}") for i in range(40)], "doc_id long, text string")
    got = suffixes.remove_repeats(docs, hot=10).collect()
    assert sum(r.n_removed > 0 for r in got) == 39
    assert "Join" in seen[0] and "BroadcastHashJoin" not in seen[0]
