"""Spelling variants: the two-way index and the search against all pairs, word counts and chains against plain programs."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from devicelens.llm import queries, spelling

SCHEMA = "doc_id long, text string, word string, n string, edge int"


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    k = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[k + 1 :] == b[k + 1 :] if len(a) == len(b) else a[k:] == b[k + 1 :]


def words_of(docs, slip=0):
    total = Counter()
    for doc, text, *_ in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if slip and h % slip == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            total[run] += 1
    return total


def groups(docs, slip=0, least=5, ratio=5):
    """The whole result by comparing all pairs of words."""
    n = {w: c for w, c in words_of(docs, slip).items() if len(w) >= 6 and c >= least}
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {w: min(v, key=lambda x: (-n[x], x)) for w, v in near.items() if v}
    form = {w: f for w, f in form.items() if n[f] >= ratio * n[w]}
    out = set()
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.add((w, n[w], form.get(w), n[form[w]] if w in form else None, len(near[w]), root))
    return out


def rows_of(frame):
    rows = [(r.word, r.n, r.form, r.form_n, r.n_near, r.root) for r in frame.collect()]
    assert len(set(rows)) == len(rows)
    return set(rows)


def test_suffix_order():
    rng = np.random.default_rng(3)
    for size, symbols in [(1, 1), (2, 3), (50, 2), (400, 2), (300, 60)]:
        text = np.concatenate([rng.integers(1, symbols + 1, size), [0]])
        want = sorted(range(len(text)), key=lambda i: text[i:].tolist())
        assert spelling.suffix_order(text, int(symbols).bit_length()).tolist() == want
    same = np.concatenate([np.ones(500, np.int64), [0]])
    assert spelling.suffix_order(same, 1).tolist() == list(range(500, -1, -1))


def test_two_way_steps_keep_both_intervals():
    words = ["abracadabra", "cadabras", "éabracé", "bracada"]
    index = spelling.TwoWayIndex(words)
    text = "$" + "$".join(words) + "$"
    rng = random.Random(4)
    for _ in range(300):
        at = rng.randrange(len(text))
        left, right = at, at
        state = ((np.zeros(1, np.int64), np.zeros(1, np.int64)), np.array([index.size]))
        code = lambda c: np.array([1]) if c == "$" else index.coded(np.array([ord(c)], np.uint32))
        while True:
            side = rng.randrange(2)
            if (side == 0 and left == 0) or (side == 1 and right == len(text)):
                break
            symbol = text[left - 1] if side == 0 else text[right]
            left, right = (left - 1, right) if side == 0 else (left, right + 1)
            state = index.extend(side, state, code(symbol))
            pattern = text[left:right]
            places = {i for i in range(len(text)) if text.startswith(pattern, i)}
            (low, mirrored), size = state
            assert size[0] == len(places)
            assert set(index.order[low[0] : low[0] + size[0]].tolist()) == places
            assert mirrored[0] >= 0 and mirrored[0] + size[0] <= index.size


@pytest.mark.parametrize("alphabet", ["ab", "abcdeéÿ", "abcdefghijklmnopqrstuvwxyz"])
def test_search_equals_all_pairs(alphabet):
    rng = random.Random(alphabet)
    for trial in range(8):
        base = ["".join(rng.choice(alphabet) for _ in range(rng.randint(6, 11))) for _ in range(150)]
        edited = []
        for w in base:
            k = rng.randrange(len(w) + 1)
            edited += [w[:k] + rng.choice(alphabet) + w[k:], w[:k] + w[k + 1 :], w[:k] + rng.choice(alphabet) + w[k + 1 :]]
        words = sorted({w for w in base + edited if len(w) >= 6} | {"a" * 40, "a" * 41})
        asked = words if trial % 2 else words[::3] + ["zzzzzzz", "ÀÀÀaaaa", "a" * 39 + "Z"]
        found = [set(zip(*(x.tolist() for x in spelling.near_words(words, asked, last)))) for last in (False, True)]
        assert not found[0] & found[1]
        want = {(i, j) for i, a in enumerate(asked) for j, b in enumerate(words) if one_edit(a, b)}
        assert found[0] | found[1] == want


def test_groups_of_odd_rows(spark):
    rng = random.Random(9)
    base = ["letters", "éclair-", "straßen", "different", "Repeated", "aaaaaaaa", "abcabcabc", "ÀÉÎÕÜßÿ"]
    docs = []
    for k in range(300):
        words = [w if rng.random() < 0.8 else w[:2] + rng.choice("xyz") + w[2 + rng.randrange(2) :] for w in rng.choices(base, k=20)]
        docs.append((k if k % 17 else None, rng.choice([" ", "\n", "_", "0", "́"]).join(words)))
    docs += [(1, None), (2, ""), (3, "short wörd ab"), (4, "straßen " * 30_000), (5, "b" * 5_000 + " " + ("b" * 4_999 + " ") * 6), (5, "x" * 3_000)] + [(6, "letters lettersa")] * 40
    frame = spark.createDataFrame([(*d, "clash", "n", 3) for d in docs], SCHEMA).repartition(4)
    for slip, ratio in [(0, 5), (7, 5), (199, 2)]:
        want = groups(docs, slip, ratio=ratio)
        assert rows_of(spelling.spelling_groups(frame, slip=slip, ratio=ratio)) == want
        assert any(w[2] for w in want)


def test_hot_ends_are_searched_in_parts(spark):
    rng = random.Random(1)
    docs = [(k, " ".join("pre" + "".join(rng.choice("abc") for _ in range(rng.randint(3, 5))) + "ing" for _ in range(40))) for k in range(60)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert rows_of(spelling.spelling_groups(frame, least=1, shard=400)) == groups(docs, least=1)


def test_chains_of_forms(spark):
    chain = {"abcdef": 3125, "abcdeg": 625, "abcdhg": 125, "abcihg": 25, "abjihg": 5}
    docs = [(1, " ".join(" ".join([w] * n) for w, n in chain.items()))]
    got = {r.word: r for r in spelling.spelling_groups(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert {w: r.root for w, r in got.items()} == dict.fromkeys(chain, "abcdef")
    assert [got[w].form for w in chain] == [None, *list(chain)[:-1]]


def test_empty_table_and_wrong_parameters(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert spelling.spelling_groups(none).collect() == []
    with pytest.raises(ValueError):
        spelling.spelling_groups(none, ratio=1)
    with pytest.raises(ValueError):
        spelling.spelling_groups(none, shortest=5)


def test_pieces_do_not_cut_runs(monkeypatch):
    run = re.compile(spelling.RUN)
    rng = random.Random(2)
    for size in (1, 2, 5, 100):
        text = "".join(rng.choice("abÉ 0.") for _ in range(300))
        cut = list(spelling.pieces(text, run, size))
        assert "".join(cut) == text and [w for p in cut for w in run.findall(p)] == run.findall(text)


def test_query_finds_planted_slips(spark, sf_dir):
    rows = queries.op13_spelling_variants(spark, sf_dir).collect()
    by = defaultdict(set)
    for r in rows:
        by[r.root].add(r.word)
    assert all(r.form is None or (one_edit(r.word, r.form) and r.form_n >= 5 * r.n) for r in rows)
    assert all(r.root in by[r.root] for r in rows)
