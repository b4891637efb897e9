"""Tensored MinHash, against the similarity of all pairs."""

import random

import brute
import numpy as np
import pytest

from millrace.llm import minhash
from millrace.llm.words import mixed


def groups(docs):
    """(set size, smallest linked id) of each row with an id."""
    sets = {}
    for i, text in docs:
        words = brute.WORDS(brute.lower(text))
        sets[i, text] = frozenset(zip(words, words[1:], strict=False)) if len(words) >= 2 else frozenset([tuple(words)] if words else [])
    rows = sorted((k for k in sets if k[0] is not None), key=repr)
    linked = brute.Groups(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            x, y = sets[rows[a]], sets[rows[b]]
            both = len(x & y)
            if both and 100 * both >= 80 * len(x | y):
                linked.link(a, b)
    lowest = {}
    for k, (i, _) in enumerate(rows):
        lowest[linked.root(k)] = min(lowest.get(linked.root(k), i), i)
    return sets, {key: lowest[linked.root(k)] for k, key in enumerate(rows)}


def check(spark, docs):
    sets, component = groups(docs)
    out = minhash.near_copies(spark.createDataFrame(brute.rows(docs), brute.SCHEMA).repartition(4))
    assert out.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    expected = [(i, len(sets[i, t]), component.get((i, t)), i is None or component[i, t] == i) for i, t in docs]
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(expected, key=repr)


def test_near_copies(spark):
    check(spark, brute.odd_texts() + [(60 + i, brute.edited(brute.prose(6, 120), i, 1 + i % 9)) for i in range(30)])


def test_ids_with_two_texts(spark):
    base, other = brute.prose(1, 100), brute.prose(2, 100)
    check(spark, [(1, base), (2, brute.edited(base, 1, 1)), (2, other), (3, other), (None, base), (None, None), (4, "one"), (5, "One"), (6, ""), (2, other)])


@pytest.mark.parametrize("crowd, group", [(0, 3), (minhash.CROWD, minhash.GROUP)])
def test_crowded_keys(spark, monkeypatch, crowd, group):
    """Groups of copies that share a good part of their words but don't link."""
    monkeypatch.setattr(minhash, "CROWD", crowd)
    monkeypatch.setattr(minhash, "GROUP", group)
    shared = brute.prose(3, 120)
    docs = [(10 * k + i, shared + " " + brute.edited(brute.prose(50 + k, 60), i, 1)) for k in range(12) for i in range(4)]
    check(spark, docs)


def test_pairs_at_the_limit_are_found():
    """Of sets with a similarity of just 80 % hardly any pair has no table key in common."""
    r, missed, tables = np.random.default_rng(3), 0, 0
    for _ in range(400):
        pool = mixed(r.integers(0, 1 << 62, 120, dtype=np.uint64))
        x, y = pool[:108], np.concatenate((pool[:96], pool[108:]))
        assert len(set(x) & set(y)) * 100 == 80 * len(set(x) | set(y))
        a, b = minhash.half_keys(np.concatenate((x, y)), np.array([0, 108]))
        equal = a == b
        tables += equal[: minhash.HALF].sum() * equal[minhash.HALF :].sum()
        missed += not (equal[: minhash.HALF].any() and equal[minhash.HALF :].any())
    assert missed <= 2
    assert abs(tables / 400 - (minhash.HALF * 0.8**minhash.WIDTH) ** 2) < 3


def test_partners_under_a_half(monkeypatch):
    r = np.random.default_rng(5)
    monkeypatch.setattr(minhash, "PAIRS", 40)
    monkeypatch.setattr(minhash, "SOME", 3)
    sizes, bits = r.integers(8, 12, 50), r.integers(0, 8, (50, 2)).astype(np.uint64)
    fits = lambda i, j: 100 * min(sizes[i], sizes[j]) >= 80 * max(sizes[i], sizes[j]) and 180 * sum(int(x ^ y).bit_count() for x, y in zip(bits[i].tolist(), bits[j].tolist(), strict=True)) <= 20 * (sizes[i] + sizes[j])
    assert minhash.with_partner(sizes, bits, 80).tolist() == [any(fits(i, j) for j in range(50) if j != i) for i in range(50)]


def test_half_keys_do_not_look_at_repeats():
    x = mixed(np.arange(50, dtype=np.uint64))
    again = np.concatenate((x, x[random.Random(1).choices(range(50), k=30)]))
    assert (minhash.half_keys(np.concatenate((x, again)), np.array([0, 50]))[0] == minhash.half_keys(again, np.array([0]))[0]).all()


def test_empty(spark):
    assert minhash.near_copies(spark.createDataFrame([], brute.SCHEMA)).count() == 0
    check(spark, [(1, None), (None, "a b")])
