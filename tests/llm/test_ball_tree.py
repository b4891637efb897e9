"""Ball-tree search, against scores of every document."""

import math
import random
from collections import Counter

import brute
import numpy as np
import pytest

from millrace.llm import ball_tree

ITEMS = "item_id bigint, text string, item int, rank int, doc_id string, score double"


def ranked(docs, items, top):
    """Rows of (item, rank, id, score); documents with equal scores and ids in any order."""
    bags = [(i, Counter(brute.ITEM_WORDS(brute.lower(t)))) for i, t in docs]
    sizes = [sum(b.values()) for _, b in bags]
    number, total = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for _, b in bags for t in b)
    weight = {t: math.floor(1000 * math.log((2 * number + 2) / (2 * n + 1))) for t, n in df.items()}
    out = []
    for item, text in sorted(set(items), key=repr):
        asked = set(brute.ITEM_WORDS(brute.lower(text)))
        scores = []
        for (i, bag), size in zip(bags, sizes, strict=True):
            m = 100 - 50 + (50 * size * number) // total if total else 0
            score = sum(weight[t] * (1_000_000_000 * bag[t] // (1_000 * bag[t] + 20 * m)) for t in asked if bag[t])
            if score > 0:
                scores.append((-score, i is None, i or 0))
        out += [(item, k + 1, None if none else i, -s) for k, (s, none, i) in enumerate(sorted(scores)[:top])]
    return sorted(out, key=repr)


def tables(spark, docs, items):
    return (
        spark.createDataFrame(brute.rows(docs), brute.SCHEMA).repartition(4),
        spark.createDataFrame([(i, t, 1, 2, "d", 0.5) for i, t in items], ITEMS),
    )


def found(spark, docs, items, top=50):
    out = ball_tree.search(*tables(spark, docs, items), top=top)
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in out.collect()), key=repr)


def corpus(seed, rows):
    r = random.Random(seed)
    names = [f"t{i}" for i in range(300)]
    weights = [1 / (1 + i) for i in range(300)]
    docs = [(i, " ".join(r.choices(names, weights, k=r.randrange(1, 60)))) for i in range(rows)]
    items = [(i, " ".join(r.choices(names, weights, k=r.randrange(1, 25)))) for i in range(25)]
    return docs + [(5_000 + i, docs[3][1]) for i in range(70)], items + [(90, docs[3][1]), (91, docs[8][1].upper())]


@pytest.mark.parametrize("chunk, groups, top", [(1_024, 4_096, 50), (40, 4_096, 7), (100, 16, 50), (33, 1, 3)])
def test_every_score(spark, monkeypatch, chunk, groups, top):
    monkeypatch.setattr(ball_tree, "CHUNK", chunk)
    monkeypatch.setattr(ball_tree, "GROUPS", groups)
    docs, items = corpus(2, 400)
    assert found(spark, docs, items, top) == ranked(docs, items, top)


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(ball_tree, "ENTRIES", 500)
    docs = brute.odd_texts()
    items = [(1, brute.prose(1, 240)), (1, brute.prose(2, 300)), (2, None), (3, ""), (4, "é tie LINE"), (None, "x p q"), (None, "x p q"), (5, "nowhere"), (6, "a" * 300_000), (7, "start w1x w2x")]
    assert found(spark, docs, items) == ranked(docs, items, 50)


def test_blocks_of_items(spark, monkeypatch):
    docs, items = corpus(3, 150)
    monkeypatch.setattr(ball_tree, "ITEMS", 6)
    assert found(spark, docs, items, 5) == ranked(docs, items, 5)


def test_empty_tables(spark):
    docs, items = corpus(4, 20)
    assert found(spark, [], items) == found(spark, docs, []) == found(spark, [], []) == found(spark, [(1, None)], items) == []


def test_limits_hold_and_prune():
    """No document beats the limit of a node above it, and a search for a planted passage leaves most leaves alone."""
    r = np.random.default_rng(1)
    n, size = 1_000, 5_000
    rows = [np.unique(np.concatenate((r.integers(0, 40, 10), r.integers(0, size, 50)))) for _ in range(n)]
    first = np.concatenate(([0], np.cumsum([len(x) for x in rows])))
    terms = np.concatenate(rows).astype(np.int32)
    values = r.integers(1, 10**10, len(terms))
    tree = ball_tree.BallTree(first, terms, values, size)
    assert sorted(tree.order.tolist()) == list(range(n))
    item, wanted = rows[77], np.zeros(size, bool)
    wanted[item] = True
    limits, scores = tree.limits(item), np.zeros(n, np.int64)
    for leaf in range(len(tree.leaves) - 1):
        own, got = tree.scores(leaf, wanted)
        scores[own] = got
        node = tree.inner + leaf
        while node >= 0:
            assert got.max() <= limits[node]
            node = (node - 1) // 2 if node else -1
    assert scores.tolist() == [int(values[a:z][wanted[terms[a:z]]].sum()) for a, z in zip(first, first[1:], strict=False)]
    best = [0]

    def threshold():
        return best[0]

    visited = 0
    for _, got in tree.search(item, wanted, threshold):
        visited, best[0] = visited + 1, max(best[0], int(got.max()))
    assert best[0] == scores.max() and visited < (len(tree.leaves) - 1) // 4
