"""Phrase automata, fuzzy lines and the n-gram join, against brute force."""

import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import line_dedup, linking, ngram_join, phrases
from millrace.llm.words import span_hashes


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(brute.rows(brute.odd_texts()), brute.SCHEMA).repartition(5).cache()


def short(docs):
    """Without the texts that brute force would take too long for."""
    return [(i, t) for i, t in docs if len(t or "") < 100_000]


@pytest.mark.parametrize("crowd", [2, phrases.HOT])
def test_repeated_phrases(spark, odd, monkeypatch, crowd):
    monkeypatch.setattr(phrases, "HOT", crowd)
    monkeypatch.setattr(phrases, "AUTOMATON", 3)
    found = phrases.dedup(odd).select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept")).collect()
    texts = brute.odd_texts()
    assert len(found) == len(texts)
    expected = brute.repeated_phrases(texts)
    empty = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
    for r in found:
        if r.doc_id is None:
            assert r.n_removed == 0 and r.n_words == 240
        else:
            assert (r.n_words, r.n_removed, r.kept) == expected.get(r.doc_id, (0, 0, empty)), r.doc_id


def test_earliest_finds_every_window():
    pieces = [(5, 0, [b"a", b"b", b"c", b"d"]), (2, 7, [b"x", b"b", b"c", b"d"]), (9, 1, [b"b", b"c", b"b", b"c", b"b"])]
    assert phrases.earliest(pieces, 3) == [[(5, 0), (2, 8)], [(2, 7), (2, 8)], [(9, 1), (9, 2), (9, 1)]]


def order(spark, texts):
    """The order of documents with the same id."""
    rows = spark.createDataFrame(list(set(texts)), "id bigint, text string").select("id", "text", F.xxhash64("id", "text").alias("row")).collect()
    return {(r.id, r.text): r.row for r in rows}


def check_lines(spark, texts, **options):
    docs = spark.createDataFrame(brute.rows(texts), brute.SCHEMA).repartition(4)
    rows = order(spark, texts)
    expected = brute.fuzzy_lines(texts, lambda i, t: rows[i, t])
    gone = [(i, tuple(expected.get((i, t), ()))) for i, t in texts]
    found = line_dedup.removals(docs).collect()
    assert sorted(((r.doc_id, tuple(r.removed_lines)) for r in found), key=repr) == sorted(gone, key=repr)
    assert all(r.n_removed == len(r.removed_lines) for r in found)
    kept = line_dedup.dedup_lines(docs, length_col="n_chars")
    assert kept.columns == docs.columns
    left = [(i, t if not g else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in g)) for (i, t), (_, g) in zip(texts, gone, strict=True)]
    rows = kept.collect()
    assert sorted(((r.doc_id, r.text) for r in rows), key=repr) == sorted(left, key=repr)
    assert all(r.n_chars == len(r.text or "") and tuple(r)[5:] == brute.rows([(1, "")])[0][5:] for r in rows)
    return expected


@pytest.mark.parametrize("crowd, pack", [(line_dedup.CROWD, line_dedup.PACK), (1, 50)])
def test_fuzzy_lines(spark, monkeypatch, crowd, pack):
    monkeypatch.setattr(line_dedup, "CROWD", crowd)
    monkeypatch.setattr(line_dedup, "PACK", pack)
    monkeypatch.setattr(linking, "CROWD", crowd)
    line = brute.prose(8, 200).replace("\n", " ")
    texts = [(i, t) for i, t in short(brute.odd_texts()) if len(t or "") < 5_000]
    texts += [(100 + i, brute.edited(line, i, 1) + "\nown line of " + str(i) + "\n\nshared LINE, same.") for i in range(12)] + [(99, "Shared line: same\n" + line)]
    texts += [(100, "shared line same\n" + brute.prose(9, 30)), (100, brute.edited(line, 50, 2))]
    expected = check_lines(spark, texts)
    assert sum(0 in v for (i, _), v in expected.items() if 100 <= i < 112) >= 12


def test_every_line_within_the_edits_goes(spark):
    """Lines of 4 to 50 words with up to a fifth of the words changed."""
    r, texts = random.Random(4), []
    for k, size in enumerate((4, 5, 6, 9, 10, 15, 20, 30, 50) * 6):
        words = [f"w{r.randrange(300)}" for _ in range(size)]
        other = list(words)
        for _ in range(size // 5 + (k % 5 == 0)):
            at, what = r.randrange(len(other)), r.randrange(3)
            other[at : at + (what > 0)] = [f"new{r.randrange(10**6)}"] if what < 2 else []
        texts += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(other) + "\nthe the the the the\nthe the the the")]
    expected = check_lines(spark, texts)
    assert sum(0 in gone for gone in expected.values()) >= 40


def test_partners_are_found_under_every_bound():
    r = np.random.default_rng(6)
    sizes, parities = r.integers(3, 9, (40, 7)).astype(np.uint32), r.integers(0, 64, (40, 7)).astype(np.uint64)
    got = line_dedup.with_partner(sizes, [parities >> np.uint64(3), parities & np.uint64(7)], 80)
    for k in range(40):
        for i in range(7):
            others = [j for j in range(7) if j != i]
            edits = {j: max(int(sizes[k, i]), int(sizes[k, j])) * 20 // 100 for j in others}
            apart = {j: abs(int(sizes[k, i]) - int(sizes[k, j])) for j in others}
            changed = {j: (int(parities[k, i]) ^ int(parities[k, j])).bit_count() for j in others}
            assert got[k, i] == any(apart[j] <= edits[j] and changed[j] <= 2 * edits[j] - apart[j] for j in others)
    assert [line_dedup._taken(n, 80) for n in (1, 2, 3, 4, 5, 9, 10, 50)] == [0, 0, 0, 1, 2, 2, 3, 11]


def test_lines_that_share_words_but_no_pair_of_words_are_never_fetched(spark, monkeypatch):
    """Long lines of words that all come often: only those with a near copy are candidates."""
    r = random.Random(5)
    lines = [" ".join(f"w{r.randrange(1_500)}" for _ in range(240)) for _ in range(96)]
    near = lines[0].split(" ")
    near[9] = "other"
    lines.append(" ".join(near))
    docs = spark.createDataFrame(brute.rows(list(enumerate(lines))), brute.SCHEMA).repartition(3)
    fetched, texts = [], line_dedup._texts
    monkeypatch.setattr(line_dedup, "_texts", lambda d, wanted: fetched.append(wanted.count()) or texts(d, wanted))
    gone = [r.doc_id for r in line_dedup.removals(docs).where("n_removed > 0").collect()]
    assert gone == [len(lines) - 1] and fetched == [2]


def test_keys_of_word_pairs_are_enough():
    """Lines of e edits at most share two of the first pairs of words, whatever the order."""
    for percent in range(76, 100):
        for most in range(1, 200):
            edits = most * (100 - percent) // 100
            for size in range(most - edits, most + 1) if edits else ():
                common = most - 1 - 2 * edits
                assert common >= 2
                assert all(line_dedup._taken(n, percent, 2) >= n - 1 - common + 1 for n in (size, most))
    assert line_dedup._width(75) == 1 and [line_dedup._taken(n, 80, 2) for n in (3, 4, 5, 9, 10, 50)] == [0, 2, 3, 4, 5, 21]


def test_every_bit_of_the_parities_counts(spark):
    """Nodes whose parities differ in the top bit, that of the sign, meet like others."""
    top = -(2**63)
    rows = spark.createDataFrame([(1, 10, 20, 5, 5, 5, 5), (1, 11, 20, 5 + top, 5, 5, 5), (2, 12, 20, 0, 0, 0, 0), (2, 13, 20, -1, -1, 0, 0)],
                                 "key bigint, node bigint, size int, p1 bigint, p2 bigint, p3 bigint, p4 bigint").repartition(2, "key")
    assert sorted(r.node for r in line_dedup._close(rows, 80).collect()) == [10, 11]


def test_only_lines_of_different_groups_meet(spark):
    """Under keys of any size: rows stay while one of another label may link to them, and pairs are made of no other rows."""
    r = random.Random(7)
    rows = []
    for key, n in ((1, 2), (2, 7), (3, 60), (4, 300), (5, 9), (6, 80)):
        for node in r.sample(range(1_000), n):
            # one group holds most of a key; keys 5 and 6 have no other
            rows.append((key, node, 20 + node % 3, *(r.getrandbits(3) for _ in range(4)), 7 if key > 4 or r.random() < 0.9 else node % 5))
    table = spark.createDataFrame(rows, "key bigint, node bigint, size int, p1 bigint, p2 bigint, p3 bigint, p4 bigint, label bigint").repartition(3, "key")
    expected, stay = set(), set()
    for x in rows:
        for y in rows:
            edits, apart = max(x[2], y[2]) * 20 // 100, abs(x[2] - y[2])
            if x[0] == y[0] and x[7] != y[7] and apart <= edits and sum((p ^ q).bit_count() for p, q in zip(x[3:7], y[3:7], strict=True)) <= 2 * edits - apart:
                expected.add((min(x[1], y[1]), max(x[1], y[1])))
                stay.add((x[0], x[1]))
    assert {(p.a, p.b) for p in line_dedup._across(table, 80).collect()} == expected
    left = line_dedup._apart(table, 80).collect()
    assert {(p.key, p.node) for p in left} == stay and 0 < len(stay) < len(rows)
    label = {(x[0], x[1]): x[7] for x in rows}
    assert all(p.other is not None for p in left if label[p.key, p.node] != 7 and p.key > 2)
    assert all((min(p.node, p.other), max(p.node, p.other)) in expected for p in left if p.other is not None)


def test_edit_distance():
    r = np.random.default_rng(2)
    for _ in range(500):
        x, y = r.integers(0, 4, r.integers(0, 9)).tolist(), r.integers(0, 4, r.integers(0, 9)).tolist()
        assert line_dedup.edit_distance(x, y) == brute.distance(x, y)


@pytest.mark.parametrize("hot, run", [(ngram_join.HOT, ngram_join.RUN), (1, 2)])
def test_ngram_join(spark, odd, monkeypatch, hot, run):
    monkeypatch.setattr(ngram_join, "HOT", hot)
    monkeypatch.setattr(linking, "CROWD", linking.CROWD if run > 2 else 0)
    monkeypatch.setattr(ngram_join, "RUN", run)
    docs = brute.odd_texts()
    expected = brute.jaccard(docs)
    found = ngram_join.jaccard_groups(odd).collect()
    rows = [(i, len(brute.shingles(t)), expected.get((i, t), (0, None))[1]) for i, t in docs]
    assert sorted(map(tuple, found), key=repr) == sorted(rows, key=repr)
    kept = ngram_join.keep_one(odd)
    assert kept.columns == odd.columns
    ids = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)
    assert ids == sorted(i for i, t in docs if i is not None and expected[i, t][1] == i)


def test_ngram_join_of_an_id_with_two_texts(spark):
    one, two = brute.prose(21, 80), brute.prose(22, 80)
    docs = [(1, one), (2, one), (2, two), (3, two), (3, two), (4, brute.prose(23, 40))]
    table = spark.createDataFrame(brute.rows(docs), brute.SCHEMA).repartition(3)
    assert sorted((r.doc_id, r.component_id) for r in ngram_join.jaccard_groups(table).collect()) == [(1, 1), (2, 1), (2, 2), (3, 2), (3, 2), (4, 4)]
    assert sorted((r.doc_id, r.text) for r in ngram_join.keep_one(table).collect()) == sorted([(1, one), (2, two), (4, docs[-1][1])])


def test_ngram_join_of_short_sets(spark):
    """A set of 6 n-grams links to one of 7 that holds it, though its prefix is a single n-gram."""
    nine = "a1 b2 c3 d4 e5 f6 g7 h8 i9"
    texts = [(1, nine), (2, nine + " j10"), (3, "z0 " + nine), (4, "k1 l2 m3 n4 o5 p6 q7 r8"), (5, "k1 l2 m3 n4 o5 p6 q7 r8 s9"), (None, nine), (6, "")]
    expected = {i: v for (i, _), v in brute.jaccard(texts).items()}
    assert expected[2] == (7, 1) and expected[3] == (7, 1) and expected[5] == (6, 5)
    found = ngram_join.jaccard_groups(spark.createDataFrame(brute.rows(texts), brute.SCHEMA).repartition(3)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found if r.doc_id is not None} == expected
    for percent in (50, 67, 80, 90):
        for size in range(1, 40):
            links = any(100 * size >= percent * more for more in range(size + 1, 3 * size + 2))
            assert links == (size * 100 // percent > size)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (300, 200), (200, 250)]
    found = dict(linking.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect())
    assert found == {**{i: 0 for i in range(41)}, **{k: 100 for k in range(100, 160)}, 200: 200, 250: 200, 300: 200}
    assert linking.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_near_copies_do_not_become_all_pairs(spark):
    """A crowd that shares its keys is held against leaders, not against itself."""
    keyed = spark.range(3_000).select(F.col("id").alias("node"), F.explode(F.array(F.lit(1).cast("bigint"), F.lit(2).cast("bigint"))).alias("key"))
    seen = []

    def verify(pairs):
        seen.append(pairs.count())
        return pairs

    groups = linking.linked(keyed, verify, lambda x, y: F.lit(True))
    assert groups.where("component <> 0").count() == 0 and groups.count() == 3_000
    assert seen == [2_999]  # rounds without pairs have nothing to verify


@pytest.mark.parametrize("crowd", [500, None])
def test_a_crowd_that_does_not_link_is_split(spark, crowd):
    """3,000 nodes under one key, none linked: with another mark each they meet only where they share one."""
    ids = spark.range(3_000).select(F.col("id").alias("node"))
    keyed = ids.select("node", F.lit(1).cast("bigint").alias("key"))
    # every node has the key and two of 1,000 other marks
    marks = ids.select("node", F.explode(F.array(F.lit(1).cast("bigint"), 10 + F.col("node") % 1_000, 2_000 + F.col("node") % 997)).alias("mark"))
    seen = []

    def verify(pairs):
        seen.append(sorted((r.a, r.b) for r in pairs.collect()) if len(seen) == 2 else pairs.count())
        return pairs.where("b = a + 1000 and a < 1000")

    groups = linking.linked(keyed, verify, lambda x, y: F.lit(True), marks=marks, crowd=crowd)
    together = {(a, b) for a in range(3_000) for m in (1_000, 997) for b in range(a + m, 3_000, m)}
    assert set(seen[2]) <= together and len(seen[2]) > len(together) - 3_000
    assert {(r.node, r.component) for r in groups.collect()} == {(n, n % 1_000) for n in range(2_000)}


def test_empty_tables(spark):
    empty = spark.createDataFrame([], brute.SCHEMA)
    assert phrases.dedup(empty).count() == 0
    assert line_dedup.removals(empty).count() == 0 and line_dedup.dedup_lines(empty, length_col="n_chars").count() == 0
    assert ngram_join.jaccard_groups(empty).count() == 0 and ngram_join.keep_one(empty).count() == 0
