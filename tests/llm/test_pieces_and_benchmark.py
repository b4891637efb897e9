"""Piece encoding against the vocabulary's own library, decontamination against brute force, and the pipeline stage by stage."""

import brute
import numpy as np
import pyarrow as pa
import pytest
import sentencepiece

import corpus_pipeline
from millrace.llm import decontaminate, line_dedup, ngram_join, pieces, quality_rules, queries

TEXTS = ["", " ", "a  b   c" + " " * 60 + "d", "x" * 300 + "é" * 40, "\n\n\t 日本語テキスト😀 " + "日本語" * 30, "Internationalization of the quick brown fox, 1234567", brute.prose(4, 300)]


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.load_vocabulary()


def test_no_dropout_gives_the_library_tokens(vocabulary):
    model = sentencepiece.SentencePieceProcessor(model_file=pieces.VOCABULARY)
    found = pieces.encode_texts(pieces.Segmenter(vocabulary, 0.0), pa.array(TEXTS)).to_pylist()
    assert found == [model.encode(t) for t in TEXTS]


def test_dropout_is_seeded_varied_and_lossless(vocabulary):
    texts = [*TEXTS, "▁ a▁b", None]
    segmenter = pieces.Segmenter(vocabulary, 0.3)
    one, same, other = (pieces.encode_texts(segmenter, pa.array(texts), seed).to_pylist() for seed in (1, 1, 2))
    assert one == same and one != other and one[-1] is None and one[0] == []
    assert [pieces.decode_ids(vocabulary, i) for i in one[:-1]] == [pieces.decode_ids(vocabulary, i) for i in other[:-1]] == texts[:-1]
    words = pieces.encode_texts(segmenter, pa.array(["segmentation " * 200])).to_pylist()[0]
    assert len({tuple(words[i : i + 4]) for i in range(len(words))}) > 20  # one word, cut in several ways


def test_long_words_take_the_heap_to_the_same_tokens(vocabulary, monkeypatch):
    segmenter = pieces.Segmenter(vocabulary, 0.2)
    together = pieces.encode_texts(segmenter, pa.array(TEXTS)).to_pylist()
    monkeypatch.setattr(pieces, "LONG_WORD", 0)
    assert pieces.encode_texts(segmenter, pa.array(TEXTS)).to_pylist() == together


def test_chunks_do_not_change_tokens(vocabulary, monkeypatch):
    segmenter = pieces.Segmenter(vocabulary, 0.2)
    whole = pieces.encode_texts(segmenter, pa.array([*TEXTS, None])).to_pylist()
    monkeypatch.setattr(pieces, "CHUNK_CHARS", 1)
    assert pieces.encode_texts(segmenter, pa.array([*TEXTS, None])).to_pylist() == whole


def test_encode_and_decode_tables(spark, vocabulary):
    docs = spark.createDataFrame(brute.rows(brute.odd_texts()), brute.SCHEMA).repartition(3)
    rows = pieces.encode(docs, ["doc_id", "id"], vocabulary)
    assert rows.columns == ["doc_id", "id", "ids", "decoded_same"] and rows.where("not decoded_same").count() == 0
    back = pieces.decode(rows, ["doc_id"], vocabulary)
    assert sorted((r.doc_id or -1, r.text or "") for r in back.collect()) == sorted((i or -1, t or "") for i, t in brute.odd_texts())
    assert pieces.encode(docs.limit(0), ["doc_id"], vocabulary).count() == 0


ITEMS = [(1, brute.prose(1, 60)), (2, "one"), (3, None), (4, " ... "), (None, brute.prose(2, 15).upper()), (5, "a b c d"), (5, "A, B; C! D?"), (6, brute.prose(77, 40)), (7, "é ß")]


@pytest.mark.parametrize("block", [decontaminate.BLOCK_BYTES, 200])
def test_decontamination(spark, block):
    texts = [(k, t) for k, (_, t) in enumerate(brute.odd_texts()) if len(t or "") < 100_000]
    docs = spark.createDataFrame(brute.rows(texts), brute.SCHEMA).repartition(3)
    items = spark.createDataFrame(ITEMS, "item_id int, text string")
    found = decontaminate.matches(docs, items, block_bytes=block).selectExpr("*", "0 as zero").withColumn("n_hit", decontaminate.hit_words()).collect()
    expected = dict(zip([i for i, _ in texts], brute.contaminated(texts, ITEMS), strict=True))
    assert len(found) == len(texts) and any(e[4] for e in expected.values())
    for r in found:
        assert (r.n_words, r.n_hit, len(r.items), decontaminate.digest(r.items), bool(r.hits)) == expected[r.doc_id], r.doc_id
    clean = decontaminate.decontaminate(docs, items, block_bytes=block)
    assert clean.columns == docs.columns
    assert sorted(r.doc_id for r in clean.collect()) == sorted(i for i, e in expected.items() if not e[4])


def test_rows_do_not_depend_on_blocks(spark):
    """Repeated and null ids keep a row each, with the same spans, items and longest match for one block and for several."""
    item = brute.prose(1, 60)
    docs = spark.createDataFrame([(1, item), (1, item), (1, "one more"), (None, brute.prose(2, 15)), (None, None), (2, item + " " + brute.prose(77, 40))], "doc_id bigint, text string")
    items = spark.createDataFrame(ITEMS, "item_id int, text string")
    one, many = (sorted(decontaminate.matches(docs, items, block_bytes=b).collect(), key=repr) for b in (decontaminate.BLOCK_BYTES, 100))
    assert one == many and len(one) == 6 and sum(bool(r.hits) for r in one) == 5


def test_longest_match_and_empty_tables(spark):
    item = brute.prose(1, 60)
    docs = spark.createDataFrame([(1, "before " + " ".join(item.split()[5:38]) + " after"), (2, "before")], "doc_id bigint, text string")
    items = spark.createDataFrame([(9, item)], "item_id bigint, text string")
    assert {r.doc_id: r.longest for r in decontaminate.matches(docs, items).collect()} == {1: 33, 2: 0}
    assert decontaminate.matches(docs.limit(0), items).count() == 0
    assert [r.items for r in decontaminate.matches(docs, items.limit(0)).collect()] == [[], []]
    assert decontaminate.decontaminate(docs, items.limit(0)).count() == 2


def test_suffix_array_is_sorted():
    words = np.array([0, 3, 1, 3, 1, 2, 0, 3, 1, 3, 0, 2, 2, 2, 2])
    at = np.flatnonzero(words)
    array = decontaminate.suffix_array(words, at, 8)
    suffixes = [[*words[p:].tolist(), 0][: [*words[p:].tolist(), 0].index(0)] for p in array]
    assert suffixes == sorted(suffixes) and sorted(array.tolist()) == at.tolist()


def test_queries_against_brute_force(spark):
    sf_dir = "/root/testdata/sf0.001"
    texts = [tuple(r) for r in queries.table(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    items = [tuple(r) for r in queries.table(spark, sf_dir, "benchmark").select("item_id", "text").collect()]
    run = lambda name: {r.doc_id: r for r in queries.QUERIES[name](spark, sf_dir).collect()}
    one, four, eight, ten = (run(n) for n in ("op1_repeated_phrases", "op4_repetition_rules", "op8_decontaminate", "op10_ngram_join"))
    phrases, groups = brute.repeated_phrases(texts), brute.jaccard(texts)
    hits = dict(zip([i for i, _ in texts], brute.contaminated(texts, items), strict=True))
    for i, text in texts:
        assert (one[i].n_words, one[i].n_removed, one[i].kept_sha256) == phrases[i]
        assert (four[i].n_words, four[i].word_chars, four[i].n_symbols, four[i].n_dup_lines, four[i].n_repeat_words, four[i].base_failed) == brute.repetition(text)
        assert (eight[i].n_words, eight[i].n_hit, eight[i].n_items, eight[i].items_sha256, eight[i].contaminated) == hits[i]
        assert (ten[i].n_shingles, ten[i].component_id) == groups[i, text]


def test_pipeline(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality rules", "line dedup", "n-gram Jaccard join", "benchmark decontamination", "SentencePiece encoding and decoding"]
    texts = {r.doc_id: r.text for r in docs.collect()}
    kept = [r.doc_id for r in quality_rules.repetition_rules(docs).where("kept").collect()]
    texts = {i: texts[i] for i in kept}
    gone = brute.fuzzy_lines(list(texts.items()), lambda i, t: 0)
    texts = {i: "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone.get((i, t), ())) for i, t in texts.items()}
    texts = {i: texts[i] for (i, _), (_, c) in brute.jaccard(list(texts.items())).items() if c == i}
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    texts = {i: t for (i, t), hit in zip(list(texts.items()), brute.contaminated(list(texts.items()), items), strict=True) if not hit[4]}
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    vocabulary = pieces.load_vocabulary()
    assert sorted(r.doc_id for r in rows) == sorted(texts) and all(r.decoded_same for r in rows)
    assert all(pieces.decode_ids(vocabulary, r.ids) == texts[r.doc_id] and r.n_tokens == len(r.ids) for r in rows)


def test_stages_keep_the_columns_and_take_odd_rows(spark):
    docs = spark.createDataFrame(brute.rows(brute.odd_texts()), brute.SCHEMA).select("doc_id", "text", "lang", "source", "n_chars").repartition(3)
    for rows in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, rows, "/root/testdata/sf0.001")
            assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
            out.count()
        assert corpus_pipeline.STAGES[-1][1](spark, rows, "/root/testdata/sf0.001").count() == rows.count()
    assert line_dedup.PERCENT >= 80 and ngram_join.PERCENT >= 80
