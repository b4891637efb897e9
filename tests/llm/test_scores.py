"""Quality rules, language, licences, toxicity and line quality."""

import textwrap

import brute
import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.llm import language, licences, line_quality, quality_rules, queries, toxicity
from millrace.llm.sampling import labelled_sample

SF_DIR = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(brute.rows(brute.odd_texts()), brute.SCHEMA).repartition(3).cache()


def test_repetition_counts(spark, odd):
    texts = brute.odd_texts()
    found = quality_rules.measure(pa.array([t for _, t in texts]))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    for k, (_, text) in enumerate(texts):
        assert tuple(found[n][k] for n in names) == brute.repetition(text)
    rows = quality_rules.repetition_rules(odd)
    assert rows.count() == len(texts) and rows.columns[0] == "doc_id"
    kept = quality_rules.keep_clean(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == sorted(r.doc_id or -1 for r in rows.where("kept").collect())


def test_repetition_verdict():
    clean = brute.prose(3, 400)
    lines = "\n".join(clean.split("\n")[:12] * 2)
    found = quality_rules.measure(pa.array([clean, lines, clean + "\n" + "one two three four five six " * 60]))
    assert found["kept"].tolist() == [True, False, False]
    assert found["dup_line_chars"][1] * 2 == found["line_chars"][1] and found["dup_chars_10"][0] == 0


def test_languages(spark, odd):
    assert language.learn(odd.limit(0)).languages == ()
    assert {r.lang_pred for r in language.predict(odd, language.learn(odd.limit(0)), ["doc_id"]).collect()} == {"und"}
    train = spark.createDataFrame([("the cat and the dog", "en"), ("der hund und die katze", "de"), (None, "fr"), ("ohne", None)], "text string, lang string")
    model = language.learn(train)
    assert model.languages == ("de", "en")
    names, score = language.score_texts(model, ["the dog", "die katze und", "123 !?", "", None, "THE CAT"])
    assert names == ["en", "de", "und", "und", "und", "en"] and (score[[2, 3, 4]] == 0).all() and (score <= 1).all()
    assert language.predict(odd, model, ["doc_id"]).count() == len(brute.odd_texts())


@pytest.mark.parametrize("name, label, of, least", [("op5_language", "lang", 4, 0.98), ("op2_line_field", "quality", 5, 0.97), ("op6_toxicity", "toxic", 4, 0.97)])
def test_held_out_accuracy(spark, name, label, of, least):
    rows = queries.QUERIES[name](spark, SF_DIR).cache()
    docs = queries.table(spark, SF_DIR, "documents")
    assert rows.count() == docs.count()
    assert rows.where("score < 0 or score > 1 or score is null or held_out is null").count() == 0
    truth = docs.select("doc_id", "lang") if label == "lang" else queries.table(spark, SF_DIR, "labels").select("doc_id", label)
    guess = "lang_pred" if label == "lang" else "predicted"
    right = rows.where("held_out").join(truth, "doc_id").where(F.col(label).isNotNull()).agg(F.avg((F.col(guess) == F.col(label)).cast("double"))).first()[0]
    assert right >= least
    if label != "lang":
        assert rows.where("predicted <> cast(score >= 0.3 as int)").count() == 0
    rows.unpersist()


def test_classifiers_without_labels_and_odd_texts(spark, odd):
    labels = spark.createDataFrame([(10, 1, 0), (11, 1, 0), (None, 0, 1), (900, 0, 1)], "doc_id bigint, quality int, toxic int")
    for module, label in ((line_quality, "quality"), (toxicity, "toxic")):
        for some in (labels.limit(0), labels):
            model = module.learn(labelled_sample(odd, some, label, F.lit(True), 100))
            rows = module.predict(odd, model, ["doc_id"])
            assert rows.count() == len(brute.odd_texts()) and rows.where("score is null or score < 0 or score > 1").count() == 0
        assert module.predict(odd.limit(0), model, ["doc_id"]).count() == 0


def test_labelled_sample_is_bounded_and_unique(spark):
    docs = spark.createDataFrame([(i, "t") for i in range(50)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i % 40, i % 2) for i in range(80)], "doc_id bigint, toxic int")
    assert labelled_sample(docs, labels, "toxic", F.lit(True), 7).count() == 7
    assert labelled_sample(docs, labels, "toxic", F.col("doc_id") < 5, 100).count() == 5


def test_marginals_match_enumeration():
    r = np.random.default_rng(4)
    row = np.array([0, 0, 0, 1, 2, 2])
    emission, pairs = r.normal(size=6), r.normal(size=(2, 2))
    good, expected, log_z = line_quality.marginals(emission, pairs, row)
    total, counts, log = np.zeros(6), np.zeros((2, 2)), 0.0
    for chain in range(3):
        at = np.flatnonzero(row == chain)
        z, own, both = 0.0, np.zeros(len(at)), np.zeros((2, 2))
        for code in range(2 ** len(at)):
            y = [code >> k & 1 for k in range(len(at))]
            weight = np.exp(sum(emission[at[k]] * y[k] for k in range(len(at))) + sum(pairs[y[k], y[k + 1]] for k in range(len(at) - 1)))
            z += weight
            own += weight * np.array(y)
            for k in range(len(at) - 1):
                both[y[k], y[k + 1]] += weight
        total[at], counts, log = own / z, counts + both / z, log + np.log(z)
    assert np.allclose(good, total) and np.allclose(expected, counts) and np.isclose(log_z, log)


def test_counterfactual_penalty_levels_identity_terms():
    """Toxic texts that name one group: without the penalty naming it is toxic, with it hardly."""
    terms = toxicity.IDENTITY_TERMS[0]
    x = np.zeros((400, 3), np.float32)  # insult, one group, another group
    y = (np.arange(400) % 2).astype(np.float32)
    x[:, 0], x[:, 1], x[:, 2] = y * (np.arange(400) % 10 != 1), y * (np.arange(400) % 4 != 3), 1 - y
    change = np.tile(np.array([[0, 1, -1]], np.float32), (50, 1))
    free, _ = toxicity._fit(x, y, change[:0], 1.0)
    tied, _ = toxicity._fit(x, y, change, 1.0)
    assert abs(tied[1] - tied[2]) < 0.25 * abs(free[1] - free[2]) and tied[0] > 1
    found = list(toxicity.counterfactuals(f"Many {terms[0]} sing. No one else."))
    assert [b for _, b in found] == [f"Many {t} sing." for t in terms[1:]]


def test_licences(spark):
    mit = licences.TEXTS["MIT"]
    british = "Copyright (c) 2020 Some One\n\n" + mit.upper().replace("\n", "\n\n   ").replace("SUBLICENSE", "sub-licence")
    texts = [(1, mit), (2, british), (3, mit + " and more"), (4, None), (5, ""), (6, " ...\n"), (7, "Copyright (c) me"), (8, "Prose.\nThis work is LICENCED under the GNU General Public License, version 3\nall  rights reserved!\nAll rights reserved."), (8, "again"), (None, "All rights reserved.")]
    texts[7] = (8, texts[7][1].replace("LICENCED", "licensed"))
    rows = licences.scan(spark.createDataFrame(brute.rows(texts), brute.SCHEMA)).collect()
    assert len(rows) == len(texts)
    assert sorted((r.doc_id or 0, r.license) for r in rows if r.license) == [(1, "MIT"), (2, "MIT")]
    assert {r.doc_id for r in rows if r.canonical_sha256 is None} == {4, 5, 6, 7}
    assert {(r.doc_id, r.notices, r.n_notice_lines) for r in rows if r.n_notice_lines} == {(8, "GPL-3.0,all-rights-reserved", 3), (None, "all-rights-reserved", 1)}
    assert licences.scan(spark.createDataFrame([], brute.SCHEMA)).count() == 0


def test_licences_as_published(spark):
    """Wrapped at any width, so that body lines begin with "copyright", plain or in comments, with marks of every form above."""
    marks = ("Copyright (c) 2020 Some One", "Copyright 2020, 2021 Some One", "copyright: Some One <one@example.org>", "Copyright Noel Once\nCopyright \u00a9 Other", "(c) 2020 Some One", "\u00a9 Some One")
    texts = []
    for k, (name, text) in enumerate(licences.TEXTS.items()):
        for j, mark in enumerate(marks):
            for width in (20, 45, 60, 72, 79):
                body = mark + "\n\n" + "\n\n".join(textwrap.fill(p, width) for p in text.split("\n"))
                leader = ("", "# ", "// ", " * ", "; ")[(j + k + width) % 5]
                texts.append((name, "\n".join(leader + x for x in body.split("\n"))))
    assert any("\ncopyright notice" in t.lower() for _, t in texts) and any("\n# copyright holders" in t.lower() or "\ncopyright holders" in t.lower() for _, t in texts)
    texts.append(("MIT", licences.TEXTS["MIT"].replace("AUTHORS OR", "AUTHOR OR")))
    found = licences.scan(spark.createDataFrame([(i, t) for i, (_, t) in enumerate(texts)], "doc_id bigint, text string")).collect()
    assert [r.license for r in sorted(found, key=lambda r: r.doc_id)] == [name for name, _ in texts]
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", [(i, t) for i, (_, t) in enumerate(texts)])
    assert sorted(con.execute(queries.SQL["op3_licence_scan"]).fetchall()) == sorted(map(tuple, found))


def test_licences_with_titles(spark):
    """Files that begin with a licence's name, in the usual wrapping and with a copyright line after it."""
    texts = [(name, f"{title}\n\nCopyright (c) 2021 Some One\n\n" + "\n".join(textwrap.wrap(licences.TEXTS[name], 70))) for name, titles in licences.TITLES.items() for title in titles]
    texts += [(None, "MIT License"), (None, "Some License\n" + licences.TEXTS["MIT"]), ("MIT", "The MIT License (MIT)\n" + licences.TEXTS["MIT"])]
    found = licences.scan(spark.createDataFrame([(i, t) for i, (_, t) in enumerate(texts)], "doc_id bigint, text string")).collect()
    assert [r.license for r in sorted(found, key=lambda r: r.doc_id)] == [name for name, _ in texts]
    assert len(licences.TEXTS) >= 12


def test_licence_scan_runs_no_python(spark):
    plan = licences.scan(queries.table(spark, "/root/testdata/sf0.001", "documents"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_notices_match_sql_on_many_documents(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF_DIR}/documents.parquet'")
    expected = sorted(con.execute(queries.SQL["op3_licence_scan"]).fetchall(), key=str)
    found = sorted(map(tuple, queries.QUERIES["op3_licence_scan"](spark, SF_DIR).collect()), key=str)
    assert found == expected and sum(r[4] for r in found) > 100
