"""Statistics, trees, rules and languages."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from staymart.llm import language, quality_model, quality_rules, statistics, trees
from staymart.llm.common import held_out, table

SF = "/root/testdata/sf0.01"


def slow_base(text):
    words = (text or "").encode().split()
    seen = {}
    for i in range(len(words) - 4):
        seen.setdefault(tuple(words[i : i + 5]), []).append(i)
    repeat = {j for at in seen.values() if len(at) > 1 for i in at for j in range(i, i + 5)}
    lines, dup, earlier = (text or "").split("\n"), 0, set()
    for line in lines:
        if line.strip(" \t\n\x0b\x0c\r"):
            dup += line in earlier
            earlier.add(line)
    chars = sum(len(w.decode()) for w in words)
    return len(words), chars, sum(c in "#*$%&|<>" for c in text or ""), dup, len(repeat)


def test_base_statistics_equal_a_plain_count():
    rng = random.Random(5)
    texts = [None, "", "a b c d e a b c d e", "x\nx\n\n \n x\nx", "é😀\x85 |#\x1c a\xa0b\nb"]
    texts += [" ".join(rng.choice("abc") + rng.choice(["", "\n", "é"]) for _ in range(rng.randrange(60))) for _ in range(200)]
    texts.append(" ".join(str(rng.randrange(20_000)) for _ in range(30_000)) + " 1 2 3 4 5 6 1 2 3 4 5 6")
    for text in texts:
        assert statistics.statistics(text)[:5] == slow_base(text), text


def test_trees_keep_their_monotone_features():
    rng = np.random.default_rng(0)
    x = rng.random((3000, 3))
    y = ((np.sin(6 * x[:, 0]) + x[:, 1] - x[:, 2] + 0.3 * rng.standard_normal(3000)) > 0).astype(float)
    model = trees.boost(x, y, monotone={0: -1, 1: 1})
    grid = np.linspace(0, 1, 60)
    for f, sign in ((0, -1), (1, 1)):
        for _ in range(20):
            rows = np.repeat(rng.random((1, 3)), 60, axis=0)
            rows[:, f] = grid
            assert (np.diff(model.raw(rows)) * sign >= -1e-12).all()
    free = trees.boost(x, y)
    assert ((free.score(x) > 0.5) == y).mean() > 0.85
    assert trees.boost(x[:0], y[:0]).score(x[:2]).tolist() == [0.5, 0.5]


def test_rules_in_spark_equal_rules_in_numpy(spark):
    rng = np.random.default_rng(1)
    x = rng.random((500, len(statistics.FEATURES)))
    y = ((x[:, 2] < 0.4) & (x[:, 4] < 0.7)).astype(float)
    model = quality_model.fit_rule_ensemble(x, y)
    assert 0 < len(model.conditions) < 200
    assert ((model.score(x) > 0.5) == y).mean() > 0.95
    frame = spark.createDataFrame([tuple(map(float, r)) for r in x], statistics.FEATURES)
    got = np.array([r[0] for r in frame.coalesce(1).select(model.column()).collect()])
    assert np.allclose(got, model.score(x))


def test_a_rule_ensemble_without_both_labels_is_a_constant():
    x = np.zeros((4, len(statistics.FEATURES)))
    assert quality_model.fit_rule_ensemble(x, np.ones(4)).score(x)[0] == pytest.approx(5 / 6)
    assert quality_model.fit_rule_ensemble(x[:0], np.zeros(0)).score(x)[0] == pytest.approx(0.5)


def test_quality_on_held_out_labels(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    scored = quality_model.quality_scores(docs, quality_model.rule_ensemble_for(docs, SF)).join(labels, "doc_id")
    right = scored.where("held_out").agg(F.avg((F.col("predicted") == F.col("quality")).cast("int"))).first()[0]
    assert right >= 0.95
    judged = quality_rules.judged(docs, quality_rules.rules_for(docs, SF)).join(labels, "doc_id")
    clean = judged.where("quality = 1 AND NOT base_failed").agg(F.avg(F.col("kept").cast("int"))).first()[0]
    junk = judged.where("quality = 0").agg(F.avg(F.col("kept").cast("int"))).first()[0]
    assert clean >= 0.97 and junk <= 0.05


def test_quality_of_odd_documents(spark, odd_docs, no_docs):
    none = spark.createDataFrame([], "doc_id long, quality int")
    x, y = statistics.labelled_sample(spark, odd_docs, none)
    assert x.shape == (0, len(statistics.FEATURES))
    model, rules = quality_rules.fit_rules(x, y), quality_model.fit_rule_ensemble(x, y)
    rows = quality_rules.judged(odd_docs.withColumn("score", F.lit(1)), model).collect()
    assert len(rows) == 9 and all(r.base_failed for r in rows if r.n_words < 10)
    kept = quality_rules.keep_good(odd_docs, model)
    assert kept.columns == odd_docs.columns
    assert kept.count() == sum(r.kept for r in rows)
    scores = quality_model.quality_scores(odd_docs, rules).collect()
    assert len(scores) == 9 and all(0 <= r.score <= 1 for r in scores)
    assert quality_rules.judged(no_docs, model).collect() == quality_model.quality_scores(no_docs, rules).collect() == []


def test_the_sample_is_bounded_and_leaves_out_the_held_out(spark, make_docs):
    docs = make_docs([(i, f"text {i}", "en", "s") for i in range(300)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(300)] + [(1, None), (None, 1), (3, 1)], "doc_id long, quality int")
    x, y = statistics.labelled_sample(spark, docs, labels)
    assert len(x) == sum(zlib.crc32(str(i).encode()) % 4 != 2 for i in range(300))
    assert len(statistics.labelled_sample(spark, docs, labels, most=40)[0]) <= 80


def test_held_out_rows(spark):
    rows = spark.range(200).withColumnRenamed("id", "doc_id").select("doc_id", held_out().alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)


def test_codewords_lie_apart():
    for n in (2, 3, 4, 7, 12):
        code = language.codewords(n)
        apart = (code.shape[1] - code @ code.T) / 2
        assert (apart + np.eye(n) * 99).min() >= max(1, 2 ** (n - 2) if n <= 7 else 3)


def test_languages_on_held_out_documents(spark):
    docs = table(spark, SF, "documents")
    out = language.languages_of(docs, language.fit_languages(docs)).join(docs.select("doc_id", "lang"), "doc_id")
    right = out.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right >= 0.97
    assert out.where("score < 0 OR score > 1").count() == 0


def test_languages_of_odd_documents(odd_docs, no_docs, make_docs):
    model = language.fit_languages(odd_docs)
    rows = language.languages_of(odd_docs.withColumn("score", F.lit("x")), model).collect()
    by = {r.doc_id: r.lang_pred for r in rows}
    assert len(rows) == 9 and by[1] == by[2] == by[6] == language.UNKNOWN
    assert by[4] in {"en", "de", "fr", "es"}
    assert language.fit_languages(no_docs) is None
    assert {r.lang_pred for r in language.languages_of(odd_docs, None).collect()} == {language.UNKNOWN}
    one = make_docs([(i, "only one language", "en", "s") for i in range(8)])
    assert {r.lang_pred for r in language.languages_of(one, language.fit_languages(one)).collect()} == {"en"}
