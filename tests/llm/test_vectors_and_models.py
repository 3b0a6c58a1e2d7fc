"""Nearest neighbours against brute force, and the toxicity chain on held-out documents."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from llm.cases import no_documents, odd_documents, tuples
from orderlake.llm.permutation_index import neighbours
from orderlake.llm import toxicity
from orderlake.llm.mixing import mixed_documents
from orderlake.llm.toxicity import THRESHOLD, Terms, fit_chain, toxicity_report, without_toxic

VECTORS = "vec_id long, embedding array<float>, label int, v string, pivot int, rank int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, e, 0, "v", 1, 2) for i, e in rows], VECTORS)


def brute_force(rows, every=50, k=5):
    rows = {i: np.array(e, np.float64) for i, e in rows}
    out = {}
    for q in (i for i in rows if i % every == 0):
        scores = [
            (-float((rows[q] * v).sum() / (math.sqrt((v * v).sum()) * math.sqrt((rows[q] * rows[q]).sum()))), i)
            for i, v in rows.items() if i != q
        ]
        out[q] = [(i, -s) for s, i in sorted(scores)[:k]]
    return out


def test_neighbours_of_odd_vectors(spark):
    r = random.Random(1)
    good = [(i, [float(np.float32(r.gauss(0, 1))) for _ in range(4)]) for i in range(0, 100, 5)]
    good += [(1, good[0][1]), (2, good[0][1]), (3, [2 * x for x in good[0][1]])]
    bad = [(7, None), (8, [0.0] * 4), (9, [1.0, None, 0.0, 0.0]), (11, [float("nan")] * 4), (12, [float("inf")] * 4),
           (None, [1.0] * 4), (13, []), (14, [1.0, 2.0]), good[2]]
    got = neighbours(vectors(spark, good + bad)).orderBy("query_id", "rank").collect()
    want = brute_force(good)
    assert {r.query_id for r in got} == set(want)
    for q, near in want.items():
        mine = [(r.rank, r.vec_id, r.score) for r in got if r.query_id == q]
        assert [m[0] for m in mine] == [1, 2, 3, 4, 5]
        assert [m[1] for m in mine] == [i for i, _ in near]
        assert np.allclose([m[2] for m in mine], [s for _, s in near], rtol=0, atol=1e-12)
    assert neighbours(vectors(spark, [])).collect() == []
    few = neighbours(vectors(spark, good[:3])).collect()
    assert [(r.query_id, r.rank) for r in sorted(few)] == [(0, 1), (0, 2)]


def test_recall(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir.replace('0.001', '0.1')}/embeddings.parquet")
    want = brute_force([(r.vec_id, r.embedding) for r in df.collect()], every=250)
    got = {}
    for r in neighbours(df, every=250).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = sum(len(got[q] & {i for i, _ in near}) for q, near in want.items())
    assert hits / sum(map(len, want.values())) >= 0.9


def test_toxicity_of_held_out_documents(spark, sf_dir):
    folder = sf_dir.replace("0.001", "0.1")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    held = F.pmod(F.xxhash64("doc_id", F.lit("held")), F.lit(4)) == 0
    out = toxicity_report(docs, labels.where(~held))
    counts = {
        (r.toxic, r.rejected): r["count"]
        for r in out.join(labels.where(held), "doc_id").groupBy("toxic", "rejected").count().collect()
    }
    assert counts[(1, True)] >= 0.95 * (counts[(1, True)] + counts.get((1, False), 0))
    assert counts.get((0, True), 0) <= 0.005 * counts[(0, False)]


def test_insults_that_clean_texts_have_by_chance():
    # Every text has the word "kolb"; only toxic ones have it in every thirtieth place.
    r, terms = random.Random(3), Terms()

    def text(n, toxic):
        words = ["".join(r.choice("aeioutrsn") for _ in range(r.randint(4, 8))) for _ in range(n)]
        for i in r.sample(range(n), n // 30 if toxic else 1):
            words[i] = "kolb"
        return " ".join(words)

    toxic = np.array([i % 6 == 0 for i in range(480)], float)
    found = [terms.of(text(r.choice([150, 300, 600]), t)) for t in toxic]
    model = fit_chain(found[:240], {"toxic": toxic[:240]}, np.arange(240) % 3)[0]
    rejected = np.array([model.probability(f, np.zeros(0)) for f in found[240:]]) >= THRESHOLD
    assert rejected[toxic[240:] == 1].mean() >= 0.95 and rejected[toxic[240:] == 0].mean() <= 0.01


def test_toxicity_of_odd_documents(spark):
    docs = odd_documents(spark)
    labels = spark.createDataFrame(
        [(2, 1, 0), (4, 1, 1), (7, None, 1), (None, 1, 1), (8, 0, 0), (8, 1, 0)], "doc_id long, quality int, toxic int"
    )
    out = toxicity_report(docs, labels)
    assert sorted(r.doc_id or -1 for r in out.collect()) == sorted(r.doc_id or -1 for r in docs.collect())
    none = labels.where("false")
    assert {r.rejected for r in toxicity_report(docs, none).collect()} == {False}
    kept = without_toxic(docs, none)
    assert kept.dtypes == docs.dtypes and tuples(kept) == tuples(docs)
    assert toxicity_report(no_documents(spark), labels).collect() == []
    assert without_toxic(no_documents(spark), labels).collect() == []


def test_columns_of_any_name_and_models_of_the_telling_terms_alone(spark, sf_dir):
    """Names with blanks; and the chain is the one that all terms of the sample give."""
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    odd = docs.withColumnRenamed("lang", "crawl date").withColumn("a.b `c`", F.lit(1))
    kept = without_toxic(odd, labels)
    assert kept.columns == odd.columns and kept.count() <= odd.count()
    assert mixed_documents(odd).columns == odd.columns
    sample = sorted(toxicity.labelled_sample(docs, labels, toxicity.SAMPLE, toxicity.FOLDS).collect())
    terms = [(np.array(r.numbers, np.int64), np.array(r.weights, np.float32)) for r in sample]
    y = {c: np.array([r[c] for r in sample], float) for c in toxicity.CATEGORIES}
    for a, b in zip(toxicity.train_chain(docs, labels), fit_chain(terms, y, np.array([r.fold for r in sample]))):
        assert np.allclose(a.words, b.words, atol=1e-6) and np.allclose(a.extra, b.extra, atol=1e-6) and abs(a.bias - b.bias) < 1e-6
