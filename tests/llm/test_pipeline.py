"""The pipeline as a whole: what each stage leaves, from its own input."""

import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

import corpus_pipeline
from llm.cases import no_documents, odd_documents
from orderlake.llm.common import documents, stored
from orderlake.llm.minhash import near_duplicates
from orderlake.llm.secret_scan import secret_report
from orderlake.llm.toxicity import toxicity_report


def test_stages(spark, sf_dir):
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    names = docs.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = stored(stage(spark, docs, sf_dir), name)
        assert docs.columns == names
        seen[name] = (before, docs)
    before, after = seen["toxicity"]
    kept = {r.doc_id for r in toxicity_report(before, labels).collect() if not r.rejected}
    assert {r.doc_id for r in after.collect()} == kept
    before, after = seen["near_dedup"]
    firsts = {r.class_id for r in near_duplicates(before).collect()}
    assert sorted(r.doc_id for r in after.collect()) == sorted(firsts)
    before, after = seen["secrets"]
    assert after.count() == before.count()
    assert not [r for r in secret_report(after).collect() if r.n_assign + r.n_access + r.n_hex]
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    assert sum(r.length for r in last) >= docs.count()
    assert len(corpus_pipeline.run(spark, sf_dir).collect()) == len(last)


def folder(spark, tmp_path, docs):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(i, i % 2, int(i % 3 == 0)) for i in range(1, 9)] + [(None, 1, 1), (5, None, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    return str(tmp_path)


def has_secret(text):
    """Matches that are too short are dropped, with what they cover."""
    assign = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    found = [len(m[1]) >= 6 for m in re.finditer(assign, text)]
    found += [len(m[0]) >= 20 for m in re.finditer("AKIA[A-Z0-9]+", text)]
    return any(found + [len(m[0]) >= 24 for m in re.finditer("[0-9a-f]+", text)])


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_stages_on_odd_rows_by_hand(spark, tmp_path):
    """Nulls, empty and long texts, repeated rows and clashing columns: each stage against plain
    Python on its own input."""
    odd = odd_documents(spark).withColumn("crawl date", F.lit("x"))
    sf_dir = folder(spark, tmp_path, odd)
    docs = documents(spark, sf_dir)
    names, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs.collect(), stored(stage(spark, docs, sf_dir), name)
        assert docs.columns == names
        seen[name] = (before, docs.collect())
    before, after = seen["toxicity"]
    assert not Counter(after) - Counter(before)
    before, after = seen["near_dedup"]
    bags = [Counter(zip(*(w[i:] for i in range(5)))) if len(w := re.findall(r"\w+", (r.text or "").lower())) >= 5 else None for r in after]
    for i, a in enumerate(bags):
        for b in bags[:i]:
            assert not (a and b) or sum((a & b).values()) < 0.8 * sum((a | b).values())
    assert {r.text for r in before if not r.text} >= {r.text for r in after if not r.text}
    before, after = seen["secrets"]
    assert Counter(r.doc_id for r in after) == Counter(r.doc_id for r in before)
    clean = {r.text for r in before if r.text and not has_secret(r.text)}
    assert clean <= {r.text for r in after} and not [r for r in after if has_secret(r.text or "")]
    before, after = seen["mixing"]
    sizes, took = Counter(), Counter()
    for rows, total in ((before, sizes), (after, took)):
        for r in rows:
            total[r.source] += len(words(r.text))
    assert all(took[s] <= 2 * sizes[s] + 128 for s in took)
    assert abs(sum(took.values()) - min(1.5, 2) * sum(sizes.values())) <= 128 * len(sizes)
    known = set().union(*(words(r.text) for r in before))
    assert all(set(words(r.text)) <= known for r in after)
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    by_sequence = defaultdict(list)
    for r in pieces:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for found in by_sequence.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at and length > 0
            at += length
        assert at <= 1024
    assert {r.doc_id for r in pieces} == {r.doc_id for r in after}
    # All stages again, in one run.
    assert len(corpus_pipeline.run(spark, sf_dir).collect()) == len(pieces)


def test_an_empty_table(spark, tmp_path):
    assert corpus_pipeline.run(spark, folder(spark, tmp_path, no_documents(spark))).collect() == []
