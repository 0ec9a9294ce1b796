import numpy as np
import pytest

import corpus_pipeline as C
from asofia.llm import pii, quality_rules, simhash_forest
from asofia.llm.common import materialise

from .helpers import DOCS, document_rows, documents, odd
from .test_hilbert_pack import check
from .test_prefix_free import brute as repeats
from .test_quality_rules import labelled
from .test_simhash_forest import brute as classes


@pytest.fixture()
def folder(tmp_path, spark):
    rows, labels = labelled(240)
    extra = [(10_000 + (r[0] or 0) if r[0] is not None else None, *r[1:]) for r in document_rows()]
    for name, df in (("documents", odd(documents(spark, rows + extra))), ("labels", spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))):
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_stages_against_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    rules = quality_rules.fit(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    for k, (name, stage) in enumerate(C.STAGES):
        before = [(r.doc_id, r.text) for r in docs.collect()]
        docs = materialise(stage(spark, docs, folder), name)
        after = docs.collect()
        if k < 4:
            assert docs.columns == columns
            have = sorted(((r.doc_id, r.text) for r in after), key=str)
        if k == 0:
            def good(t):
                s = dict(zip(quality_rules.COUNTS + quality_rules.MORE, quality_rules.statistics(t or "")))
                x = {f: np.array([v]) for f, v in quality_rules.features({c: float(v) for c, v in s.items()}).items()}
                return s["n_words"] >= 50 and 100 * s["n_repeat_words"] <= 50 * s["n_words"] and not any(all(c.holds(x)[0] for c in r) for r in rules)

            assert have == sorted(((d, t) for d, t in before if good(t)), key=str)
        elif k == 1:
            firsts = {(c, n) if size > 1 else d for d, c, n, size in classes(before) for n in [None]}
            assert len(have) == len(firsts) and set(have) <= set(before)
        elif k == 2:
            assert have == sorted(((d, b.decode("utf-8", "ignore")) for d, *_, b in repeats(before)), key=str)
        elif k == 3:
            assert have == sorted(((d, pii.redact_text(t)) for d, t in before), key=str)
        else:
            check(after, before, 2048)
    assert sorted(map(tuple, C.run(spark, folder).collect()), key=str) == sorted(map(tuple, after), key=str)


@pytest.mark.parametrize("name,stage", C.STAGES)
def test_stages_on_awkward_tables(spark, folder, name, stage):
    for docs in (odd(documents(spark)), spark.createDataFrame([], DOCS)):
        got = stage(spark, docs, folder)
        if name != "packing":
            assert got.columns == docs.columns
        assert got.count() >= 0


def test_contract():
    assert [n for n, _ in C.STAGES] == ["quality_rules", "near_duplicates", "repeated_passages", "personal_data", "packing"] and C.ORACLE_SQL is None
    assert simhash_forest.DISTANCE < simhash_forest.BITS / 4
