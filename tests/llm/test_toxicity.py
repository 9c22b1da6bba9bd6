"""Toxicity: held-out accuracy, small and odd tables."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from livetable.llm import toxicity as t
from livetable.llm.queries import QUERIES

from conftest import SF001


def test_held_out_accuracy(spark):
    """On the documents that no label was learned from: no clean one is called toxic
    often, and toxic ones rank above clean ones."""
    scored = QUERIES["op4_toxicity"](spark, "/root/testdata/sf0.1")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select("doc_id", "toxic")
    assert scored.count() == spark.read.parquet("/root/testdata/sf0.1/documents.parquet").count()
    held = scored.filter("held_out").join(labels, "doc_id").toPandas()
    bad, good = held[held.toxic == 1], held[held.toxic == 0]
    assert len(bad) > 50 and held.score.between(0, 1).all()
    assert (bad.predicted == 1).mean() > 0.9 and (good.predicted == 1).mean() < 0.01
    ranks = held.score.rank()
    auc = (ranks[held.toxic == 1].sum() - len(bad) * (len(bad) + 1) / 2) / (len(bad) * len(good))
    assert auc > 0.97


def test_odd_rows_and_columns(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF001}/labels.parquet").select("doc_id", "toxic")
    odd = spark.createDataFrame([(10_001, None, "q"), (10_002, "", "q"), (None, "idiot", "q"), (10_003, "you idiot " * 20_000, "q"),
                                 (10_003, "you idiot", "q")], "doc_id long, text string, score string")
    model = t.fit(docs, labels.union(spark.createDataFrame([(1, None), (None, 1), (5, 0), (5, 1)], "doc_id long, toxic int")), F.lit(True))
    got = [tuple(r) for r in model.score(odd).collect()]
    assert len(got) == 5 and all(0 <= s <= 1 and p == int(s >= 0.5) for _, s, p in got)
    by = dict((i, s) for i, s, _ in got)
    assert by[10_001] == by[10_002] and by[10_003] > 0.5
    assert model.score(odd.limit(0)).collect() == []


def test_without_labels_or_with_one_class(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r["score"] for r in t.fit(docs, none, F.lit(True)).score(docs).collect()} == {0.0}
    ones = spark.createDataFrame([(1, 1), (2, 1)], "doc_id long, toxic int")
    assert {r["predicted"] for r in t.fit(docs, ones, F.lit(True)).score(docs).collect()} == {1}


def test_scores_do_not_depend_on_the_file_layout(spark, tmp_path):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF001}/labels.parquet").select("doc_id", "toxic")
    docs.repartition(6).write.parquet(str(tmp_path / "six"))
    six = spark.read.parquet(str(tmp_path / "six"))
    one, other = ({r["doc_id"]: round(r["score"], 9) for r in t.fit(d, labels, F.lit(True)).score(d).collect()} for d in (docs, six))
    assert one == other and len(set(one.values())) > 2


def test_a_document_does_not_see_its_neighbours():
    texts = ["", "so it ends.", "b!!", "!! a", "", "a-b c.d", ".", "e", None, ""]
    none = np.zeros(0, np.uint64), np.zeros(0)
    together = t.features(*t.column_bytes(pa.array(texts)), 0, len(texts), *none)
    for k, text in enumerate(texts):
        alone = t.features(*t.column_bytes(pa.array([text], pa.string())), 0, 1, *none)
        assert (together[k] == alone[0]).all(), k
