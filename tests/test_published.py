"""Versioned publication: numbers are put only where absent, and serving names them."""

import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from livetable.operators import published as pub
from livetable.operators import recommend as rec


def test_versions_are_put_only_where_absent(spark, tmp):
    root = os.path.join(tmp, "registry")
    assert pub.current(spark, root) is None and pub.versions(spark, root) == []
    assert pub.publish(spark, root, "a", 1.0) == 1
    assert not pub.put_if_absent(spark, root, 1, "other", 0.5)
    assert pub.publish(spark, root, "refused", 9.0) is None
    assert pub.publish(spark, root, "refused", float("nan")) is None
    assert pub.current(spark, root) == (1, "a", 1.0)
    # A publisher that was lost while writing: its number is taken, but never current.
    with open(f"{root}/v=2.json", "w") as f:
        f.write('{"path": "lo')
    assert pub.current(spark, root) == (1, "a", 1.0)
    assert pub.publish(spark, root, "b", 1.2) == 3
    assert pub.current(spark, root) == (3, "b", 1.2)
    assert pub.versions(spark, root) == [(1, "a", 1.0), (3, "b", 1.2)]


def test_publishers_at_once_get_numbers_of_their_own(spark, tmp):
    root = os.path.join(tmp, "registry")
    with ThreadPoolExecutor(4) as pool:
        got = list(pool.map(lambda k: pub.publish(spark, root, f"m{k}", 1.0), range(12)))
    assert sorted(got) == list(range(1, 13))
    assert {(p.version, p.path) for p in pub.versions(spark, root)} == {(v, f"m{k}") for k, v in enumerate(got)}


def test_a_batch_is_served_by_the_version_current_when_it_begins(spark, tmp):
    root = os.path.join(tmp, "registry")
    ratings = spark.createDataFrame([(s, q, float(1 + (s + q) % 3)) for s in range(1, 9) for q in range(1, 13)],
                                    "student_id long, question_id long, rating float")
    small = ratings.filter("student_id <= 4")
    answers = spark.createDataFrame([(f"{rec.STUDENT_PREFIX}{s}", f"{rec.QUESTION_PREFIX}1") for s in (1, 1, 7)],
                                    "student_id string, question_id string")
    out = {}
    fn = pub.serve_versioned(spark, root, lambda df, b: out.update({b: [tuple(r) for r in df.select("student_id", "model_version").collect()]}), k=2)
    with pytest.raises(rec.NoModel):
        fn(answers, 0)
    kw = {"rank": 2, "max_iter": 2, "num_blocks": 1}
    assert pub.train_and_publish(spark, small, f"{tmp}/m0", root, gate=0.0, **kw)[0] is None
    assert not os.path.exists(f"{tmp}/m0")
    assert pub.train_and_publish(spark, small, f"{tmp}/m1", root, gate=9.0, **kw)[0] == 1
    fn(answers, 0)
    assert pub.train_and_publish(spark, ratings, f"{tmp}/m2", root, gate=9.0, **kw)[0] == 2
    fn(answers, 1)
    fn(answers.filter(F.lit(False)), 2)
    one, seven = f"{rec.STUDENT_PREFIX}1", f"{rec.STUDENT_PREFIX}7"
    assert out == {0: [(one, 1)] * 2, 1: out[1]}
    assert sorted(out[1]) == [(one, 2), (one, 2), (seven, 2)]
