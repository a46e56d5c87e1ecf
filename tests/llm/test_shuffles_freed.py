"""The class model's search does not pile up the shuffle files of its sweeps."""

import os

import numpy as np
from helpers import frame, odd_documents
from pyspark.sql import functions as F

from quantspark.llm import class_lm
from quantspark.llm.common import shared_dir, shuffles_freed

KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def test_setting_holds_inside_only(spark):
    before = spark.conf.get(KEY, None)
    try:
        with shuffles_freed(spark):
            assert spark.conf.get(KEY) == "true"
            raise KeyError
    except KeyError:
        pass
    assert spark.conf.get(KEY, None) == before


def test_sweeps_free_their_shuffles(spark, monkeypatch):
    before, seen = spark.conf.get(KEY, None), []
    moved, sums = class_lm._moved, class_lm._sums
    for name, step in (("_moved", moved), ("_sums", sums)):
        monkeypatch.setattr(class_lm, name, lambda *a, f=step: (seen.append(spark.conf.get(KEY)), f(*a))[1])
    docs = frame(spark, odd_documents())
    out = class_lm.class_lm_scores(docs, F.col("doc_id") % 7 == 2)
    assert len(seen) >= 2 and set(seen) == {"true"}
    assert spark.conf.get(KEY, None) == before
    assert out.count() == docs.count()


def test_search_keeps_two_sweeps_of_files(spark, monkeypatch):
    """The shared folder never holds more than the tokens, the vocabulary and the counts of two sweeps, and in the
    end what the scores are read from: the tokens and the coded words."""
    root = shared_dir(spark).removeprefix("file:")
    before, seen = set(os.listdir(root)), []
    sums = class_lm._sums
    monkeypatch.setattr(class_lm, "_sums", lambda *a: (seen.append(len(set(os.listdir(root)) - before)), sums(*a))[1])
    docs = frame(spark, odd_documents())
    out = class_lm.class_lm_scores(docs, F.col("doc_id") % 7 == 2)
    assert len(seen) >= 2 and max(seen) <= 4
    assert len(set(os.listdir(root)) - before) == 2
    assert out.count() == docs.count()


def test_run_sums_add_as_reduceat():
    rng = np.random.default_rng(2)
    size = rng.integers(1, 30, 4000)
    start, x = np.cumsum(size) - size, rng.normal(size=(int(size.sum()), 5))
    whole, seen = np.add.reduceat(x, start, axis=0), []
    for run, length in class_lm._batches(size):
        n = size[run]
        first = np.cumsum(n) - n
        at = np.repeat(start[run] - first, n) + np.arange(n.sum())
        assert (class_lm._run_sums(x[at], first, length) == whole[run]).all()
        seen.extend(run)
    assert sorted(seen) == list(range(len(size)))
