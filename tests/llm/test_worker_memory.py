"""What a reused Python worker keeps between the stages of the pipeline."""

import random

import numpy as np
import pyarrow as pa

from quantspark.llm import textvec as tv
from quantspark.llm import toxicity


def _column(texts):
    return tv.arrow_text(pa.array(texts, pa.string()))


def _texts(n, seed=5):
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 12))) for _ in range(4000)]
    return [" ".join(rng.choice(vocab) + rng.choice(["", "", ".", "!\n"]) for _ in range(rng.randint(0, 500)))
            for _ in range(n)]


def test_power_tables_of_a_worker_stay_small(monkeypatch):
    monkeypatch.setattr(tv, "_POWERS", tv._Cache())
    buf, offs = _column(_texts(1500))
    for part in (1 << 14, 1 << 17, 1 << 19, len(buf)):
        s, e, _ = tv.word_spans(buf[:part], np.minimum(offs, part))
        tv.span_hashes(buf[:part], s, e)
    assert len(buf) > 2 << 20
    assert sum(x.nbytes for pair in tv._POWERS.values() for x in pair) <= 8 << 20


def test_hashes_do_not_depend_on_the_chunks(monkeypatch):
    buf, offs = _column(_texts(60) + ["x" * (3 << 20), "x " * 1000])
    s, e, _ = tv.word_spans(buf, offs)
    whole = tv.span_hashes(buf, s, e)
    for chunk in (1 << 12, 1 << 20):
        monkeypatch.setattr(tv, "CHUNK_BYTES", chunk)
        monkeypatch.setattr(tv, "_POWERS", tv._Cache())
        assert (tv.span_hashes(buf, s, e) == whole).all()


def test_released_keeps_the_batches_and_releases_at_the_end(monkeypatch):
    ended = []
    monkeypatch.setattr(tv, "release", lambda: ended.append(True))
    batches = [pa.record_batch({"x": [1, 2]}), pa.record_batch({"x": [3]})]
    out = tv.released(lambda given: (b.slice(0, 1) for b in given))(iter(batches))
    assert next(out).to_pydict() == {"x": [1]} and not ended
    assert [b.to_pydict() for b in out] == [{"x": [3]}] and ended == [True]


def test_toxicity_scores_do_not_depend_on_the_slices(spark, monkeypatch):
    rows = [(i, t) for i, t in enumerate(_texts(300) + ["", None, "bad word. good word."])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    buf, offs = _column([t for _, t in rows])
    h = np.unique(toxicity.sentence_features(buf, offs)[0])[::50]
    weights = np.random.default_rng(3).normal(0, 1.5, len(h))
    got = []
    for size in (1 << 12, 3 << 20):
        monkeypatch.setattr(toxicity, "SCORE_BYTES", size)
        got.append(sorted(map(tuple, toxicity.score_documents(
            docs, toxicity.NoisyOrModel(h, weights, -2.0, -4.0)).collect()), key=lambda r: r[0]))
    assert got[0] == got[1] and 0 < sum(r[2] for r in got[0]) < len(rows)
