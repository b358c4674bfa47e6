"""N-grams and tokens travel as runs, a row for a chunk and a place, and are counted over all chunks."""

import random
from collections import Counter
from math import log

import numpy as np
import pytest

from tallyframe.llm import backoff, dealt
from tallyframe.llm.work import Workspace


def test_scores_over_chunks(spark):
    rng = random.Random(7)
    texts = ["", "one", "one two", None, *(" ".join(rng.choices([f"w{i}" for i in range(300)], k=k)) for k in (700_000, 700_000, 5, 60)), "one"]
    words = [(t or "").split() for t in texts]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    rows = docs.selectExpr("doc_id AS row", "coalesce(text, '') AS text")
    sent = rows.mapInArrow(backoff._sent((1, 2, 3), 3, 0, 2, 8), backoff.DEALT).select("chunk", "place").collect()
    assert 2 <= len({r["chunk"] for r in sent}) and len(sent) <= 25 * len({r["chunk"] for r in sent})

    counts = Counter(tuple(w[i : i + n]) for w in words for n in (1, 2, 3) for i in range(len(w) - n + 1))
    total = sum(map(len, words))
    got = {r["doc_id"]: r["log_score"] for r in backoff.score(docs, Workspace(spark, "t")).collect()}
    for i, w in enumerate(words):
        grams = [tuple(w[max(0, k - 2) : k + 1]) for k in range(len(w))]
        want = sum(log(counts[g] / (counts[g[:-1]] if len(g) > 1 else total)) for g in grams)
        assert got[i] == pytest.approx(want, rel=1e-9, abs=1e-9)


def test_runs():
    values = np.arange(7, dtype=np.int32)
    column = dealt.runs(np.array([0, 2, 2, 7]), values)
    assert [len(x) for x in column.to_pylist()] == [8, 0, 20]
    assert dealt.values(column, "i4").tolist() == values.tolist()
    assert dealt.values(column.slice(1, 2), "i4").tolist() == values[2:].tolist()
    assert dealt.values(column.slice(1, 1), "i4").tolist() == []
