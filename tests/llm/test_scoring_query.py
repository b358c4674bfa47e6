"""The registered scoring query counts n-grams that occur once."""

import random
import re
from collections import Counter
from math import log

import pytest

from tallyframe.llm.queries import op8_lm_scoring


def test_single_ngrams_count(spark, tmp_path):
    rng = random.Random(3)
    texts = [None, "", "one", *(" ".join(rng.choices([f"w{i}" for i in range(60)], k=k)) for k in (2, 3, 40, 90))]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    words = [re.findall(r"\S+", t or "") for t in texts]
    counts = Counter(tuple(w[i : i + n]) for w in words for n in (1, 2, 3) for i in range(len(w) - n + 1))
    total = sum(map(len, words))

    def one(gram):
        if len(gram) == 1:
            return log(counts[gram] / total)
        return log(counts[gram] / counts[gram[:-1]]) if counts[gram] else log(0.4) + one(gram[1:])

    got = {r["doc_id"]: r["log_score"] for r in op8_lm_scoring(spark, str(tmp_path)).collect()}
    assert got == {i: pytest.approx(sum(one(tuple(w[max(0, k - 2) : k + 1])) for k in range(len(w))), abs=1e-4) for i, w in enumerate(words)}
