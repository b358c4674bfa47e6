"""Tokens of prefixes travel as runs and are counted over all of them."""

import random
from collections import Counter

import numpy as np

from tallyframe.llm import jaccard_join
from tallyframe.llm import textbytes as tb
from tallyframe.llm.work import Workspace


def test_shared_tokens(spark):
    rng = random.Random(9)
    hashes = tb.mix(np.arange(30_000, dtype=np.uint64))
    mixed = [(node, 400, np.sort(hashes[rng.sample(range(30_000), k=rng.choice([0, 3, 300]))]).view(np.int64).tolist()) for node in range(250)]
    table = spark.createDataFrame(mixed, "node long, n long, tokens array<long>").repartition(3)
    sent = table.mapInArrow(jaccard_join._dealt(0, 2, 8), "place int, token binary, node binary, n binary, at binary").count()
    assert sent <= 3 * 8
    df = Counter(x for _, _, tokens in mixed for x in tokens)
    want = sorted((x, node, n, at, df[x]) for node, n, tokens in mixed for at, x in enumerate(tokens) if df[x] > 1)
    assert want and sorted(map(tuple, jaccard_join._shared(table, Workspace(spark, "t"), "tokens", 2).collect())) == want
