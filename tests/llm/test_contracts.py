"""The operators against brute force on small tables with nulls, empty texts, copies, ties and clashing columns."""

import random
import re
from collections import Counter, defaultdict
from math import log
from zlib import crc32

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tallyframe.llm import backoff, decontaminate, jaccard_join, language_id, packing, quality_rules, queries, sharding, token_counts
from tallyframe.llm.work import Workspace

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)]
    base = [" ".join(rng.choices(vocabulary, k=rng.choice([3, 20, 60, 200]))) for _ in range(40)]
    out = [None, "", "   ", "one", "One", "alone here now"]
    for b in base:
        out.append(b)
        words = b.split()
        for _ in range(rng.choice([0, 0, 1, 4])):
            near = list(words)
            near[rng.randrange(len(near))] = "changed"
            out.append(" ".join(near))
        out += [b] * rng.choice([0, 0, 2])
    passage = " ".join(rng.choices(vocabulary, k=55))
    out += [passage + " " + " ".join(rng.choices(vocabulary, k=k)) for k in (5, 8, 40, 300)]
    return out


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, n_words string").repartition(3)


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def components(texts):
    """Shingle counts and the smallest place of each text's component, by comparing all pairs."""
    sets = []
    for t in texts:
        w = WORD.findall(low(t))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in range(len(texts))}


def test_links(spark, docs, texts):
    want = components(texts)
    for options in ({}, {"crowd": 2}, {"crowd": 2, "rounds": 1}, {"few": 0}):
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.link(docs, Workspace(spark, "t"), **options).collect()}
        assert got == want, options


def test_links_of_passages_and_chains(spark, tmp_path):
    """The registered query on texts that share a long passage, on chains of near copies and on a group of them."""
    rng = random.Random(11)
    draw = lambda k: rng.choices([f"v{i}" for i in range(900)], k=k)
    passage, texts = draw(120), []
    texts += [passage + draw(rng.randrange(5, 90)) for _ in range(60)]  # a passage of more than half of each text
    texts += [draw(rng.randrange(5, 40)) + passage[:80] + draw(9) for _ in range(30)]
    step = draw(150)
    for _ in range(25):  # a chain whose ends are not alike
        step = list(step)
        step[rng.randrange(150)] = rng.choice(["new", "other", "third"])
        texts.append(step)
    base = draw(200)
    for _ in range(90):
        near = list(base)
        for _ in range(rng.randrange(9)):
            near[rng.randrange(200)] = f"x{rng.randrange(10**6)}"
        texts.append(near)
    texts = [" ".join(t) for t in texts] + [" ".join(draw(20_000))] * 2
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in queries.op3_jaccard_join(spark, str(tmp_path)).collect()}
    assert got == components(texts)


def test_common_passages_need_no_second_tier(spark, monkeypatch):
    """Texts that quote one of a few passages are not taken for a crowd, and the links are right whatever the sample shows."""
    rng = random.Random(17)
    draw = lambda k: rng.choices([f"p{i}" for i in range(700)], k=k)
    passages = [draw(25) for _ in range(3)]
    texts = [draw(rng.randrange(40, 120)) + rng.choice(passages) + draw(60) for _ in range(150)]
    for base in texts[:20]:
        near = list(base)
        near[rng.randrange(len(near))] = "changed"
        texts.append(near)
    texts = [" ".join(x) for x in texts] + [" ".join(passages[0])] * 3 + [None, ""]
    docs, want = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), components(texts)
    for most in (jaccard_join.MOST_FREQUENT, 0):
        monkeypatch.setattr(jaccard_join, "MOST_FREQUENT", most)
        work = Workspace(spark, "t")
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.link(docs, work, crowd=16).collect()}
        assert got == want, most
        crowded = spark.read.parquet(work.path("crowded_nodes")).count()
        assert crowded <= 2 if most else crowded > 100, (most, crowded)


def test_links_of_repeated_and_null_keys(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (1, "x y"), (None, "a b c d e f"), (2, None), (None, None), (3, "x  Y")]
    got = jaccard_join.link(spark.createDataFrame(rows, "doc_id long, text string"), Workspace(spark, "t")).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(1, 2, 1), (1, 2, 1), (1, 1, 1), (None, 2, 1), (2, 0, 2), (None, 0, None), (3, 1, 1)], key=str)


@pytest.mark.parametrize("least", [1, 2, 3])
def test_backoff(spark, docs, texts, least):
    words = [WORD.findall(low(t)) for t in texts]
    counts = [Counter(tuple(w[i : i + n]) for w in words for i in range(len(w) - n + 1)) for n in (1, 2, 3)]
    total = sum(map(len, words))

    def one(gram):
        if len(gram) == 1:
            return log(counts[0][gram] / total) if counts[0][gram] >= least else log(1 / total)
        if counts[len(gram) - 1][gram] >= least:
            return log(counts[len(gram) - 1][gram] / counts[len(gram) - 2][gram[:-1]])
        return log(0.4) + one(gram[1:])

    got = {r["doc_id"]: r for r in backoff.score(docs, Workspace(spark, "t"), least=least).collect()}
    assert len(got) == len(texts)
    for i, w in enumerate(words):
        assert got[i]["n_words"] == len(w)
        assert got[i]["log_score"] == pytest.approx(sum(one(tuple(w[max(0, k - 2) : k + 1])) for k in range(len(w))), abs=1e-6)


def test_backoff_of_repeated_and_null_rows(spark):
    rows = [(1, "a b c d"), (1, "a b c d"), (None, "a b"), (None, None), (2, "z")]
    got = backoff.score(spark.createDataFrame(rows, "doc_id long, text string"), Workspace(spark, "t")).collect()
    twice = log(3 / 11) + log(3 / 3) + log(2 / 3) + log(2 / 2)
    want = [(1, 4, twice), (1, 4, twice), (None, 2, log(3 / 11)), (None, 0, 0.0), (2, 1, log(1 / 11))]
    assert sorted((str(r[0]), r[1], round(r[2], 9)) for r in got) == sorted((str(a), b, round(c, 9)) for a, b, c in want)


def test_decontaminate(spark, docs, texts):
    rng = random.Random(1)
    items = [("a", " ".join(texts[-1].split()[3:20])), ("b", texts[8]), ("c", "one"), ("d", None), ("e", ""), ("f", "w1 w2 never seen")]
    items += [(f"r{k}", " ".join((rng.choice([t for t in texts if t]) + " tail of it").split()[-30:])) for k in range(10)]
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(t))
    windows = defaultdict(set)
    for name, t in items:
        w = split(t)
        for i in range(max(1, len(w) - 12) if w else 0):
            windows[tuple(w[i : i + 13])].add(name)
    got = {r["doc_id"]: r for r in decontaminate.find(docs, spark.createDataFrame(items, "item_id string, text string")).collect()}
    for i, t in enumerate(texts):
        w, hit, names = split(t), set(), set()
        for size in {len(x) for x in windows}:
            for k in range(len(w) - size + 1):
                if found := windows.get(tuple(w[k : k + size])):
                    hit |= set(range(k, k + size))
                    names |= found
        assert (got[i]["n_words"], got[i]["n_hit"], got[i]["items"]) == (len(w), len(hit), sorted(names))


def test_packing(spark, docs, texts):
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    for capacity in (2048, 64):
        rows = packing.pack(docs, Workspace(spark, "t"), path, capacity=capacity).collect()
        by_doc, by_bin = defaultdict(list), defaultdict(list)
        for r in rows:
            by_doc[r["doc_id"]].append((r["start"], r["length"], bytes(r["ids"])))
            by_bin[r["sequence_id"]].append((r["offset"], r["length"]))
        for i, t in enumerate(texts):
            want = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
            assert b"".join(x[2] for x in sorted(by_doc[i])) == b"".join(x.to_bytes(4, "little") for x in want)
        for pieces in by_bin.values():
            at = 0
            for offset, length in sorted(pieces):
                assert offset == at
                at += length
            assert at <= capacity


def test_sharding(spark, docs, texts):
    rows = sharding.external_shuffle(docs, Workspace(spark, "t")).collect()
    assert sorted(r["doc_id"] for r in rows) == list(range(len(texts)))
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
        data = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(data) + 1, crc32(data))
    assert len(slots) == 16 and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


def test_quality_counts(spark, docs, texts):
    got = {r["doc_id"]: r for r in quality_rules.apply(docs).collect()}
    for i, t in enumerate(texts):
        w = WORD.findall(t or "")
        at = defaultdict(list)
        for k in range(len(w) - 2):
            at[tuple(w[k : k + 3])].append(k)
        repeated = {k + d for places in at.values() if len(places) > 1 for k in places for d in range(3)}
        assert (got[i]["n_words"], got[i]["word_chars"], got[i]["n_repeat_words"]) == (len(w), sum(map(len, w)), len(repeated))
    assert not quality_rules.apply(docs).where("kept").where("n_words < 50").count()


def test_languages(spark):
    rng = random.Random(2)
    words = {"xx": ["kala", "maito", "talo", "puu"], "yy": ["brot", "schiff", "strumpf", "zwei"]}
    rows = [(k, " ".join(rng.choices(words[lang], k=12)), lang) for k, lang in enumerate(["xx", "yy"] * 40)] + [(900, None, "xx"), (901, "123 --", "yy"), (902, "talo", None)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["doc_id"]: r for r in language_id.predict(table, language_id.train(table)).collect()}
    assert all(got[k]["lang_pred"] == lang and 0 <= got[k]["score"] <= 1 for k, _, lang in rows[:80])
    assert [got[k]["lang_pred"] for k in (900, 901, 902)] == ["und", "und", "xx"]


def test_rollup(spark, docs, tmp_path):
    rollup = token_counts.TokenRollup(spark, str(tmp_path / "r"))
    row = "op string, doc_id long, source string, lang string, tokenizer string, n_tokens long"
    make = lambda *rows: spark.createDataFrame(list(rows), row)
    assert rollup.commit("1", make(("insert", 1, "s", "en", "t", 5), ("insert", 2, None, "en", "t", 7)))
    assert rollup.commit("2", make(("revise", 1, "s", "fr", "t", 6), ("delete", 2, None, None, "t", None), ("delete", 9, None, None, "t", None)))
    assert not rollup.commit("2", make(("insert", 3, "s", "en", "t", 1)))
    assert [tuple(r) for r in rollup.totals().collect()] == [("s", "fr", "t", 1, 6)]


def test_rollup_of_null_and_repeated_documents(spark, tmp_path):
    rollup = token_counts.TokenRollup(spark, str(tmp_path / "r"))
    row = "op string, doc_id long, source string, lang string, tokenizer string, n_tokens long"
    make = lambda *rows: spark.createDataFrame(list(rows), row)
    rollup.commit("1", make(("insert", None, "s", "en", "t", 5), ("insert", 1, "s", "en", "t", 7), ("insert", 1, "s", "en", "t", 7), ("insert", 1, "s", "en", "t", 3)))
    assert [tuple(r) for r in rollup.totals().collect()] == [("s", "en", "t", 2, 12)]
    rollup.commit("2", make(("revise", None, "s", "en", "t", 1), ("delete", 1, None, None, "t", None)))
    rollup.commit("3", make())
    assert [tuple(r) for r in rollup.totals().collect()] == [("s", "en", "t", 1, 1)]


def test_clashing_columns_pass_through(spark, tmp_path):
    import corpus_pipeline

    rows = [(k, f"{k} " + "the quick brown fox and the lazy dog of it all " * 3 + " ".join(f"word{k}x{j} of" for j in range(40)), "en", 42, 43, 44, "y") for k in range(8)]
    rows += [(None, None, None, None, None, None, None), (100, "", "", 0, 0, 0, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, n_words long, score long, items long, row string")
    spark.createDataFrame([("a", "never seen here")], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.schema == docs.schema, name
        kept = {r["doc_id"]: tuple(r) for r in out.collect()}
        assert all(kept.get(r[0]) == r for r in rows[:8]), name
    with pytest.raises(ValueError, match="reserved"):
        quality_rules.apply(docs.withColumnRenamed("items", "_quality_words"))


def test_pipeline_against_its_stages(spark, tmp_path):
    """run() gives what the brute-force stages leave: kept, accepted, first of each group, clean; packed without loss."""
    import corpus_pipeline

    rng = random.Random(8)
    en = ["the", "of", "and", "river", "stone", "winter", "garden", "window", "house", "morning", "paper", "silver", "music", "yellow", "summer", "letter"]
    draw = lambda k: " ".join(rng.choice(en) + (str(rng.randrange(999)) if rng.random() < 0.3 else "") for _ in range(k))
    base = [draw(120) for _ in range(30)]
    item = draw(20)
    texts = [*base, *base[:5], base[6] + " end", "short", None, base[7] + " " + item]
    spark.createDataFrame([(k, t, "en") for k, t in enumerate(texts)], "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([("a", item)], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    got = {r["doc_id"]: r["doc_tokens"] for r in rows}
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    good = {r["doc_id"] for r in quality_rules.apply(docs).where("kept").collect()}
    same = components(texts)
    want = {k for k in good if same[k][1] == k and item not in texts[k]}
    assert set(got) == want and len(want) >= 25
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    assert got == {k: len(tokenizer.encode(texts[k], add_special_tokens=False).ids) + 1 for k in want}


def test_repeated_windows_with_mixed_hashes(spark, monkeypatch):
    """Equal windows are found also where other windows agree in the high bits, and beyond the places that fit in them."""
    rng = random.Random(9)
    text = " ".join(rng.choices([f"w{i}" for i in range(12)], k=400))
    w = text.split()
    at = defaultdict(list)
    for k in range(len(w) - 2):
        at[tuple(w[k : k + 3])].append(k)
    want = len({k + d for places in at.values() if len(places) > 1 for k in places for d in range(3)})
    table = spark.createDataFrame([(1, text)], "doc_id long, text string")
    for place in ((1 << 26) - 1, (1 << 62) - 1, 7):  # no high bits to tell windows apart; places that don't fit
        monkeypatch.setattr(quality_rules, "PLACE", place)
        assert quality_rules.apply(table).first()["n_repeat_words"] == want


def test_plain_kneser_ney(spark):
    """The interpolated probabilities of the tables against a plain recursion."""
    import numpy as np
    import pyarrow as pa

    texts = {"xx": ["kala maito talo", "puu kala kala"], "yy": ["brot schiff", "zwei brot brot x"]}
    counts = {}
    for label, group in texts.items():
        codes, offsets = language_id.code_points(pa.array(group, pa.large_string()))
        counts[label] = np.unique(language_id.grams(codes, offsets), return_counts=True)
    model = language_id.build(counts)
    alphabet = {c for group in texts.values() for t in group for c in t} | {""}

    def grams(text, order):
        return [tuple(text[i - k] if i >= k else "" for k in range(order - 1, -1, -1)) for i in range(len(text))]

    def probability(label, gram):
        order = len(gram)
        if not order:
            return 1 / len(alphabet)
        if order == language_id.ORDER:
            found = Counter(g for t in texts[label] for g in grams(t, order))
        else:
            found = Counter(g[-order:] for g in {g for t in texts[label] for g in grams(t, order + 1)})
        once, two = (sum(n == k for n in found.values()) for k in (1, 2))
        discount = min(0.95, max(0.05, once / max(1, once + 2 * two)))
        total = sum(n for g, n in found.items() if g[:-1] == gram[:-1])
        if not total:
            return probability(label, gram[1:])
        types = sum(g[:-1] == gram[:-1] for g in found)
        return max(found[gram] - discount, 0) / total + discount * types / total * probability(label, gram[1:])

    for text in ("kala", "brot maito", "talo zwei puu"):
        bits, size = language_id.cross_entropy(model, pa.array([text], pa.large_string()))
        for k, label in enumerate(model.labels):
            want = -sum(log(probability(label, g)) for g in grams(text, language_id.ORDER)) / len(text) / log(2)
            assert size[0] == len(text) and bits[0, k] == pytest.approx(want, abs=1e-4)


def test_many_labels_and_rare_grams(spark):
    """No label and no n-gram of the sample is left out."""
    rows = [(k, f"{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}q" * 6, f"l{k % 600}") for k in range(1200)]
    model = language_id.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), per_label=10**6)
    assert len(model.labels) == 600


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert jaccard_join.link(none, Workspace(spark, "t")).count() == 0
    assert backoff.score(none, Workspace(spark, "t")).count() == 0
    assert packing.pack(none, Workspace(spark, "t"), public_tokenizers.path("word_bpe_49k.json")).count() == 0
    assert sharding.external_shuffle(none, Workspace(spark, "t")).count() == 0
    assert language_id.predict(none, language_id.train(none)).count() == 0
