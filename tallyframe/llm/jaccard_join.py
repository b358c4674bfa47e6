"""N-gram Jaccard self-join with adaptive multi-match prefixes, exact, as components of linked documents.

A document is its set of distinct 5-word shingles (64-bit hashes). Two sets of x and y shingles are similar if they share
o = ceil(t (x + y) / (1 + t)) or more. Then, in any common order, the first x - o + l of the one and the first y - o + l of
the other share l or more. With l = 1 this is the usual prefix filter; with a larger l the prefixes are longer, but l shared
tokens are required before a pair is verified, which few documents that merely quote the same passage reach.

Each document gets its own l, a power of two. Its estimated candidate cost under l is what its prefix tokens meet (the sum
of the others that have them, in the prefix for partners of its own size), and for each document that could share l of them, an l-th part of that sum, a verification;
the l of the least cost is taken. Two documents use the smaller of their two l.

Tokens are ordered in two tiers. The first orders them by their hash, so that only a third of all shingles is counted; those
of common passages, which a sample of the texts shows, come after all others. Its posting lists of more than ``crowd``
documents are left out; instead all documents of such a list post in a second tier, over their whole sets, rarest tokens
first. If two similar documents meet in a crowded list, both are in the second tier and meet there; if they don't, no list
that they share was left out. So what the sample shows or misses changes which documents need the second tier, and no result.

Equal sets are one node. Large groups of near copies don't become all pairs: in rounds, each posting list is held against
one node, the likeliest centre of a group, and a list that lies in one component is done. When the pairs that are left,
across components, are few for the lists' size, they are formed, counted and those with l matches verified on the whole
shingle sets. A star's pair is held to l matches among the lists of its centre; one that has fewer waits for the last step.
Texts and not sets travel to the verification: they have fewer bytes, compressed, and need not be kept.

Defined results: null, empty or wordless texts have no shingles and are linked with nothing; a text of fewer than five
words is one shingle; rows that repeat a document are linked with it; rows with the same key and different texts are
different documents; a null key is a key like others, and the smallest of a group with other keys is one of those; ties need
no rule, since links are symmetric. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyframe.llm import dealt
from tallyframe.llm import textbytes as tb
from tallyframe.llm.components import connected
from tallyframe.llm.work import Workspace

WIDTH = 5


def shingle_sets(column: pa.Array, width: int = WIDTH) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    for lo, hi in tb.blocks(column):
        w = tb.words(column.slice(lo, hi - lo))
        h = tb.hashes(w)
        full = tb.windows(h, width)
        for a, b in zip(w.offsets[:-1].tolist(), w.offsets[1:].tolist(), strict=True):
            if b - a >= width:
                yield np.unique(full[a : b - width + 1])
            else:
                yield tb.windows(h[a:b], b - a) if b > a else full[:0]


#: Candidates for l, and what the verification of a pair costs against the meeting of two documents in a token.
LEVELS = (1, 2, 4, 8, 16, 32)
VERIFY_COST = 16


def _most(n: int) -> int:
    """The largest l for a set of n shingles."""
    return n // 10 + 1


class Threshold:
    """Similarities of at least percent / 100."""

    def __init__(self, percent: int):
        self.percent = percent

    def long(self, n: int) -> int:
        """Length of the longest prefix."""
        return n - -(-self.percent * n // 100) + _most(n)

    def similar(self, a: np.ndarray, b: np.ndarray) -> bool:
        if 100 * min(len(a), len(b)) < self.percent * max(len(a), len(b)):
            return False
        both = len(np.intersect1d(a, b, assume_unique=True))
        return 100 * both >= self.percent * (len(a) + len(b) - both)

    def shared(self, n: str, m: str) -> str:
        """SQL: what similar sets of n and m shingles share at least."""
        return f"({self.percent} * ({n} + {m}) + {99 + self.percent}) div {100 + self.percent}"

    def prefix(self, l: int | str, m: str | None = None) -> str:  # noqa: E741
        """SQL: length of the prefix of n shingles that holds for a partner of m, or for every partner."""
        return f"(n - {self.shared('n', m)} + {l})" if m else f"(n - ({self.percent} * n + 99) div 100 + {l})"

    def reach(self) -> str:
        """SQL: the largest partner that a token at place ``at`` can still help to find."""
        return f"((n + l - 1 - at) * {100 + self.percent} div {self.percent} - n)"

    def meet(self, a: str, b: str) -> str:
        """SQL: whether the places of a token that two documents share lie in both prefixes of their common l."""
        return " AND ".join(f"{x}at + {self.shared(f'{a}n', f'{b}n')} <= {x}n + least({a}l, {b}l) - 1" for x in (a, b))


def _frequent_last(s: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """A sorted set in the first tier's order; ``frequent`` is sorted too."""
    if not len(frequent):
        return s
    late = frequent[np.minimum(np.searchsorted(frequent, s), len(frequent) - 1)] == s
    return np.concatenate([s[~late], s[late]]) if late.any() else s


def _signatures(t: Threshold, sent: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = sent.value
        salt = np.uint64(0xA5A5A5A5A5A5A5A5)
        for batch in batches:
            n, d1, d2, prefixes = [], [], [], []
            for s in shingle_sets(tb.as_strings(batch.column("text"))):
                n.append(len(s))
                d1.append(int(tb.mix(s ^ salt).sum(dtype=np.uint64).astype(np.int64)))
                d2.append(int((s * s + s).sum(dtype=np.uint64).astype(np.int64)))
                prefixes.append(_frequent_last(s, frequent)[: t.long(len(s))] if len(s) else s)
            sizes = np.fromiter(map(len, prefixes), np.int64, len(prefixes))
            flat = np.concatenate(prefixes).view(np.int64) if prefixes else np.zeros(0, np.int64)
            tokens = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("node"), pa.array(n, pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()), tokens], ["doc_id", "node", "n", "d1", "d2", "tokens"])

    return run


def _verify(t: Threshold):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = []
            for node, text in (("u", "text_u"), ("v", "text_v")):
                ids = batch.column(node).to_numpy()
                _, first, at = np.unique(ids, return_index=True, return_inverse=True)
                sides.append((list(shingle_sets(tb.as_strings(batch.column(text)).take(pa.array(first)))), at.tolist()))
            (us, at_u), (vs, at_v) = sides
            yield batch.select(["u", "v"]).filter(pa.array([t.similar(us[i], vs[j]) for i, j in zip(at_u, at_v, strict=True)], pa.bool_()))

    return run


def _lengthened(tokens: DataFrame, t: Threshold, most: int | None = None) -> DataFrame:
    """(token, node, n, l, at): what each node posts, from the tokens (token, node, n, at, df) that it shares with others.

    ``most``: tokens of more nodes are left out.
    """
    live = tokens if most is None else tokens.where(F.col("df") <= most)
    levels = LEVELS
    met = [F.sum(F.expr(f"CASE WHEN at < {t.prefix(x, 'n')} THEN df - 1 ELSE 0 END")).alias(f"met{x}") for x in levels]
    by_node = live.groupBy("node").agg(F.max("n").alias("n"), *met, F.collect_list(F.struct("at", "token")).alias("tokens"))
    costs = [F.when(F.expr(f"{x} <= n div 10 + 1"), F.struct((F.col(f"met{x}") * (1 + VERIFY_COST / x)).alias("cost"), F.lit(x).alias("l"))) for x in levels]
    by_node = by_node.select("node", "n", F.array_min(F.array_compact(F.array(*costs)))["l"].alias("l"), "tokens")
    posted = by_node.select("node", "n", "l", F.explode("tokens").alias("x")).select(F.col("x.token").alias("token"), "node", "n", "l", F.col("x.at").alias("at"))
    return posted.where(f"at < {t.prefix('l')}")


def _met(posted: DataFrame, t: Threshold) -> DataFrame:
    """``posted`` without the tokens with which a node can find nobody."""
    lists = posted.groupBy("tier", "token").agg(F.count("*").alias("size"), F.min("n").alias("least")).where("size > 1")
    return posted.join(lists.hint("shuffle_hash"), ["tier", "token"]).where(f"{t.reach()} >= least").drop("least")


#: Tokens that are ordered last, as they are sent to all workers, and how many texts of the sample have a token of ``crowd`` texts.
MOST_FREQUENT = 1 << 20
DRAWN = 16
#: Nodes that are sent to all workers to find their texts.
FEW_NODES = 100_000
#: Tokens that a worker holds before it sends them.
HELD = 1 << 19


def _dealt(part: int, passes: int, places: int):
    """Runs of tokens of one part, from (node, n, tokens), with the places that their hashes send them to."""

    def sent(held: list[list[np.ndarray]]) -> pa.RecordBatch:
        place, *columns = (np.concatenate(c) for c in zip(*held, strict=True))
        order = np.argsort(place, kind="stable")
        found, first = np.unique(place[order], return_index=True)
        bounds = np.append(first, len(order))
        return pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), *(dealt.runs(bounds, c[order]) for c in columns)], ["place", "token", "node", "n", "at"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            lists = batch.column("tokens")
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
            flat = lists.flatten().to_numpy().view(np.uint64)
            bucket = dealt.bucket(flat, passes * places)
            keep = np.flatnonzero((bucket >= part * places) & (bucket < (part + 1) * places))
            row = np.repeat(np.arange(len(sizes)), sizes)[keep]
            at = keep - (np.cumsum(sizes, dtype=np.int64) - sizes)[row]
            place = (bucket[keep] - np.uint64(part * places)).astype(np.uint16 if places <= 1 << 16 else np.int32)
            held.append([place, flat[keep], batch.column("node").to_numpy()[row], batch.column("n").to_numpy()[row].astype(np.int32), at.astype(np.int32)])
            size += len(keep)
            if size >= HELD:
                yield sent(held)
                held, size = [], 0
        if size:
            yield sent(held)

    return run


def _several(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of all runs of a place, the tokens that come twice or more, with df, how often they come."""
    c = dealt.gathered(batches, {"token": "u8", "node": "i8", "n": "i4", "at": "i4"})
    order = np.argsort(c["token"])
    token = c["token"][order]
    first = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]])) if len(token) else order
    df = np.diff(np.append(first, len(token)))
    df = np.repeat(df, df)
    keep = np.flatnonzero(df > 1)
    for lo in range(0, len(keep), 1 << 16):
        k = keep[lo : lo + (1 << 16)]
        at = order[k]
        columns = [token[k].view(np.int64), c["node"][at], c["n"][at].astype(np.int64), c["at"][at], df[k]]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["token", "node", "n", "at", "df"])


def _shared(rows: DataFrame, work: Workspace, name: str, passes: int) -> DataFrame:
    """(token, node, n, at, df) of the tokens of (node, n, tokens) that are also another row's; df is the number of its rows.

    In passes over parts of the tokens, so that only a part of all is shuffled at a time.
    """
    out, places = None, dealt.places(work.spark)
    for part in range(passes):
        sent = rows.select("node", "n", "tokens").mapInArrow(tb.released(_dealt(part, passes, places)), "place int, token binary, node binary, n binary, at binary")
        found = dealt.deal(sent, places).drop("place").mapInArrow(tb.released(_several), "token long, node long, n long, at int, df long")
        found = work.save(found, f"{name}{part}")
        work.free_shuffles()
        out = found if out is None else out.unionAll(found)
    return out


SETS = "node long, n long, tokens array<long>"


def _whole_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, n, tokens) of (node, text)."""
    for batch in batches:
        column = tb.as_strings(batch.column("text"))
        for lo, hi in tb.blocks(column):
            sets = list(shingle_sets(column.slice(lo, hi - lo)))
            n = np.fromiter(map(len, sets), np.int64, len(sets))
            tokens = pa.LargeListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)])), pa.array(np.concatenate(sets).view(np.int64))).cast(pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("node").slice(lo, hi - lo), pa.array(n), tokens], ["node", "n", "tokens"])


def _frequent(docs: DataFrame, work: Workspace, crowd: int) -> np.ndarray:
    """The sorted tokens that seem to be in about ``crowd`` different texts or more, at most ``MOST_FREQUENT``.

    Of every crowd / DRAWN texts one is read, chosen by its hash, so that copies count once. A token must come in 3 of 8 of
    those that a list of ``crowd`` texts has there; in more, where too many tokens do.
    """
    step = max(1, crowd // DRAWN)
    sample = docs.where(F.col("text").isNotNull() & (F.pmod(F.xxhash64("text"), F.lit(step)) == 0)).select("text").distinct()
    sets = sample.select(F.xxhash64("text").alias("node"), "text").mapInArrow(tb.released(_whole_sets), SETS)
    sets = work.save(sets, "sample")  # in one plan with the next step each task would hold two workers
    seen = _shared(sets, work, "sampled", 1).groupBy("token").agg(F.first("df").alias("df")).where(F.col("df") >= max(2, 3 * crowd // (8 * step)))
    seen = work.save(seen, "frequent")
    least, total = 0, 0
    for df, count in seen.groupBy("df").count().orderBy(F.desc("df")).collect():
        total += count
        if total > MOST_FREQUENT:
            break
        least = df
    for name in ("sample", "sampled0"):
        work.drop(name)
    work.free_shuffles()
    if not least:
        return np.zeros(0, np.uint64)
    return np.sort(seen.where(F.col("df") >= least).select("token").toArrow().column("token").to_numpy().view(np.uint64))


def _first_tier(signatures: DataFrame, nodes: DataFrame, work: Workspace, passes: int) -> DataFrame:
    """(token, node, n, at, df) of the tokens that several nodes have in their longest prefixes, in the order of their hashes."""
    rows = work.save(signatures.select("node", "n", "tokens").join(nodes.select("node").hint("shuffle_hash"), "node"), "prefixes")
    work.drop("signatures")  # the passes read the nodes' prefixes alone
    work.free_shuffles()
    out = _shared(rows, work, "tokens", passes)
    work.drop("prefixes")
    return out


def _second_tier(texts: DataFrame, work: Workspace, passes: int) -> DataFrame:
    """(token, node, n, at, df) of the tokens that several of these nodes have, rarest first."""
    rows = work.save(texts.mapInArrow(tb.released(_whole_sets), SETS), "crowded")
    shared = _shared(rows, work, "crowd_tokens", passes)
    work.drop("crowded")
    by_node = shared.groupBy("node").agg(F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("df", "token"))).alias("tokens"))
    # Tokens that nobody shares come first.
    return by_node.select("node", "n", F.posexplode("tokens").alias("k", "x"), F.size("tokens").alias("shared")).select(F.col("x.token").alias("token"), "node", "n", (F.col("n") - F.col("shared") + F.col("k")).alias("at"), F.col("x.df").alias("df"))


def link(docs: DataFrame, work: Workspace, *, percent: int = 75, crowd: int = 256, rounds: int = 6, few: int = 4, passes: int = 2, key: str = "doc_id", text: str = "text") -> DataFrame:
    """For each row: doc_id, n_shingles and component_id, the smallest key that its links reach.

    The last step begins when the pairs left in the lists are ``few`` times the rows of the lists or no longer get fewer by a
    tenth in a round, or after ``rounds``.
    """
    t = Threshold(percent)
    docs = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    plain = docs.groupBy("doc_id").count().where("doc_id IS NULL OR count > 1").isEmpty()
    docs = docs.withColumn("node", F.col("doc_id").cast("long") if plain and dict(docs.dtypes)["doc_id"] in ("bigint", "int") else F.xxhash64("doc_id", "text"))
    schema = StructType([docs.schema["doc_id"], *StructType.fromDDL("node long, n long, d1 long, d2 long, tokens array<long>")])
    sent = work.spark.sparkContext.broadcast(_frequent(docs, work, crowd))
    signatures = work.save(docs.mapInArrow(tb.released(_signatures(t, sent)), schema), "signatures")
    classes = signatures.where("n > 0").groupBy("d1", "d2").agg(F.min("node").alias("node"), F.min("doc_id").alias("first"))
    classes = work.save(classes, "classes")
    n_nodes = classes.count()
    keys = work.save(signatures.select("doc_id", "n", "d1", "d2"), "keys")
    once = signatures.where("n > 0") if plain else signatures.where("n > 0").dropDuplicates(["node"])
    tokens = _first_tier(once, classes, work, passes)
    texts = docs.select("node", "text") if plain else docs.select("node", "text").dropDuplicates(["node"])
    crowded = work.save(tokens.where(F.col("df") > crowd).where(f"at < {t.prefix(1)}").select("node").distinct(), "crowded_nodes")
    lists = None
    for tier, most in ((1, crowd), (2, None)):
        if tier == 2:
            tokens = _second_tier(texts.join(crowded, "node"), work, passes)
        posted = work.save(_lengthened(tokens, t, most).withColumn("tier", F.lit(tier)), f"posted{tier}")
        work.free_shuffles()
        lists = _met(posted, t) if lists is None else lists.unionAll(_met(posted, t))
    for part in range(passes):
        work.drop(f"tokens{part}")
        work.drop(f"crowd_tokens{part}")
    # The node whose shingles most others share is the likeliest centre of a group of copies.
    lists = work.save(lists, "met")
    weights = lists.groupBy("node").agg(F.sum("size").alias("weight"))
    lists = work.save(lists.drop("size").join(weights, "node"), "lists")
    for name in ("posted1", "posted2", "met"):
        work.drop(name)
    work.free_shuffles()

    def matched(rows: DataFrame) -> DataFrame:
        """Pairs with as many common tokens as their l asks for, from (u, v, tier, l) with a row for each token."""
        return rows.groupBy("u", "v", "tier").agg(F.min("l").alias("l"), F.count("*").alias("k")).where("k >= l").select("u", "v").distinct()

    def verified(pairs: DataFrame, name: str) -> DataFrame:
        pairs = work.save(pairs, f"{name}_pairs")
        needed = pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct()
        # The nodes of a late round are few: then the other texts are left out before all are shuffled.
        mine = texts.join(F.broadcast(needed), "node", "left_semi") if needed.count() <= min(FEW_NODES, n_nodes // 4) else texts
        both = pairs.join(mine.select(F.col("node").alias("v"), F.col("text").alias("text_v")), "v").join(mine.select(F.col("node").alias("u"), F.col("text").alias("text_u")), "u")
        out = work.save(both.mapInArrow(tb.released(_verify(t)), "u long, v long"), f"{name}_links")
        work.free_shuffles()
        return out

    spark, sides = work.spark, ["node", "n", "l", "at", "root"]
    links = spark.createDataFrame([], "u long, v long")
    tried, left, before = links, lists.withColumn("root", F.col("node")), None
    for k in range(rounds):
        # The best node of a list, and from the second round on the best one outside of that one's component.
        best = left.groupBy("tier", "token").agg(F.max(F.struct("weight", *sides)).alias("c"))
        if k:
            other = left.join(best.select("tier", "token", F.col("c.root").alias("first")), ["tier", "token"]).where("root <> first")
            best = other.groupBy("tier", "token").agg(F.max(F.struct("weight", *sides)).alias("c"))
        pairs = left.join(best, ["tier", "token"]).where(f"root <> c.root AND {t.meet('', 'c.')}")
        pairs = matched(pairs.select(F.least("node", "c.node").alias("u"), F.greatest("node", "c.node").alias("v"), "tier", F.least("l", "c.l").alias("l")))
        found = verified(pairs.join(tried, ["u", "v"], "left_anti"), f"star{k}")
        tried = tried.unionAll(spark.read.parquet(work.path(f"star{k}_pairs")))
        roots = connected(links.unionAll(found), work, f"near{k}_")
        links = roots.where("node <> root").select(F.col("node").alias("u"), F.col("root").alias("v"))  # the same components
        # A list that is done, or a row that finds nobody in its list, stays so: only what is left needs the new roots.
        labelled = left.drop("root").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        several = labelled.groupBy("tier", "token").agg(F.min("root").alias("a"), F.max("root").alias("b"), F.min("n").alias("least")).where("a < b").select("tier", "token", "least")
        left = work.save(labelled.join(several, ["tier", "token"]).where(f"{t.reach()} >= least").drop("least"), f"mixed{k}")
        work.drop(f"mixed{k - 1}" if k else "lists")
        work.free_shuffles()
        sizes = left.groupBy("tier", "token", "root").agg(F.count("*").alias("s")).groupBy("tier", "token").agg(F.sum("s").alias("s"), F.sum(F.col("s") * F.col("s")).alias("own"))
        rows, cross = sizes.agg(F.sum("s"), F.sum((F.col("s") * F.col("s") - F.col("own")) / 2)).first()
        if (cross or 0) <= few * (rows or 0) or (before is not None and cross > 0.9 * before):
            break
        before = cross
    a, b = (left.select("tier", "token", *[F.col(c).alias(f"{x}_{c}") for c in sides]) for x in "ab")
    across = a.join(b, ["tier", "token"]).where(f"a_node < b_node AND a_root <> b_root AND {t.meet('a_', 'b_')}")
    pairs = matched(across.select(F.col("a_node").alias("u"), F.col("b_node").alias("v"), "tier", F.least("a_l", "b_l").alias("l")))
    cross = verified(pairs.join(tried, ["u", "v"], "left_anti"), "cross")
    roots = connected(links.unionAll(cross), work, "all")
    linked = classes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = linked.groupBy("root").agg(F.min("first").alias("component_id"))
    found = work.save(linked.join(smallest, "root").select("d1", "d2", "component_id"), "found")
    rows = keys.select("doc_id", F.col("n").alias("n_shingles"), "d1", "d2")
    whole = rows.where("n_shingles > 0").join(found, ["d1", "d2"]).select("doc_id", "n_shingles", "component_id")
    return whole.unionAll(rows.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
