"""Language identification with interpolated Kneser-Ney character models.

One model for each label, of character 4-grams over lower-cased letters with everything else as a space. Types of all
labels share one sorted array of hashes for each order, with a row of interpolated log probabilities (a column for each
label), so a character costs one search for all labels and only unseen n-grams go down to lower orders. The label with the
lowest cross-entropy a character wins. Held-back training documents calibrate the score (a temperature) and, for each
label, the cross-entropy above which a text is rejected.

Training reads a bounded sample: about ``per_label`` documents of each label, chosen by a hash of key and text, and
``calibrate`` more. These bounds alone bound the model, which is sent to all workers: every label and every n-gram of the
sample is learned, also those that occur once, from which the discounts come. Calibration is summed where it is measured: a
row for each label and step of a histogram comes to the driver, not one for each document. Prediction reads every character.

Defined results: null texts and texts without a letter get ``und``, score 0 and are not accepted; rows with a null label
train nothing, rows with a null key do; repeated rows are judged one by one; of labels with equal cross-entropies the first
in order of name wins; without any training rows everything is ``und``. Columns of the input named like those that
``predict`` adds are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyframe.llm import textbytes as tb

ORDER = 4
BITS = 16
UNKNOWN = "und"
#: Steps of the histogram of cross-entropies, and where it ends: in bits a character.
STEPS, MOST_BITS = 4096, 32.0
ADDED = "lang_pred string, score double, cross_entropy double, accepted boolean"
_SPACE = 32
#: Bytes of text that are scored at a time; each character takes some hundred bytes for it.
BLOCK = 1 << 18
_letters: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    """Whether a code point below 2^16 is a letter; the last entry stands for all above."""
    if not _letters:
        _letters.append(np.array([chr(c).isalpha() for c in range(1 << BITS)]))
    return _letters[0]


def code_points(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Each text's letters, with single spaces for the rest: codes of all texts and the n + 1 offsets."""
    column = pc.utf8_lower(column.fill_null("") if column.null_count else column)
    size = pc.utf8_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    points = np.frombuffer(tb.raw(column)[0].tobytes().decode().encode("utf-32-le"), np.uint32)
    offsets = np.concatenate([[0], np.cumsum(size)])
    small = np.minimum(points, (1 << BITS) - 1)
    letter = _is_letter()[small]
    beyond = np.flatnonzero(points >> BITS)
    if len(beyond):
        letter[beyond] = [chr(c).isalpha() for c in points[beyond].tolist()]
        small[beyond] = 0xE000 | (points[beyond] & 0xFFF)  # private codes: few texts need them
    first = np.zeros(len(points) + 1, bool)
    first[offsets] = True
    kept = letter.copy()
    kept[1:] |= letter[:-1]  # one space after each run of letters
    kept &= letter | ~first[: len(points)]
    codes = np.where(letter, small, _SPACE)[kept].astype(np.uint64)
    return codes, np.concatenate([[0], np.cumsum(kept)])[offsets]


def grams(codes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each character the code of itself and the ORDER - 1 before it in its text, 0 where there are none."""
    place = np.arange(len(codes)) - np.repeat(offsets[:-1], np.diff(offsets))
    out = codes.copy()
    for k in range(1, ORDER):
        before = np.zeros(len(codes), np.uint64)
        before[k:] = codes[:-k]
        before[place < k] = 0
        out |= before << np.uint64(BITS * k)
    return out


class Table(NamedTuple):
    hashes: np.ndarray  # sorted
    values: np.ndarray  # a row for each hash, a column for each label

    def find(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h = tb.mix(codes)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return at, self.hashes[at] == h


class Model(NamedTuple):
    labels: list[str]
    types: list[Table]  # of orders 1 to ORDER
    contexts: list[Table]  # log weights of the lower order, of orders 2 to ORDER
    floor: np.ndarray  # log probability of an unseen character
    limit: np.ndarray  # cross-entropies above are rejected
    temperature: float


def _suffix(codes: np.ndarray, order: int) -> np.ndarray:
    return codes & np.uint64((1 << BITS * order) - 1) if order < 4 else codes


class _One:
    """The Kneser-Ney model of one label, from its distinct n-grams of the highest order and their counts."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray, alphabet: int):
        self.alphabet, self.orders = alphabet, []
        for order in range(ORDER, 0, -1):
            if order < ORDER:  # lower orders count the types that end with them
                codes, counts = np.unique(_suffix(codes, order), return_counts=True)
            once, two = int((counts == 1).sum()), int((counts == 2).sum())
            discount = min(0.95, max(0.05, once / max(1, once + 2 * two)))
            context, at = np.unique(codes >> np.uint64(BITS), return_inverse=True)
            total = np.bincount(at, counts)
            weight = discount * np.bincount(at) / total
            self.orders.insert(0, (codes, np.maximum(counts - discount, 0), context, total, weight))

    def probability(self, codes: np.ndarray, order: int) -> np.ndarray:
        if order == 0:
            return np.full(len(codes), 1 / self.alphabet)
        known, counts, contexts, total, weight = self.orders[order - 1]
        codes = _suffix(codes, order)
        lower = self.probability(codes, order - 1)
        at = np.minimum(np.searchsorted(contexts, codes >> np.uint64(BITS)), len(contexts) - 1)
        seen = contexts[at] == codes >> np.uint64(BITS)
        i = np.minimum(np.searchsorted(known, codes), len(known) - 1)
        count = np.where(known[i] == codes, counts[i], 0)
        return np.where(seen, count / total[at] + weight[at] * lower, lower)

    def weight(self, context: np.ndarray, order: int) -> np.ndarray:
        _, _, contexts, _, weight = self.orders[order - 1]
        at = np.minimum(np.searchsorted(contexts, context), len(contexts) - 1)
        return np.where(contexts[at] == context, weight[at], 1.0)


def _table(codes: np.ndarray, columns: list[np.ndarray]) -> Table:
    h = tb.mix(codes)
    order = np.argsort(h)
    return Table(h[order], np.log(np.stack(columns, 1))[order].astype(np.float32))


def build(counts: dict[str, tuple[np.ndarray, np.ndarray]]) -> Model:
    """From each label's sorted distinct n-grams and their counts."""
    labels = sorted(counts)
    alphabet = len(np.unique(np.concatenate([_suffix(c, 1) for c, _ in counts.values()]))) + 1
    ones = [_One(*counts[x], alphabet) for x in labels]
    types, contexts = [], []
    for order in range(1, ORDER + 1):
        codes = np.unique(np.concatenate([m.orders[order - 1][0] for m in ones]))
        types.append(_table(codes, [m.probability(codes, order) for m in ones]))
        if order > 1:
            codes = np.unique(np.concatenate([m.orders[order - 1][2] for m in ones]))
            contexts.append(_table(codes, [m.weight(codes, order) for m in ones]))
    unseen = np.array([np.uint64(0)])
    floor = np.log([float(m.orders[0][4][0] / alphabet) if not (m.orders[0][0] == unseen).any() else 1 / alphabet for m in ones])
    return Model(labels, types, contexts, floor, np.full(len(labels), np.inf), 1.0)


def cross_entropy(model: Model, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Of each text under each label, in bits a character; and the number of characters, 0 for texts without letters."""
    codes, offsets = code_points(column)
    all_grams = grams(codes, offsets)
    size = np.diff(offsets)
    out = np.zeros((len(size), len(model.labels)))
    if not len(codes):
        return out, size
    score = np.zeros((len(codes), len(model.labels)), np.float32)
    left = np.arange(len(codes))
    for order in range(ORDER, 0, -1):
        g = _suffix(all_grams[left], order)
        at, hit = model.types[order - 1].find(g)
        score[left[hit]] += model.types[order - 1].values[at[hit]]
        left, g = left[~hit], g[~hit]
        if order > 1 and len(left):
            at, hit = model.contexts[order - 2].find(g >> np.uint64(BITS))
            score[left[hit]] += model.contexts[order - 2].values[at[hit]]
    score[left] += model.floor
    filled = size > 0
    out[filled] = -np.add.reduceat(score, offsets[:-1][filled], axis=0, dtype=np.float64) / size[filled, None] / np.log(2)
    return out, size


def _training_counts(rows: DataFrame) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column, labels = tb.as_strings(batch.column("text")), batch.column("label").to_numpy(zero_copy_only=False)
            for lo, hi in tb.blocks(column):
                codes, offsets = code_points(column.slice(lo, hi - lo))
                g = grams(codes, offsets)
                owner = np.repeat(labels[lo:hi], np.diff(offsets))
                for label in set(labels[lo:hi]):
                    types, n = np.unique(g[owner == label], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([label] * len(types), pa.string()), pa.array(types.astype(np.int64)), pa.array(n, pa.int64())], ["label", "gram", "n"])

    found = rows.mapInArrow(tb.released(count), "label string, gram long, n long").groupBy("label", "gram").agg(F.sum("n").alias("n"))
    kept = found.toPandas()
    out = {}
    for label, part in kept.groupby("label"):
        codes, n = part["gram"].to_numpy().astype(np.uint64), part["n"].to_numpy()
        order = np.argsort(codes)
        out[label] = codes[order], n[order]
    return out


def train(rows: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "lang", per_label: int = 3000, calibrate: int = 1000) -> Model | None:
    """Fits the models; None if no row has both a label and a text."""
    rows = rows.where(F.col(label).isNotNull() & F.col(text).isNotNull()).select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(label).cast("string").alias("label"))
    sizes = {r[0]: r[1] for r in rows.groupBy("label").count().orderBy("label").collect()}
    if not sizes:
        return None
    draw = F.pmod(F.xxhash64("key", "text", F.lit("language id")), F.lit(1_000_000))
    # Labels of fewer than 8 documents train on all of them; of fewer than 4 * calibrate, a quarter is held back.
    share = lambda n, m: min(1_000_000, -(-n * 1_000_000 // m))
    held = {x: 0 if m < 8 else min(250_000, share(calibrate, m)) if m < 4 * calibrate else share(calibrate, m) for x, m in sizes.items()}
    drawn = rows.sparkSession.createDataFrame([(x, held[x], held[x] + share(per_label, m)) for x, m in sizes.items()], "label string, held int, upto int")
    rows = rows.join(F.broadcast(drawn), "label")  # a row for each label of the model, which is broadcast itself
    counts = _training_counts(rows.where((draw >= F.col("held")) & (draw < F.col("upto"))).select("text", "label"))
    if not counts:
        return None
    model = build(counts)
    sent = rows.sparkSession.sparkContext.broadcast(model)

    grid = 2.0 ** np.arange(0, 9)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each label its losses at each temperature, and how many documents have which cross-entropy under it."""
        for batch in batches:
            column, labels = tb.as_strings(batch.column("text")), np.array(batch.column("label").to_pylist(), object)
            for lo, hi in tb.blocks(column, BLOCK):
                bits, size = cross_entropy(sent.value, column.slice(lo, hi - lo))
                truth = np.searchsorted(model.labels, labels[lo:hi].astype(str))
                keep = np.flatnonzero((size > 0) & np.isin(labels[lo:hi], model.labels))
                bits, truth = bits[keep], truth[keep]
                rows = np.arange(len(keep))
                for k, t in enumerate(grid):
                    yield from _sums("loss", np.full(len(keep), k), -np.log(np.maximum(_posterior(bits, t)[rows, truth], 1e-12)))
                yield from _sums("limit", truth * STEPS + np.minimum((bits[rows, truth] * STEPS / MOST_BITS).astype(np.int64), STEPS - 1), np.ones(len(keep)))

    tested = rows.where(draw < F.col("held")).select("text", "label").mapInArrow(tb.released(measure), "kind string, place long, amount double").groupBy("kind", "place").agg(F.sum("amount").alias("amount")).toPandas()
    if not len(tested):
        return model
    losses = tested[tested["kind"] == "loss"].sort_values("place")
    counts = np.zeros((len(model.labels), STEPS))
    found = tested[tested["kind"] == "limit"]
    counts.reshape(-1)[found["place"].to_numpy()] = found["amount"].to_numpy()
    limit = np.full(len(model.labels), np.inf)
    for k in np.flatnonzero(counts.sum(1)):
        below = np.cumsum(counts[k])
        limit[k] = 1.25 * (np.searchsorted(below, 0.999 * below[-1]) + 1) * MOST_BITS / STEPS
    return model._replace(limit=limit, temperature=float(grid[losses["place"].to_numpy()[int(np.argmin(losses["amount"].to_numpy()))]]))


def _sums(kind: str, places: np.ndarray, amounts: np.ndarray) -> Iterator[pa.RecordBatch]:
    at, back = np.unique(places, return_inverse=True)
    if len(at):
        columns = [pa.array([kind] * len(at)), pa.array(at, pa.int64()), pa.array(np.bincount(back, amounts))]
        yield pa.RecordBatch.from_arrays(columns, ["kind", "place", "amount"])


def _posterior(bits: np.ndarray, temperature: float) -> np.ndarray:
    x = np.exp(-temperature * (bits - bits.min(1, keepdims=True)))
    return x / x.sum(1, keepdims=True)


def predict(docs: DataFrame, model: Model | None, *, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score, cross_entropy (bits a character) and accepted."""
    added = StructType.fromDDL(ADDED)
    docs = docs.drop(*added.names)
    schema = StructType([*docs.schema, *added])
    if model is None:
        return docs.withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0), "cross_entropy": F.lit(None).cast("double"), "accepted": F.lit(False)})
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for batch in batches:
            column = tb.as_strings(batch.column(text))
            for lo, hi in tb.blocks(column, BLOCK):
                bits, size = cross_entropy(m, column.slice(lo, hi - lo))
                best = bits.argmin(1)
                rows = np.arange(len(best))
                lowest, some = bits[rows, best], size > 0
                score = np.where(some, _posterior(bits, m.temperature)[rows, best], 0.0)
                label = np.where(some, np.array(m.labels, object)[best], UNKNOWN)
                new = [pa.array(label, pa.string()), pa.array(score), pa.array(lowest, mask=~some), pa.array(some & (lowest <= m.limit[best]))]
                yield pa.RecordBatch.from_arrays(batch.slice(lo, hi - lo).columns + new, batch.schema.names + added.names)

    return docs.mapInArrow(tb.released(run), schema)
