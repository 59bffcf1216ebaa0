"""A convolutional text classifier for toxicity, trained in numpy.

A word's vector is the sum of hashed embeddings of the word and of its beginnings. Filters
of several widths run over the word vectors of a whole text; the largest value of each
filter, wherever it occurs, feeds a logistic output. Texts only: no other column is an
input of a score. Decisions compare the score with a threshold calibrated by language.

Few labels must not be learnt by heart: only words and beginnings that several texts share
have an embedding, words are left out at random in each step, weights decay, and of all
states on the way the one with the least loss on rows kept aside is taken.

Every labelled row that is not held out counts, with its whole text. Few rows are fitted in one
process; many are dealt to shards, whose tasks train in rounds, each from the average of the
round before; document counts, losses and thresholds are sums over all shards.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from copy import deepcopy
from dataclasses import asdict, dataclass, field
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

BUCKETS = 1 << 16
SIZE = 16
FILTERS = 16
WIDTHS = (1, 2, 3)
LEAK = 0.1
# Beginnings of a word, in letters, that have an embedding of their own.
BEGINNINGS = (3, 4, 5, 6)

# Up to so many labelled rows, with so many characters in all, are fitted in one process.
FEW_ROWS = 4000
FEW_CHARACTERS = 40_000_000
# Of so many labelled rows, one is kept from fitting for the thresholds.
CALIBRATED = 4
# So many calibration rows of the rarer label weigh a language's own threshold and the common
# one the same.
SUPPORT = 10

STEPS = 900
TEXTS_PER_STEP = 32
# Texts that share an embedding row at least, words left out in a step, decay of a step.
SHARED = 3
LEFT_OUT = 0.5
DECAY = 0.002
# Steps between looks at the rows kept aside, and looks without a gain before the end.
STEPS_PER_LOOK = 50
PATIENCE = 12
# Shards at most, steps that each makes at least, passes over all rows at least, and rounds of
# a pass, after which the shards' models are averaged.
SHARDS = 24
SHARD_STEPS = 300
PASSES = 2
ROUNDS = 3
# Parts of the embedding that are averaged apart.
BLOCKS = 8
# Scores that are counted apart, for losses and thresholds: so many to a unit of log odds.
BINS = 64
# Words that are scored at once; a longer text is cut into overlapping parts.
WORDS_AT_ONCE = 100_000
CHARACTERS_AT_ONCE = 1 << 20

_PAD = b""


def words_of(text: str | None) -> list[bytes]:
    """Runs of letters, lower-cased: ASCII signs and digits part words."""
    return text.lower().encode().translate(_LETTERS).split() if text else []


_LETTERS = bytes(c if c >= 0x80 or chr(c).isalpha() else 0x20 for c in range(256))


def pieces_of(words: list[bytes]) -> np.ndarray:
    """The embedding rows of each word: one for the word, one for each beginning."""
    found = np.empty((len(words), 1 + len(BEGINNINGS)), np.int64)
    found[:, 0] = [crc32(word) for word in words]
    for k, size in enumerate(BEGINNINGS, 1):
        mark = crc32(b"%d:" % size)
        found[:, k] = [crc32(word[:size], mark) for word in words]
    for at, word in enumerate(words):
        if not word.isascii():
            letters = word.decode("utf-8", "replace")
            found[at, 1:] = [crc32(b"%d:" % size + letters[:size].encode("utf-8", "replace")) for size in BEGINNINGS]
    return found % BUCKETS


@dataclass
class Layout:
    """Texts as one row of word numbers, each followed by padding, so that no window reaches
    the next text. Long texts are cut into parts that overlap by a window."""

    rows: np.ndarray  # embedding rows of every distinct word
    at: np.ndarray  # word number at every position
    begins: np.ndarray  # of each part
    ends: np.ndarray
    text: np.ndarray  # the text of each part


class Pieces(dict):
    """The embedding rows of words met lately: a task looks most words up once."""

    def __missing__(self, word: bytes) -> list[int]:
        if len(self) >= WORDS_KEPT:
            self.clear()
        found = self[word] = pieces_of(word)
        return found


def numbered(texts: list[list[bytes]]) -> tuple[np.ndarray, list[np.ndarray]]:
    """The embedding rows of all distinct words, padding first, and the texts as word numbers."""
    numbers: dict[bytes, int] = defaultdict()
    numbers.default_factory = numbers.__len__
    numbers[_PAD] = 0
    found = [np.array([numbers[word] for word in words], np.int64) for words in texts]
    return pieces_of(list(numbers)), found


def layout(rows: np.ndarray, texts: list[np.ndarray]) -> Layout:
    reach = max(WIDTHS) - 1
    pad, parts, owner = np.zeros(reach, np.int64), [], []
    for text, words in enumerate(texts):
        for start in range(0, max(1, len(words)), WORDS_AT_ONCE):
            part = words[start : start + WORDS_AT_ONCE + reach]
            parts.append(part if len(part) else pad[:1])
            owner.append(text)
    sizes = np.array([len(part) for part in parts])
    begins = np.cumsum(sizes + reach) - sizes - reach
    every = np.concatenate([piece for part in parts for piece in (part, pad)])
    used, at = np.unique(np.append(0, every), return_inverse=True)
    return Layout(rows[used], at[1:], begins, begins + sizes, np.array(owner))


@dataclass
class Model:
    embedding: np.ndarray
    filters: dict[int, np.ndarray]  # width -> (width, SIZE, FILTERS)
    bias: dict[int, np.ndarray]
    weights: np.ndarray
    offset: float
    thresholds: dict[str, float] = field(default_factory=dict)
    threshold: float = 0.5

    @staticmethod
    def fresh(seed: int) -> Model:
        draw = np.random.default_rng(seed)
        return Model(
            draw.normal(0, 0.1, (BUCKETS, SIZE)).astype(np.float32),
            {w: draw.normal(0, 0.3, (w, SIZE, FILTERS)).astype(np.float32) for w in WIDTHS},
            {w: np.zeros(FILTERS, np.float32) for w in WIDTHS},
            draw.normal(0, 0.3, len(WIDTHS) * FILTERS).astype(np.float32),
            0.0,
        )

    def vectors(self, rows: np.ndarray) -> np.ndarray:
        found = self.embedding[rows].sum(axis=1)
        found[0] = 0  # padding
        return found

    def filtered(self, vectors: np.ndarray, width: int) -> list[np.ndarray]:
        """What each word adds to the filters at each place of a window."""
        return [vectors @ self.filters[width][offset] for offset in range(width)]

    def windows(self, filtered: list[np.ndarray], at: np.ndarray, width: int) -> np.ndarray:
        """Filter values of the windows that begin at each position but the last ones."""
        size = len(at) - max(WIDTHS) + 1
        total = np.tile(self.bias[width], (size, 1))
        for offset in range(width):
            total += filtered[offset][at[offset : offset + size]]
        return total

    def scores(self, texts: list[list[bytes]]) -> np.ndarray:
        found = np.empty(len(texts))
        for first, last in _groups(texts):
            some = layout(*numbered(texts[first:last]))
            vectors = self.vectors(some.rows)
            borders = np.column_stack((some.begins, some.ends)).ravel()
            pooled = [
                np.maximum.reduceat(np.vstack((self.windows(self.filtered(vectors, w), some.at, w), self.bias[w])), borders)[::2]
                for w in WIDTHS
            ]
            best = np.full((last - first, len(WIDTHS) * FILTERS), -np.inf, np.float32)
            np.maximum.at(best, some.text, np.hstack(pooled))
            found[first:last] = _sigmoid(_leaky(best) @ self.weights + self.offset)
        return found


def _groups(texts: list[list[bytes]]) -> Iterator[tuple[int, int]]:
    first, size = 0, 0
    for at, words in enumerate(texts):
        if size and size + len(words) > WORDS_AT_ONCE:
            yield first, at
            first, size = at, 0
        size += len(words) + 1
    if first < len(texts):
        yield first, len(texts)


def _leaky(value: np.ndarray) -> np.ndarray:
    """A filter that no text excites still learns."""
    return np.maximum(value, value * np.float32(LEAK))


def _sigmoid(value: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(value.astype(np.float64), -40, 40)))


class _Adam:
    def __init__(self, rate: float):
        self.rate, self.step, self.state = rate, 0, {}

    def __call__(
        self, name: object, value: np.ndarray, gradient: np.ndarray, rows: np.ndarray | None = None, decay: float = DECAY
    ) -> None:
        """Change ``value`` in place; with ``rows``, only those rows of it."""
        first, second = self.state.setdefault(name, (np.zeros_like(value), np.zeros_like(value)))
        at = slice(None) if rows is None else rows
        value[at] *= 1 - decay
        first[at] = 0.9 * first[at] + 0.1 * gradient
        second[at] = 0.99 * second[at] + 0.01 * gradient**2
        value[at] -= self.rate * first[at] / (1 - 0.9**self.step) / (
            np.sqrt(second[at] / (1 - 0.99**self.step)) + 1e-6
        )


def fit(
    texts: list[list[bytes]],
    labels: list[int],
    seed: int = 7,
    aside: tuple[list[list[bytes]], list[int]] = ([], []),
) -> Model:
    """Train on whole texts; ``aside``, other texts and labels, tell when to stop. Without
    both labels the model scores every text by their share."""
    model = Model.fresh(seed)
    truth = np.array(labels, np.float32)
    if len(set(labels)) < 2:
        model.embedding[:] = 0
        model.weights[:] = 0
        share = min(max(truth.mean(), 0.01), 0.99) if len(truth) else 0.01
        model.offset = float(np.log(share / (1 - share)))
        return model
    draw, adam = np.random.default_rng(seed), _Adam(0.01)
    offset = np.zeros(1, np.float32)
    rows, found = numbered(texts)
    known = _shared(rows, found)
    model.embedding[~known] = 0
    # Both labels weigh the same, however rare one is.
    weight = np.where(truth == 1, 0.5 / truth.mean(), 0.5 / (1 - truth.mean())).astype(np.float32)
    best, looks, kept = np.inf, 0, model
    while adam.step < STEPS and looks < PATIENCE:
        order = draw.permutation(len(texts))
        for start in range(0, len(order), TEXTS_PER_STEP):
            chosen = order[start : start + TEXTS_PER_STEP]
            adam.step += 1
            some = [np.where(draw.random(len(found[i])) < LEFT_OUT, 0, found[i]) for i in chosen]
            _train_step(model, offset, adam, layout(rows, some), truth[chosen], weight[chosen], known)
            if adam.step % STEPS_PER_LOOK == 0 and len(set(aside[1])) == 2:
                model.offset = float(offset[0])
                loss = _loss(model, *aside)
                best, looks, kept = (loss, 0, deepcopy(model)) if loss < best else (best, looks + 1, kept)
    model.offset = float(offset[0])
    return kept if np.isfinite(best) else model


def _shared(rows: np.ndarray, texts: list[np.ndarray]) -> np.ndarray:
    """Which embedding rows belong to words of several texts."""
    count = np.zeros(BUCKETS, np.int64)
    for words in texts:
        count[np.unique(rows[words])] += 1
    return count >= min(SHARED, len(texts) // 4 + 1)


def _loss(model: Model, texts: list[list[bytes]], labels: list[int]) -> float:
    """Mean log loss of both labels, weighed alike."""
    scores, truth = np.clip(model.scores(texts), 1e-6, 1 - 1e-6), np.array(labels)
    return float(-np.log(scores[truth == 1]).mean() - np.log(1 - scores[truth == 0]).mean()) / 2


def _train_step(
    model: Model,
    offset: np.ndarray,
    adam: _Adam,
    some: Layout,
    truth: np.ndarray,
    weight: np.ndarray,
    known: np.ndarray,
) -> None:
    vectors = model.vectors(some.rows)
    count = len(truth)
    best = np.full((count, len(WIDTHS), FILTERS), -np.inf, np.float32)
    where = np.zeros((count, len(WIDTHS), FILTERS), np.int64)
    reach = max(WIDTHS) - 1
    for k, width in enumerate(WIDTHS):
        filtered = model.filtered(vectors, width)
        for begin, end, text in zip(some.begins, some.ends, some.text):
            values = model.windows(filtered, some.at[begin : end + reach], width)
            at = values.argmax(axis=0)
            value = values[at, np.arange(FILTERS)]
            better = value > best[text, k]
            best[text, k][better] = value[better]
            where[text, k][better] = (begin + at)[better]
    active = _leaky(best).reshape(count, -1)
    error = (weight * (_sigmoid(active @ model.weights + offset[0]) - truth) / count).astype(np.float32)
    back = (error[:, None] * model.weights) * np.where(active > 0, 1, LEAK).astype(np.float32)
    back = back.reshape(count, len(WIDTHS), FILTERS)
    moved = np.zeros_like(vectors)
    for k, width in enumerate(WIDTHS):
        change = np.zeros_like(model.filters[width])
        for o in range(width):
            words = some.at[where[:, k] + o]  # (text, filter)
            change[o] = np.einsum("tf,tfs->sf", back[:, k], vectors[words])
            np.add.at(moved, words, back[:, k, :, None] * model.filters[width][o].T[None])
        adam(("filter", width), model.filters[width], change)
        adam(("bias", width), model.bias[width], back[:, k].sum(axis=0))
    adam("weights", model.weights, error @ active)
    adam("offset", offset, error.sum(keepdims=True), decay=0)
    moved[0] = 0
    touched = np.flatnonzero(moved.any(axis=1))
    rows, place = np.unique(some.rows[touched], return_inverse=True)
    gradient = np.zeros((len(rows), SIZE), np.float32)
    np.add.at(gradient, place.reshape(len(touched), -1), moved[touched][:, None, :])
    if known[rows].any():
        adam("embedding", model.embedding, gradient[known[rows]], rows[known[rows]])


def calibrate(model: Model, texts: list[list[bytes]], labels: list[int], langs: list[str | None]) -> None:
    """Set the thresholds by these rows, each counted once."""
    scores, truth = model.scores(texts), np.array(labels)
    rows = pd.DataFrame({"lang": pd.Series(langs, dtype=object), "score": scores, "toxic": truth, "clean": 1 - truth})
    set_thresholds(model, rows)


def set_thresholds(model: Model, counts: pd.DataFrame) -> None:
    """Set the common threshold, the middle of the range of scores with the best F1, and that
    of every language: its own, drawn to the common one the more the fewer rows of either
    label it has here. The output is then moved so that the common threshold is one half.
    ``counts``: toxic and clean rows of each lang and score."""
    model.threshold = _threshold(counts, 0.5)
    for lang, own in counts.groupby("lang"):
        rows = min(int(own["toxic"].sum()), int(own["clean"].sum()))
        alone = _threshold(own, model.threshold)
        model.thresholds[lang] = (rows * alone + SUPPORT * model.threshold) / (rows + SUPPORT)
    odds = lambda share: float(np.log(share / (1 - share)))
    move = odds(np.clip(model.threshold, 1e-6, 1 - 1e-6))
    model.offset -= move
    moved = {lang: np.clip(at, 1e-6, 1 - 1e-6) for lang, at in model.thresholds.items()}
    model.thresholds = {lang: float(_sigmoid(np.array(odds(at) - move))) for lang, at in moved.items()}
    model.threshold = 0.5


def _threshold(counts: pd.DataFrame, otherwise: float) -> float:
    toxic, clean = counts["toxic"].sum(), counts["clean"].sum()
    if not toxic or not clean:
        return otherwise
    ranked = counts.groupby("score")[["toxic", "clean"]].sum().sort_index(ascending=False)
    hits, seen = ranked["toxic"].cumsum(), (ranked["toxic"] + ranked["clean"]).cumsum()
    last = int(np.argmax((2 * hits / (seen + toxic)).to_numpy()))
    below = ranked.index[last + 1] if last + 1 < len(ranked) else 0.0
    return float((ranked.index[last] + below) / 2)


# --- on tables ---------------------------------------------------------------------------


def held_out(doc_id: Column) -> Column:
    """Rows that no model learns from; false without an id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text, lang, toxic) of every labelled document that is not held out, once.

    Dealt by id to as many tasks as there are shards, in an order that makes the fit
    repeatable; ``aside`` marks the rows for thresholds, ``round`` the part of a pass."""
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    shards = shards_of(known.count())
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
        F.col("lang").cast("string").alias("lang"),
    ).filter(F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    # Texts and labels meet in one shuffle into exactly that many tasks; a join may take others.
    both = texts.unionByName(known, allowMissingColumns=True).repartition(shards, "doc_id")
    # A repeated row counts once, whichever copy.
    one = F.min(F.when(F.col("text").isNotNull(), F.struct("text", "lang"))).alias("one")
    once = both.groupBy("doc_id").agg(one, F.max("toxic").alias("toxic")).filter("one IS NOT NULL AND toxic IS NOT NULL")
    part = F.pmod(F.xxhash64("doc_id", F.lit(12)), F.lit(CALIBRATED * ROUNDS))
    return once.select(
        "doc_id", "one.text", "one.lang", "toxic",
        (part % CALIBRATED == 0).alias("aside"), F.floor(part / CALIBRATED).cast("int").alias("round"),
    ).sortWithinPartitions(F.xxhash64("doc_id", F.lit(11)), "doc_id")


def passes_of(rows: int) -> int:
    """Passes over so many labelled rows: few are read more often."""
    fitted = max(1, rows - rows // CALIBRATED)
    return max(PASSES, -(-STEPS * TEXTS_PER_STEP // fitted))


def shards_of(rows: int) -> int:
    """As many as leave each shard its steps."""
    fitted = rows - rows // CALIBRATED
    return min(max(1, passes_of(rows) * fitted // (TEXTS_PER_STEP * SHARD_STEPS)), SHARDS)


def trained(texts: list[list[bytes]], labels: list[int], langs: list[str | None], seed: int = 7) -> Model:
    """A model fitted on most of these rows, stopped and calibrated on the others."""
    part = lambda values, aside: [v for i, v in enumerate(values) if (i % CALIBRATED == 0) == aside]
    model = fit(part(texts, False), part(labels, False), seed, (part(texts, True), part(labels, True)))
    calibrate(model, part(texts, True), part(labels, True), part(langs, True))
    return model


def train(docs: DataFrame, labels: DataFrame, seed: int = 7) -> Model:
    """A model fitted on every labelled row that is not held out, but for the part of them that
    gives the thresholds."""
    rows = labelled(docs, labels).persist(StorageLevel.DISK_ONLY)
    try:
        count, characters = rows.agg(F.count(F.lit(1)), F.sum(F.length("text"))).first()
        if count > FEW_ROWS or (characters or 0) > FEW_CHARACTERS:
            return trained_in_rounds(rows, seed)
        found = sorted(
            rows.select("doc_id", "text", "lang", "toxic").collect(),
            key=lambda row: (crc32(str(row.doc_id).encode()), row.doc_id),
        )
    finally:
        rows.unpersist()
    return trained([words_of(row.text) for row in found], [row.toxic for row in found], [row.lang for row in found], seed)


def trained_in_rounds(rows: DataFrame, seed: int = 7) -> Model:
    """The same for rows of any number: each partition of :func:`labelled` rows is a shard, and
    the driver holds the model, sums and the shards' changes of a round."""
    counts = {(r.aside, r.toxic): r["count"] for r in rows.groupBy("aside", "toxic").count().collect()}
    fitted = [counts.get((False, value), 0) for value in (0, 1)]
    model = Model.fresh(seed)
    if not all(fitted):
        model = fit([], [int(fitted[1] > 0)] * sum(fitted), seed)
        set_thresholds(model, score_counts(rows, model))
        return model
    known = document_counts(rows) >= SHARED
    model.embedding[~known] = 0
    weights = [sum(fitted) / 2 / fitted[value] for value in (0, 1)]
    best, kept, looked = np.inf, model, None
    for number in range(passes_of(sum(counts.values())) * ROUNDS):
        model = next_round(rows, model, known, weights, number, seed)
        if number % ROUNDS == ROUNDS - 1:
            seen = score_counts(rows, model)
            loss = _counted_loss(seen)
            if loss < best or looked is None or not np.isfinite(loss):
                best, kept, looked = loss, model, seen
    set_thresholds(kept, looked)
    return kept


def document_counts(rows: DataFrame) -> np.ndarray:
    """Texts, of those that are fitted, with each embedding row."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = np.zeros(BUCKETS, np.int64)
        for some in _steps(batches):
            at, texts = numbered([words_of(text) for text in some["text"]])
            for words in texts:
                found[at[words]] += 1  # by one, however often a row occurs in the text
        at = np.flatnonzero(found)
        yield pd.DataFrame({"piece": at, "texts": found[at]})

    counted = _fitted(rows).mapInPandas(count, "piece int, texts long").groupBy("piece").agg(F.sum("texts").alias("texts"))
    total = np.zeros(BUCKETS, np.int64)
    for row in counted.toPandas().itertuples():
        total[row.piece] = row.texts
    return total


def _fitted(rows: DataFrame) -> DataFrame:
    return rows.filter(~F.col("aside")).select("text", "toxic")


def _steps(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The rows of each step; of long texts fewer."""
    rest = None
    for batch in batches:
        rest = batch if rest is None else pd.concat((rest, batch))
        sizes, first, size = rest["text"].str.len().to_numpy(), 0, 0
        for at in range(len(rest)):
            if at > first and (at - first == TEXTS_PER_STEP or size + sizes[at] > CHARACTERS_AT_ONCE):
                yield rest.iloc[first:at]
                first, size = at, 0
            size += sizes[at]
        rest = rest.iloc[first:]
    if rest is not None and len(rest):
        yield rest


def next_round(
    rows: DataFrame, model: Model, known: np.ndarray, weights: list[float], number: int, seed: int
) -> Model:
    """The average of the models that the shards make of ``model`` with their rows of a round.
    An embedding row is the average of those shards that changed it. The shards' arrays are
    averaged in blocks by tasks; the driver gets one model."""
    shared = rows.sparkSession.sparkContext.broadcast((asdict(model), known))

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        arrays, of_several = shared.value
        before, own = Model(**arrays), deepcopy(Model(**arrays))
        adam, offset, draw, shard = _Adam(0.01), np.full(1, own.offset, np.float32), None, -1
        for some in _steps(batches):
            if draw is None:
                shard = int(some["shard"].iloc[0])
                draw = np.random.default_rng((seed, number, shard))
            truth = some["toxic"].to_numpy(np.float32)
            weight = np.where(truth == 1, weights[1], weights[0]).astype(np.float32)
            at, texts = numbered([words_of(text) for text in some["text"]])
            texts = [np.where(draw.random(len(words)) < LEFT_OUT, 0, words) for words in texts]
            adam.step += 1
            _train_step(own, offset, adam, layout(at, texts), truth, weight, of_several)
        if adam.step:
            own.offset = float(offset[0])
            dense = _dense(own)
            yield _block(-1, shard, np.arange(len(dense)), dense[:, None] - _dense(before)[:, None])
            changed = np.flatnonzero((own.embedding != before.embedding).any(axis=1))
            for block in range(BLOCKS):
                of_block = changed[changed % BLOCKS == block]
                yield _block(block, shard, of_block, own.embedding[of_block] - before.embedding[of_block])

    chosen = rows.filter(~F.col("aside") & (F.col("round") == number % ROUNDS))
    chosen = chosen.select("text", "toxic", F.spark_partition_id().alias("shard"))
    made = chosen.mapInPandas(work, _BLOCK).groupBy("block").applyInPandas(_average, _BLOCK).collect()
    shared.unpersist()
    after = deepcopy(model)
    for row in made:
        changed, values = np.frombuffer(row.changed, np.int32), np.frombuffer(row.values, np.float16)
        if row.block < 0:
            _set_dense(after, _dense(model) + values)
        else:
            after.embedding[changed] += values.reshape(-1, SIZE)
    return after


_BLOCK = "block int, shard int, changed binary, values binary"


def _block(block: int, shard: int, changed: np.ndarray, values: np.ndarray) -> pd.DataFrame:
    # Changes of a round are small: half precision is enough of them.
    arrays = {"changed": [changed.astype(np.int32).tobytes()], "values": [values.astype(np.float16).tobytes()]}
    return pd.DataFrame({"block": [block], "shard": [shard], **arrays})


def _average(found: pd.DataFrame) -> pd.DataFrame:
    """The mean change of each row over the shards that changed it, in the shards' order: the
    sums are the same each time."""
    block, width = int(found["block"].iloc[0]), 1 if found["block"].iloc[0] < 0 else SIZE
    total, shards = np.zeros((BUCKETS, width)), np.zeros(BUCKETS, np.int64)
    for row in found.sort_values("shard").itertuples():
        changed = np.frombuffer(row.changed, np.int32)
        total[changed] += np.frombuffer(row[4], np.float16).reshape(-1, width)
        shards[changed] += 1
    changed = np.flatnonzero(shards)
    return _block(block, 0, changed, total[changed] / shards[changed, None])


def _dense(model: Model) -> np.ndarray:
    arrays = [values[width].ravel() for values in (model.filters, model.bias) for width in WIDTHS]
    return np.concatenate([*arrays, model.weights, [model.offset]]).astype(np.float32)


def _set_dense(model: Model, dense: np.ndarray) -> None:
    for values in (model.filters, model.bias):
        for width in WIDTHS:
            size = values[width].size
            values[width], dense = dense[:size].reshape(values[width].shape).copy(), dense[size:]
    model.weights, model.offset = dense[:-1].copy(), float(dense[-1])


def score_counts(rows: DataFrame, model: Model) -> pd.DataFrame:
    """Toxic and clean rows kept aside, by language and score; the scores to a part of a unit of
    log odds, so that any number of rows gives a bounded table."""
    aside = rows.filter("aside")
    share = F.least(F.greatest(F.col("score"), F.lit(1e-12)), F.lit(1 - 1e-12))
    log_odds = F.ln(share / (1 - share))
    scored = aside.select("lang", "toxic", score(aside, model, F.col("text")).alias("score"))
    found = (
        scored.groupBy("lang", F.round(log_odds * BINS).cast("long").alias("bin"))
        .agg(F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("clean"))
        .orderBy("lang", "bin")
        .collect()
    )
    counts = pd.DataFrame([row.asDict() for row in found], columns=["lang", "bin", "toxic", "clean"])
    counts["score"] = _sigmoid(counts["bin"].to_numpy(np.float64) / BINS)
    return counts


def _counted_loss(counts: pd.DataFrame) -> float:
    """Mean log loss of both labels, weighed alike; not a number without one of them."""
    at = np.clip(counts["score"], 1e-6, 1 - 1e-6)
    toxic, clean = counts["toxic"], counts["clean"]
    if not toxic.sum() or not clean.sum():
        return float("nan")
    return float(-(np.log(at) * toxic).sum() / toxic.sum() - (np.log(1 - at) * clean).sum() / clean.sum()) / 2


def score(docs: DataFrame, model: Model, text: Column) -> Column:
    """The score of whole texts, from 0 to 1; null and empty texts score as no words do."""
    # A few megabytes whatever the corpus. Plain arrays: the broadcast of an object would need
    # its class on the workers.
    shared = docs.sparkSession.sparkContext.broadcast(asdict(model))

    @pandas_udf("double")
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = Model(**shared.value)
        for batch in batches:
            yield pd.Series(np.concatenate([model.scores([words_of(one) for one in some]) for some in _lots(batch)]))

    return scores(text)


def _lots(texts: pd.Series) -> Iterator[pd.Series]:
    """Some hundred thousand characters at a time."""
    ends = texts.str.len().fillna(0).cumsum() // CHARACTERS_AT_ONCE
    yield from (some for _, some in texts.groupby(ends.to_numpy(), sort=False))


def threshold(model: Model, lang: Column) -> Column:
    found = F.lit(model.threshold)
    for name, value in sorted(model.thresholds.items()):
        found = F.when(lang == name, F.lit(value)).otherwise(found)
    return found


def reject_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` without the rows whose score reaches the threshold of their language; a null
    or unknown language has the common one. Repeated rows are judged alike."""
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    rows = rows.withColumn("score", score(docs, model, F.col("row.text")))
    return rows.filter(F.col("score") < threshold(model, F.col("row.lang"))).select("row.*")
