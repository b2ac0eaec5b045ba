"""Toxicity by a convolutional text classifier, trained in numpy.

A word (lower-cased letters) is the sum of hashed embeddings of itself and of its first 4, 5 and 6 letters, so that other endings of a
known stem are known as well; places that fewer than ``LEAST_TEXTS`` training texts have stay zero. Filters of several widths slide over the
words, a ReLU and the maximum over the whole text follow, and one output adds them up, with weights of zero or more: evidence for
toxicity can't be outweighed by whatever else a text holds. Training is plain
mini-batch Adam with hand-written gradients on at most ``SAMPLE_ROWS`` labelled texts a class (smallest hashes of their text;
the one that brings them to ``SAMPLE_BYTES`` is the last), since more add nothing to a model of fixed size.

Thresholds are calibrated by language on labelled texts that training didn't see: per language the cut between the classes
(a third of the way up in the gap that errs least) becomes a score of ``CUT``. The language is guessed from the text's
own stop words, never read from a column. All texts are scored whole: filter outputs come from tables of
word contributions, chunk by chunk.

Defined results: null, empty and wordless texts are scored like any other (by the bias alone). Without labelled texts of both
classes every score is 0. Labels that are null, and labelled texts that are null, are left out of training.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recurra.llm.language_id import letters_of
from recurra.llm.shared import sampled, widened
from recurra.llm.stopwords import STOP_WORDS
from recurra.llm.words import PLACES, chunks, mixed, numbered, split_words, word_hashes

TABLE = 1 << 17
STEMS = (4, 5, 6)
LEAST_TEXTS = 6
DECAY = 1e-4
DIMENSIONS = 8
WIDTHS = (1, 2, 3)
FILTERS = 8
SAMPLE_ROWS = 3_000
SAMPLE_BYTES = 8_000_000
CALIBRATE_EVERY = 4
EPOCHS = 8
BATCH = 32
RATE = 0.02
CUT = 0.7
SEED = 7

LANGUAGES = [*STOP_WORDS, "other"]


def _places(bare: list[str]) -> np.ndarray:
    """The table places of each word: of the word itself and of its first 4, 5 and 6 letters."""
    parts = [word_hashes(np.array([word[:n] for word in bare], object)) for n in (None, *STEMS)]
    salted = [mixed(part + PLACES[k]) % np.uint64(TABLE) for k, part in enumerate(parts)]
    return np.stack(salted, axis=1).astype(np.int64)


def _language(bare: list[str], index: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each text the language whose stop words make up most of it, the last number if it has none."""
    counts = np.stack([np.array([word in words for word in bare], bool)[index] for words in STOP_WORDS.values()], axis=1)
    running = np.concatenate([np.zeros((1, counts.shape[1])), np.cumsum(counts, axis=0)])
    sums = running[offsets[1:]] - running[offsets[:-1]]
    return np.where(sums.max(axis=1) > 0, sums.argmax(axis=1), len(STOP_WORDS))


class Network:
    """Hashed embeddings, filters of several widths, maximum over the text, one output."""

    def __init__(self, seed: int = SEED):
        draw = np.random.default_rng(seed)
        self.embedding = draw.normal(0, 0.05, (TABLE, DIMENSIONS)).astype(np.float32)
        self.filters = {w: draw.normal(0, 0.5, (w, DIMENSIONS, FILTERS)).astype(np.float32) for w in WIDTHS}
        self.bias = {w: np.zeros(FILTERS, np.float32) for w in WIDTHS}
        self.out = np.abs(draw.normal(0, 0.3, (len(WIDTHS) * FILTERS,))).astype(np.float32)
        self.last = np.zeros(1, np.float32)
        self.cuts = np.zeros(len(LANGUAGES))
        self.slope = 1.0

    def pooled(self, words: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The maxima of all filters over each text, and the word position where each was found (-1: nothing above zero)."""
        n = len(offsets) - 1
        best, place = np.zeros((n, len(WIDTHS) * FILTERS), np.float32), np.full((n, len(WIDTHS) * FILTERS), -1, np.int64)
        for k, w in enumerate(WIDTHS):
            hits = np.zeros((max(0, len(words) - w + 1), FILTERS), np.float32) + self.bias[w]
            for j in range(w):
                hits += words[j : j + len(hits)] @ self.filters[w][j]
            for i in range(n):
                here = hits[offsets[i] : offsets[i + 1] - w + 1] if offsets[i + 1] - offsets[i] >= w else hits[:0]
                if len(here):
                    at = here.argmax(axis=0)
                    value = here[at, np.arange(FILTERS)]
                    columns = slice(k * FILTERS, (k + 1) * FILTERS)
                    best[i, columns] = np.maximum(value, 0)
                    place[i, columns] = np.where(value > 0, at + offsets[i], -1)
        return best, place

    def embedded(self, places: np.ndarray) -> np.ndarray:
        return sum(self.embedding[places[:, k]] for k in range(places.shape[1]))

    def logits(self, places: np.ndarray, index: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The output for texts whose words are rows ``index`` of ``places``; contributions are computed once per distinct word."""
        distinct = self.embedded(places)
        pooled = np.zeros((len(offsets) - 1, len(WIDTHS) * FILTERS), np.float32)
        lengths = np.diff(offsets)
        for k, w in enumerate(WIDTHS):
            hits = np.zeros((max(0, len(index) - w + 1), FILTERS), np.float32) + self.bias[w]
            for j in range(w):
                hits += (distinct @ self.filters[w][j])[index[j : j + len(hits)]]
            some = np.flatnonzero(lengths >= w)
            if len(some):
                # the maximum over each text's own windows; what lies between two texts is pooled apart and left out
                cuts = np.stack([offsets[some], offsets[some + 1] - w + 1], axis=1).ravel()
                padded = np.concatenate([hits, np.zeros((1, FILTERS), np.float32)])
                most = np.maximum.reduceat(padded, cuts, axis=0)[::2]
                pooled[some, k * FILTERS : (k + 1) * FILTERS] = np.maximum(most, 0)
        return pooled @ self.out + self.last[0]

    def parameters(self) -> list[np.ndarray]:
        return [self.embedding, *self.filters.values(), *self.bias.values(), self.out, self.last]

    def gradients(self, places: np.ndarray, offsets: np.ndarray, labels: np.ndarray, weights: np.ndarray):
        """Of the mean logistic loss: rows of the embedding and their change, and the change of every other parameter."""
        words = self.embedded(places)
        pooled, place = self.pooled(words, offsets)
        logit = np.clip(pooled @ self.out + self.last[0], -30, 30)
        miss = ((1 / (1 + np.exp(-logit)) - labels) * weights / len(labels)).astype(np.float32)
        back = miss[:, None] * self.out
        back[place < 0] = 0
        of_words = np.zeros_like(words)
        of_filters, of_bias = [], []
        for k, w in enumerate(WIDTHS):
            columns = slice(k * FILTERS, (k + 1) * FILTERS)
            i, f = np.nonzero(place[:, columns] >= 0)
            at, value = place[:, columns][i, f], back[:, columns][i, f]
            change = np.zeros_like(self.filters[w])
            for j in range(w):
                np.add.at(change[j].T, f, value[:, None] * words[at + j])
                np.add.at(of_words, at + j, value[:, None] * self.filters[w][j].T[f])
            of_filters.append(change)
            of_bias.append(np.bincount(f, weights=value, minlength=FILTERS).astype(np.float32))
        used = np.flatnonzero(of_words.any(axis=1))
        table, inverse = np.unique(places[used], return_inverse=True)
        of_table = np.zeros((len(table), DIMENSIONS), np.float32)
        np.add.at(of_table, inverse.reshape(len(used), places.shape[1]), of_words[used][:, None, :])
        return (table, of_table), [*of_filters, *of_bias, miss @ pooled, miss.sum(keepdims=True)]

    def score(self, logits: np.ndarray, language: np.ndarray) -> np.ndarray:
        """Scores from 0 to 1; a language's cut scores ``CUT``."""
        shifted = self.slope * (logits - self.cuts[language]) + np.log(CUT / (1 - CUT))
        return 1 / (1 + np.exp(-np.clip(shifted, -60, 60)))


def _prepared(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Places of the distinct words, the words of all texts among them, the offsets of the texts, their languages."""
    words, offsets = split_words(texts)
    index, distinct = numbered(words)
    bare = [letters_of(word) for word in distinct]
    return _places(bare), index, offsets, _language(bare, index, offsets)


def train(texts: list[str], labels: np.ndarray, epochs: int = EPOCHS, seed: int = SEED) -> Network:
    """A network of the given texts; every ``CALIBRATE_EVERY``-th is kept back to calibrate the cuts."""
    network, draw = Network(seed), np.random.default_rng(seed)
    places, index, offsets, language = _prepared(pa.array(texts, pa.string()))
    fit = np.flatnonzero(np.arange(len(texts)) % CALIBRATE_EVERY != 0)
    share = np.clip(labels[fit].mean(), 0.01, 0.99)
    weights = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share))
    # places that few texts have would only be learned by heart: they stay zero, as do those of unknown words
    texts_with = np.zeros(TABLE, np.int64)
    for i in fit:
        texts_with[np.unique(places[np.unique(index[offsets[i] : offsets[i + 1]])])] += 1
    frequent = texts_with >= LEAST_TEXTS
    network.embedding[~frequent] = 0
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in network.parameters()]
    step = 0
    for _ in range(epochs):
        for batch in np.array_split(draw.permutation(fit), max(1, len(fit) // BATCH)):
            rows = np.concatenate([index[offsets[i] : offsets[i + 1]] for i in batch])
            cuts = np.concatenate([[0], np.cumsum(offsets[batch + 1] - offsets[batch])])
            step += 1
            (table, of_table), rest = network.gradients(places[rows], cuts, labels[batch], weights[batch])
            known = frequent[table]
            changes = [(table[known], of_table[known]), *((slice(None), change) for change in rest)]
            for value, (mean, square), (where, change) in zip(network.parameters(), moments, changes):
                _adam(value, mean, square, change, step, where)
            np.maximum(network.out, 0, out=network.out)
    network.cuts, network.slope = _calibrated(network.logits(places, index, offsets), labels, language)
    return network


def _adam(value, mean, square, change, step: int, rows) -> None:
    mean[rows] = 0.9 * mean[rows] + 0.1 * change
    square[rows] = 0.999 * square[rows] + 0.001 * change**2
    value[rows] -= RATE * DECAY * value[rows] + RATE * (mean[rows] / (1 - 0.9**step)) / (np.sqrt(square[rows] / (1 - 0.999**step)) + 1e-8)


def _calibrated(logits: np.ndarray, labels: np.ndarray, language: np.ndarray) -> tuple[np.ndarray, float]:
    """The cut of each language, on texts kept back; languages with too few of either class share the cut of all."""
    kept = np.arange(len(labels)) % CALIBRATE_EVERY == 0
    whole = _cut(logits[kept], labels[kept])
    cuts = np.full(len(LANGUAGES), whole)
    for k in range(len(LANGUAGES)):
        mine = kept & (language == k)
        if min((labels[mine] == 1).sum(), (labels[mine] == 0).sum()) >= 10:
            cuts[k] = _cut(logits[mine], labels[mine])
    return cuts, 1.0


def _cut(logits: np.ndarray, labels: np.ndarray) -> float:
    """Where a cut errs least, in the widest such gap, a third of the way up: the edge of the clean texts is known best."""
    if not len(logits):
        return 0.0
    order = np.argsort(logits, kind="stable")
    sorted_logits, ones = logits[order], labels[order] == 1
    errors = np.concatenate([[0], np.cumsum(ones)]) + np.concatenate([np.cumsum(~ones[::-1])[::-1], [0]])
    edges = np.concatenate([[sorted_logits[0] - 2], sorted_logits, [sorted_logits[-1] + 2]])
    best = np.flatnonzero(errors == errors.min())
    at = best[np.argmax(edges[best + 1] - edges[best])]
    return float(edges[at] + (edges[at + 1] - edges[at]) / 3)


def learn(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Network | None:
    """The network of a bounded sample of the texts of ``docs`` that ``labels`` (doc_id, toxic) covers."""
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", "toxic")
    given = docs.where(F.col("text").isNotNull())
    marked = given.select("doc_id", F.xxhash64("text").alias("order"), F.octet_length("text").alias("n_bytes")).join(known, "doc_id")
    texts = marked.groupBy("order").agg(
        F.min("doc_id").alias("doc_id"), F.max("toxic").alias("toxic"), F.max("n_bytes").alias("n_bytes")
    )
    chosen = [sampled(texts.where(F.col("toxic") == k), sample_rows, SAMPLE_BYTES).drop("n_bytes") for k in (0, 1)]
    few = F.broadcast(chosen[0].union(chosen[1]))
    rows = given.select("doc_id", "text").join(few, "doc_id").select("order", "text", "toxic").toPandas()
    rows = rows.drop_duplicates("order").sort_values("order")
    if rows["toxic"].nunique() < 2:
        return None
    return train(rows["text"].tolist(), rows["toxic"].to_numpy(np.float32))


def scored(docs: DataFrame, shared: Broadcast) -> DataFrame:
    """``docs`` with toxicity (0 to 1) and toxic (1 from ``CUT`` on, else 0); the network comes by broadcast."""
    rest = docs.drop("toxicity", "toxic")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = shared.value
        for batch in chunks(batches, "text"):
            found = np.zeros(batch.num_rows)
            if network is not None:
                places, index, offsets, language = _prepared(batch.column("text"))
                found = network.score(network.logits(places, index, offsets), language)
            columns = [pa.array(found, pa.float64()), pa.array((found >= CUT).astype(np.int32))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, "toxicity", "toxic"])

    return rest.mapInArrow(score, widened(rest, "toxicity double, toxic int"))


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from training: crc32 of its id as text, modulo 3, is 1. A null id is kept from it too."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(True))


def classified(docs: DataFrame, training: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` with toxicity and toxic by a network of the labelled rows of ``training``."""
    return scored(docs, docs.sparkSession.sparkContext.broadcast(learn(training, labels)))
