"""Mixing documents to target weights of domains by soft membership.

A softmax regression on whole-text features (square roots of the shares of hashed word stems, of the marks around words and of
their case, and how far the text repeats itself) is fitted in numpy on at most ``SAMPLE_ROWS`` labelled texts a domain
(smallest hashes of their text; the one that brings them to ``SAMPLE_BYTES`` is the last), weighted to the shares of all labelled texts. It gives every document p(domain | text).

The rates r of the documents minimise

    |A r - b|^2 / 2 + RIDGE / 2 * sum of t_i (r_i - 1)^2,   r >= 0,

where t_i is a document's share of all tokens, A r the expected token shares of the domains (sum of t_i r_i p_i), and b the
target weights times the budget (tokens wanted over tokens there). Every iteration is one aggregate over the table of posteriors: the
gradient step is scaled by the curvature of the few domain totals and then projected onto rates of zero or more, so that a handful of
passes suffice. As the steps only combine the posteriors of a document, the rates after any number of steps are
max(0, 1 - p_i . y) for a vector y with a number per domain; only y and the totals ever reach the driver.

A rate becomes whole copies: its integer part, and one more where a hash of doc_id falls below the rest.

Defined results: a null, empty or wordless text has no tokens, a rate of 1 and one copy; a row without doc_id likewise. Rows that repeat a
doc_id are rated each and mixed by the smallest number of copies. Without labelled texts of two domains all posteriors are the target weights.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recurra.llm.language_id import letters_of
from recurra.llm.shared import checkpoint, sampled
from recurra.llm.words import chunks, numbered, split_words, word_hashes

QUALITY_TARGETS = {"high": 0.95, "low": 0.05}
BUDGET = 1.1
RIDGE = 1e-4
SAMPLE_ROWS = 3_000
SAMPLE_BYTES = 8_000_000
STEM = 4
STEMS = 1024
MARKS = 256
CASES = 4
EXTRA = 3
WIDTH = STEMS + MARKS + CASES + EXTRA
STEPS = 400
MOST_PASSES = 40
CLOSE = 1e-9
SEED = 11


def quality_domains(labels: DataFrame) -> DataFrame:
    """doc_id, domain: quality 1 is ``high``, quality 0 is ``low``."""
    domain = F.when(F.col("quality") == 1, "high").when(F.col("quality") == 0, "low")
    return labels.select("doc_id", domain.alias("domain")).where(F.col("domain").isNotNull() & F.col("doc_id").isNotNull())


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The feature row and the number of words of each text."""
    words, offsets = split_words(texts, lower=False)
    index, distinct = numbered(words)
    bare = [letters_of(word) for word in distinct]
    marks = ["".join(c for c in word if not c.isalnum())[:4] for word in distinct]
    case = [0 if not b else 1 if w.isupper() and len(b) > 1 else 2 if w[:1].isupper() else 3 for w, b in zip(distinct, bare)]
    stems = word_hashes(np.array([b[:STEM] for b in bare], object)) % np.uint64(STEMS)
    around = word_hashes(np.array(marks, object)) % np.uint64(MARKS)
    n = np.diff(offsets)
    owner = np.repeat(np.arange(len(n)), n)
    groups = ((stems, STEMS), (around, MARKS), (np.array(case, np.int64), CASES))
    shares = []
    for place, size in groups:
        at = owner * size + place.astype(np.int64)[index]
        counts = np.bincount(at, minlength=len(n) * size).reshape(len(n), size)
        shares.append(np.sqrt(counts / np.maximum(1, n)[:, None]).astype(np.float32))
    again = np.zeros(len(index), bool)
    again[1:] = (index[1:] == index[:-1]) & (owner[1:] == owner[:-1])
    pairs = np.unique(owner.astype(np.int64) * max(1, len(distinct)) + index)
    variety = np.bincount(pairs // max(1, len(distinct)), minlength=len(n)) / np.maximum(1, n)
    repeated = np.bincount(owner, weights=again, minlength=len(n)) / np.maximum(1, n)
    extra = np.stack([repeated, variety, np.log1p(n) / 10], axis=1).astype(np.float32)
    return np.concatenate([*shares, extra], axis=1), n


class Classifier:
    """Softmax regression with a weight per feature and domain."""

    def __init__(self, domains: list[str], weights: np.ndarray, bias: np.ndarray):
        self.domains, self.weights, self.bias = domains, weights, bias

    def posteriors(self, rows: np.ndarray) -> np.ndarray:
        level = rows @ self.weights + self.bias
        found = np.exp(level - level.max(axis=1, keepdims=True))
        return found / found.sum(axis=1, keepdims=True)


def fit(rows: np.ndarray, labels: np.ndarray, domains: list[str], prior: np.ndarray, steps: int = STEPS) -> Classifier:
    """Adam on the cross-entropy of texts weighted to the given shares of the domains."""
    wanted = np.eye(len(domains), dtype=np.float32)[labels]
    weight = (prior / np.maximum(1, wanted.sum(axis=0)))[labels][:, None].astype(np.float32)
    model = Classifier(domains, np.zeros((rows.shape[1], len(domains)), np.float32), np.zeros(len(domains), np.float32))
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in (model.weights, model.bias)]
    for step in range(1, steps + 1):
        miss = (model.posteriors(rows) - wanted) * weight
        for value, (mean, square), change in zip(
            (model.weights, model.bias), moments, (rows.T @ miss + 1e-5 * model.weights, miss.sum(axis=0))
        ):
            mean += 0.1 * (change - mean)
            square += 0.01 * (change**2 - square)
            value -= 0.1 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return model


def learn(docs: DataFrame, domains: DataFrame, names: list[str], sample_rows: int = SAMPLE_ROWS) -> Classifier | None:
    """The classifier of a bounded sample of the texts that ``domains`` (doc_id, domain) labels."""
    given = docs.where(F.col("text").isNotNull())
    hashed = given.select("doc_id", F.xxhash64("text").alias("order"), F.octet_length("text").alias("n_bytes"))
    marked = hashed.join(domains.where(F.col("domain").isin(names)), "doc_id")
    texts = checkpoint(
        marked.groupBy("order").agg(
            F.min("doc_id").alias("doc_id"), F.min("domain").alias("domain"), F.max("n_bytes").alias("n_bytes")
        )
    )
    counts = {row["domain"]: row["count"] for row in texts.groupBy("domain").count().collect()}
    if len(counts) < 2:
        return None
    chosen = reduce(
        DataFrame.union,
        (sampled(texts.where(F.col("domain") == name), sample_rows, SAMPLE_BYTES).drop("n_bytes") for name in names),
    )
    texts = given.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("order", "domain", "text")
    found = featured(texts).toArrow()
    # copies of a text are one sample
    _, at = np.unique(found.column("order").to_numpy(), return_index=True)
    rows = found.column("features").combine_chunks().flatten().to_numpy().reshape(len(found), -1)[at]
    labels = np.array([names.index(name) for name in found.column("domain").to_pylist()])[at]
    prior = np.array([counts.get(name, 0) for name in names], np.float64)
    return fit(rows, labels, names, prior / prior.sum())


def featured(texts: DataFrame) -> DataFrame:
    """order, domain, features of labelled texts: only numbers leave the tasks, ``WIDTH`` 32-bit ones a text."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            flat = np.ascontiguousarray(features(batch.column("text"))[0]).ravel()
            lists = pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * WIDTH), pa.array(flat))
            yield pa.RecordBatch.from_arrays([batch.column("order"), batch.column("domain"), lists], ["order", "domain", "features"])

    return texts.mapInArrow(rows, "order long, domain string, features array<float>")


def memberships(docs: DataFrame, model: Classifier | None, targets: dict[str, float]) -> DataFrame:
    """doc_id, n_tokens, p (array of posteriors in the order of ``targets``)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    even = np.array(list(targets.values()))

    def classify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            rows, n = features(batch.column("text"))
            found = shared.value.posteriors(rows) if shared.value is not None else np.tile(even / even.sum(), (len(n), 1))
            p = pa.array(list(found.astype(np.float64)), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), p], ["doc_id", "n_tokens", "p"])

    return docs.select("doc_id", "text").mapInArrow(classify, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_tokens long, p array<double>")


def _rate(y: np.ndarray) -> Column:
    """max(0, 1 - p . y), 1 for a document without tokens."""
    product = reduce(lambda a, b: a + b, (F.col("p")[k] * F.lit(float(v)) for k, v in enumerate(y)))
    return F.when(F.col("n_tokens") > 0, F.greatest(F.lit(0.0), 1 - product)).otherwise(F.lit(1.0))


def solve(table: DataFrame, targets: list[float], budget: float = 1.0, ridge: float = RIDGE) -> np.ndarray:
    """The vector y of the best rates for a table of n_tokens and p."""
    total = table.agg(F.sum("n_tokens")).first()[0] or 0
    y, k = np.zeros(len(targets)), range(len(targets))
    if not total:
        return y
    wanted = budget * np.array(targets) / sum(targets)
    share = F.col("n_tokens") / F.lit(float(total))
    best, step = np.inf, np.zeros(len(targets))
    for _ in range(MOST_PASSES):
        rate = _rate(y)
        sums = [F.sum(share * rate * F.col("p")[d]) for d in k]
        active = F.when(rate > 0, share).otherwise(F.lit(0.0))
        curve = [F.sum(active * F.col("p")[d] * F.col("p")[e]) for d in k for e in k]
        row = np.array(table.agg(*(F.coalesce(c, F.lit(0.0)).alias(f"c{i}") for i, c in enumerate(sums + curve))).first(), float)
        miss = ridge * y - (row[: len(targets)] - wanted)
        error = np.abs(miss).max()
        if error < CLOSE:
            break
        if error > best:  # too far: back by half of the last step
            step = step / 2
            y = y - step
            continue
        best = error
        step = -np.linalg.solve(row[len(targets) :].reshape(len(targets), -1) + ridge * np.eye(len(targets)), miss)
        y = y + step
    return y


def rates(docs: DataFrame, domains: DataFrame, targets: dict[str, float], budget: float = 1.0) -> DataFrame:
    """doc_id, n_tokens, posteriors (map of domain to probability), rate, copies: a row per row of ``docs``.

    ``domains`` (doc_id, domain) labels some of the documents; ``targets`` gives every domain its weight in tokens.
    """
    if len(targets) < 2 or min(targets.values()) < 0 or sum(targets.values()) <= 0:
        raise ValueError("give at least two domains weights of zero or more")
    names = list(targets)
    table = checkpoint(memberships(docs, learn(docs, domains, names), targets))
    rate = _rate(solve(table, list(targets.values()), budget))
    draw = F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    pairs = [part for k, name in enumerate(names) for part in (F.lit(name), F.col("p")[k])]
    copies = F.floor("rate") + F.when(F.col("doc_id").isNull(), F.lit(0)).otherwise((draw < F.col("rate") - F.floor("rate")).cast("int"))
    return (
        table.withColumn("rate", F.when(F.col("doc_id").isNull(), F.lit(1.0)).otherwise(rate))
        .withColumn("posteriors", F.create_map(*pairs))
        .select("doc_id", "n_tokens", "posteriors", "rate", copies.cast("long").alias("copies"))
    )


def mixed(docs: DataFrame, domains: DataFrame, targets: dict[str, float], budget: float = 1.0) -> DataFrame:
    """``docs`` with each row as often as its copies say."""
    rated = rates(docs, domains, targets, budget).where(F.col("doc_id").isNotNull())
    per_doc = rated.groupBy("doc_id").agg(F.min("copies").alias("_copies"))
    joined = docs.join(per_doc, "doc_id", "left").withColumn("_copies", F.coalesce("_copies", F.lit(1)).cast("int"))
    once = joined.where(F.col("_copies") > 0).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    return once.select(*(F.col(f"`{name}`") for name in docs.columns))
