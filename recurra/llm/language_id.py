"""Language identification by scripts, per-word scores and a Viterbi path with a switching penalty.

Learning counts, over all training texts, the character 1- to 3-grams of words by language (``TABLE`` hashed counters a
language, so that the model's size doesn't grow with the corpus) and the letters of each script by language.

A word's script comes from the code point of its first letter; only languages that hold at least ``SCRIPT_SHARE`` of their
letters in that script are candidates for it (all, if none does). A word's score in a language is the mean log-likelihood of its n-grams times
the square root of their number (0 is the mean of all languages), bounded by ``WORD_BOUND``, plus ``OFF_SCRIPT`` for a language that isn't a candidate. The best
path over all words of a text pays ``PENALTY`` for each change of language, so that single odd words don't break a span while
longer foreign passages become spans of their own. A language's score is the mean of its share of the letters on the path and of
its share in a softmax over the whole text's scores (divided by the square root of the number of words); the label is the best one. Texts are read whole; batches advance word by word together, long texts included.

Defined results: a null text, an empty one or one without letters is ``und`` with score 0 and no spans. Ties go to the first
language by name. Without any labelled text every prediction is ``und``.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recurra.llm.shared import widened
from recurra.llm.words import chunks, mixed, numbered, split_words

TABLE = 1 << 15
PENALTY = 6.0
WORD_BOUND = 6.0
OFF_SCRIPT = -8.0
SCRIPT_SHARE = 0.01
SLICE = 8192
UNKNOWN = "und"

# First and last code point of the ranges that hold the letters of each script.
SCRIPTS = {
    "latin": ((0x41, 0x24F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFB00, 0xFB06)),
    "greek": ((0x370, 0x3FF), (0x1F00, 0x1FFF)),
    "cyrillic": ((0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)),
    "armenian": ((0x530, 0x58F),),
    "hebrew": ((0x590, 0x5FF), (0xFB1D, 0xFB4F)),
    "arabic": ((0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)),
    "indic": ((0x900, 0xDFF),),
    "thai": ((0xE00, 0xE7F),),
    "georgian": ((0x10A0, 0x10FF),),
    "hangul": ((0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)),
    "kana": ((0x3040, 0x30FF), (0x31F0, 0x31FF)),
    "han": ((0x2E80, 0x2FDF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF)),
}
SCRIPT_NAMES = [*SCRIPTS, "other"]

_letters = regex.compile(r"\p{L}+").findall


def script_of(letter: str) -> int:
    """The number of a letter's script in ``SCRIPT_NAMES``."""
    point = ord(letter)
    for number, ranges in enumerate(SCRIPTS.values()):
        if any(low <= point <= high for low, high in ranges):
            return number
    return len(SCRIPTS)


def letters_of(word: str) -> str:
    """The lower-cased letters of a word, in composed form; empty if it has none."""
    if not word.isascii():
        word = unicodedata.normalize("NFC", word)
    return word.lower() if word.isalpha() else "".join(_letters(word)).lower()


def grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Table places of the 1- to 3-grams of all words' letters, with a mark at both ends, and the word of each.

    ``words`` are made of letters only; an empty one has no n-grams.
    """
    points = np.frombuffer(f" {' '.join(words)} ".encode("utf-32-le"), np.uint32).astype(np.uint64)
    mark = points == 32
    word = np.cumsum(mark) - 1
    letter = np.flatnonzero(~mark)
    pair = np.flatnonzero(~(mark[:-1] & mark[1:]))
    one = points[letter] * np.uint64(0x9E3779B97F4A7C15)
    two = (points[pair] << np.uint64(21) | points[pair + 1]) * np.uint64(0xC2B2AE3D27D4EB4F)
    three = points[letter - 1] << np.uint64(42) | points[letter] << np.uint64(21) | points[letter + 1]
    places = mixed(np.concatenate([one, two, three * np.uint64(0x165667B19E3779F9)])) & np.uint64(TABLE - 1)
    return places.astype(np.int64), np.concatenate([word[letter], word[pair], word[letter]])


def slices(words: list[str]) -> Iterator[slice]:
    """Cuts of ``SLICE`` words: n-grams take many times the memory of their words, and no word needs another one's."""
    return (slice(k, k + SLICE) for k in range(0, len(words), SLICE))


class Model:
    """Log-likelihoods of n-gram places by language, and the candidate languages of each script."""

    def __init__(self, languages: list[str], counts: np.ndarray, scripts: np.ndarray):
        self.languages = languages
        smooth = counts + 0.5
        self.table = np.log(smooth / smooth.sum(axis=1, keepdims=True)).T.astype(np.float32)
        self.table -= self.table.mean(axis=1, keepdims=True)
        share = scripts / np.maximum(1, scripts.sum(axis=1, keepdims=True))
        allowed = share.T >= SCRIPT_SHARE
        allowed[~allowed.any(axis=1)] = True
        self.off = np.where(allowed, 0, OFF_SCRIPT).astype(np.float32)

    def score(self, words: list[str]) -> np.ndarray:
        """The score of each word of letters in each language; zero for an empty word."""
        scores = np.zeros((len(words), len(self.languages)), np.float32)
        for cut in slices(words):
            scores[cut] = self._score(words[cut])
        return scores

    def _score(self, words: list[str]) -> np.ndarray:
        places, owner = grams(words)
        number = np.bincount(owner, minlength=len(words))
        sums = [np.bincount(owner, weights=self.table[places, k], minlength=len(words)) for k in range(len(self.languages))]
        mean = np.stack(sums, axis=1) / np.sqrt(np.maximum(1, number))[:, None]
        scripts = np.array([script_of(word[0]) if word else 0 for word in words], np.int64)
        found = np.clip(mean, -WORD_BOUND, WORD_BOUND) + self.off[scripts]
        return np.where(number[:, None] > 0, found, 0)


def _counted(batches: Iterator[pa.RecordBatch], languages: list[str]) -> Iterator[pa.RecordBatch]:
    """Counts of one task: language, place (n-grams, then scripts) and number."""
    place_of = {name: k for k, name in enumerate(languages)}
    counts = np.zeros((len(languages), TABLE + len(SCRIPT_NAMES)), np.int64)
    for batch in chunks(batches, "text"):
        words, offsets = split_words(batch.column("text"), lower=False)
        index, distinct = numbered(words)
        owner = np.repeat(np.array([place_of[x] for x in batch.column("lang").to_pylist()], np.int64), np.diff(offsets))
        seen = np.bincount(owner * max(1, len(distinct)) + index, minlength=len(languages) * len(distinct))
        seen = seen.reshape(len(languages), -1)
        bare = [letters_of(word) for word in distinct]
        for cut in slices(bare):
            places, word = grams(bare[cut])
            for k, times in enumerate(seen[:, cut]):
                used = times[word] > 0
                counts[k, :TABLE] += np.bincount(places[used], weights=times[word[used]], minlength=TABLE).astype(np.int64)
        scripts = np.array([script_of(x[0]) if x else 0 for x in bare], np.int64)
        sizes = np.array([len(x) for x in bare], np.int64)
        for k, times in enumerate(seen):
            counts[k, TABLE:] += np.bincount(scripts, weights=times * sizes, minlength=len(SCRIPT_NAMES)).astype(np.int64)
    language, place = np.nonzero(counts)
    yield pa.RecordBatch.from_arrays(
        [pa.array(language.astype(np.int32)), pa.array(place.astype(np.int32)), pa.array(counts[language, place])],
        ["language", "place", "n"],
    )


def learn(docs: DataFrame) -> Model | None:
    """The model of all rows of ``docs`` (text, lang) whose lang isn't null.

    The counters are summed in Spark; the driver gets ``TABLE`` of them a language, whatever the size of the corpus.
    """
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("text", "lang")
    languages = sorted(row[0] for row in labelled.select("lang").distinct().collect())
    if not languages:
        return None
    counted = labelled.mapInArrow(lambda batches: _counted(batches, languages), "language int, place int, n long")
    sums = counted.groupBy("language", "place").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros((len(languages), TABLE + len(SCRIPT_NAMES)))
    counts[sums.column("language").to_numpy(), sums.column("place").to_numpy()] = sums.column("n").to_numpy()
    return Model(languages, counts[:, :TABLE], counts[:, TABLE:])


def paths(scores: np.ndarray, offsets: np.ndarray, penalty: float = PENALTY) -> np.ndarray:
    """The best language of every word; ``scores`` has a row per word, ``offsets`` cut them into texts.

    All texts advance together, a word at a time; those that have ended are left out.
    """
    lengths = np.diff(offsets)
    order = np.argsort(-lengths, kind="stable")
    begin, lengths = offsets[:-1][order], lengths[order]
    best = np.zeros(len(scores), np.int32)
    if not len(scores):
        return best
    stay = np.zeros(scores.shape, bool)
    top = np.zeros(len(scores), np.int32)
    alive = np.searchsorted(-lengths, -np.arange(1, lengths[0] + 1), side="right")
    value = scores[begin[: alive[0]]].copy()
    for t in range(1, int(lengths[0])):
        n = alive[t]
        value = value[:n]
        leader = value.argmax(axis=1)
        jump = value[np.arange(n), leader] - np.float32(penalty)
        rows = begin[:n] + t
        kept = value >= jump[:, None]
        stay[rows], top[rows] = kept, leader
        value = np.where(kept, value, jump[:, None]) + scores[rows]
        # what has ended at this word leaves its last values in ``scores`` row of that word, to start the way back
        scores[rows] = value
    ends = offsets[1:][order][: alive[0]] - 1
    state = scores[ends].argmax(axis=1)
    # the way back: a text joins when the walk reaches its length
    current = np.zeros(len(lengths), np.int64)
    for t in range(int(lengths[0]) - 1, -1, -1):
        n, fresh = alive[t], alive[t + 1] if t + 1 < lengths[0] else 0
        current[fresh:n] = state[fresh:n]
        rows = begin[:n] + t
        best[rows] = current[:n]
        if t:
            current[:n] = np.where(stay[rows, current[:n]], current[:n], top[rows])
    return best


def _sums(rows: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """The sum of the rows of each text."""
    running = np.concatenate([np.zeros((1, rows.shape[1])), np.cumsum(rows, axis=0, dtype=np.float64)])
    return running[cuts[1:]] - running[cuts[:-1]]


def unlearned(texts: pa.Array) -> tuple[list[str], np.ndarray, list[list[tuple[int, int, str]]]]:
    """What ``Labeller.label`` returns where no language was learned: one span from the first to the last word with letters."""
    words, offsets = split_words(texts, lower=False)
    index, distinct = numbered(words)
    sound = np.flatnonzero(np.array([bool(letters_of(word)) for word in distinct], bool)[index])
    spans = [
        [(int(sound[a] - start), int(sound[b - 1] - start) + 1, UNKNOWN)] if b > a else []
        for start, a, b in zip(offsets, *(np.searchsorted(sound, cuts) for cuts in (offsets[:-1], offsets[1:])))
    ]
    return [UNKNOWN] * len(texts), np.zeros(len(texts)), spans


class Labeller:
    """Applies a model to batches of texts."""

    def __init__(self, model: Model):
        self.model = model

    def label(self, texts: pa.Array) -> tuple[list[str], np.ndarray, list[list[tuple[int, int, str]]]]:
        """Language, score and spans (first word, last word + 1, language) of each text."""
        words, offsets = split_words(texts, lower=False)
        index, distinct = numbered(words)
        bare = [letters_of(word) for word in distinct]
        sizes, scores = np.array([len(x) for x in bare], np.int64)[index], self.model.score(bare)[index]
        sound = sizes > 0
        cuts = np.concatenate([[0], np.cumsum(sound)])[offsets]
        counts = np.diff(cuts)
        scores, weight, place = scores[sound], sizes[sound], np.flatnonzero(sound)
        sums = _sums(scores, cuts)
        path = paths(scores, cuts)
        share = _sums(weight[:, None] * (path[:, None] == np.arange(len(self.model.languages))), cuts)
        total = share.sum(axis=1)
        level = (sums - sums.max(axis=1, keepdims=True)) / np.sqrt(np.maximum(1, counts))[:, None]
        likely = np.exp(level) / np.exp(level).sum(axis=1, keepdims=True)
        found = (share / np.maximum(1, total)[:, None] + likely) / 2
        winner = found.argmax(axis=1)
        score = np.where(total > 0, found[np.arange(len(counts)), winner], 0.0)
        names = [self.model.languages[w] if n else UNKNOWN for w, n in zip(winner, total)]
        return names, score, [self._spans(path[a:b], place[a:b] - offsets[k]) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]

    def _spans(self, path: np.ndarray, place: np.ndarray) -> list[tuple[int, int, str]]:
        if not len(path):
            return []
        cuts = [0, *(np.flatnonzero(np.diff(path)) + 1).tolist(), len(path)]
        return [(int(place[a]), int(place[b - 1]) + 1, self.model.languages[path[a]]) for a, b in zip(cuts, cuts[1:])]


SPANS = "array<struct<first: int, last: int, lang: string>>"


def labelled(docs: DataFrame, shared: Broadcast) -> DataFrame:
    """``docs`` with lang_pred, score and lang_spans (words ``first`` to ``last`` - 1 of the text); the model comes by broadcast."""
    names = ("lang_pred", "score", "lang_spans")
    rest = docs.drop(*names)
    kind = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("lang", pa.string())]))

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(shared.value) if shared.value else None
        for batch in chunks(batches, "text"):
            found = (labeller.label if labeller else unlearned)(batch.column("text"))
            spans = [[{"first": a, "last": b, "lang": x} for a, b, x in row] for row in found[2]]
            columns = [pa.array(found[0], pa.string()), pa.array(found[1], pa.float64()), pa.array(spans, kind)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, *names])

    return rest.mapInArrow(label, widened(rest, f"lang_pred string, score double, lang_spans {SPANS}"))


def identified(docs: DataFrame, training: DataFrame) -> DataFrame:
    """``docs`` with lang_pred, score and lang_spans by a model of ``training`` (text, lang)."""
    return labelled(docs, docs.sparkSession.sparkContext.broadcast(learn(training)))
