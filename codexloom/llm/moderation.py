"""Problem 10: abusive, hateful and sexual content, by subword-bag embeddings and a linear softmax.

A word is the mean of the vectors of itself and its character n-grams (Joulin et al., "Bag of tricks for efficient text
classification", 2017; Bojanowski et al., "Enriching word vectors with subword information", 2017), a sentence the mean
of its words, and a linear softmax gives its class; vectors and softmax are trained jointly, in numpy. Misspelled words
share n-grams with their right forms, so that they need not be known. Reviewed are whole documents, so the sentences
that make a document offensive are latent: they are chosen again after each round of training.

As everything before the softmax is linear, a trained model is a table of class scores per word. Scoring looks every
word up once per worker and averages over sentences; it never holds more than a batch of documents.
"""

from __future__ import annotations

import math
import re
import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CLASSES = ("clean", "abusive", "hateful", "sexual")
#: Signs written for letters.
LEET = str.maketrans("013457@$!", "oieastasi")
_EDGE = re.compile(r"^[^\w@$*#]+|[^\w@$*#]+$")
_END = frozenset(".!?…")
#: Words from which on a sentence counts in full, so that a fragment of a word or two decides nothing.
SHORTEST = 6
_CLOSERS = "\"')]}»”’"


def plain_word(token: str) -> str:
    """A token in lower case without outer punctuation; '' for numbers and long opaque strings, which say nothing."""
    word = _EDGE.sub("", unicodedata.normalize("NFKC", token).lower())
    if not word:
        return ""
    if not any(ch.isalpha() for ch in word):
        return "<sign>" if any(ch in "*@$#" for ch in word) else ""
    return word if len(word) <= 30 else ""


def word_parts(word: str, buckets: int) -> list[int]:
    """Hash buckets of a word, of its spoken form (signs read as letters, repeats and inner points dropped), and of their n-grams."""
    if word.startswith("<"):
        return [zlib.crc32(word.encode()) % buckets]
    spoken = re.sub(r"[^\w]|_", "", re.sub(r"(\w)\1{2,}", r"\1", word.translate(LEET) if re.search(r"[a-z]", word) else word))
    parts = {f"={word}", f"={spoken}"}
    for form in {word, spoken}:
        edged = f"<{form}>"
        for n in (3, 4, 5):
            parts.update(edged[i : i + n] for i in range(len(edged) - n + 1))
    return [zlib.crc32(p.encode()) % buckets for p in sorted(parts)]


def split_sentences(text: str) -> list[list[str]]:
    """Sentences of a text as lists of raw tokens: they end at . ! ? and at line breaks."""
    out: list[list[str]] = []
    for line in text.split("\n"):
        now: list[str] = []
        for token in line.split():
            now.append(token)
            bare = token.rstrip(_CLOSERS)
            if bare and bare[-1] in _END and len(bare) > 1:
                out.append(now)
                now = []
        if now:
            out.append(now)
    return out


@dataclass
class Model:
    """Scores per n-gram bucket (buckets x classes), i.e. embeddings times softmax weights, and the bias."""

    scores: np.ndarray
    bias: np.ndarray

    @property
    def buckets(self) -> int:
        return len(self.scores)

    def word(self, word: str) -> np.ndarray:
        return self.scores[word_parts(word, self.buckets)].mean(axis=0)

    def probabilities(self, sentences: list[list[str]]) -> np.ndarray:
        means, sizes = [], []
        for sentence in sentences:
            words = [w for w in map(plain_word, sentence) if w]
            sizes.append(len(words))
            means.append(np.mean([self.word(w) for w in words], axis=0) if words else np.zeros(len(self.bias)))
        return _discounted(_softmax(np.array(means).reshape(-1, len(self.bias)) + self.bias), np.array(sizes))


def _discounted(p: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Class chances with those of sentences below :data:`SHORTEST` words moved towards clean."""
    p = p * np.minimum(1.0, sizes / SHORTEST)[:, None]
    p[:, 0] += 1 - p.sum(axis=1)
    return p


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


class _Bags:
    """Sums over ragged bags and back, by sorted positions."""

    def __init__(self, bags: list[list[int]], size: int) -> None:
        self.flat = np.array([x for b in bags for x in b], dtype=np.int64)
        lengths = np.array([len(b) for b in bags])
        self.starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
        self.lengths = lengths[:, None].astype(np.float32)
        owner = np.repeat(np.arange(len(bags)), lengths)
        order = np.argsort(self.flat, kind="stable")
        self.back_owner = owner[order]
        self.back_ids, self.back_starts = np.unique(self.flat[order], return_index=True)
        self.size = size

    def mean(self, values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(values[self.flat], self.starts, axis=0) / self.lengths

    def spread(self, grads: np.ndarray) -> np.ndarray:
        out = np.zeros((self.size, grads.shape[1]), dtype=np.float32)
        out[self.back_ids] = np.add.reduceat((grads / self.lengths)[self.back_owner], self.back_starts, axis=0)
        return out


def _fit(sentences: list[tuple[str, ...]], target: np.ndarray, weight: np.ndarray, buckets: int, dim: int, steps: int, rate: float, seed: int) -> Model:
    """Full-batch Adam on embeddings and softmax."""
    rng = np.random.default_rng(seed)
    vocabulary = {w: k for k, w in enumerate(sorted({w for s in sentences for w in s}))}
    parts = _Bags([word_parts(w, buckets) for w in vocabulary], buckets)
    bags = _Bags([[vocabulary[w] for w in s] for s in sentences], len(vocabulary))
    k = len(CLASSES)
    params = [rng.normal(0, 0.1, (buckets, dim)).astype(np.float32), rng.normal(0, 0.1, (dim, k)).astype(np.float32), np.zeros(k, dtype=np.float32)]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    wanted = np.eye(k, dtype=np.float32)[target]
    share = (weight / weight.sum()).astype(np.float32)[:, None]
    for step in range(1, steps + 1):
        words = parts.mean(params[0])
        held = bags.mean(words)
        miss = (_softmax(held @ params[1] + params[2]) - wanted) * share
        grads = [parts.spread(bags.spread(miss @ params[1].T)), held.T @ miss + 1e-6 * params[1], miss.sum(axis=0)]
        for p, g, a, b in zip(params, grads, first, second):
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            p -= rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-8)
    return Model((params[0] @ params[1]).astype(np.float32), params[2])


def train(documents: list[tuple[str, str]], buckets: int = 1 << 15, dim: int = 12, steps: int = 60, rounds: int = 3, rate: float = 0.05, balance: float = 4.0, seed: int = 7) -> Model:
    """Fit on (text, label) of reviewed documents.

    Sentences of clean documents are clean. Of an offensive document the sentence whose words clean documents hold least
    is the first suspect; from then on its likeliest sentence is offensive, others as likely as not as well, the rest
    is clean. Offensive sentences weigh up to ``balance`` times as much as clean ones.
    """
    held = [([tuple(w for w in map(plain_word, s) if w) for s in split_sentences(text)], CLASSES.index(label)) for text, label in documents if label in CLASSES]
    held = [([s for s in sentences if s], label) for sentences, label in held]
    clean = {s for sentences, label in held if label == 0 for s in sentences}
    unlike = [([s for s in dict.fromkeys(sentences) if s not in clean], label) for sentences, label in held if label]
    unlike = [(sentences, label) for sentences, label in unlike if sentences]
    if not unlike or not clean:
        return Model(np.zeros((buckets, len(CLASSES)), dtype=np.float32), np.array([1.0, 0, 0, 0], dtype=np.float32) * 9)
    # First suspicion: mean log-odds of the words' document frequencies.
    bad, good = Counter(), Counter()
    for sentences, label in held:
        (bad if label else good).update({w for s in sentences for w in s})
    n_bad = sum(label > 0 for _, label in held)
    odds = lambda w: math.log((bad[w] + 0.1) / (n_bad + 0.2)) - math.log((good[w] + 0.5) / (len(held) - n_bad + 1))
    doubt = lambda sentences: np.array([np.mean([odds(w) for w in s]) for s in sentences])
    limit = None
    model = None
    for _ in range(rounds):
        negative, suspects = set(clean), set()
        for sentences, label in unlike:
            if model is None:
                x, limit = doubt(sentences), math.inf
            else:
                x, limit = 1 - model.probabilities([list(s) for s in sentences])[:, 0], 0.5
            for s, v in zip(sentences, x):
                if v >= limit or v == x.max():
                    suspects.add((s, label))
                elif model is not None:
                    negative.add(s)
        negative -= {s for s, _ in suspects}
        rows = sorted(negative) + [s for s, _ in sorted(suspects)]
        target = np.array([0] * len(negative) + [label for _, label in sorted(suspects)])
        weight = np.where(target == 0, 1.0, min(balance, max(1.0, 0.5 * len(negative) / len(suspects))))
        model = _fit(rows, target, weight, buckets, dim, steps, rate, seed)
    return model


def labelled_texts(documents: DataFrame, labels: DataFrame, most: int = 20_000) -> list[tuple[str, str]]:
    """(text, label) of at most ``most`` reviewed documents, those with the least hash of their id; of several reviews
    of one document the latest counts (ties: the greater label). This sample is the only text that reaches the driver."""
    latest = labels.where("doc_id is not null and label is not null").groupBy("doc_id").agg(F.max_by(F.lower(F.trim("label")), F.struct("labelled_at", "label")).alias("label"))
    picked = latest.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    texts = documents.where("text is not null").select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    return sorted((r.text, r.label) for r in texts.select("text", "label").collect())


_SCORED = "doc_id long, label string, score double, p_abusive double, p_hateful double, p_sexual double, n_sentences int"


def score_documents(documents: DataFrame, model: Model, threshold: float = 0.4, cache: int = 400_000) -> DataFrame:
    """One row per document: class of its worst sentence, ``score`` = its chance not to be clean, and the worst of each class.

    ``label`` is clean where score < ``threshold``. Null and blank texts score 0 with no sentence; rows with a null id
    are left out; other columns are ignored. Whole texts are read.
    """
    held = documents.sparkSession.sparkContext.broadcast((model.scores, model.bias))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*held.value)
        k = len(CLASSES)
        ids: dict[str, int] = {}
        table = np.zeros((1024, k), dtype=np.float32)
        real, ends = np.zeros(1024, dtype=bool), np.zeros(1024, dtype=bool)

        def learn(token: str) -> int:
            nonlocal table, real, ends
            at = len(ids)
            if at == len(table):
                table, real, ends = np.concatenate([table, np.zeros_like(table)]), np.concatenate([real, np.zeros_like(real)]), np.concatenate([ends, np.zeros_like(ends)])
            ids[token] = at
            word = plain_word(token)
            bare = token.rstrip(_CLOSERS)
            real[at], ends[at] = bool(word), bool(bare) and bare[-1] in _END and len(bare) > 1
            table[at] = own.word(word) if word else 0
            return at

        for batch in batches:
            if len(ids) > cache:
                ids.clear()
            keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            codes: list[int] = []
            stops: list[int] = []  # token positions after which a line ends
            firsts: list[int] = []
            get = ids.get
            for text in texts:
                firsts.append(len(codes))
                for line in (text or "").split("\n"):
                    tokens = line.split()
                    if tokens:
                        codes += [c if (c := get(t)) is not None else learn(t) for t in tokens]
                        stops.append(len(codes) - 1)
            n = len(codes)
            worst = np.zeros((len(keys), k))
            best = np.zeros(len(keys))
            count = np.zeros(len(keys), dtype=np.int32)
            if n:
                code = np.array(codes, dtype=np.int64)
                stop = ends[code]
                stop[stops] = True
                begin = np.concatenate([[0], np.flatnonzero(stop)[:-1] + 1]) if stop[-1] else np.concatenate([[0], np.flatnonzero(stop) + 1])
                total = np.add.reduceat(table[code], begin, axis=0)
                size = np.add.reduceat(real[code].astype(np.float32), begin)
                p = _discounted(_softmax(total / np.maximum(size, 1)[:, None] + own.bias), size)
                doc = np.searchsorted(np.array(firsts), begin, side="right") - 1
                np.maximum.at(worst, doc, p)
                np.maximum.at(best, doc, 1 - p[:, 0])
                np.add.at(count, doc, 1)
            label = [CLASSES[1 + int(np.argmax(w[1:]))] if b >= threshold else CLASSES[0] for w, b in zip(worst, best)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(label, pa.string()), pa.array(np.round(best, 6)), *(pa.array(np.round(worst[:, c], 6)) for c in (1, 2, 3)), pa.array(count, pa.int32())], names=["doc_id", "label", "score", "p_abusive", "p_hateful", "p_sexual", "n_sentences"])

    return documents.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(score, _SCORED)


def moderated(documents: DataFrame, labels: DataFrame, most: int = 20_000, threshold: float = 0.4) -> DataFrame:
    """Train on the reviewed sample and score every document; see :func:`train` and :func:`score_documents`."""
    return score_documents(documents, train(labelled_texts(documents, labels, most)), threshold)


def source_rates(documents: DataFrame, scored: DataFrame) -> DataFrame:
    """Per source (null sources are one group): documents, offensive ones by class, and their rate."""
    joined = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "source").join(scored.select("doc_id", "label"), "doc_id")
    counts = [F.count_if(F.col("label") == c).alias(f"n_{c}") for c in CLASSES[1:]]
    return joined.groupBy("source").agg(F.count("*").alias("n_documents"), *counts, F.round(F.avg((F.col("label") != "clean").cast("int")), 6).alias("rate"))
