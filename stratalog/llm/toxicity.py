"""Toxicity by a subsequence string kernel, Nyström landmarks and a support vector machine.

The strings are the words of sentences of labelled documents. The kernel compares two words by the
subsequences of three and of four symbols that they share, each weighted by ``DECAY`` to the power of the length it
spans, up to ``SPAN``; a character put in between, or a dot after each letter, leaves most of them. A set
of words are the landmarks: a word's kernel values with them, times the inverse root of the landmarks'
own kernel matrix, are its features. A linear support vector machine on them tells words of toxic
sentences from those of others: first with the labels as they are, where a harmless word of a toxic
document is outweighed by its other occurrences, then with the words that this finds as positives and
the clean words that it scores highest as further negatives.

Kernel, landmarks and machine are linear in the subsequences, so a fitted model is one table of weights
by subsequence, and a word is scored by looking its subsequences up. A document's score is a logistic
function of its largest word scores, fitted on the training documents.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalog.llm.common import WHITE, written
from stratalog.session import ship

SYMBOLS, SPAN, DECAY = 64, 6, 0.6
WINDOW, STEP = 24, 12
TOP = 3
THRESHOLD = 0.3
_PUNCTUATION = ".,;:!?\"'()[]{}<>*_-~`|/\\"
_SINGLES = re.compile(r"(?<!\S)\S[.,;:!?*_-]?(?:[ \t]\S[.,;:!?*_-]?){2,}(?!\S)")
#: Where the further symbols of a subsequence stand, counted from its first.
_PLACES = [places for n in (2, 3) for places in combinations(range(1, SPAN), n)]
#: Subsequences of three symbols have numbers of their own, those of four share the rest by hash.
TABLE = 1 << 20
_GAP = "\0" * SPAN


@dataclass(frozen=True)
class Training:
    """Bounds of what the model is fitted on: labelled rows of each label, words kept of each kind for
    the machine, landmarks."""

    toxic_rows: int = 3000
    clean_rows: int = 6000
    words: int = 12000
    landmarks: int = 256
    rounds: int = 2
    seed: int = 5


def _symbols() -> np.ndarray:
    """The symbol of each code point: a-z and digits their own, the others 27 classes, 0 for no one."""
    table = 37 + np.arange(0x110000) % 25
    table[ord("a"):ord("z") + 1] = np.arange(1, 27)
    table[ord("0"):ord("9") + 1] = np.arange(27, 37)
    table[ord("^")], table[ord("$")], table[0] = 62, 63, 0
    return table.astype(np.int32)


_TABLE = _symbols()


def subsequences(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, subsequence, weight) for all subsequences of the words between ``^`` and ``$``, the
    weights of a word scaled to length 1 as far as its subsequences differ."""
    marked = [f"^{word}$" for word in words]
    text = _GAP.join(marked) + _GAP
    codes = _TABLE[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    owner = np.repeat(np.arange(len(words)), [len(word) + SPAN for word in marked])
    n = len(codes) - SPAN
    parts = []
    for places in _PLACES:
        at = np.flatnonzero((codes[:n] > 0) & (owner[:n] == owner[places[-1]:n + places[-1]])
                            & (codes[places[-1]:n + places[-1]] > 0))
        key = codes[at].astype(np.int64)
        for place in places:
            key = key * SYMBOLS + codes[at + place]
        if len(places) == 3:
            key = SYMBOLS ** 3 + (key * 0x9E3779B1 >> 7) % (TABLE - SYMBOLS ** 3)
        parts.append((owner[at], key, np.full(
            len(at), DECAY ** (places[-1] - len(places)), np.float32)))
    word, key, weight = (np.concatenate(part) for part in zip(*parts, strict=True))
    norm = np.sqrt(np.bincount(word, weight ** 2, minlength=len(words)))
    return word, key, weight / norm[word]


#: Words that are compared with the landmarks at once: each of their subsequences takes a row of floats.
COMPARED_WORDS = 64


class Landmarks:
    """Words to compare others with: their subsequences and the weights each word has for them."""

    def __init__(self, words: list[str]):
        word, key, weight = subsequences(words)
        self.keys, at = np.unique(key, return_inverse=True)
        self.weights = np.zeros((len(self.keys), len(words)), np.float32)
        np.add.at(self.weights, (at, word), weight)

    def kernel(self, words: list[str]) -> np.ndarray:
        out = np.zeros((len(words), self.weights.shape[1]), np.float32)
        for start in range(0, len(words), COMPARED_WORDS):
            word, key, weight = subsequences(words[start:start + COMPARED_WORDS])
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            same = np.flatnonzero(self.keys[at] == key)
            same = same[np.argsort(word[same], kind="stable")]
            owners, first = np.unique(word[same], return_index=True)
            if len(owners):
                out[start + owners] = np.add.reduceat(
                    self.weights[at[same]] * weight[same][:, None], first, axis=0)
        return out


#: Rows of a sum over features that are taken at once.
BLOCK = 2000


def _machine(x: np.ndarray, up: np.ndarray, down: np.ndarray, ridge: float) -> np.ndarray:
    """Weights of a linear support vector machine with squared hinge loss, by Newton steps.

    A row of ``x`` has the label 1 with the weight ``up`` and -1 with the weight ``down``. The sums over
    rows are taken block by block, so only ``x`` itself is held whole.
    """
    width = x.shape[1] + 1
    total = up.sum() + down.sum()
    penalty = ridge * np.eye(width)
    penalty[-1, -1] = 1e-9
    w = np.zeros(width)
    for _ in range(30):
        square, linear = penalty.copy(), np.zeros(width)
        for at in range(0, len(x), BLOCK):
            rows = x[at:at + BLOCK].astype(np.float64)
            rows = np.column_stack([rows, np.ones(len(rows))])
            score = rows @ w
            for label, weight in ((1.0, up[at:at + BLOCK]), (-1.0, down[at:at + BLOCK])):
                weight = np.where(label * score < 1, weight, 0.0) / total
                square += (rows * weight[:, None]).T @ rows
                linear += label * (weight @ rows)
        new = np.linalg.solve(square, linear)
        if np.allclose(new, w, atol=1e-8):
            break
        w = new
    return w


@dataclass(frozen=True)
class WordModel:
    """Score of a word: the sum of ``weights`` over its subsequences, and ``bias``."""

    weights: np.ndarray
    bias: float

    def scores(self, words: list[str]) -> np.ndarray:
        out = np.full(len(words), self.bias)
        for at in range(0, len(words), BLOCK):
            word, key, weight = subsequences(words[at:at + BLOCK])
            out[at:at + BLOCK] += np.bincount(
                word, weight * self.weights[key], minlength=len(out[at:at + BLOCK]))
        return out


def fit_words(words: list[str], toxic: np.ndarray, clean: np.ndarray, marks: list[str],
              ridge: float = 1e-5) -> WordModel:
    """A model of words with the weights they have as toxic and as clean ones."""
    landmarks = Landmarks(marks)
    values, vectors = np.linalg.eigh((landmarks.weights.T @ landmarks.weights).astype(np.float64))
    good = values > 1e-4 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])
    root32 = root.astype(np.float32)
    x = np.empty((len(words), root.shape[1]), np.float32)
    for at in range(0, len(words), BLOCK):
        x[at:at + BLOCK] = landmarks.kernel(words[at:at + BLOCK]) @ root32
    w = _machine(x, toxic, clean, ridge)
    weights = np.zeros(TABLE, np.float32)
    weights[landmarks.keys] = landmarks.weights @ (root @ w[:-1])
    return WordModel(weights, float(w[-1]))


def plain_word(token: str) -> str:
    return token.strip(_PUNCTUATION)


def variants(token: str) -> list[str]:
    """What a token is scored as: itself in windows, and without marks between its letters."""
    word = plain_word(token)
    forms = [word] if word else []
    if word and not word.isalnum():
        squeezed = "".join(c for c in word if c.isalnum())
        forms += [squeezed] if squeezed else []
    out = []
    for form in forms:
        last = max(len(form) - WINDOW, 0)
        out += [form[at:at + WINDOW] for at in range(0, last + STEP, STEP)
                if at == 0 or at < len(form) - STEP]
    return out


class Scorer:
    """Word scores with a memory of bounded size."""

    REMEMBERED = 300_000

    def __init__(self, model: WordModel):
        self.model, self.known = model, {}

    def tops(self, text: str) -> list[float]:
        """The largest scores of the different words of a text, ``TOP`` of them."""
        low = text.lower()
        tokens = set(low.split())
        tokens.update(re.sub(r"\s+", "", run) for run in _SINGLES.findall(low))
        new = [token for token in tokens if token not in self.known]
        if new:
            if len(self.known) > self.REMEMBERED:
                self.known.clear()
                new = list(tokens)
            self.known.update(zip(new, self.token_scores(new), strict=True))
        known = self.known
        scores = sorted((known[token] for token in tokens), reverse=True)[:TOP]
        return scores + [self.model.bias - 1.0] * (TOP - len(scores))

    def token_scores(self, tokens: list[str]) -> list[float]:
        out: list[float] = []
        for at in range(0, len(tokens), 5000):
            forms = [variants(token) for token in tokens[at:at + 5000]]
            flat = self.model.scores([form for several in forms for form in several]).tolist()
            start = 0
            for several in forms:
                end = start + len(several)
                out.append(max(flat[start:end], default=self.model.bias - 1.0))
                start = end
        return out


@dataclass(frozen=True)
class Model:
    words: WordModel
    coefficients: np.ndarray

    def score(self, tops: np.ndarray) -> np.ndarray:
        """Scores (0 to 1) of rows of largest word scores."""
        z = np.column_stack([tops, np.ones(len(tops))]) @ self.coefficients
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    x = np.column_stack([x, np.ones(len(x))])
    w, weight = np.zeros(x.shape[1]), weight / weight.sum()
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (weight * (p - y)) + ridge * w
        h = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x
        w = w - np.linalg.solve(h + ridge * np.eye(len(w)), grad)
    return w


def held_out(doc_id: Column) -> Column:
    """Rows that no model learns from: crc32 of the id as text is 2 modulo 4. NULL ids are not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, training: Training) -> DataFrame:
    """(doc_id, text, toxic, share), written: a bounded sample of the labelled rows that are not held
    out, in the order of a hash of the id. ``share`` is the part of its label's rows that was taken."""
    known = labels.filter(F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id"))).groupBy(
        "doc_id").agg(F.max("toxic").alias("toxic"))
    sizes = dict(known.groupBy("toxic").count().collect())
    parts = []
    for label, most in ((1, training.toxic_rows), (0, training.clean_rows)):
        picked = known.filter(F.col("toxic") == label).orderBy(
            F.xxhash64("doc_id"), "doc_id").limit(most)
        share = min(1.0, most / max(sizes.get(label, 0), 1))
        parts.append(picked.withColumn("share", F.lit(share)))
    return written(docs.select("doc_id", "text").join(F.broadcast(parts[0].unionByName(parts[1])),
                                                      "doc_id"), "training")


def word_counts(rows: DataFrame) -> DataFrame:
    """(word, toxic, clean), written: in how many training rows of each label a word is."""
    tokens = F.array_distinct(F.split(F.lower(F.coalesce("text", F.lit(""))), WHITE))
    words = rows.select("toxic", F.explode(tokens).alias("word")).withColumn(
        "word", F.btrim("word", F.lit(_PUNCTUATION))).filter(
        (F.length("word") > 1) & (F.length("word") <= WINDOW))
    return written(words.groupBy("word").agg(
        F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("clean")), "words")


def _gapped(words: list[str], rng: np.random.Generator) -> list[str]:
    """Each word with one letter put in at a place of chance."""
    out = []
    for word in words:
        at = int(rng.integers(1, max(2, len(word))))
        out.append(word[:at] + chr(int(rng.integers(97, 123))) + word[at:])
    return out


def _mapped_words(model: WordModel):
    def score(batches):
        for batch in batches:
            words = batch.column("word").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("word"), batch.column("clean"), pa.array(model.scores(words))],
                ["word", "clean", "score"])

    return score


def fit(docs: DataFrame, labels: DataFrame, training: Training = Training()) -> Model | None:  # noqa: B008
    """A model from labelled rows; None where either label has no rows."""
    ship(docs.sparkSession)
    rows = training_rows(docs, labels, training)
    sizes = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    if len(sizes) < 2:
        return None
    counts = word_counts(rows)
    evidence = F.col("toxic") / (F.col("clean") * (sizes[1] / sizes[0]) + 0.5)
    n = training.words
    favoured = counts.filter("toxic > 0").orderBy(F.desc(evidence), F.desc("toxic"), "word").limit(n)
    usual = counts.filter("clean > 0").orderBy(F.xxhash64("word"), "word").limit(n)
    common = counts.filter("clean > 0").orderBy(F.desc("clean"), "word").limit(n // 4)
    table = {r["word"]: (r["toxic"], r["clean"])
             for part in (favoured, usual, common) for r in part.collect()}
    rng = np.random.default_rng(training.seed)
    words = sorted(table)
    if not words:
        return None
    toxic, clean = (np.array([table[word][i] for word in words], float) / sizes[1 - i]
                    for i in (0, 1))
    rank = np.argsort(-(toxic - 5 * clean), kind="stable")
    third = training.landmarks // 3
    marks = [words[i] for i in rank[:2 * third]] + [
        words[i] for i in rng.permutation(rank[2 * third:])[:training.landmarks - 2 * third]]
    model = fit_words(words, toxic, 5 * clean + 0.2 / sizes[0], marks)
    for _ in range(training.rounds):
        hard = counts.filter("clean > 0").mapInArrow(
            _mapped_words(model), "word string, clean bigint, score double").orderBy(
            F.desc("score"), "word").limit(n // 4).collect()
        scores = model.scores(words)
        # A word of one toxic row only may be there by chance, unless the machine knows its like.
        positive = [word for word, t, c, s in zip(words, toxic, clean, scores, strict=True)
                    if t > 5 * c and s > (0 if t * sizes[1] > 1.5 else 0.5)]
        if not positive:
            break
        more = _gapped(positive, rng)
        negative = [word for word, c in zip(words, clean, strict=True) if c > 0]
        hard_words = [r["word"] for r in hard]
        both = positive + more + negative + hard_words
        is_toxic = np.repeat([1.0, 0.0], [2 * len(positive), len(negative) + len(hard_words)])
        share = dict(zip(words, toxic, strict=True))
        weight = np.array([share[w] for w in positive] * 2)
        up = np.concatenate([weight / weight.sum(), np.zeros(len(negative) + len(hard_words))])
        down = np.concatenate([np.zeros(2 * len(positive)), np.full(
            len(negative), 1 / len(negative)), np.full(len(hard_words), 2 / max(1, len(hard_words)))])
        top = sorted(positive, key=lambda w: (-share[w], w))[:third]
        marks = list(dict.fromkeys(top + more[:third // 2] + hard_words[:third] + [
            negative[i] for i in rng.permutation(len(negative))[:third]]))[:training.landmarks]
        model = fit_words(both, up * is_toxic, down, marks)
    tops = rows.select("text", "toxic", "share").mapInArrow(
        _mapped_tops(model), "tops array<double>, toxic bigint, share double").collect()
    x = np.array([r["tops"] for r in tops])
    y = np.array([float(r["toxic"]) for r in tops])
    return Model(model, _logistic(x, y, np.array([1 / r["share"] for r in tops])))


def _mapped_tops(model: WordModel):
    def run(batches):
        scorer = Scorer(model)
        for batch in batches:
            tops = [scorer.tops(text or "") for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(tops, pa.list_(pa.float64())), batch.column("toxic").cast(pa.int64()),
                 batch.column("share")], ["tops", "toxic", "share"])

    return run


def _scored(shared):
    def run(batches):
        model: Model = shared.value
        scorer = Scorer(model.words)
        for batch in batches:
            tops = np.array([scorer.tops(text or "") for text in batch.column("text").to_pylist()])
            scores = model.score(tops.reshape(-1, TOP))
            columns = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in columns], pa.array(scores)], [*columns, "score"])

    return run


def scored(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, score) of every row of ``docs`` (doc_id, text), of the whole text.

    NULL and empty texts have the score of a text without words. Without a model every score is 0.
    Rows repeated and NULL ids are kept; other columns are not read. No rows: no rows.
    """
    ship(docs.sparkSession)
    rows = docs.select("doc_id", "text")
    if model is None:
        return rows.select("doc_id", F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # one table of TABLE numbers
    return rows.mapInArrow(_scored(shared), "doc_id bigint, score double")


def without_toxic(docs: DataFrame, model: Model | None, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, any others) that score under the threshold, as they are."""
    ship(docs.sparkSession)
    if model is None:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def keep(batches):
        scorer = Scorer(shared.value.words)
        for batch in batches:
            at = batch.schema.names.index("text")
            tops = np.array([scorer.tops(text or "") for text in batch.column(at).to_pylist()])
            low = shared.value.score(tops.reshape(-1, TOP)) < threshold
            yield batch.filter(pa.array(low))

    return docs.mapInArrow(keep, docs.schema)
