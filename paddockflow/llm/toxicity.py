"""Toxicity by a subsequence string kernel and a support vector machine.

The kernel counts subsequences of two and three characters shared by two strings, weighted by
how far they are spread, so an insult with gaps, inserted marks or doubled letters stays close
to the plain one; both counts are normalised by the strings' own, averaged and put through an
exponential, which keeps it a kernel.  Strings are mapped by Nyström landmarks: kernel values
against a few landmark words, whitened by the landmarks' own kernel matrix; a linear machine on
that map is a kernel machine.  Every unit of a text gets its margin: a word, a run of single
letters set apart, or a stretch of a word that is longer than ``LONGEST``.

Training sentences carry the label of their document only, so the machine is trained on bags:
each toxic document is represented by its highest-scoring units, chosen again in a few rounds.
A document is judged by its highest margins and by how many units, of how many words, lie above
certain margins: one plain insult is enough, while words that are only near to some count by
how thickly they stand.  A logistic curve over these, fitted with the classes in their true
shares on whole labelled documents, gives the score.

Null and empty texts have no units and get the score of such a text; very long texts and words
take time in proportion to their length; repeated rows get equal scores; an empty table gives no
rows, and without labels of both classes every score is 0.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paddockflow.llm.langid import held_out

_DECAY = np.float32(0.6)
_REMEMBERED = 300_000
_SLICE_CHARACTERS = 1 << 20
_UNITS_AT_ONCE = 256
_SHARPNESS = 6.0
_START = "^"
#: A longer word is taken apart into overlapping stretches of this many characters.
LONGEST = 48
#: Margins above which units are counted.
_LEVELS = (-0.5, 0.0, 0.5)
_NO_UNIT = -1.5
#: Bounds of the fit: letters of a landmark, clean units, and units that get disguised.
_LANDMARK_LETTERS = 10
_CLEAN_UNITS = 20_000
_DISGUISED = 1500
_MARKS = ".,;:!?\"'()[]{}<>#*$%&|-_/\\«»„“”‘’…¡¿"


def stretches(word: str) -> list[str]:
    """The word, or overlapping stretches that cover it."""
    if len(word) <= LONGEST:
        return [word]
    return [word[at : at + LONGEST] for at in range(0, len(word) - LONGEST // 2, LONGEST // 2)]


def units(text: str | None) -> set[str]:
    """Lower-cased words without outer marks, the same without inner marks, and runs of three or
    more single letters joined."""
    found, run = set(), []
    for word in (text or "").lower().split():
        word = word.strip(_MARKS)
        if len(word) == 1:
            run.append(word)
            continue
        if len(run) > 2:
            found.add("".join(run))
        run = []
        if len(word) > 2:
            found.add(word)
            if not word.isalnum():
                found.add("".join(c for c in word if c.isalnum()))
    if len(run) > 2:
        found.add("".join(run))
    found.discard("")
    for word in [word for word in found if len(word) > LONGEST]:
        found.remove(word)
        found.update(stretches(word))
    return found


def _codes(words: list[str], width: int, fill: int) -> np.ndarray:
    out = np.full((len(words), width), fill, np.int32)
    for i, word in enumerate(words):
        out[i, : len(word)] = np.frombuffer(word.encode("utf-32-le", "surrogatepass"), "<i4")
    return out


class SubsequenceKernel:
    """Counts of shared subsequences of lengths 2 and 3 against fixed landmarks.

    One pass over a word's characters; words of like length and all landmarks go together.
    The state holds, for every place of every landmark, the weighted subsequences of one and of
    two characters that end there.
    """

    def __init__(self, landmarks: list[str]):
        self.width = max(map(len, landmarks))
        self.count = len(landmarks)
        codes = _codes(landmarks, self.width, -2)
        letters = sorted({c for c in codes.ravel().tolist() if c >= 0})
        self.letters = np.array(letters)
        # row of a letter: the places of the landmarks that hold it; the last row is for all others
        self.places = np.zeros((len(letters) + 1, self.count * self.width), np.float32)
        for i, letter in enumerate(letters):
            self.places[i] = (codes.ravel() == letter) * (_DECAY * _DECAY)
        self.decay = _decays(self.width)
        # what a letter adds to each place from all places up to it
        self.spread = (self.places.reshape(-1, self.width) @ self.decay).reshape(self.places.shape)
        self.first = np.arange(self.count) * self.width

    def __call__(self, words: list[str]) -> np.ndarray:
        out = np.zeros((2, len(words), self.count), np.float32)
        for some, codes in _alike(words):
            at = np.minimum(np.searchsorted(self.letters, codes), len(self.letters) - 1)
            rows = np.where(self.letters[at] == codes, at, len(self.letters))
            one, two, step, triple, pairs, triples = (
                np.zeros((len(some), self.count * self.width), np.float32) for _ in range(6)
            )
            for k in range(codes.shape[1]):
                same = self.places[rows[:, k]]
                # what stood before a place meets it; a landmark's first place has nothing before it
                np.multiply(two[:, :-1], same[:, 1:], out=triple[:, 1:])
                np.multiply(one[:, :-1], same[:, 1:], out=step[:, 1:])
                triple[:, self.first] = step[:, self.first] = 0
                triples += triple
                pairs += step
                two *= _DECAY
                two += (step.reshape(-1, self.width) @ self.decay).reshape(step.shape)
                one *= _DECAY
                one += self.spread[rows[:, k]]
            out[0, some], out[1, some] = (x.reshape(len(some), self.count, -1).sum(axis=2) for x in (pairs, triples))
        return out


def _decays(width: int) -> np.ndarray:
    """Weight of each place in a state at each place from it on."""
    gap = np.arange(width)[None, :] - np.arange(width)[:, None]
    return np.where(gap >= 0, _DECAY ** np.maximum(gap, 0), 0).astype(np.float32)


def _alike(words: list[str]):
    """Groups of words of like length: which, and their characters, filled with -1."""
    order = sorted(range(len(words)), key=lambda i: len(words[i]))
    for low in range(0, len(order), _UNITS_AT_ONCE):
        some = order[low : low + _UNITS_AT_ONCE]
        yield some, _codes([words[i] for i in some], len(words[some[-1]]), -1)


def self_kernel(words: list[str]) -> np.ndarray:
    """The same counts of each word with itself."""
    out = np.zeros((2, len(words)))
    for some, codes in _alike(words):
        filled, decay = codes < 0, _decays(codes.shape[1]).astype(np.float64)
        one, two, step = (np.zeros(codes.shape) for _ in range(3))
        for k in range(codes.shape[1]):
            same = ((codes == codes[:, k, None]) & ~filled) * float(_DECAY * _DECAY)
            out[1, some] += (two[:, :-1] * same[:, 1:]).sum(axis=1)
            step[:, 1:] = one[:, :-1] * same[:, 1:]
            out[0, some] += step.sum(axis=1)
            two = two * _DECAY + step @ decay
            one = one * _DECAY + same @ decay
    return out


class Machine:
    """Nyström map, linear machine and calibration."""

    def __init__(self, landmarks: list[str]):
        self.landmarks = landmarks
        self.known: dict[str, float] = {}
        self.curve = np.zeros(2 + 2 * len(_LEVELS) + 1)
        self.weights, self.bias = np.zeros(len(landmarks)), -1.0
        if landmarks:
            self.kernel = SubsequenceKernel([_START + w for w in landmarks])
            self.scale = np.sqrt(np.maximum(self_kernel([_START + w for w in landmarks]), 1e-9))
            values, vectors = np.linalg.eigh(self.similarity(landmarks))
            values = np.maximum(values, 1e-3)
            self.whiten = vectors / np.sqrt(values) @ vectors.T

    def similarity(self, words: list[str]) -> np.ndarray:
        """Exponential of the normalised subsequence kernel, against every landmark."""
        marked = [_START + w for w in words]
        own = np.sqrt(np.maximum(self_kernel(marked), 1e-9))
        near = self.kernel(marked) / (self.scale[:, None, :] * own[:, :, None])
        return np.exp(_SHARPNESS * (near.mean(axis=0) - 1))

    def features(self, words: list[str]) -> np.ndarray:
        """Nyström features."""
        return self.similarity(words) @ self.whiten if words else np.zeros((0, len(self.landmarks)))

    def margins(self, words: list[str]) -> np.ndarray:
        return self.features(words) @ self.weights + self.bias

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 1e-4, steps: int = 30) -> None:
        """Squared hinge loss by Newton steps on the rows inside the margin."""
        x = np.hstack([x, np.ones((len(x), 1))])
        w = np.zeros(x.shape[1])
        ridge = np.eye(len(w)) * penalty
        for _ in range(steps):
            inside = y * (x @ w) < 1
            a = x[inside] * weight[inside, None]
            new = np.linalg.solve(a.T @ x[inside] / len(x) + ridge, a.T @ y[inside] / len(x))
            if np.allclose(new, w, atol=1e-7):
                break
            w = new
        self.weights, self.bias = w[:-1], float(w[-1])

    def signs(self, texts: list[str | None]) -> np.ndarray:
        """What each text is judged by: its two highest margins, and units above each level as the
        logarithm of their number and per hundred words."""
        if len(self.known) > _REMEMBERED:
            self.known = {}
        bags = [units(t) for t in texts]
        fresh = sorted({u for bag in bags for u in bag if u not in self.known})
        if fresh:
            self.known.update(zip(fresh, self.margins(fresh).tolist(), strict=True))
        out = np.zeros((len(texts), len(self.curve) - 1))
        for row, text, bag in zip(out, texts, bags, strict=True):
            margin = np.fromiter((self.known[u] for u in bag), np.float64, len(bag))
            high = np.sort(np.append(margin[margin > _NO_UNIT], (_NO_UNIT, _NO_UNIT)))[-2:]
            above = np.array([(margin > level).sum() for level in _LEVELS])
            row[:] = [*high, *np.log1p(above), *np.minimum(10.0, 100 * above / max(1, len((text or "").split())))]
        return out

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if not self.landmarks or not texts:
            return np.zeros(len(texts))
        return _logistic(self.signs(texts) @ self.curve[:-1] + self.curve[-1])

    def calibrate(self, signs: np.ndarray, labels: np.ndarray) -> None:
        """Logistic curve of the label over what documents are judged by, with a small ridge."""
        middle, spread = signs.mean(axis=0), signs.std(axis=0) + 1e-9
        x = np.hstack([(signs - middle) / spread, np.ones((len(signs), 1))])
        w = np.zeros(x.shape[1])
        for _ in range(50):
            p = _logistic(x @ w)
            slope = x.T @ (p - labels) + 0.1 * w
            w = w - np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w)), slope)
        self.curve = np.append(w[:-1] / spread, w[-1] - (w[:-1] * middle / spread).sum())


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _disguises(words: list[str], draw: np.random.Generator) -> list[str]:
    """Each word with marks between its letters, one mark inserted, and one letter doubled."""
    out = []
    for word in words:
        mark = ".-*_"[int(draw.integers(4))]
        at = int(draw.integers(1, len(word)))
        out += [mark.join(word), word[:at] + mark + word[at:], word[:at] + word[at - 1] + word[at:]]
    return out


def fit(bags: list[set[str]], labels: list[int], landmarks: int = 24, rounds: int = 3, seed: int = 5) -> Machine:
    """Train on bags of units; a bag is a document's sampled sentences with the document's label.

    Bounded: landmarks have at most ``_LANDMARK_LETTERS`` letters, ``_CLEAN_UNITS`` units of clean
    bags are drawn, and ``_DISGUISED`` units of either class are disguised as well.  The result
    has margins; :meth:`Machine.calibrate` turns them into scores.
    """
    toxic = [b for b, y in zip(bags, labels, strict=True) if y]
    clean = [b for b, y in zip(bags, labels, strict=True) if not y]
    if not toxic or not clean:
        return Machine([])
    draw = np.random.default_rng(seed)
    seen, other = Counter(u for b in toxic for u in b), Counter(u for b in clean for u in b)
    odds = {u: math.log((n + 0.5) / len(toxic)) - math.log((other[u] + 0.5) / len(clean)) + 0.5 * math.log(n)
            for u, n in seen.items() if n * len(clean) > 2 * other[u] * len(toxic)}
    ranked = sorted(odds, key=lambda u: (-odds[u], u))[: 12 * landmarks]
    chosen: list[str] = []
    pool = [u for u in ranked if len(u) <= _LANDMARK_LETTERS]
    if pool:
        gram = SubsequenceKernel(pool)(pool)[0]
        own = np.diag(gram).copy()
        gram /= np.sqrt(np.outer(own, own)) + 1e-9
        taken: list[int] = []
        for i in range(len(pool)):
            if len(taken) < landmarks and own[i] > 0.01 and all(gram[i, j] < 0.6 for j in taken):
                taken.append(i)
        chosen = [pool[i] for i in taken]
    machine = Machine(chosen)
    plain = sorted(other)
    if len(plain) > _CLEAN_UNITS:
        plain = [plain[i] for i in np.sort(draw.choice(len(plain), _CLEAN_UNITS, replace=False))]
    plain += _disguises([plain[i] for i in draw.choice(len(plain), min(len(plain), _DISGUISED), replace=False)], draw)
    negative = machine.features(plain)
    value = dict(odds)
    for turn in range(rounds):
        found = Counter()
        for bag in toxic:
            best = sorted((u for u in bag if u in value), key=lambda u: (-value[u], u))[:2]
            found.update(u for u in best if turn == 0 or value[u] > 0)
        positive = sorted(found)
        if not positive:
            break
        positive += _disguises(positive[:_DISGUISED], draw)
        x = np.vstack([machine.features(positive), negative])
        y = np.concatenate((np.ones(len(positive)), -np.ones(len(plain))))
        weight = np.where(y > 0, len(y) / (2 * len(positive)), len(y) / (2 * len(plain)) * 4)
        machine.fit(x, y, weight)
        words = sorted(u for u in seen if u in odds)
        value = dict(zip(words, machine.margins(words).tolist(), strict=True)) if words else {}
    return machine


def train(docs: DataFrame, labels: DataFrame, docs_per_class: int = 1000, clean_per_toxic: int = 3, sentences: int = 32, characters: int = 300) -> Machine:
    """Fit on labelled sentences of documents that are not held out.

    The sample is bounded: at most ``docs_per_class`` toxic and ``clean_per_toxic`` times as
    many clean labelled documents, by a hash of the id.  Margins are learnt from at most
    ``sentences`` sentences of ``characters`` characters of each; the curve is fitted on the same
    documents' whole texts, of which each task sends a few numbers.  If a label is missing, the
    machine knows no landmark and scores 0.
    """
    turn = F.xxhash64(F.col("doc_id").cast("string"), F.lit("toxic"))
    usable = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out()).select("doc_id", "toxic")
    picked = usable.filter("toxic = 1").orderBy(turn).limit(docs_per_class).unionByName(
        usable.filter("toxic = 0").orderBy(turn).limit(clean_per_toxic * docs_per_class)
    )
    parts = F.array_distinct(F.transform(F.split("text", "[.!?\\n]+\\s*"), lambda s: F.substring(s, 1, characters)))
    some = F.slice(F.sort_array(F.transform(parts, lambda s: F.struct(F.xxhash64(s), s.alias("s")))), 1, sentences)
    # at most (1 + clean_per_toxic) * docs_per_class ids go to every task
    sample = docs.select("doc_id", F.col("text").cast("string").alias("text")).filter(F.col("text").isNotNull()).join(
        F.broadcast(picked.dropDuplicates(["doc_id"])), "doc_id"
    )
    rows = sample.select("doc_id", "toxic", F.transform(some, lambda x: x["s"]).alias("parts"))
    found = sorted((r.doc_id, int(r.toxic), sorted(r.parts)) for r in rows.collect())
    machine = fit([set().union(*(units(p) for p in parts)) for _, _, parts in found], [y for _, y, _ in found])
    if machine.landmarks:
        judged = sample.select("toxic", "text").mapInArrow(_judging(machine), "toxic int, signs array<double>").collect()
        judged = sorted((r["signs"], r["toxic"]) for r in judged)
        machine.calibrate(np.array([x for x, _ in judged]), np.array([y for _, y in judged]))
    return machine


def _slices(texts: pa.Array):
    """(first row, texts) of slices with a bounded number of characters."""
    low = 0
    while low < len(texts):
        some, held = [], 0
        while low + len(some) < len(texts) and held < _SLICE_CHARACTERS:
            some.append(texts[low + len(some)].as_py())
            held += len(some[-1] or "")
        yield low, some
        low += len(some)


def _judging(machine: Machine):
    def run(batches):
        for batch in batches:
            for low, some in _slices(batch.column("text")):
                label = batch.column("toxic").slice(low, len(some)).cast(pa.int32())
                signs = pa.array(machine.signs(some).tolist(), pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([label, signs], names=["toxic", "signs"])

    return run


def scored(docs: DataFrame, machine: Machine, id_column: str = "doc_id") -> DataFrame:
    """(id, score) of every whole text; null and empty texts get the score of a text without units."""
    spec = docs.select(F.col(id_column).alias("id"), F.col("text").cast("string").alias("text"))
    id_type = spec.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for low, some in _slices(batch.column("text")):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(low, len(some)), pa.array(machine.scores(some), pa.float64())],
                    names=["id", "score"],
                )

    return spec.mapInArrow(run, f"id {id_type}, score double").withColumnRenamed("id", id_column)
