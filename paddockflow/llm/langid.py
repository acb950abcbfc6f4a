"""Language identification by a small byte convolutional network, in numpy.

Bytes are embedded, passed through filters of several widths, max-pooled over a fixed-length
window and classified by a softmax.  The network is trained on the driver from a bounded
sample of labelled windows, and applied to every window of every whole text; a document's
probabilities are the mean over its windows, weighted by their bytes.

For scoring, embedding and filters are multiplied out into tables over pairs of bytes, which
gives the same activations with two lookups a byte.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WINDOW = 256
WIDTHS = (2, 3, 4)
_REACH = max(WIDTHS)
_SLICE_CHARACTERS = 1 << 20
_WINDOWS_AT_ONCE = 256
UNDETERMINED = "und"
_LETTER = regex.compile(r"\p{L}")


def windows(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes of windows padded for the filters' reach, text of each window, bytes in it)."""
    raw = [t.lower().encode("utf-8", "surrogatepass") for t in texts]
    size = np.fromiter(map(len, raw), np.int64, len(raw))
    count = np.maximum(1, -(-size // WINDOW))
    flat = np.frombuffer(
        b"".join(r.ljust(n * WINDOW, b"\0") for r, n in zip(raw, count.tolist(), strict=True)), np.uint8
    ).reshape(-1, WINDOW)
    owner = np.repeat(np.arange(len(raw)), count)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    held = np.minimum(WINDOW, np.maximum(1, size[owner] - nth * WINDOW))
    return np.pad(flat, ((0, 0), (0, _REACH - 1))), owner, held


class ByteNetwork:
    """Multi-width byte filters, max pooling and softmax."""

    def __init__(self, languages: list[str], dimensions: int = 8, filters: int = 10, seed: int = 7):
        draw = np.random.default_rng(seed)
        self.languages = languages
        total = filters * len(WIDTHS)
        self.mask = np.zeros((_REACH, 1, total), np.float32)
        for i, width in enumerate(WIDTHS):
            self.mask[:width, :, i * filters : (i + 1) * filters] = 1
        self.weights = {
            "embed": draw.normal(0, 0.5, (256, dimensions)),
            "filter": draw.normal(0, 0.3, (_REACH, dimensions, total)) * self.mask,
            "bias": np.zeros(total),
            "dense": draw.normal(0, 0.2, (total, len(languages))),
            "offset": np.zeros(len(languages)),
        }
        self.weights = {k: v.astype(np.float32) for k, v in self.weights.items()}
        self._pairs = None

    def _softmax(self, pooled: np.ndarray) -> np.ndarray:
        z = np.maximum(pooled, 0) @ self.weights["dense"] + self.weights["offset"]
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 4, batch: int = 64, rate: float = 0.004, seed: int = 11,
            least_steps: int = 500):
        """Adam on the cross-entropy; ``x`` holds padded windows, ``y`` language numbers.

        A small sample is passed over more often, for at least ``least_steps`` batches.
        """
        draw, w = np.random.default_rng(seed), self.weights
        first = {k: np.zeros_like(v) for k, v in w.items()}
        second = {k: np.zeros_like(v) for k, v in w.items()}
        step = 0
        passes = max(epochs, round(least_steps / max(1, len(x) / batch)))
        for _ in range(min(passes, least_steps)):
            order = draw.permutation(len(x))
            for low in range(0, len(x), batch):
                some = x[order[low : low + batch]]
                want = y[order[low : low + batch]]
                tables = np.einsum("be,kef->kbf", w["embed"], w["filter"])
                act = sum(tables[k][some[:, k : k + WINDOW]] for k in range(_REACH))
                at = act.argmax(axis=1)
                pooled = np.take_along_axis(act, at[:, None, :], 1)[:, 0] + w["bias"]
                grad = self._softmax(pooled)
                grad[np.arange(len(want)), want] -= 1
                grad /= len(want)
                back = (grad @ w["dense"].T) * (pooled > 0)
                slope = {"dense": np.maximum(pooled, 0).T @ grad, "offset": grad.sum(0), "bias": back.sum(0)}
                touched = np.zeros_like(tables)
                rows = np.arange(len(want))[:, None]
                for k in range(_REACH):
                    np.add.at(touched[k], (some[rows, at + k], np.arange(back.shape[1])), back)
                slope["embed"] = np.einsum("kbf,kef->be", touched, w["filter"])
                slope["filter"] = np.einsum("be,kbf->kef", w["embed"], touched) * self.mask
                step += 1
                for k, g in slope.items():
                    first[k] += 0.1 * (g - first[k])
                    second[k] += 0.001 * (g * g - second[k])
                    w[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-7)
        return self

    def pair_tables(self) -> list[np.ndarray]:
        if self._pairs is None:
            tables = np.einsum("be,kef->kbf", self.weights["embed"], self.weights["filter"])
            self._pairs = [
                (tables[k][:, None, :] + tables[k + 1][None, :, :]).reshape(1 << 16, -1) for k in range(0, _REACH, 2)
            ]
        return self._pairs

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """Softmax of every padded window."""
        tables = self.pair_tables()
        pair = x[:, :-1].astype(np.int32) << 8 | x[:, 1:]
        out = np.empty((len(x), len(self.languages)), np.float32)
        for low in range(0, len(x), _WINDOWS_AT_ONCE):
            some = pair[low : low + _WINDOWS_AT_ONCE]
            act = tables[0].take(some[:, :WINDOW], axis=0)
            for i in range(1, len(tables)):
                act += tables[i].take(some[:, 2 * i : 2 * i + WINDOW], axis=0)
            out[low : low + len(some)] = self._softmax(act.max(axis=1) + self.weights["bias"])
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and probability of whole texts; ``und`` and 0 for null or letterless ones."""
        names, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
        real = [i for i, t in enumerate(texts) if t is not None and _LETTER.search(t)]
        if not real or not self.languages:
            return names, scores
        x, owner, held = windows([texts[i] for i in real])
        mean = np.zeros((len(real), len(self.languages)))
        for low in range(0, len(x), 4096):
            part = slice(low, low + 4096)
            np.add.at(mean, owner[part], self.probabilities(x[part]) * held[part, None])
        mean /= mean.sum(axis=1, keepdims=True)
        best = mean.argmax(axis=1)
        for k, i in enumerate(real):
            names[i] = self.languages[best[k]]
            scores[i] = min(1.0, mean[k, best[k]])
        return names, scores


def held_out(id_column: str = "doc_id"):
    """True for ids that are never learned from: crc32 of the id as text is 2 modulo 4."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, per_language: int = 2500, windows_per_doc: int = 4) -> ByteNetwork:
    """Fit on windows at hashed places of labelled texts that are not held out.

    The sample is bounded: about ``per_language`` windows of each language, of at most WINDOW
    characters each, chosen by a hash of the id, so it is the same on every run.  One language
    is always predicted if only one is labelled; without labels the network knows none.
    """
    labelled = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out())
    found = {r[0]: r[1] for r in labelled.groupBy("lang").count().collect()}
    languages = sorted(found)
    if not languages:
        return ByteNetwork([])
    share = F.create_map(*(F.lit(v) for k in languages for v in (k, per_language / windows_per_doc / found[k])))
    even = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("sample")), F.lit(1_000_003)) / 1_000_003
    place = lambda i: F.pmod(
        F.xxhash64(F.col("doc_id").cast("string"), i), F.greatest(F.lit(1), F.length("text") - WINDOW + 1)
    ).cast("int") + 1
    rows = (
        labelled.filter(even < share[F.col("lang")])
        .select("lang", F.explode(F.transform(
            F.sequence(F.lit(1), F.lit(windows_per_doc)), lambda i: F.substring(F.col("text"), place(i), F.lit(WINDOW))
        )).alias("part"))
        .distinct()
    )
    some = sorted((r.lang, r.part) for r in rows.collect() if _LETTER.search(r.part))
    if not some:
        return ByteNetwork([])
    x, owner, _ = windows([p for _, p in some])
    y = np.array([languages.index(lang) for lang, _ in some])
    first = np.concatenate(([True], owner[1:] != owner[:-1]))
    return ByteNetwork(languages).fit(x[first], y)


def identified(docs: DataFrame, network: ByteNetwork) -> DataFrame:
    """One row per document: ``row`` (all its columns as a struct), lang_pred and score.

    Null texts and texts without a letter are ``und`` with score 0.
    """
    spec = docs.select(F.struct("*").alias("row"))
    schema = T.StructType(list(spec.schema.fields)).add("lang_pred", "string").add("score", "double")

    def run(batches):
        for batch in batches:
            texts = batch.column("row").field("text")
            low = 0
            while low < len(texts):
                some, held = [], 0
                while low + len(some) < len(texts) and held < _SLICE_CHARACTERS:
                    some.append(texts[low + len(some)].as_py())
                    held += len(some[-1] or "")
                names, scores = network.predict(some)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").slice(low, len(some)), pa.array(names), pa.array(scores)],
                    names=["row", "lang_pred", "score"],
                )
                low += len(some)

    return spec.mapInArrow(run, schema)


def kept(docs: DataFrame, least_score: float = 0.4) -> DataFrame:
    """Documents whose language is told with at least ``least_score``; same columns as ``docs``."""
    told = identified(docs, train(docs)).filter((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= least_score))
    return told.select(*(F.col("row")[c].alias(c) for c in docs.columns))
