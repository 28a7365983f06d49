"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Texts are lower-cased, everything but letters becomes a space, and n-grams of one to ``N`` characters are hashed into
``BUCKETS`` features, weighted by (1 + log tf) * idf and scaled to length one. Document frequencies are counted over
all learning documents. The weights are learned by FTRL-proximal with elastic-net penalties (L1 makes them sparse) on a
bounded sample of labelled rows: at most ``SAMPLE`` rows, those with the smallest hash of their id, each with its ``FEATURES`` most frequent features at
most, so the driver gets at most 131 MB. A fifth of the
sample is left out of learning and sets the temperature that calibrates the scores. The model, buckets x languages,
doesn't grow with the data; every whole text is scored by itself.

Defined results: a null text or one without a letter is ``und`` with score 0; so is every text if there is nothing to learn
from. Ties go to the first language in alphabetical order. Repeated rows are judged alike; long texts are counted whole, in blocks; an empty table gives an
empty result; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

N, BUCKETS = 3, 1 << 15
SAMPLE, FEATURES, EPOCHS = 4000, 4096, 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.02
BLOCK = 1 << 20
UNKNOWN = "und"
PRIME = np.uint64(0x9E3779B97F4A7C15)
_ASCII = np.full(128, 32, np.uint32)
for _c in range(26):
    _ASCII[97 + _c] = _ASCII[65 + _c] = 97 + _c


def letters(text: str | None) -> np.ndarray:
    """Code points of the lower-cased text with one space for each run of other characters; empty if there is no letter."""
    if not text:
        return np.zeros(0, np.uint32)
    if text.isascii():
        points = _ASCII[np.frombuffer(text.encode(), np.uint8)]
    else:
        low = text.lower()
        points = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), np.uint32).copy()
        plain = points < 128
        points[plain] = _ASCII[points[plain]]
        other = np.unique(points[~plain])
        drop = other[[not chr(p).isalpha() for p in other.tolist()]]
        if len(drop):
            points[np.isin(points, drop)] = 32
    if not (points != 32).any():
        return np.zeros(0, np.uint32)
    points = np.concatenate([[np.uint32(32)], points, [np.uint32(32)]])
    space = points == 32
    return points[~(space & np.concatenate([[False], space[:-1]]))]


def counts(text: str | None, buckets: int = BUCKETS, n: int = N) -> tuple[np.ndarray, np.ndarray]:
    """(features, how often) of a whole text; blocks bound the memory of very long texts."""
    points = letters(text).astype(np.uint64)
    total = np.zeros(buckets, np.int64)
    shift = np.uint64(64 - buckets.bit_length() + 1)
    for at in range(0, len(points), BLOCK):
        part = points[at : at + BLOCK + n - 1]
        key = np.zeros(len(part), np.uint64)
        for k in range(n):
            key = key[: len(part) - k] * np.uint64(0x110001) + part[k:]
            end = min(BLOCK, len(key))
            total += np.bincount(((key[:end] + np.uint64(k)) * PRIME >> shift).astype(np.int64), minlength=buckets)
    at = np.flatnonzero(total)
    return at, total[at]


def strongest(at: np.ndarray, n: np.ndarray, most: int = FEATURES) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` features that occur most often, ties to the lower number."""
    if len(at) <= most:
        return at, n
    keep = np.sort(np.argsort(-n, kind="stable")[:most])
    return at[keep], n[keep]


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # buckets + 1 (bias) x languages
    temperature: float = 1.0

    def vector(self, at: np.ndarray, n: np.ndarray) -> np.ndarray:
        x = (1 + np.log(n)) * self.idf[at]
        return x / max(np.linalg.norm(x), 1e-12)

    def logits(self, at: np.ndarray, n: np.ndarray) -> np.ndarray:
        return self.vector(at, n) @ self.weights[at] + self.weights[-1]

    def predict(self, text: str | None) -> tuple[str, float]:
        at, n = counts(text, len(self.idf))
        if not len(at) or not self.languages:
            return UNKNOWN, 0.0
        p = softmax(self.logits(at, n) / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit(sample: list[tuple[str, np.ndarray, np.ndarray]], idf: np.ndarray, epochs: int = EPOCHS) -> Model:
    """FTRL-proximal with L1 and L2 on (language, features, how often); every fifth row calibrates."""
    languages = sorted({lang for lang, _, _ in sample})
    size = len(idf) + 1
    model = Model(languages, idf, np.zeros((size, len(languages))))
    z, g2 = np.zeros((size, len(languages))), np.zeros((size, len(languages)))
    number = {lang: i for i, lang in enumerate(languages)}
    rows = [(number[lang], np.append(at, size - 1), np.append(model.vector(at, n), 1.0)) for lang, at, n in sample]
    learn = [r for i, r in enumerate(rows) if i % 5] or rows
    held = rows[::5]

    def weights(at: np.ndarray) -> np.ndarray:
        zz, gg = z[at], g2[at]
        w = -(zz - np.sign(zz) * L1) / ((BETA + np.sqrt(gg)) / ALPHA + L2)
        return np.where(np.abs(zz) <= L1, 0.0, w)

    rng = np.random.default_rng(0)
    for _ in range(epochs):
        for i in rng.permutation(len(learn)).tolist():
            y, at, x = learn[i]
            w = weights(at)
            error = softmax(x @ w)
            error[y] -= 1
            g = x[:, None] * error
            had = g2[at]
            z[at] += g - (np.sqrt(had + g * g) - np.sqrt(had)) / ALPHA * w
            g2[at] = had + g * g
    model.weights = weights(np.arange(size))
    if held:
        logits = np.array([x @ model.weights[at] for _, at, x in held])
        truth = np.array([y for y, _, _ in held])
        loss = lambda t: -np.log(np.maximum(softmax(logits / t)[np.arange(len(truth)), truth], 1e-12)).mean()
        model.temperature = float(min(np.geomspace(0.25, 20, 100), key=loss))
    return model


def train(docs: DataFrame, sample: int = SAMPLE, buckets: int = BUCKETS) -> Model:
    """A model from ``docs`` (doc_id, text, lang): all of them may be learned from."""
    known = docs.select("doc_id", "text", "lang").filter(F.col("lang").isNotNull() & F.col("text").isNotNull())

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, n = np.zeros(buckets, np.int64), 0
        for batch in batches:
            for t in batch.column(0):
                at, _ = counts(t.as_py(), buckets)
                seen[at] += 1
                n += 1
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(seen[at], n))], ["feature", "n"])

    df = {r["feature"]: r["n"] for r in known.select("text").mapInArrow(frequencies, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n")).collect()}
    total = df.pop(-1, 0)
    idf = np.full(buckets, np.log(1.0 + total) + 1)
    for f, n in df.items():
        idf[f] = np.log((1.0 + total) / (1 + n)) + 1
    if not total:
        return Model([], idf, np.zeros((buckets + 1, 0)))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [strongest(*counts(t.as_py(), buckets)) for t in batch.column(1)]
            at = pa.array([a.astype("<u4").tobytes() for a, _ in made], pa.binary())
            n = pa.array([b.astype("<u4").tobytes() for _, b in made], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), at, n, batch.column(2)], ["lang", "at", "n", "rank"])

    rank = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 40))
    share = min(1.0, 1.2 * sample / total + 50 / total)
    rows = known.withColumn("rank", rank).filter(F.col("rank") < int(share * (1 << 40)))
    drawn = rows.select("lang", "text", "rank").mapInArrow(features, "lang string, at binary, n binary, rank long").orderBy("rank", "lang", "at").limit(sample).collect()
    read = lambda b: np.frombuffer(b, "<u4").astype(np.int64)
    return fit([(r["lang"], read(r["at"]), read(r["n"])) for r in drawn if len(r["at"])], idf)


def predicted(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score) of each row of ``docs`` (doc_id, text, ...)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # its size is fixed by BUCKETS and the number of languages

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [sent.value.predict(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([a for a, _ in made], pa.string()), pa.array([b for _, b in made], pa.float64())], ["doc_id", "lang_pred", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, lang_pred string, score double")


def held_out(docs: DataFrame) -> DataFrame:
    """Add held_out: crc32 of the id as text is divisible by 5. A null id is held out."""
    return docs.withColumn("held_out", F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(True)))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(held_out(docs).filter("not held_out"))
    return held_out(predicted(docs, model)).select("doc_id", "held_out", "lang_pred", "score")


QUERIES = {"op1_language_id": op1_language_id}
ORACLE_SQL: dict[str, str] = {}
