"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Character n-grams of orders 1 to 3 of the lower-cased text are hashed to ``WIDTH`` features. Document frequencies are counted over
all training documents. Weights are fitted by follow-the-regularised-leader (per-coordinate steps, elastic-net penalty) on a bounded
sample, ``per_class`` documents a language by lowest hash rank and ``sample_rows`` in all, and scores are calibrated by one temperature
on documents that were kept out of the fit.

Defined cases: a null text or one without any letter is ``und`` with score 0; documents without a language are not learned from;
with no labelled document at all every text is ``und``; repeated rows are each predicted; texts are read whole; other columns are ignored
whatever their names. ``accept`` drops ``und`` texts and those of a score near chance; where there are no labels, or the model does no
better than chance on documents kept out of the fit, scores say nothing and only texts without a letter go.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import gathered, materialise, release

WIDTH = 1 << 13
UNKNOWN = "und"
_LATIN = re.compile("[A-Za-z]")
_BATCH = 2 << 20
#: Characters whose n-grams are counted at a time.
_STEP = 1 << 18


def has_letter(text: str | None) -> bool:
    return bool(text) and (_LATIN.search(text) is not None or any(map(str.isalpha, text)))


def counts(texts: list[str]) -> np.ndarray:
    """Hashed n-gram counts, one row a text, over whole texts."""
    padded = [f" {t.lower()} " for t in texts]
    ends = np.cumsum([len(t) for t in padded])
    whole = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), np.uint32)
    out = np.zeros(len(texts) * WIDTH, np.float32)
    # A stretch at a time, with the two characters after it that its last n-grams reach into.
    for start in range(0, len(whole), _STEP):
        code = whole[start : start + _STEP + 2]
        code = np.where((code >= 48) & (code <= 57), np.uint32(48), code)
        doc = np.searchsorted(ends, np.arange(start, start + len(code)), "right")
        gram = np.zeros(len(code), np.uint32)
        for order in range(1, 4):
            gram = gram[: len(code) - order + 1] * np.uint32(0x9E3779B1) + (code[order - 1 :] + np.uint32(1)) * np.uint32(0x85EBCA6B)
            mixed = ((gram ^ (gram >> np.uint32(15))) * np.uint32(0x2C1B3C6D + 2 * order))[:_STEP]
            first = doc[: len(mixed)]
            slot = (mixed >> np.uint32(19)).astype(np.int64) + first * WIDTH
            out += np.bincount(slot[first == doc[order - 1 : order - 1 + len(mixed)]], minlength=len(out))
    return out.reshape(len(texts), WIDTH)


def chunks(texts: list[str], limit: int = 1 << 18) -> Iterator[list[str]]:
    held: list[str] = []
    size = 0
    for t in texts:
        held.append(t)
        size += len(t)
        if size >= limit or len(held) >= 128:
            yield held
            held, size = [], 0
    if held:
        yield held


class Model:
    def __init__(self, classes: list[str], idf: np.ndarray, weights: np.ndarray, bias: np.ndarray, temperature: float, informed: bool = False):
        self.classes, self.idf, self.weights, self.bias, self.temperature, self.informed = classes, idf, weights, bias, temperature, informed

    def features(self, raw: np.ndarray) -> np.ndarray:
        """Unit TF-IDF rows, in the place of the counts."""
        np.log1p(raw, out=raw)
        raw *= self.idf
        raw /= np.maximum(np.sqrt(np.einsum("ij,ij->i", raw, raw))[:, None], 1e-9)
        return raw

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        known = [i for i, t in enumerate(texts) if has_letter(t)] if self.classes else []
        at = 0
        for part in chunks([texts[i] for i in known]):
            p = softmax((self.features(counts(part)) @ self.weights + self.bias) / self.temperature)
            for i, best, score in zip(known[at : at + len(part)], p.argmax(1), p.max(1), strict=True):
                names[i], scores[i] = self.classes[best], float(score)
            at += len(part)
        return names, scores


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def ftrl(x: np.ndarray, y: np.ndarray, use: np.ndarray, k: int, alpha=1.0, beta=1.0, l1=0.02, l2=0.01, epochs=6, batch=32) -> tuple[np.ndarray, np.ndarray]:
    """Follow-the-regularised-leader (proximal) with elastic-net penalties on minibatches of the rows ``use``; the last row is the bias."""
    z, n = np.zeros((x.shape[1] + 1, k)), np.zeros((x.shape[1] + 1, k))
    w = np.zeros_like(z)
    rng = np.random.default_rng(5)
    for _ in range(epochs):
        for rows in np.array_split(use[rng.permutation(len(use))], max(1, len(use) // batch)):
            part = np.hstack([x[rows], np.ones((len(rows), 1), np.float32)])
            p = softmax(part @ w)
            p[np.arange(len(rows)), y[rows]] -= 1
            g = part.T @ p / len(rows)
            z += g - (np.sqrt(n + g * g) - np.sqrt(n)) / alpha * w
            n += g * g
            w = np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2))
    return w[:-1].astype(np.float32), w[-1].astype(np.float32)


def temperature(z: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least log loss, by golden-section search on its logarithm."""
    loss = lambda t: -np.log(np.maximum(softmax(z / np.exp(t))[np.arange(len(y)), y], 1e-12)).mean()
    lo, hi, g = -3.0, 3.0, (5**0.5 - 1) / 2
    for _ in range(40):
        a, b = hi - g * (hi - lo), lo + g * (hi - lo)
        lo, hi = (lo, b) if loss(a) < loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))


def better_than_chance(said: np.ndarray, y: np.ndarray) -> bool:
    """Whether hits exceed those of always naming the most frequent class by three standard errors."""
    if not len(y):
        return False
    chance = np.bincount(y).max() / len(y)
    return float((said == y).sum()) > len(y) * chance + 3 * np.sqrt(len(y) * chance * (1 - chance))


def fold() -> F.Column:
    """crc32 of the id as text, modulo 4."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(4))


def train(docs: DataFrame, per_class: int = 400, folds: tuple[int, ...] = (0, 1, 3), sample_rows: int = 4000) -> Model:
    """Fit on ``docs`` (doc_id, text, lang) of the given folds; ``per_class`` and ``sample_rows`` bound the labelled rows the driver gets."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text", "lang")
    rank = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1 << 40))
    rows = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & fold().isin(*folds))
    rows = rows.select("text", F.col("lang").cast("string").alias("lang"), rank.alias("rank"))
    by_lang = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not by_lang:
        return Model([], np.ones(WIDTH, np.float32), np.zeros((WIDTH, 0)), np.zeros(0), 1.0)
    per_class = max(8, min(per_class, sample_rows // len(by_lang)))
    # About half as many again as wanted pass; the exact bound is applied when they are sorted.
    share = spark.createDataFrame([(k, int(min(1.0, 1.5 * per_class / n + 40 / n) * (1 << 40))) for k, n in by_lang.items()], "s_lang string, top long")

    def statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(WIDTH, np.int64), 0
        for batch in gathered(batches, _BATCH):
            keep: list[list] = [[], [], []]
            texts, top = batch.column("text").to_pylist(), batch.column("top").to_pylist()
            ranks, langs = batch.column("rank").to_pylist(), batch.column("lang").to_pylist()
            at = 0
            for part in chunks(texts):
                c = counts(part)
                df += (c > 0).sum(0)
                n += len(part)
                for i in range(len(part)):
                    if ranks[at + i] <= top[at + i] and has_letter(part[i]):
                        used = np.flatnonzero(c[i])
                        keep[0].append(ranks[at + i])
                        keep[1].append(langs[at + i])
                        keep[2].append(used.astype("<u2").tobytes() + c[i][used].astype("<f4").tobytes())
                at += len(part)
            yield pa.RecordBatch.from_arrays([pa.array(keep[0], pa.int64()), pa.array(keep[1], pa.string()), pa.array(keep[2], pa.binary())], ["rank", "lang", "made"])
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([-n], pa.int64()), pa.array([None], pa.string()), pa.array([df.astype("<i8").tobytes()], pa.binary())], ["rank", "lang", "made"])
        release()

    joined = rows.join(F.broadcast(share), F.col("lang") == F.col("s_lang")).select("text", "lang", "rank", "top")
    made = materialise(joined.mapInArrow(statistics, "rank long, lang string, made binary"), "language-id")
    # Document frequencies: one fixed vector a task, added up a slice at a time.
    part = made.filter("rank < 0").select("rank", F.explode(F.sequence(F.lit(0), F.lit(WIDTH // 1024 - 1))).alias("slice"), "made")
    part = part.select("rank", "slice", F.substring("made", F.col("slice") * 8192 + 1, F.lit(8192)).alias("made"))

    def added(key: tuple, tables: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, "<i8") for x in tables.column("made").to_pylist())
        n = -sum(tables.column("rank").to_pylist())
        return pa.table({"slice": pa.array([key[0].as_py()], pa.int32()), "n": pa.array([n], pa.int64()), "df": pa.array([total.tolist()], pa.list_(pa.int64()))})

    slices = part.groupBy("slice").applyInArrow(added, "slice int, n long, df array<long>").collect()
    df, n = np.concatenate([np.array(r.df) for r in sorted(slices)]), slices[0].n
    # A language has some hundred rows here, so its window is small.
    place = F.row_number().over(Window.partitionBy("lang").orderBy("rank", "made"))
    got = made.filter("rank >= 0").withColumn("place", place).filter(F.col("place") <= per_class).collect()
    sample: dict[str, list] = {}
    for r in sorted(got, key=lambda r: (r.lang, r.place)):
        sample.setdefault(r.lang, []).append(bytes(r.made))
    classes = list(sample)
    idf = np.log((1 + n) / (1 + df)).astype(np.float32) + 1
    model = Model(classes, idf, np.zeros((WIDTH, len(classes)), np.float32), np.zeros(len(classes), np.float32), 1.0)
    if not classes:
        return model
    y = np.array([i for i, c in enumerate(classes) for _ in sample[c]])
    x = np.zeros((len(y), WIDTH), np.float32)
    for row, packed in zip(x, [p for c in classes for p in sample[c]], strict=True):
        k = len(packed) // 6
        row[np.frombuffer(packed[: 2 * k], "<u2")] = np.frombuffer(packed[2 * k :], "<f4")
    sample.clear()
    x = model.features(x)
    aside = np.arange(len(y)) % 5 == 4
    fit = np.flatnonzero(~aside) if aside.any() else np.arange(len(y))
    model.weights, model.bias = ftrl(x, y, fit, len(classes))
    if aside.any():
        z = x[aside] @ model.weights + model.bias
        model.temperature = temperature(z, y[aside])
        model.informed = better_than_chance(z.argmax(1), y[aside])
    return model


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score) of every document; only its text is looked at."""
    model_b = docs.sparkSession.sparkContext.broadcast(model)  # WIDTH numbers a language
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches, _BATCH):
            said, scores = model_b.value.predict(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(said, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])

    return narrow.mapInArrow(run, "doc_id long, lang_pred string, score double")


def accept(docs: DataFrame, model: Model, over_chance: float = 1.2, least: float = 0.25) -> DataFrame:
    """``docs``, all columns, without what is ``und`` or scored under ``least`` or ``over_chance`` times an even split over the languages."""
    model_b = docs.sparkSession.sparkContext.broadcast(model)
    gate = max(least, over_chance / max(len(model.classes), 2)) if model.informed and len(model.classes) > 1 else 0.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches, _BATCH):
            texts = batch.column("text").to_pylist()
            if gate:
                said, scores = model_b.value.predict(texts)
                keep = [a != UNKNOWN and s >= gate for a, s in zip(said, scores, strict=True)]
            else:
                keep = [has_letter(t) for t in texts]
            yield batch.filter(pa.array(keep, pa.bool_()))
        release()

    # Numbered meanwhile, as names may hold dots.
    plain = docs.toDF(*[c if c == "text" else f"c{i}" for i, c in enumerate(docs.columns)])
    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)
