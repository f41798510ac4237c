"""Language identification by averaged hashed subword embeddings and a linear softmax.

A text in lower case is the average of the embeddings of its hashed byte n-grams (``GRAMS`` bytes
long, spaces included); a linear layer and a softmax over it give the language. Embeddings and layer
are trained by stochastic gradient descent in numpy on a bounded, stratified sample of the labelled
rows: about ``SAMPLE_PER_LANG`` distinct texts of each language, chosen by a hash, of up to ``SAMPLE_CHARS``
code points. More than ``MAX_LANGS`` languages are an error. A quarter of the sample is held back to calibrate: a temperature is fitted to it, and
a text is rejected when its calibrated probability is below the level under which a share of ``LOST`` of the
calibration texts that the model gets right lie, one half at most.

For prediction the layer is folded into the embeddings, which leaves one small table (buckets x
languages) that the tasks share. Prediction reads whole texts and nothing else.

Defined results: a null text and one without a letter give ``und``, score 0 and a rejection; with no
labelled rows every text does; rows without a label are not learnt from but predicted; a null doc_id
counts as the empty text for the fold; repeated rows count once in the sample and are predicted each; input columns with the
names of the results are replaced, other columns are ignored or carried unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm.common import documents, fold

GRAMS = (2, 3, 4)
BUCKETS, DIM = 1 << 16, 16
SAMPLE_PER_LANG, SAMPLE_CHARS, MAX_LANGS = 500, 20_000, 500
EPOCHS, RATE, SEED = 6, 0.5, 42
LOST = 0.002
_SEGMENT = 1 << 18


# ------------------------------------------------------------------ the model

def gram_buckets(data: bytes) -> Iterator[np.ndarray]:
    """Bucket numbers of all byte n-grams of a text, in parts of bounded size."""
    raw = np.frombuffer(b" " + data + b" ", np.uint8)
    lead = max(GRAMS) - 1
    for at in range(0, len(raw), _SEGMENT):
        part = raw[at:at + _SEGMENT + lead].astype(np.uint64)
        room = len(raw) - at
        found = []
        for n in GRAMS:
            last = min(_SEGMENT, room - n + 1)
            if last <= 0:
                continue
            key = np.full(last, n, np.uint64)
            for i in range(n):
                key = (key << np.uint64(8)) | part[i:i + last]
            found.append((key * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BUCKETS.bit_length() + 1))
        yield np.concatenate(found).astype(np.int64)


@dataclass
class LangModel:
    langs: list[str]
    table: np.ndarray          # buckets x langs: embeddings times layer
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0

    def logits(self, data: bytes) -> np.ndarray:
        total, n = np.zeros(len(self.langs)), 0
        for ids in gram_buckets(data):
            total += self.table[ids].sum(axis=0, dtype=np.float64)
            n += len(ids)
        return total / max(1, n) + self.bias

    def probabilities(self, data: bytes) -> np.ndarray:
        return _softmax(self.logits(data) / self.temperature)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def _bag(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    ids, n = np.unique(np.concatenate(list(gram_buckets(data))), return_counts=True)
    return ids, (n / n.sum()).astype(np.float32)


def train(texts: list[bytes], labels: list[str]) -> LangModel | None:
    """Fits the model on three quarters of the rows and calibrates it on the rest."""
    langs = sorted(set(labels))
    if not langs:
        return None
    y = np.array([langs.index(x) for x in labels])
    rng = np.random.default_rng(SEED)
    held = rng.random(len(y)) < 0.25
    fit = np.flatnonzero(~held) if (~held).any() else np.arange(len(y))
    bags = [_bag(t) for t in texts]
    emb = rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
    layer, bias = rng.normal(0, 0.1, (len(langs), DIM)).astype(np.float32), np.zeros(len(langs), np.float32)
    steps, done = EPOCHS * len(fit), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(fit):
            rate = np.float32(RATE * (1 - done / steps))
            done += 1
            ids, w = bags[i]
            h = w @ emb[ids]
            g = _softmax(layer @ h + bias).astype(np.float32)
            g[y[i]] -= 1
            back = g @ layer
            layer -= rate * np.outer(g, h)
            bias -= rate * g
            # a bucket's share of the average is tiny in a long text; scaled so that its largest step is full
            emb[ids] -= rate * np.outer(w / w.max(), back)
    model = LangModel(langs, emb @ layer.T, bias.astype(np.float64))
    check = np.flatnonzero(held) if held.any() else fit
    return calibrated(model, np.stack([model.logits(texts[i]) for i in check]), y[check])


def calibrated(model: LangModel, logits: np.ndarray, y: np.ndarray) -> LangModel:
    """Sets the temperature of least held-out loss and the rejection threshold. The targets are smoothed
    by 1 in n + 2, as in Platt scaling: n texts, all right, are no proof of certainty."""
    grid = np.exp(np.linspace(np.log(0.02), np.log(20), 120))
    miss = 1 / (len(y) + 2)
    target = np.full(logits.shape, miss / max(1, logits.shape[1] - 1))
    target[np.arange(len(y)), y] = 1 - miss
    loss = [-(target * np.log(np.maximum(_softmax(logits / t), 1e-300))).sum(axis=1).mean() for t in grid]
    model.temperature = float(grid[int(np.argmin(loss))])
    p = _softmax(logits / model.temperature)
    right = p.max(axis=1)[p.argmax(axis=1) == y]
    if len(right):
        model.threshold = float(min(0.5, np.quantile(right, LOST)))
    return model


# ------------------------------------------------------------------ frames

def training_sample(labelled: DataFrame) -> tuple[list[bytes], list[str]]:
    """A bounded, hash-chosen sample of ``labelled`` (text, lang), about equal for each language."""
    rows = labelled.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")
                          & (F.length("text") <= SAMPLE_CHARS)).select("lang", F.lower("text").alias("text"))
    key = F.xxhash64("text", "lang")
    counts = rows.select("lang", key).distinct().groupBy("lang").count().limit(MAX_LANGS + 1).collect()
    if len(counts) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages")
    if not counts:
        return [], []
    share = F.create_map(*[F.lit(v) for r in counts for v in (r["lang"], min(1.0, SAMPLE_PER_LANG / r["count"]))])
    place = F.pmod(key, F.lit(1 << 20)) / (1 << 20)
    chosen = rows.where(place < share[F.col("lang")]).distinct().withColumn("place", place)
    got = chosen.orderBy("place", "lang", "text").limit(2 * SAMPLE_PER_LANG * len(counts)).collect()
    return [r["text"].encode() for r in got], [r["lang"] for r in got]


def fit_languages(docs: DataFrame, learn: Column) -> LangModel | None:
    """The model of the rows of ``docs`` (doc_id, text, lang) that satisfy ``learn``."""
    return train(*training_sample(docs.where(learn).select("text", "lang")))


def with_language(spark: SparkSession, df: DataFrame, model: LangModel | None, names=("lang_pred", "score", "accepted")) -> DataFrame:
    """``df`` (text) with the predicted language, its calibrated probability, and whether the prediction is accepted."""
    shared = spark.sparkContext.broadcast(model)   # BUCKETS x MAX_LANGS numbers at most
    keep = [c for c in df.columns if c not in names]
    lang, score, accepted = names
    schema = df.select(*keep, F.lit("").alias(lang), F.lit(0.0).alias(score), F.lit(True).alias(accepted)).schema
    low = "__lower_text"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            out: list[tuple[str, float, bool]] = []
            for t in b.column(low):
                data = t.as_py()
                if data is None or m is None:
                    out.append(("und", 0.0, False))
                    continue
                p = m.probabilities(data)
                k = int(p.argmax())
                out.append((m.langs[k], float(p[k]), bool(p[k] >= m.threshold)))
            made = [pa.array([x[i] for x in out], kind) for i, kind in enumerate((pa.string(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), *made], [*keep, *names])

    lettered = F.when(F.col("text").rlike(r"\p{L}"), F.lower("text").cast("binary"))
    return df.select(*keep, lettered.alias(low)).mapInArrow(run, schema)


def accepted_documents(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose language the model accepts, with all their columns. The model
    learns from the labelled rows of ``docs`` itself."""
    names = ("__lang_pred", "__lang_score", "__lang_accepted")
    model = fit_languages(docs, F.lit(True))
    return with_language(spark, docs, model, names).where(names[2]).drop(*names)


def op6_lang_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    model = fit_languages(docs, fold("doc_id", 4) != 2)
    rows = docs.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "text")
    return with_language(spark, rows, model).drop("text")
