"""Document quality from a linear-chain conditional random field over lines.

A text is cut at line ends, and every line is labelled good or bad. The score of a label for a line sums
weights of the line itself, of the line before and of the line after, each over byte frequencies, hashed byte
trigram frequencies and a few counts of the line (`DENSE`); two labels side by side have a weight of their own. The
marginal probability of each label comes from a forward and a backward pass over the document, and the mean
probability of good, weighted by the lines' lengths in bytes, is the document's raw quality. A logistic curve fitted on held-back
documents turns it into a probability.

The weights are learned by gradient ascent in numpy on a bounded sample: up to ``SAMPLE_PER_CLASS`` distinct
labelled texts of each quality, of up to ``SAMPLE_CHARS`` code points, those with the smallest hashes. Lines first take
the quality of their document; then the lines of bad documents that the field itself finds good without its
neighbours are relabelled good, as a bad document need not be bad in every line, and the field is learned again.

Texts are read whole, in parts of bounded size; a task holds some megabytes of text at a time or the longest one.

Defined results: a null or empty text, or one of line ends only, has no line to judge and gets the share of
good ones in the sample (with add-one smoothing); without any labelled text every score is 0.5; labels other than 0
and 1, and labels without a doc_id, are not learnt from; a text with both labels is learnt as both; repeated rows are
scored each, and count once in the sample; a null doc_id counts as the empty text for the fold; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm.common import documents, fold, whole_text

BUCKETS = 1 << 15
SAMPLE_PER_CLASS, SAMPLE_CHARS = 1000, 20_000
EPOCHS, BATCH, RATE, SHRINK, SEED = 8, 16, 0.5, 1e-5, 42
THRESHOLD = 0.3
#: log of the length, no text, equal to the line before, occurred before in the document, share of words that repeat the
#: word before, whether a fifth of them does, mean word length.
DENSE = 7
#: Bytes of text that are worked on at a time. Texts of half a chunk or more are worked on alone and a segment holds
#: any other chunk, so that no text's numbers depend on its neighbours.
CHUNK, SEGMENT = 1 << 20, 1 << 21
#: Random numbers by which words are told apart, for each byte at each of 64 places.
_TELL = np.random.default_rng(SEED).integers(1, 1 << 62, (64, 256), dtype=np.int64)
_NEAR = 3                       # weights of a line for itself, for the line after it, for the line before it


# ------------------------------------------------------------------ lines

@dataclass
class Lines:
    """The lines of some texts, one after the other."""

    raw: np.ndarray             # all bytes, each text with a line end
    start: np.ndarray           # first byte of each line
    size: np.ndarray            # bytes of each line, without its end
    first: np.ndarray           # first line of each text, and the number of lines
    dense: np.ndarray

    @classmethod
    def of(cls, texts: list[bytes]) -> Lines:
        raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        ends = np.flatnonzero(raw == 10)
        start = np.r_[0, ends[:-1] + 1]
        size = ends - start
        text_ends = np.cumsum([len(t) + 1 for t in texts]) - 1
        first = np.r_[0, np.searchsorted(ends, text_ends) + 1]
        text = np.repeat(np.arange(len(texts)), np.diff(first))
        data = raw.tobytes()
        digest = np.array([xxhash.xxh64_intdigest(data[a:a + n]) for a, n in zip(start.tolist(), size.tolist())], np.uint64)
        digest ^= text.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        seen = np.ones(len(start), bool)
        seen[np.unique(digest, return_index=True)[1]] = False
        again = np.r_[False, (digest[1:] == digest[:-1])]
        some = size > 0
        dense = np.stack([np.log1p(size) / 8, ~some, again & some, seen & some], axis=1).astype(np.float32)
        made = cls(raw, start, size, first, dense)
        made.dense = np.concatenate([dense, made._words()], axis=1)
        return made

    def _words(self) -> np.ndarray:
        """For each line the share of words that repeat the word before, whether that is a fifth, and the mean length."""
        words, repeats = np.zeros(len(self.start)), np.zeros(len(self.start))
        for at in range(0, len(self.raw), SEGMENT):
            part = self.raw[at:at + SEGMENT]
            inner = (part != 32) & ((part < 9) | (part > 13))
            before = np.r_[False, inner[:-1]]
            begin, end = np.flatnonzero(inner & ~before), np.flatnonzero(before & ~inner)
            if not len(begin):
                continue
            end = np.r_[end, len(part)] if len(end) < len(begin) else end
            place = np.arange(len(part)) - np.repeat(np.r_[0, begin], np.diff(np.r_[0, begin, len(part)]))
            told = np.where(inner, _TELL[place & 63, part], 0)
            name = np.add.reduceat(told, begin) + (end - begin)
            line = np.searchsorted(self.start, begin + at, side="right") - 1
            same = np.r_[False, (name[1:] == name[:-1]) & (line[1:] == line[:-1])]
            words += np.bincount(line, minlength=len(words))
            repeats += np.bincount(line, same, len(words))
        share = repeats / np.maximum(1, words - 1)
        return np.stack([share, share >= 0.2, np.minimum(self.size / np.maximum(1, words) / 16, 2)], axis=1).astype(np.float32)

    def segments(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Parts of the bytes: line of each byte's part start, byte values, trigram buckets, and whether the trigram
        lies inside one line. Line ends count for nothing."""
        for at in range(0, len(self.raw), SEGMENT):
            part = self.raw[at:at + SEGMENT + 2]
            n = min(SEGMENT, len(self.raw) - at)
            part = np.pad(part, (0, n + 2 - len(part)), constant_values=10).astype(np.uint32)
            key = (part[:-2] << np.uint32(16)) | (part[1:-1] << np.uint32(8)) | part[2:]
            bucket = ((key * np.uint32(2654435761)) >> np.uint32(32 - BUCKETS.bit_length() + 1)).astype(np.int64)
            end = part == 10
            inside = ~(end[:-2] | end[1:-1] | end[2:])
            lo = int(np.searchsorted(self.start, at, side="right")) - 1
            hi = int(np.searchsorted(self.start, at + n, side="left"))
            cuts = np.maximum(self.start[lo:hi] - at, 0)
            yield np.arange(lo, hi), cuts, np.where(end[:-2], 256, part[:-2]).astype(np.int64), np.where(inside, bucket, BUCKETS)

    def grams(self) -> np.ndarray:
        return np.maximum(1, self.size - 2)


def _shifted(x: np.ndarray, lines: Lines, by: int) -> np.ndarray:
    """Each line's value taken from the line ``by`` places before it in the same text, else 0."""
    out = np.zeros_like(x)
    if by > 0:
        out[by:] = x[:-by]
        out[lines.first[:-1]] = 0
    else:
        out[:by] = x[-by:]
        out[lines.first[1:] - 1] = 0
    return out


# ------------------------------------------------------------------ the field

@dataclass
class LineField:
    """Weights of the field. The last rows of ``trigrams`` and ``bytes`` stay zero: what lies outside of lines."""

    trigrams: np.ndarray = field(default_factory=lambda: np.zeros((BUCKETS + 1, _NEAR), np.float32))
    bytes: np.ndarray = field(default_factory=lambda: np.zeros((257, _NEAR), np.float32))
    dense: np.ndarray = field(default_factory=lambda: np.zeros((DENSE, _NEAR), np.float32))
    bias: np.ndarray = field(default_factory=lambda: np.zeros(1, np.float32))
    pairs: np.ndarray = field(default_factory=lambda: np.zeros((2, 2), np.float32))
    curve: tuple[float, float] = (1.0, 0.0)
    share: float = 0.5

    def evidence(self, lines: Lines) -> np.ndarray:
        """The score of good less that of bad for each line, without the pairs."""
        sums = np.zeros((len(lines.start), _NEAR))
        by_byte = np.zeros_like(sums)
        for at, cuts, value, bucket in lines.segments():
            sums[at] += np.add.reduceat(self.trigrams[bucket], cuts, axis=0, dtype=np.float64)
            by_byte[at] += np.add.reduceat(self.bytes[value], cuts, axis=0, dtype=np.float64)
        v = sums / lines.grams()[:, None] + by_byte / np.maximum(1, lines.size)[:, None] + lines.dense @ self.dense
        return v[:, 0] + _shifted(v[:, 1], lines, 1) + _shifted(v[:, 2], lines, -1) + self.bias[0]

    def messages(self, evidence: np.ndarray, lines: Lines) -> tuple[np.ndarray, np.ndarray]:
        """Log odds of good from the lines up to each one, and from the lines after each one. All texts are
        passed through side by side, the longest first, so that those still running lie together."""
        t = self.pairs.astype(np.float64)
        count = np.diff(lines.first)
        order = np.argsort(-count, kind="stable")
        count, at = count[order], lines.first[:-1][order]
        until = lines.first[1:][order] - 1
        forward, backward = np.zeros(len(evidence)), np.zeros(len(evidence))
        forward[at] = evidence[at]
        running = len(count)
        for k in range(1, int(count[0]) if len(count) else 0):
            while count[running - 1] <= k:
                running -= 1
            i = at[:running] + k
            r = forward[i - 1]
            forward[i] = evidence[i] + np.logaddexp(r + t[1, 1], t[0, 1]) - np.logaddexp(r + t[1, 0], t[0, 0])
            j = until[:running] - k
            s = evidence[j + 1] + backward[j + 1]
            backward[j] = np.logaddexp(s + t[1, 1], t[1, 0]) - np.logaddexp(s + t[0, 1], t[0, 0])
        return forward, backward

    def marginals(self, lines: Lines) -> np.ndarray:
        """Probability of good for each line."""
        return _sigmoid(np.add(*self.messages(self.evidence(lines), lines)))

    def raw_quality(self, lines: Lines) -> np.ndarray:
        """Mean probability of good by length for each text; nan for one without any."""
        weight = np.add.reduceat(lines.size.astype(np.float64), lines.first[:-1])
        good = np.add.reduceat(self.marginals(lines) * lines.size, lines.first[:-1])
        return np.divide(good, weight, out=np.full(len(weight), np.nan), where=weight > 0)

    def scores(self, texts: list[bytes]) -> np.ndarray:
        raw = self.raw_quality(Lines.of(texts))
        a, b = self.curve
        return np.where(np.isnan(raw), self.share, _sigmoid(a * _logit(np.nan_to_num(raw, nan=0.5)) + b))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return np.exp(-np.logaddexp(0.0, -x))


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p) - np.log1p(-p)


# ------------------------------------------------------------------ learning

def gradients(model: LineField, lines: Lines, good: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Gradient of the log likelihood of the lines' labels, and the marginals."""
    evidence = model.evidence(lines)
    forward, backward = model.messages(evidence, lines)
    p = _sigmoid(forward + backward)
    g = good - p
    near = np.stack([g, _shifted(g, lines, -1), _shifted(g, lines, 1)], axis=1)
    out = {"trigrams": np.zeros((BUCKETS + 1, _NEAR)), "bytes": np.zeros((257, _NEAR)),
           "dense": lines.dense.T.astype(np.float64) @ near, "bias": np.array([g.sum()])}
    per_gram, per_byte = near / lines.grams()[:, None], near / np.maximum(1, lines.size)[:, None]
    for at, cuts, value, bucket in lines.segments():
        line = np.repeat(at, np.diff(np.r_[cuts, len(value)]))
        for c in range(_NEAR):
            out["trigrams"][:, c] += np.bincount(bucket, per_gram[line, c], BUCKETS + 1)
            out["bytes"][:, c] += np.bincount(value, per_byte[line, c], 257)
    out["trigrams"][BUCKETS] = 0
    out["bytes"][256] = 0
    # neighbouring labels: seen less expected
    later = np.ones(len(p), bool)
    later[lines.first[:-1]] = False
    j = np.flatnonzero(later)
    pairs = np.zeros((2, 2))
    if len(j):
        t, r, s = model.pairs.astype(np.float64), forward[j - 1], evidence[j] + backward[j]
        joint = np.stack([np.full(len(j), t[0, 0]), t[0, 1] + s, t[1, 0] + r, t[1, 1] + r + s], axis=1)
        joint = np.exp(joint - joint.max(axis=1, keepdims=True))
        joint /= joint.sum(axis=1, keepdims=True)
        a, b = good[j - 1], good[j]
        seen = np.stack([(1 - a) * (1 - b), (1 - a) * b, a * (1 - b), a * b], axis=1)
        pairs = (seen - joint).sum(axis=0).reshape(2, 2)
    out["pairs"] = pairs
    return out, p


def _learned(batches: list[tuple[Lines, np.ndarray]]) -> LineField:
    """Gradient ascent with a step size for each weight that falls with its past gradients."""
    model, rng = LineField(), np.random.default_rng(SEED)
    past = {n: np.full(getattr(model, n).shape, 1e-8) for n in ("trigrams", "bytes", "dense", "bias", "pairs")}
    for _ in range(EPOCHS):
        for i in rng.permutation(len(batches)):
            lines, good = batches[i]
            found, _ = gradients(model, lines, good)
            for name, g in found.items():
                w = getattr(model, name)
                g = g / len(good) - SHRINK * w
                past[name] += g * g
                w += (RATE * g / np.sqrt(past[name])).astype(np.float32)
    return model


def fit_field(texts: list[bytes], quality: list[int]) -> LineField | None:
    """The field of labelled texts; a quarter of them is held back for the curve."""
    if not texts:
        return None
    y = np.array(quality, np.float64)
    rng = np.random.default_rng(SEED)
    held = rng.random(len(y)) < 0.25
    if len(set(y[~held])) < len(set(y)) or not held.any():
        held[:] = False
    fit = rng.permutation(np.flatnonzero(~held))
    batches = []
    for at in range(0, len(fit), BATCH):
        some = fit[at:at + BATCH]
        lines = Lines.of([texts[i] for i in some])
        batches.append((lines, np.repeat(y[some], np.diff(lines.first))))
    first = _learned(batches)
    relabelled = []
    for lines, owner in batches:
        alone = first.evidence(lines)
        good = np.where((owner == 0) & (alone > 0), 1.0, owner)
        worst = np.minimum.reduceat(np.where(lines.size > 0, alone, np.inf), lines.first[:-1])
        worst = np.repeat(worst, np.diff(lines.first))
        relabelled.append((lines, np.where((owner == 0) & (alone <= worst), 0.0, good)))      # a bad text has a bad line
    model = _learned(relabelled)
    check = np.flatnonzero(held) if held.any() else fit
    model.curve = _curve(_logit(np.nan_to_num(np.concatenate(
        [model.raw_quality(Lines.of([texts[i] for i in check[at:at + BATCH]])) for at in range(0, len(check), BATCH)]), nan=0.5)), y[check])
    model.share = float((y.sum() + 1) / (len(y) + 2))
    return model


def _curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve of y over x by Newton's method; targets are smoothed as in Platt scaling."""
    n1, n0 = y.sum(), (1 - y).sum()
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, 0.0
    for _ in range(100):
        p = _sigmoid(a * x + b)
        g = np.array([((target - p) * x).sum() - 1e-3 * (a - 1), (target - p).sum()])
        w = p * (1 - p)
        h = np.array([[(w * x * x).sum() + 1e-3, (w * x).sum()], [(w * x).sum(), w.sum() + 1e-6]])
        step = np.clip(np.linalg.solve(h, g), -1, 1)
        a, b = a + step[0], b + step[1]
        if np.abs(step).max() < 1e-9:
            break
    return (float(a), float(b)) if a > 0 else (1.0, 0.0)


# ------------------------------------------------------------------ frames

def labelled_sample(docs: DataFrame, labels: DataFrame, learn: Column) -> tuple[list[bytes], list[int]]:
    """Up to SAMPLE_PER_CLASS distinct texts of each quality among the rows of ``docs`` (doc_id, text) that satisfy
    ``learn``. Only hashes are joined with the labels; the chosen texts are then looked up."""
    place = F.xxhash64("text").alias("place")
    rows = docs.where(learn & F.col("doc_id").isNotNull() & F.col("text").isNotNull() & (F.length("text") <= SAMPLE_CHARS))
    marks = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").select("doc_id", F.col("quality").cast("int").alias("quality")).distinct()
    keys = rows.select("doc_id", place).join(marks, "doc_id").groupBy("quality", "place").agg(F.min("doc_id").alias("doc_id"))
    chosen = []
    for q in (0, 1):
        chosen += keys.where(F.col("quality") == q).orderBy("place").limit(SAMPLE_PER_CLASS).collect()
    if not chosen:
        return [], []
    spark = docs.sparkSession
    wanted = spark.createDataFrame([(r["doc_id"], r["place"], r["quality"]) for r in chosen],
                                   f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, place long, quality int")
    texts = rows.select("doc_id", place, "text").join(F.broadcast(wanted), ["doc_id", "place"])      # 2 x SAMPLE_PER_CLASS rows at most
    got = texts.select("place", "quality", "text").distinct().orderBy("place", "quality", "text").collect()
    return [r["text"].encode() for r in got], [r["quality"] for r in got]


def with_quality(spark: SparkSession, df: DataFrame, model: LineField | None, name: str = "score") -> DataFrame:
    """``df`` (text) without its text and with the probability that it is good."""
    shared = spark.sparkContext.broadcast(model)         # a fixed number of weights
    keep = [c for c in df.columns if c not in ("text", name)]
    schema = df.select(*keep, F.lit(0.0).alias(name)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            out = np.full(b.num_rows, 0.5)
            if m is not None and b.num_rows:
                texts = b.column("text").cast(pa.binary())
                size = np.asarray(pc.binary_length(texts)).astype(np.int64)
                alone = size >= CHUNK // 2
                window = (np.cumsum(size) - size) // (CHUNK // 2)
                cuts = np.flatnonzero(np.r_[True, (np.diff(window) > 0) | alone[1:] | alone[:-1]])
                for lo, hi in zip(cuts, np.r_[cuts[1:], b.num_rows]):
                    out[lo:hi] = m.scores(texts[lo:hi].to_pylist())
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(out)], [*keep, name])

    return df.select(*keep, whole_text().alias("text")).mapInArrow(run, schema)


def op13_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    held_out = fold("doc_id", 5) == 0
    model = fit_field(*labelled_sample(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality"), ~held_out))
    scored = with_quality(spark, docs.select("doc_id", held_out.alias("held_out"), "text"), model)
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
