"""Personal data by fixed patterns and a character-level bidirectional LSTM with CRF transitions.

The patterns give the base spans. They also label a bounded, hash-chosen sample of texts
(``SAMPLE_DOCS`` texts of up to ``SAMPLE_CHARS`` code points), on which a small tagger is trained in numpy:
character embeddings, an LSTM in each direction, a linear layer, and a linear-chain CRF over begin and inside tags of
the four kinds. The tagger finds spans that look like the kinds but that the patterns miss.

A text is tagged in windows of ``WINDOW`` characters, each half a window on from the one before. Every window is
decoded by Viterbi. The windows of a text are then reconciled: each character takes its tag from the
window in which it lies nearest to the middle, and spans are read from the joined tag sequence of the whole
text, so a span may run across windows. A tagged span is added when it touches no base span and satisfies
its kind's plain test (``_plausible``), which asks for a digit or an ``@``. Windows without one
of those in reach can add nothing, and are not run; that changes no result.

Defined results: null texts count as empty and have no spans; without any base span in the sample no model is
trained and only base spans are returned; very long texts are read whole, window by window; repeated rows give
repeated result rows; other columns are ignored. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm.common import documents, whole_text

#: The kinds in report order.
KINDS = ("email", "ip", "card", "phone")
SAMPLE_DOCS, SAMPLE_CHARS, SAMPLE_WINDOWS = 300, 20_000, 512
WINDOW, HALF, QUARTER = 128, 64, 32
CHARS, EMBED, HIDDEN = 131, 16, 24
EPOCHS, BATCH, RATE, SEED = 8, 64, 0.02, 42
_PAD, _LETTER, _OTHER = 0, 128, 129
TAGS = 1 + 2 * len(KINDS)            # 0: outside, 2k+1: begins kind k, 2k+2: inside kind k
_RUN = 512

# The base patterns. The look-behinds only skip starts that cannot match, so that long
# runs of digits take linear time.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_TRIGGER = re.compile("[0-9@]")
#: Characters that an added span of a kind may have.
_NUMBERS = {1: re.compile(r"[0-9. ]+"), 2: re.compile(r"[0-9 ./-]+"), 3: re.compile(r"\+?[0-9 ()./-]+")}

Span = tuple[int, int, int]           # kind, start, end


# ------------------------------------------------------------------ base spans

def _emails(text: str) -> Iterator[tuple[int, int]]:
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def _digits(s: str) -> str:
    return re.sub("[^0-9]", "", s)


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """The spans of the fixed patterns, by kind, then start."""
    if not _TRIGGER.search(text):
        return []
    found: list[Span] = [(0, a, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            found.append((1, *m.span()))
    for m in _CARD.finditer(text):
        if 16 <= len(d := _digits(m[0])) <= 19 and _luhn(d):
            found.append((2, *m.span()))
    for m in _PHONE.finditer(text):
        if 8 <= len(_digits(m[0])) <= 15:
            found.append((3, *m.span()))
    return found


# ------------------------------------------------------------------ the tagger

def char_ids(text: str) -> np.ndarray:
    """A number for each code point: ASCII as it is, other letters alike, the rest alike."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    ids = np.minimum(codes, 127).astype(np.int64) + 1
    high = np.flatnonzero(codes > 127)
    if len(high):
        kinds, back = np.unique(codes[high], return_inverse=True)
        ids[high] = np.array([_LETTER if chr(c).isalpha() else _OTHER for c in kinds])[back] + 1
    return ids


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + top.squeeze(axis)


def _allowed() -> np.ndarray:
    """allowed[a, b]: tag b may follow tag a. An inside tag follows its kind's begin or inside tag."""
    ok = np.ones((TAGS, TAGS), bool)
    for k in range(len(KINDS)):
        ok[:, 2 * k + 2] = False
        ok[[2 * k + 1, 2 * k + 2], 2 * k + 2] = True
    return ok


@dataclass
class Tagger:
    p: dict[str, np.ndarray]

    @classmethod
    def fresh(cls, rng: np.random.Generator) -> Tagger:
        p = {"emb": rng.normal(0, 0.3, (CHARS, EMBED))}
        for d in "fb":
            p |= {f"wx{d}": rng.normal(0, EMBED ** -0.5, (EMBED, 4 * HIDDEN)),
                  f"wh{d}": rng.normal(0, HIDDEN ** -0.5, (HIDDEN, 4 * HIDDEN)),
                  f"b{d}": np.r_[np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)]}
        p |= {"out": rng.normal(0, HIDDEN ** -0.5, (2 * HIDDEN, TAGS)), "bias": np.zeros(TAGS), "trans": np.zeros((TAGS, TAGS))}
        return cls({k: v.astype(np.float32) for k, v in p.items()})

    def _lstm(self, x: np.ndarray, d: str, trace: list | None = None) -> np.ndarray:
        """Hidden states (steps, rows, HIDDEN) of inputs (steps, rows, EMBED) in one direction."""
        steps, rows, _ = x.shape
        pre = x @ self.p[f"wx{d}"] + self.p[f"b{d}"]
        h = c = np.zeros((rows, HIDDEN), np.float32)
        out = np.empty((steps, rows, HIDDEN), np.float32)
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            z = pre[t] + h @ self.p[f"wh{d}"]
            gates = _sigmoid(z[:, :3 * HIDDEN])
            i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN:2 * HIDDEN], gates[:, 2 * HIDDEN:]
            g = np.tanh(z[:, 3 * HIDDEN:])
            before, prev = c, h
            c = f * c + i * g
            s = np.tanh(c)
            h = o * s
            out[t] = h
            if trace is not None:
                trace.append((t, i, f, o, g, s, before, prev))
        return out

    def emissions(self, ids: np.ndarray) -> np.ndarray:
        """Tag scores (steps, rows, TAGS) of windows (rows, steps)."""
        x = self.p["emb"][ids.T]
        return np.concatenate([self._lstm(x, "f"), self._lstm(x, "b")], axis=2) @ self.p["out"] + self.p["bias"]

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The best tag sequence of each window, by Viterbi over the allowed transitions."""
        e = self.emissions(ids)
        ok = _allowed()
        trans = np.where(ok, self.p["trans"], -1e4).astype(np.float32)
        score = e[0] + np.where(ok[0], 0, -1e4)
        back = np.empty(e.shape, np.int8)
        for t in range(1, len(e)):
            ways = score[:, :, None] + trans
            back[t] = ways.argmax(axis=1)
            score = ways.max(axis=1) + e[t]
        tags = np.empty(ids.shape, np.int8)
        at = score.argmax(axis=1)
        rows = np.arange(len(ids))
        for t in range(len(e) - 1, -1, -1):
            tags[:, t] = at
            at = back[t][rows, at] if t else at
        return tags

    def gradients(self, ids: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log-likelihood of the tag sequences, and its gradients."""
        rows, steps = ids.shape
        x, y = self.p["emb"][ids.T], tags.T
        traces: dict[str, list] = {"f": [], "b": []}
        h = np.concatenate([self._lstm(x, d, traces[d]) for d in "fb"], axis=2)
        e = (h @ self.p["out"] + self.p["bias"]).astype(np.float64)
        trans = self.p["trans"].astype(np.float64)
        ahead, behind = np.empty_like(e), np.zeros_like(e)
        ahead[0] = e[0]
        for t in range(1, steps):
            ahead[t] = _logsum(ahead[t - 1][:, :, None] + trans, 1) + e[t]
        for t in range(steps - 2, -1, -1):
            behind[t] = _logsum(trans + (e[t + 1] + behind[t + 1])[:, None, :], 2)
        z = _logsum(ahead[-1], 1)
        de = np.exp(ahead + behind - z[:, None])
        dtrans = np.zeros_like(trans)
        for t in range(1, steps):
            pair = ahead[t - 1][:, :, None] + trans + (e[t] + behind[t])[:, None, :] - z[:, None, None]
            dtrans += np.exp(pair).sum(axis=0)
        np.subtract.at(dtrans, (y[:-1].ravel(), y[1:].ravel()), 1)
        r = np.arange(rows)
        true = e[0][r, y[0]] + sum(trans[y[t - 1], y[t]] + e[t][r, y[t]] for t in range(1, steps))
        for t in range(steps):
            de[t][r, y[t]] -= 1
        de = (de / rows).astype(np.float32)
        g = {"trans": (dtrans / rows).astype(np.float32), "bias": de.sum(axis=(0, 1)),
             "out": h.reshape(-1, 2 * HIDDEN).T @ de.reshape(-1, TAGS)}
        dh_all = de @ self.p["out"].T
        dx = np.zeros_like(x)
        for n, d in enumerate("fb"):
            dz_all = np.zeros((steps, rows, 4 * HIDDEN), np.float32)
            dh = dc = np.zeros((rows, HIDDEN), np.float32)
            dwh = np.zeros_like(self.p[f"wh{d}"])
            for t, i, f, o, gg, s, before, prev in reversed(traces[d]):
                dh = dh + dh_all[t][:, n * HIDDEN:(n + 1) * HIDDEN]
                dc = dc + dh * o * (1 - s * s)
                dz = np.concatenate([dc * gg * i * (1 - i), dc * before * f * (1 - f), dh * s * o * (1 - o), dc * i * (1 - gg * gg)], axis=1)
                dz_all[t] = dz
                dwh += prev.T @ dz
                dh, dc = dz @ self.p[f"wh{d}"].T, dc * f
            flat = dz_all.reshape(-1, 4 * HIDDEN)
            g |= {f"wh{d}": dwh, f"wx{d}": x.reshape(-1, EMBED).T @ flat, f"b{d}": flat.sum(axis=0)}
            dx += dz_all @ self.p[f"wx{d}"].T
        g["emb"] = np.zeros_like(self.p["emb"])
        np.add.at(g["emb"], ids.T.ravel(), dx.reshape(-1, EMBED))
        return float((z - true).mean()), g


def _tag_row(text_len: int, spans: list[Span]) -> np.ndarray:
    """Tags of a text's characters; where kinds overlap the one listed first keeps its place."""
    tags = np.zeros(text_len, np.int64)
    for kind, a, b in sorted(spans):
        if not tags[a:b].any():
            tags[a], tags[a + 1:b] = 2 * kind + 1, 2 * kind + 2
    return tags


def _windows(ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
    padded = np.r_[np.full(QUARTER, _PAD), ids, np.full(WINDOW, _PAD)]
    return padded[starts[:, None] + np.arange(WINDOW)]


def reach(text: str) -> np.ndarray:
    """Numbers of the half-window blocks of a text that hold a digit or an ``@``, or lie beside one."""
    n = -(-len(text) // HALF)
    hot = np.zeros(n + 2, bool)
    at = np.fromiter((m.start() for m in _TRIGGER.finditer(text)), np.int64)
    hot[at // HALF + 1] = True
    return np.flatnonzero(hot[:-2] | hot[1:-1] | hot[2:])


def train_tagger(texts: list[str]) -> Tagger | None:
    """A tagger for the base spans of ``texts``; None when they have none. Block b of a text is
    the middle half of the window from b*HALF - QUARTER on."""
    rng = np.random.default_rng(SEED)
    xs, ys = [], []
    for text in texts:
        blocks = reach(text)
        if len(blocks):
            tags = np.r_[np.zeros(QUARTER, np.int64), _tag_row(len(text), base_spans(text)), np.zeros(WINDOW, np.int64)]
            xs.append(_windows(char_ids(text), blocks * HALF))
            ys.append(tags[(blocks * HALF)[:, None] + np.arange(WINDOW)])
    if not xs:
        return None
    x, y = np.concatenate(xs), np.concatenate(ys)
    # a window that begins inside a span shows the rest of it as a begun one
    cut = np.flatnonzero((y[:, 0] > 0) & (y[:, 0] % 2 == 0))
    y[cut, 0] -= 1
    full, plain = np.flatnonzero(y.any(axis=1)), np.flatnonzero(~y.any(axis=1))
    if not len(full):
        return None
    pick = np.r_[rng.permutation(full)[:SAMPLE_WINDOWS * 3 // 4], rng.permutation(plain)[:SAMPLE_WINDOWS // 4]]
    x, y = x[pick], y[pick]
    model = Tagger.fresh(rng)
    first = {k: np.zeros_like(v) for k, v in model.p.items()}
    second = {k: np.zeros_like(v) for k, v in model.p.items()}
    steps = EPOCHS * -(-len(x) // BATCH)
    done = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(x))
        for lo in range(0, len(x), BATCH):
            now = order[lo:lo + BATCH]
            _, grad = model.gradients(x[now], y[now])
            norm = float(np.sqrt(sum((g * g).sum() for g in grad.values())))
            done += 1
            rate = RATE * (1 - done / (steps + 1))
            for k, g in grad.items():
                g = g * np.float32(min(1.0, 5.0 / (norm + 1e-9)))
                first[k] = np.float32(0.9) * first[k] + np.float32(0.1) * g
                second[k] = np.float32(0.99) * second[k] + np.float32(0.01) * g * g
                step = first[k] / (1 - 0.9 ** done) / (np.sqrt(second[k] / (1 - 0.99 ** done)) + 1e-8)
                model.p[k] -= (rate * step).astype(np.float32)
    return model


# ------------------------------------------------------------------ reconciliation

def _plausible(kind: int, text: str, a: int, b: int) -> bool:
    """Whether a tagged span may be its kind at all: whole words, the kind's characters, its digits."""
    s = text[a:b]
    if s != s.strip() or text[a - 1:a].isalnum() or text[b:b + 1].isalnum():
        return False
    if kind == 0:
        return "@" in s[1:-1] and any(c.isalpha() for c in s.partition("@")[2])
    if not _NUMBERS[kind].fullmatch(s):
        return False
    digits = _digits(s)
    if kind == 1:
        return s.count(".") == 3
    return 13 <= len(digits) <= 19 and _luhn(digits) if kind == 2 else 8 <= len(digits) <= 15


def added_spans(text: str, blocks: np.ndarray, tags: np.ndarray, base: list[Span]) -> list[Span]:
    """Spans of the joined tags: block i of ``blocks`` has the tags of its window's middle half."""
    joined = np.zeros((-(-len(text) // HALF)) * HALF, np.int8)
    joined.reshape(-1, HALF)[blocks] = tags[:, QUARTER:QUARTER + HALF]
    joined = joined[:len(text)]
    taken = np.zeros(len(text) + 1, bool)
    for _, a, b in base:
        taken[a:b] = True
    kind = (joined.astype(np.int64) + 1) // 2
    starts = (kind > 0) & ((joined % 2 == 1) | (np.r_[0, kind[:-1]] != kind))
    found = []
    for a in np.flatnonzero(starts).tolist():
        k, b = int(kind[a]), a + 1
        while b < len(text) and kind[b] == k and not starts[b]:
            b += 1
        if not taken[a:b].any() and _plausible(k - 1, text, a, b):
            found.append((k - 1, a, b))
    return found


def find_spans(texts: list[str], model: Tagger | None) -> list[tuple[list[Span], list[Span]]]:
    """(base spans, added spans) of each text; the windows of all texts are decoded together."""
    base = [base_spans(t) for t in texts]
    extra: list[list[Span]] = [[] for _ in texts]
    if model is not None:
        blocks = [reach(t) if _TRIGGER.search(t) else np.empty(0, np.int64) for t in texts]
        group: list[int] = []
        room = 0

        def finish() -> None:
            if group:
                x = np.concatenate([_windows(char_ids(texts[i]), blocks[i] * HALF) for i in group])
                tags = np.concatenate([model.decode(x[lo:lo + _RUN]) for lo in range(0, len(x), _RUN)])
                for i, part in zip(group, np.split(tags, np.cumsum([len(blocks[i]) for i in group])[:-1])):
                    extra[i] = added_spans(texts[i], blocks[i], part, base[i])

        for i, b in enumerate(blocks):
            if len(b):
                group.append(i)
                room += len(b)
                if room >= _RUN:
                    finish()
                    group, room = [], 0
        finish()
    return list(zip(base, extra))


# ------------------------------------------------------------------ frames

def fit_tagger(docs: DataFrame) -> Tagger | None:
    """The tagger of a bounded sample of ``docs`` (text): distinct texts with a digit or ``@``, chosen by hash.

    A share of the distinct texts that leaves some times SAMPLE_DOCS of them is taken before the limit, so what reaches the
    driver does not grow with the number of partitions.
    """
    rows = docs.select("text").where(F.col("text").rlike("[0-9@]") & (F.length("text") <= SAMPLE_CHARS))
    share = 4 * SAMPLE_DOCS / max(1, rows.select(F.xxhash64("text")).distinct().count())
    near = rows.where(F.pmod(F.xxhash64("text"), F.lit(1 << 40)) / (1 << 40) < share).distinct()
    return train_tagger([r["text"] for r in near.orderBy(F.xxhash64("text"), "text").limit(SAMPLE_DOCS).collect()])


def private_spans(spark: SparkSession, docs: DataFrame, model: Tagger | None) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): doc_id, base and added spans, each an
    array of (kind, start, end)."""
    shared = spark.sparkContext.broadcast(model)     # some thousand numbers
    span = "array<struct<kind:int,start:int,end:int>>"
    kinds = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = find_spans(b.column("text").to_pylist(), shared.value)
            cols = [pa.array([[dict(zip(("kind", "start", "end"), s)) for s in sorted(x[n])] for x in found], kinds) for n in (0, 1)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *cols], ["doc_id", "base", "added"])

    rows = docs.select("doc_id", whole_text().alias("text"))
    schema = rows.select("doc_id", F.expr(f"CAST(NULL AS {span})").alias("base"), F.expr(f"CAST(NULL AS {span})").alias("added")).schema
    return rows.mapInArrow(run, schema)


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op9_pii_lstm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = private_spans(spark, docs, fit_tagger(docs))
    counts = [F.expr(f"CAST(size(filter(base, s -> s.kind = {k})) AS BIGINT) AS n_{name}") for k, name in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
                        _listed(F.concat("base", "added")).alias("spans"))
