"""SentencePiece encoding and decoding on the tokenizers library.

The model file's protobuf is read field by field, and its parts are rebuilt as a tokenizers pipeline:
the normaliser (compiled character map, white-space rules, the metaspace marker), the unigram scores or
the BPE merges that the piece scores order, and byte fallback. Texts are encoded and decoded in
multithreaded batches, and the ids are those of the rebuilt pipeline. They are checked against the sentencepiece library:
where no piece goes on past a word's end and the normaliser only marks spaces, a text's ids are its words' ids in a row, so each
distinct word is checked once, when a task meets it first; other models are checked by every whole
text. A text with a word that differs (runs of pieces with equal scores) gets the library's ids and ``parity`` false, so
the ids are always those of the model and the replaced rows can be counted.

Defined results: null and empty texts have no ids and decode to the empty text; a text is encoded whole;
control symbols inside a text are ordinary characters; repeated rows are encoded each; input columns of the
names ``ids``, ``n_ids``, ``parity``, ``decoded`` and ``round_trip`` are replaced, others carried unchanged.
"""

from __future__ import annotations

import os
import re
import struct
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import chain, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.llm.common import documents

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
#: Threads of a task's tokenizer, and code points encoded at a time.
THREADS, BATCH_CHARS = 2, 1 << 18
#: Words that are encoded as one text, and words whose ids a task keeps.
WORDS_PER_TEXT, MAX_WORDS = 512, 300_000
MARK = "▁"
_ANCHOR = "a"
_WORDS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


# ------------------------------------------------------------------ the model file

def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of each field of a protobuf message; nested messages and strings as bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(kind)
        if size is None:
            if kind != 2:
                raise ValueError(f"wire type {kind} at byte {at}")
            size = varint()
        yield key >> 3, data[at:at + size]
        at += size


@dataclass
class PieceModel:
    pieces: list[str] = field(default_factory=list)
    scores: list[float] = field(default_factory=list)
    types: list[int] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    suffix_mark: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    squeeze: bool = True
    escape: bool = True

    @property
    def unk_id(self) -> int:
        return self.types.index(UNKNOWN)


def parse_model(data: bytes) -> PieceModel:
    """Field numbers are those of the public sentencepiece model format."""
    m = PieceModel()
    for number, value in _fields(data):
        if number == 1:
            piece, score, kind = "", 0.0, NORMAL
            for n, v in _fields(value):
                if n == 1:
                    piece = v.decode()
                elif n == 2:
                    score = struct.unpack("<f", v)[0]
                elif n == 3:
                    kind = v
            m.pieces.append(piece)
            m.scores.append(score)
            m.types.append(kind)
        elif number == 2:
            spec = dict(_fields(value))
            m.kind = spec.get(3, UNIGRAM)
            m.suffix_mark = bool(spec.get(24, 0))
            m.byte_fallback = bool(spec.get(35, 0))
        elif number == 3:
            spec = dict(_fields(value))
            m.charsmap = spec.get(2, b"")
            m.dummy_prefix, m.squeeze, m.escape = (bool(spec.get(n, 1)) for n in (3, 4, 5))
    return m


def merges(m: PieceModel) -> list[tuple[str, str]]:
    """Every way to put a piece together from two others, the best scored pieces first."""
    rank = {p: i for i, (p, t) in enumerate(zip(m.pieces, m.types)) if t == NORMAL}
    found = []
    for p, i in rank.items():
        for cut in range(1, len(p)):
            if p[:cut] in rank and p[cut:] in rank:
                found.append((-m.scores[i], i, rank[p[:cut]], rank[p[cut:]]))
    return [(m.pieces[a], m.pieces[b]) for _, _, a, b in sorted(found)]


def build_tokenizer(m: PieceModel):
    """The model as a tokenizers pipeline."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

    if m.kind not in (UNIGRAM, BPE) or m.suffix_mark or not m.escape:
        raise ValueError("only unigram and BPE models with a leading metaspace marker are supported")
    if m.kind == BPE:
        vocab = {p: i for i, p in enumerate(m.pieces)}
        model = models.BPE(vocab=vocab, merges=merges(m), unk_token=m.pieces[m.unk_id], fuse_unk=True,
                           byte_fallback=m.byte_fallback)
    else:
        model = models.Unigram(list(zip(m.pieces, m.scores)), unk_id=m.unk_id, byte_fallback=m.byte_fallback)
    tok = Tokenizer(model)
    steps = [normalizers.Precompiled(m.charsmap)] if m.charsmap else []
    if m.squeeze:
        steps += [normalizers.Replace(Regex("^ +| +$"), ""), normalizers.Replace(Regex(" {2,}"), " ")]
    steps += [normalizers.Prepend(MARK)] if m.dummy_prefix else []
    tok.normalizer = normalizers.Sequence([*steps, normalizers.Replace(" ", MARK)])
    if not any(re.search(f"[^{MARK}]{MARK}", p) for p in m.pieces):
        # no piece goes on past a word's end, so words can be encoded one by one
        tok.pre_tokenizer = pre_tokenizers.Split(Regex(_WORDS.pattern), "isolated")
    back = [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
    tok.decoder = decoders.Sequence(back + ([decoders.Strip(" ", 1, 0)] if m.dummy_prefix else []))
    return tok


class Grown:
    """An array that is added to. Its room doubles, so what it holds is seldom copied."""

    def __init__(self, kind: type) -> None:
        self.room, self.n = np.empty(1024, kind), 0

    def add(self, more: np.ndarray) -> None:
        n = self.n + len(more)
        if n > len(self.room):
            room = np.empty(max(n, 2 * len(self.room)), self.room.dtype)
            room[:self.n] = self.room[:self.n]
            self.room = room
        self.room[self.n:n] = more
        self.n = n


class Codec:
    """The rebuilt pipeline and the sentencepiece model of one model file.

    Where no piece goes on past a word's end, distinct words are encoded once, many words to a text and
    many texts to a multithreaded batch, and a bounded table keeps their ids; a text's ids are then those of its
    words in a row. Models with such pieces encode whole texts.
    """

    def __init__(self, data: bytes) -> None:
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "true"
        os.environ.setdefault("RAYON_NUM_THREADS", str(THREADS))
        self.model = parse_model(data)
        self.tok = build_tokenizer(self.model)
        self.reference = sentencepiece.SentencePieceProcessor(model_proto=data)
        self.by_word = self.tok.pre_tokenizer is not None
        self.checks_words = self.by_word and not self.model.charsmap and not self.model.squeeze
        self.bare = Tokenizer(self.tok.model)
        if self.by_word:
            self.bare.pre_tokenizer = self.tok.pre_tokenizer
        self.anchor = np.array(self.bare.encode(f"{MARK}{_ANCHOR}", add_special_tokens=False).ids, np.int32)
        self._forget()
        marked = {i: p.replace(MARK, " ").encode() for i, (p, t) in enumerate(zip(self.model.pieces, self.model.types)) if t in (NORMAL, USER_DEFINED)}
        single = {i: bytes([int(p[3:5], 16)]) for i, (p, t) in enumerate(zip(self.model.pieces, self.model.types)) if t == BYTE}
        self.bytes_of = marked | single

    def _forget(self) -> None:
        self.index: dict[str, int] = {}
        self.ids, self.start, self.size, self.same = (Grown(k) for k in (np.int32, np.int64, np.int64, bool))

    def _as_library(self, groups: list[list[str]], found: list[np.ndarray]) -> list[bool]:
        """Whether the library has the same ids for the words of each group in a row. Before a word that stands alone goes
        a plain one, as the library drops a text of spaces' first marker."""
        texts, want = [], []
        for group, ids in zip(groups, found):
            text = "".join(group).replace(MARK, " ")
            if self.model.dummy_prefix and len(group) == 1:
                text, ids = _ANCHOR + text, np.concatenate([self.anchor, ids])
            elif self.model.dummy_prefix:
                text = text[1:]
            texts.append(text)
            want.append(ids)
        got = self.reference.encode(texts, num_threads=THREADS)
        return [len(g) == len(w) and g == w.tolist() for g, w in zip(got, want)]

    def _learn(self, words: list[str]) -> None:
        # a word that ends in a marker, or does not begin with one, would run into its neighbour
        joined = [w for w in words if w[0] == MARK and w[-1] != MARK]
        alone = [w for w in words if not (w[0] == MARK and w[-1] != MARK)]
        groups = [joined[i:i + WORDS_PER_TEXT] for i in range(0, len(joined), WORDS_PER_TEXT)] + [[w] for w in alone]
        found, sizes = [], []
        for group, e in zip(groups, self.bare.encode_batch(["".join(g) for g in groups], add_special_tokens=False)):
            found.append(np.array(e.ids, np.int32))
            sizes.append(np.bincount(np.array(e.word_ids, np.int64), minlength=len(group)) if len(group) > 1 else np.array([len(e.ids)]))
        same = []
        if self.checks_words:
            for group, ids, size, right in zip(groups, found, sizes, self._as_library(groups, found)):
                each = [right] * len(group)
                if not right and len(group) > 1:
                    each = self._as_library([[w] for w in group], np.split(ids, np.cumsum(size)[:-1]))
                same += each
        size = np.concatenate(sizes)
        self.start.add(self.ids.n + np.cumsum(size) - size)
        self.index.update(zip(chain.from_iterable(groups), range(self.size.n, self.size.n + len(size))))
        self.size.add(size)
        self.ids.add(np.concatenate(found))
        self.same.add(np.array(same, bool))

    def _normal(self, text: str) -> str:
        m = self.model
        if m.charsmap or m.squeeze:
            return self.tok.normalizer.normalize_str(text)
        return (MARK if m.dummy_prefix and text else "") + text.replace(" ", MARK)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids one after the other, the number of each text's, and whether its words were found as the library has them."""
        if not self.by_word:
            found = [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]
            return *flat_ids(found), np.ones(len(texts), bool)
        words = [_WORDS.findall(self._normal(t)) for t in texts]
        n = np.array([len(w) for w in words], np.int64)
        # the batch's own small table numbers its distinct words; only those are looked for in the large one. Its factory
        # must not refer to the table: such a cycle keeps a batch's words until the garbage collector happens to run
        own: defaultdict[str, int] = defaultdict(count().__next__)
        place = np.fromiter(map(own.__getitem__, chain.from_iterable(words)), np.int64, int(n.sum()))
        new = [w for w in own if w not in self.index]
        if len(self.index) + len(new) > MAX_WORDS:
            self._forget()
            new = list(own)
        if new:
            self._learn(new)
        known = np.fromiter(map(self.index.__getitem__, own), np.int64, len(own))
        size, start = self.size.room[known][place], self.start.room[known][place]
        after = np.cumsum(size)
        take = np.arange(size.sum()) + np.repeat(start - (after - size), size)
        ends = np.r_[0, after][np.cumsum(n)]
        right = np.ones(len(texts), bool)
        if self.checks_words and not (same := self.same.room[known]).all():
            right[np.repeat(np.arange(len(texts)), n)[~same[place]]] = False
        return self.ids.room[take], np.diff(np.r_[0, ends]), right

    def checked(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``encode`` with the library's ids for the texts that differ, and whether each did not."""
        ids, n, right = self.encode(texts)
        if not self.checks_words:
            flat, m = flat_ids(self.reference.encode(texts, num_threads=THREADS))
            if len(flat) == len(ids) and (n == m).all() and (flat == ids).all():
                return ids, n, right
            mine, theirs = (np.split(x, np.cumsum(k)[:-1]) for x, k in ((ids, n), (flat, m)))
            right = np.array([len(a) == len(b) and bool((a == b).all()) for a, b in zip(mine, theirs)], bool)
        if right.all():
            return ids, n, right
        parts = np.split(ids, np.cumsum(n)[:-1])
        for i in np.flatnonzero(~right):
            parts[i] = np.array(self.reference.encode(texts[i]), np.int32)
        return np.concatenate(parts), np.array([len(x) for x in parts], np.int64), right

    def decode(self, ids: list[int]) -> str:
        try:
            text = b"".join(map(self.bytes_of.__getitem__, ids)).decode()
        except (KeyError, UnicodeDecodeError):        # control pieces, or byte pieces that are no UTF-8
            return self.tok.decode(ids, skip_special_tokens=False)
        return text[1:] if self.model.dummy_prefix and text[:1] == " " else text


def flat_ids(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    n = np.array([len(x) for x in lists], np.int64)
    return np.fromiter(chain.from_iterable(lists), np.int32, int(n.sum())), n


@lru_cache(maxsize=2)
def codec(data: bytes) -> Codec:
    return Codec(data)


def encode_texts(data: bytes, texts: list[str]) -> tuple[list[list[int]], list[bool]]:
    """Ids of the texts, and whether the rebuilt pipeline found them by itself."""
    ids, n, right = codec(data).checked(texts)
    return [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] if len(texts) else [], right.tolist()


def decode_ids(data: bytes, ids: list[list[int]]) -> list[str]:
    c = codec(data)
    return [c.decode(x) for x in ids]


# ------------------------------------------------------------------ frames

def _model_bytes(path: str) -> bytes:
    with open(path, "rb") as f:   # a parameter of the job, read once on the driver and sent with the tasks
        return f.read()


def _runs(sizes: list[int]) -> Iterator[tuple[int, int]]:
    lo = n = 0
    for i, size in enumerate(sizes):
        n += size
        if n >= BATCH_CHARS or i - lo >= 4096:
            yield lo, i + 1
            lo, n = i + 1, 0
    if lo < len(sizes):
        yield lo, len(sizes)


def _lists(ids: np.ndarray, n: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(n)].astype(np.int32)), pa.array(ids))


def _column(values: list | pa.Array, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.Array):
        return values
    if not pa.types.is_list(kind):
        return pa.array(values, kind)
    return _lists(*flat_ids(values))


def _mapped(df: DataFrame, read: str, made: dict[str, tuple[T.DataType, pa.DataType]], work) -> DataFrame:
    """``df`` with the columns ``made`` from the column ``read``, some rows at a time."""
    keep = [c for c in df.columns if c not in made]
    schema = T.StructType([*(df.schema[c] for c in keep), *(T.StructField(c, t[0]) for c, t in made.items())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            values = b.column(read).to_pylist()
            for lo, hi in _runs([len(v or "") for v in values]):
                got = work(values[lo:hi])
                cols = [b.column(c).slice(lo, hi - lo) for c in keep]
                yield pa.RecordBatch.from_arrays(cols + [_column(g, t[1]) for g, t in zip(got, made.values())], [*keep, *made])

    return df.mapInArrow(run, schema)


def encoded(df: DataFrame, model_path: str = MODEL_PATH) -> DataFrame:
    """``df`` (text) with ids, n_ids and parity."""
    data = _model_bytes(model_path)

    def work(texts: list[str | None]) -> tuple:
        ids, n, parity = codec(data).checked([t or "" for t in texts])
        return _lists(ids, n), pa.array(n), pa.array(parity)

    return _mapped(df, "text", {"ids": (T.ArrayType(T.IntegerType()), pa.list_(pa.int32())),
                                "n_ids": (T.LongType(), pa.int64()), "parity": (T.BooleanType(), pa.bool_())}, work)


def decoded(df: DataFrame, model_path: str = MODEL_PATH) -> DataFrame:
    """``df`` (ids) with ``decoded``, the text of the ids."""
    data = _model_bytes(model_path)
    return _mapped(df, "ids", {"decoded": (T.StringType(), pa.string())},
                   lambda ids: (decode_ids(data, [x or [] for x in ids]),))


def coded(df: DataFrame, model_path: str = MODEL_PATH) -> DataFrame:
    """``df`` (text) with ids, n_ids, parity and ``decoded``, in one pass: one Python worker for each task."""
    data = _model_bytes(model_path)

    def work(texts: list[str | None]) -> tuple:
        ids, n, parity = codec(data).checked([t or "" for t in texts])
        flat, ends = ids.tolist(), np.cumsum(n).tolist()
        back = [codec(data).decode(flat[lo:hi]) for lo, hi in zip([0, *ends], ends)]
        return _lists(ids, n), pa.array(n), pa.array(parity), back

    return _mapped(df, "text", {"ids": (T.ArrayType(T.IntegerType()), pa.list_(pa.int32())),
                                "n_ids": (T.LongType(), pa.int64()), "parity": (T.BooleanType(), pa.bool_()),
                                "decoded": (T.StringType(), pa.string())}, work)


def encoded_documents(spark: SparkSession, docs: DataFrame, model_path: str = MODEL_PATH) -> DataFrame:
    """``docs`` with ids, n_ids, parity, and round_trip: whether the ids decode to the text again."""
    done = coded(docs, model_path)
    return done.withColumn("round_trip", F.col("decoded") == F.coalesce("text", F.lit(""))).drop("decoded")


def op7_sp_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = coded(documents(spark, sf_dir).select("doc_id", "text"))
    same = F.col("decoded") == F.coalesce("text", F.lit(""))
    return done.select("doc_id", "n_ids", "ids", "parity", same.alias("round_trip"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))
