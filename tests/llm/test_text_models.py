"""Mixing, language model, language ID, personal data and SentencePiece."""

import gc
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from footfall.llm import interp_lm as lm
from footfall.llm import lang_id as li
from footfall.llm import mixing as mx
from footfall.llm import pii_lstm as pii
from footfall.llm import sp_codec as sp
from footfall.llm.common import UID, WORD, fold, identified
from footfall.llm.queries import QUERIES

from .conftest import SF_MID, SF_SMALL, awkward_rows, key, rows_of, sentence

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# ------------------------------------------------------------------ mixing

def test_targets_stop_at_twice_the_size_and_reshare():
    sizes, weights = [100, 1000, 10, 0], [3, 1, 2, 3]
    got = mx.mix_targets(sizes, weights)
    assert got[0] == 200 and got[2] == 20 and got[3] == 0
    assert math.isclose(sum(got), 1.5 * sum(sizes))
    assert mx.mix_targets([], []) == [] and mx.mix_targets([0, 0], [1, 2]) == [0, 0]


def test_permutation_is_one_to_one():
    for n in (1, 2, 3, 7, 100, 1025):
        x = np.arange(n)
        got = mx.permuted(x, np.int64(n), np.uint64(n * 31))
        assert sorted(got.tolist()) == x.tolist()


def test_tree_splits_quotas_exactly():
    quotas = np.array([5000, 17, 0, 999], np.int64)
    tree = mx.SplittingTree(quotas, 13, seed=3)
    counts = tree.shard_counts()
    assert (counts.sum(axis=0) == quotas).all() and counts.sum(axis=1).max() - counts.sum(axis=1).min() <= 2
    s = np.repeat(np.arange(4), quotas)
    draw = np.concatenate([np.arange(q) for q in quotas])
    shard, slot = tree.place(s, draw)
    assert (np.array([[((shard == k) & (s == i)).sum() for i in range(4)] for k in range(13)]) == counts).all()
    for k in range(13):
        assert sorted(slot[shard == k].tolist()) == list(range(int(counts[k].sum())))
    big = mx._hypergeometric(np.random.default_rng(1), np.array([3 * 10**9, 10**9]), 2 * 10**9)
    assert big.sum() == 2 * 10**9 and abs(big[0] - 1.5e9) < 1e6


def test_mix_on_awkward_rows(spark, awkward, clashing, empty):
    cols = ("doc_id", "size", "source_size", "target", "taken")
    got = mx.mix_summary(spark, awkward, block_words=16).toPandas()
    rows = awkward_rows()
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += len(re.findall(WORD, r[1] or ""))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    target = dict(zip(order, mx.mix_targets([sizes[s] for s in order], [(3, 1, 2)[i % 3] for i in range(len(order))])))
    assert sorted(got["size"]) == sorted(len(re.findall(WORD, r[1] or "")) for r in rows)
    taken = got.groupby("target")["taken"].sum()
    for s, t in target.items():
        if sizes[s]:
            assert taken[t] == round(t)
    assert (got["taken"] <= 2 * got["size"]).all()
    again = rows_of(mx.mix_summary(spark, clashing.repartition(5), block_words=16), *cols)
    assert again == rows_of(mx.mix_summary(spark, awkward, block_words=16), *cols)
    assert mx.mix_summary(spark, empty).count() == 0 and mx.mixed_documents(spark, empty).count() == 0


def test_mixed_outputs_hold_the_taken_words(spark, clashing):
    summary = mx.mix_summary(spark, clashing, block_words=16).toPandas()
    docs = mx.mixed_documents(spark, clashing, block_words=16)
    assert docs.columns == clashing.columns
    docs = docs.toPandas()
    assert sum(len(re.findall(WORD, t)) for t in docs.text) == summary.taken.sum()
    assert (docs.text.str.len() == docs.n_chars).all()
    pieces = mx.mixed_texts(spark, clashing, block_words=16, shard_blocks=200).toPandas()
    assert sum(len(re.findall(WORD, t)) for t in pieces.text) == summary.taken.sum()
    for _, shard in pieces.groupby("__shard"):
        assert sorted(set(shard["__slot"])) == list(range(shard["__slot"].nunique()))


def level_targets(sizes, weights, share=1.5, most=2.0):
    """Targets by another way: the level at which min(most * size, level * weight) adds up to the share."""
    low, high = 0.0, most * sum(sizes) + 1
    for _ in range(200):
        mid = (low + high) / 2
        reached = sum(min(most * z, mid * w) for z, w in zip(sizes, weights)) >= share * sum(sizes)
        low, high = (low, mid) if reached else (mid, high)
    return [min(most * z, high * w) for z, w in zip(sizes, weights)]


def test_query_against_a_brute_force_of_targets_and_places(spark):
    docs = pd.read_parquet(f"{SF_MID}/documents.parquet").set_index("doc_id")
    got = QUERIES["op1_mixing"](spark, SF_MID).toPandas().set_index("doc_id").loc[docs.index]
    size = docs.text.map(lambda t: len(re.findall(WORD, t or "")))
    assert (got["size"] == size).all() and len(got) == len(docs)
    source = docs.source.map(lambda x: (x is None or x != x, x if isinstance(x, str) else ""))
    whole = size.groupby(source).sum().sort_index()
    want = dict(zip(whole.index, level_targets(whole.tolist(), [(3, 1, 2)[i % 3] for i in range(len(whole))])))
    assert np.allclose(got.target, source.map(want), rtol=1e-9)
    assert (got.source_size == source.map(whole)).all() and (got.taken <= 2 * got["size"]).all()
    taken = got.taken.groupby(source).sum()
    assert all(abs(taken[k] - want[k]) <= 1 for k in want)
    assert ((got.taken > 0) == (got.n_shards > 0)).all() and (got.first_shard.isna() == (got.taken == 0)).all()


def test_the_tree_decides_what_is_taken(spark, awkward, monkeypatch):
    options = {"block_words": 16, "shard_blocks": 100}
    whole = mx.mix_summary(spark, awkward, **options).toPandas().taken.sum()
    counts = rows_of(mx.shard_counts(spark, awkward, **options), "shard", "sid", "blocks")
    sizes = defaultdict(int)
    for r in awkward_rows():
        sizes[r[3]] += len(re.findall(WORD, r[1] or ""))
    words = [sizes[s] for s in sorted(sizes, key=lambda s: (s is None, s or ""))]
    targets = level_targets(words, [(3, 1, 2)[i % 3] for i in range(len(words))])
    plan = mx.MixPlan(np.array(words), np.array([round(t) for t in targets]), 16, 100, mx.SEED)
    tree = plan.tree.shard_counts()
    assert plan.tree.shards > 20 and (tree.sum(axis=0) == plan.tree.quotas).all()
    assert {(k, s): n for k, s, n in counts} == {(k, s): n for (k, s), n in np.ndenumerate(tree) if n}
    plan.tree.quotas = plan.tree.quotas // 2           # a tree that deals half the blocks makes half a mix
    sid, start = np.arange(len(words)), np.zeros(len(words), np.int64)
    got = plan.pieces(sid, start, np.array(words))
    assert 0.4 * whole < (got["end"] - got["begin"]).sum() < 0.6 * whole
    assert (got["shard"] >= 0).all()


def test_split_draws_follow_the_distribution():
    rng = np.random.default_rng(7)
    for good, total, take in ((5, 12, 4), (1, 9, 8), (30, 40, 20), (0, 5, 3), (5, 5, 2)):
        n = 20_000
        seen = Counter(mx._marginal(rng, good, total, take) for _ in range(n))
        for k in range(take + 1):
            p = math.comb(good, k) * math.comb(total - good, take - k) / math.comb(total, take)
            assert abs(seen[k] - n * p) <= 5 * math.sqrt(n * p) + 1e-9, (good, total, take, k)
    for good, total, take in ((400_000, 10**6, 300_000), (4 * 10**9, 10**10, 3 * 10**9)):      # one rule at every size
        draws = np.array([mx._marginal(rng, good, total, take) for _ in range(60)], float)
        mean, share = take * good / total, good / total
        spread = math.sqrt(take * share * (1 - share) * (total - take) / (total - 1))
        assert abs(draws.mean() - mean) < 5 * spread / math.sqrt(60) and 0.6 < draws.std() / spread < 1.5


def test_documents_lie_in_shard_and_slot_order(spark, awkward):
    text = " ".join(f"w{i}" for i in range(4000))
    docs = spark.createDataFrame([(i, text[i:], "en", "abc"[i % 3], None) for i in range(60)], awkward.schema).coalesce(1)
    options = {"block_words": 64, "shard_blocks": 500}
    first = {r["doc_id"]: (r["first_shard"], r["first_slot"]) for r in mx.mix_summary(spark, docs, **options).collect()}
    ids = mx.mixed_documents(spark, docs, **options).select("doc_id", F.spark_partition_id().alias("part")).collect()
    places, seen = defaultdict(list), set()
    for r in ids:
        if r["doc_id"] not in seen and first[r["doc_id"]] is not None:
            seen.add(r["doc_id"])
    assert seen == {d for d, (shard, _) in first.items() if shard is not None}
    once = [d for d in seen if sum(r["doc_id"] == d for r in ids) == 1]
    for r in ids:
        if r["doc_id"] in once:
            places[r["part"]].append(first[r["doc_id"]])
    assert places and all(p == sorted(p) for p in places.values())


def test_long_documents_lie_among_the_short_ones(spark, awkward):
    words = " ".join(f"w{i}" for i in range(3000))
    docs = spark.createDataFrame([(i, words if i % 10 == 0 else words[i:i + 60], "en", "ab"[i % 2], None) for i in range(400)], awkward.schema)
    options = {"block_words": 16}
    got = mx.mix_summary(spark, docs, **options).toPandas()
    got = got[got.taken > 0].sort_values(["first_shard", "first_slot"]).reset_index(drop=True)
    ranks = got.index[got["size"] == 3000] / len(got)
    assert len(ranks) > 30 and 0.3 < ranks.to_numpy().mean() < 0.7 and ranks.max() > 0.8
    rows = [len(r["text"]) for r in mx.mixed_documents(spark, docs, **options).select("text").collect()]
    tenths = [sum(x) for x in np.array_split(np.array(rows), 10)]
    assert max(tenths) < 0.4 * sum(rows)


def test_rows_of_a_generator_have_identities_of_their_own(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/ids")
    read = spark.read.parquet(f"{tmp_path}/ids")
    for df, n in ((read, 3), (read.where("id > 0").select("id"), 2), (read.selectExpr("id", "explode(array(1, 2)) AS x"), 6),
                  (read.join(read.select(F.lit(1).alias("y")), F.lit(True)), 9), (read.union(read), 6)):
        assert identified(spark, df, "ids").select(UID).distinct().count() == n


# ------------------------------------------------------------------ language model

def slow_scores(rows):
    toks = [re.findall(WORD, (r[1] or "").translate(LOW)) + ["\n"] for r in rows]
    learn = [zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 10 != 0 for r in rows]
    u, b = Counter(), Counter()
    for t, k in zip(toks, learn):
        if k:
            u.update(t)
            b.update(zip(["\n"] + t[:-1], t))
    n, v = sum(u.values()), len(u)
    events = [(u[p] - 1, (b[p, w] - 1) / (u[p] - 1) if u[p] > 1 else 0.0, (u[w] - 1) / (n - 1))
              for t, k in zip(toks, learn) if k for p, w in zip(["\n"] + t[:-1], t)]
    c = np.array([e[0] for e in events])
    bucket = np.floor(np.log2(c + 1.0)).astype(int)
    p = np.array([(e[1], e[2], 1 / (v + 1)) for e in events])
    weights = np.full((lm.BUCKETS, 3), 1 / 3)
    weights[0] = 0, 0.5, 0.5
    for _ in range(lm.EM_ROUNDS):
        s = weights[bucket] * p
        s /= s.sum(axis=1, keepdims=True)
        mass = np.stack([np.bincount(bucket, s[:, i], lm.BUCKETS) for i in range(3)], axis=1)
        some = mass.sum(axis=1) > 0
        weights[some] = mass[some] / mass[some].sum(axis=1, keepdims=True)
    used = [x for x in np.flatnonzero(np.bincount(bucket, minlength=lm.BUCKETS)) if x]
    for i in range(1, lm.BUCKETS):
        if i not in used and used:
            weights[i] = weights[min(used, key=lambda x: abs(x - i))]
    out = []
    for r, t, k in zip(rows, toks, learn):
        base = sum(math.log10((u[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t)
        score = 0.0
        for x, w in zip(["\n"] + t[:-1], t):
            m = weights[int(math.log2(u[x] + 1))]
            score += math.log10(m[0] * (b[x, w] / u[x] if u[x] else 0) + m[1] * u[w] / n + m[2] / (v + 1))
        out.append((r[0], not k, len(t), sum(u[w] > 0 for w in t), n, base, score))
    return out


def test_scores_on_awkward_rows(spark, awkward, clashing, empty, monkeypatch):
    monkeypatch.setattr(lm, "BLOCK_BYTES", 100_000)
    monkeypatch.setattr(lm, "RANGE_KEYS", 1 << 15)
    want = sorted(slow_scores(awkward_rows()), key=lambda r: key(r[:4]) + (r[5],))
    for df in (awkward, clashing):
        got = lm.interpolated_scores(spark, df, fold("doc_id", 10) != 0).collect()
        got = sorted((tuple(r) for r in got), key=lambda r: key(r[:4]) + (r[5],))
        assert [r[:5] for r in got] == [r[:5] for r in want]
        for a, b in zip(got, want):
            assert a[5] == pytest.approx(b[5], rel=1e-9) and a[6] == pytest.approx(b[6], rel=2e-2)
    assert lm.interpolated_scores(spark, empty, fold("doc_id", 10) != 0).count() == 0
    none = lm.interpolated_scores(spark, awkward, F.lit(False)).agg(F.max("score"), F.max("train_tokens")).first()
    assert tuple(none) == (0.0, 0)


def test_model_beats_the_base_on_held_out_texts(spark):
    got = QUERIES["op3_interp_lm"](spark, SF_MID).where("held_out").agg(F.sum("base_score"), F.sum("score")).first()
    assert got[1] > 0.85 * got[0]


def test_probabilities_of_all_words_sum_to_one():
    rng = np.random.default_rng(0)
    w = rng.dirichlet([1, 1, 1])
    c = Counter({"a": 3, "b": 2, "c": 1})
    pairs = Counter({("a", "b"): 2, ("a", "c"): 1})
    total = sum(w[0] * pairs["a", x] / 3 + w[1] * c[x] / 6 + w[2] / 4 for x in "abc") + w[2] / 4
    assert math.isclose(total, 1)


# ------------------------------------------------------------------ language ID

def test_language_accuracy_on_held_out_documents(spark):
    got = QUERIES["op6_lang_id"](spark, SF_MID).toPandas()
    docs = pd.read_parquet(f"{SF_MID}/documents.parquet")[["doc_id", "lang"]].merge(got, on="doc_id")
    held = docs[docs.held_out & docs.lang.notna() & (docs.lang_pred != "und")]
    assert (held.lang == held.lang_pred).mean() > 0.97
    assert docs.score.between(0, 1).all() and docs.accepted.mean() > 0.97
    assert (docs.held_out == docs.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 4 == 2)).all()


def slow_prediction(model, text):
    """Language and probability of a text: grams listed one by one, their rows averaged, softmax by math.exp."""
    raw = b" " + text.lower().encode() + b" "
    rows = []
    for n in li.GRAMS:
        for i in range(len(raw) - n + 1):
            key = int.from_bytes(bytes([n]) + raw[i:i + n], "big") * 0x9E3779B97F4A7C15 % 2**64
            rows.append(model.table[key >> (64 - li.BUCKETS.bit_length() + 1)])
    logits = [(math.fsum(float(r[k]) for r in rows) / len(rows) + float(model.bias[k])) / model.temperature for k in range(len(model.langs))]
    odds = [math.exp(x - max(logits)) for x in logits]
    best = max(range(len(odds)), key=odds.__getitem__)
    return model.langs[best], odds[best] / sum(odds)


def test_predictions_against_a_brute_force(spark, awkward):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text", "lang")
    model = li.fit_languages(docs, fold("doc_id", 4) != 2)
    for rows in (docs.orderBy("doc_id").limit(60), awkward.where("doc_id < 100 OR doc_id > 105")):
        for r in li.with_language(spark, rows.select("doc_id", "text"), model).collect():
            if r["text"] is None or not any(c.isalpha() for c in r["text"]):
                assert (r["lang_pred"], r["score"], r["accepted"]) == ("und", 0.0, False)
                continue
            lang, p = slow_prediction(model, r["text"])
            assert r["lang_pred"] == lang and math.isclose(r["score"], p, rel_tol=1e-9), r["doc_id"]
            assert r["accepted"] == (r["score"] >= model.threshold)


def test_the_layer_over_averaged_embeddings_is_the_folded_table():
    rng = np.random.default_rng(3)
    emb, layer = rng.normal(size=(li.BUCKETS, li.DIM)), rng.normal(size=(3, li.DIM))
    model = li.LangModel(["a", "b", "c"], emb @ layer.T, np.array([0.1, 0.2, 0.3]))
    for data in (b"one text", "zwei Wörter".encode(), b"x"):
        ids = np.concatenate(list(li.gram_buckets(data)))
        assert np.allclose(model.logits(data), layer @ emb[ids].mean(axis=0) + model.bias)


def test_language_on_awkward_rows(spark, awkward, clashing, empty):
    model = li.fit_languages(awkward, F.lit(True))
    got = li.with_language(spark, awkward.select("doc_id", "text"), model).collect()
    assert len(got) == awkward.count()
    for r in got:
        lettered = r["text"] is not None and any(c.isalpha() for c in r["text"])
        assert (r["lang_pred"] == "und") == (not lettered) and 0 <= r["score"] <= 1
        assert lettered or not r["accepted"]
    kept = li.accepted_documents(spark, clashing)
    assert kept.columns == clashing.columns and kept.count() <= clashing.count()
    assert li.accepted_documents(spark, empty).count() == 0
    assert li.fit_languages(empty, F.lit(True)) is None
    only = {r["lang_pred"] for r in li.with_language(spark, awkward.select("text"), None).collect()}
    assert only == {"und"}


def test_long_texts_are_summed_in_parts(monkeypatch):
    data = ("der die das und " * 500).encode()
    whole = np.sort(np.concatenate(list(li.gram_buckets(data))))
    monkeypatch.setattr(li, "_SEGMENT", 64)
    assert (np.sort(np.concatenate(list(li.gram_buckets(data)))) == whole).all()


# ------------------------------------------------------------------ personal data

def slow_base(text):
    out = [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(1, *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]

    def luhn(d):
        return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(d[::-1])) % 10 == 0

    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 16 <= len(d) <= 19 and luhn(d):
            out.append((2, *m.span()))
    out += [(3, *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return out


TRICKY = ["", "a@b", "x.y+z@ex-a.co.uk, a@b.c@d.e @x.y", "1.2.3.4.5.6.7.8 256.1.1.1 0000255.1.2.03", "4111 1111 1111 1111 4111-1111-1111-1112",
          "+49 (30) 123-4567 +1 2 +123456789012345678", "é" * 300 + "user@mail.example.org" + "ü" * 300, "4111111111111111" * 3, "9" * 4000 + ".1.2.3"]


@pytest.mark.parametrize("text", TRICKY)
def test_base_spans_on_tricky_texts(text):
    assert pii.base_spans(text) == slow_base(text)


def test_base_spans_and_accuracy_of_the_tagger(spark):
    texts = [t for t in pd.read_parquet("/root/testdata/sf0.1/documents.parquet").text if re.search("[0-9@]", t or "")]
    for t in texts[:200]:
        assert pii.base_spans(t) == slow_base(t)
    model = pii.train_tagger([t for t in texts[::2] if len(t) <= pii.SAMPLE_CHARS][:pii.SAMPLE_DOCS])
    hits = wrong = total = 0
    for t in texts[1::2][:150]:
        blocks = pii.reach(t)
        tags = model.decode(pii._windows(pii.char_ids(t), blocks * pii.HALF))
        found, base = set(pii.added_spans(t, blocks, tags, [])), set(pii.base_spans(t))
        hits, wrong, total = hits + len(found & base), wrong + len(found - base), total + len(base)
    assert hits > 0.6 * total and wrong <= 0.1 * hits
    for (base, added), t in zip(pii.find_spans(texts[:100], model), texts):
        assert base == pii.base_spans(t)
        assert all(b <= c or d <= a for _, a, b in added for _, c, d in base)


def test_gradients_of_the_tagger():
    rng = np.random.default_rng(0)
    model = pii.Tagger.fresh(rng)
    x = rng.integers(1, 100, (3, 24))
    y = np.zeros((3, 24), np.int64)
    y[:, 5], y[:, 6:9] = 1, 2
    _, grad = model.gradients(x, y)
    for name in ("trans", "bias", "out", "whf", "wxb"):
        i = tuple(s // 2 for s in model.p[name].shape)
        ends = []
        for step in (1e-2, -2e-2):
            model.p[name][i] += np.float32(step)
            ends.append(model.gradients(x, y)[0])
        model.p[name][i] += np.float32(1e-2)
        assert (ends[0] - ends[1]) / 2e-2 == pytest.approx(float(grad[name][i]), abs=2e-2, rel=2e-2)


def test_spans_on_awkward_rows(spark, awkward, clashing, empty):
    for df in (awkward, clashing):
        got = pii.private_spans(spark, df, pii.fit_tagger(df))
        assert got.count() == df.count() and got.columns == ["doc_id", "base", "added"]
    assert pii.private_spans(spark, empty, pii.fit_tagger(empty)).count() == 0


# ------------------------------------------------------------------ SentencePiece

def test_ids_are_those_of_the_model_and_round_trip(spark):
    import sentencepiece
    got = QUERIES["op7_sp_codec"](spark, SF_SMALL).toPandas().set_index("doc_id")
    docs = pd.read_parquet(f"{SF_SMALL}/documents.parquet").set_index("doc_id")
    model = sentencepiece.SentencePieceProcessor(model_file=sp.MODEL_PATH)
    for i, t in docs.text.items():
        assert list(got.ids[i]) == model.encode(t or "") and got.n_ids[i] == len(got.ids[i])
    assert got.parity.all() and got.round_trip.all()


def test_codec_on_awkward_rows(spark, clashing, empty):
    got = sp.encoded_documents(spark, clashing).toPandas()
    assert len(got) == len(awkward_rows()) and got.parity.all() and got.round_trip.all()
    assert {len(x) for x, t in zip(got.ids, got.text) if not t} == {0}
    assert sp.encoded_documents(spark, empty).count() == 0


def test_rebuilt_pipeline_on_odd_texts():
    data = sp._model_bytes(sp.MODEL_PATH)
    odd = ["", " ", "  a  b   c", "a\n\n\tb", "你好 <s> </s> <unk> <0x0A>", "x" * 3000, " " * 37 + "z", "tail   ", "\x00a", "� é é"]
    ids, parity = sp.encode_texts(data, odd)
    assert all(parity) and sp.decode_ids(data, ids) == odd


def _varint(n):
    out = b""
    while True:
        out += bytes([n & 127 | (128 if n > 127 else 0)])
        n >>= 7
        if not n:
            return out


def test_unigram_models_are_rebuilt_from_their_scores():
    import struct

    def bytes_field(n, b):
        return _varint(n << 3 | 2) + _varint(len(b)) + b

    pieces = [("<unk>", 0.0, 2), ("▁", -3.0, 1), ("a", -4.0, 1), ("b", -4.5, 1), ("▁ab", -2.0, 1), ("ab", -3.5, 1), ("ba", -3.6, 1), ("▁a", -3.7, 1)]
    body = b"".join(bytes_field(1, bytes_field(1, p.encode()) + _varint(2 << 3 | 5) + struct.pack("<f", s) + _varint(3 << 3) + _varint(t)) for p, s, t in pieces)
    body += bytes_field(2, _varint(3 << 3) + _varint(1)) + bytes_field(3, bytes_field(1, b"identity"))
    ids, parity = sp.encode_texts(body, ["ab", "abba", "  ab   ba ", "a b", ""])
    assert all(parity)
    assert sp.decode_ids(body, ids)[1] == "abba"


def test_a_pipeline_that_differs_is_seen_and_replaced(monkeypatch):
    """With half of the merges missing, texts of the words that differ get the library's ids, counted by parity; the others
    keep the pipeline's own."""
    import sentencepiece
    data = sp._model_bytes(sp.MODEL_PATH)
    all_merges = sp.merges
    monkeypatch.setattr(sp, "merges", lambda m: all_merges(m)[: len(all_merges(m)) // 2])
    broken, model = sp.Codec(data), sentencepiece.SentencePieceProcessor(model_proto=data)
    texts = ["the", "in an", "", " ", "extraordinary circumstances", "the extraordinary", "a  b"] + [sentence(i, 50) for i in range(20)]
    ids, n, right = broken.checked(texts)
    assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == [model.encode(t) for t in texts]
    alone, m, _ = broken.encode(texts)
    same = [x.tolist() == model.encode(t) for x, t in zip(np.split(alone, np.cumsum(m)[:-1]), texts)]
    assert right.tolist() == same and 0 < sum(same) < len(texts)


def test_ids_come_from_the_rebuilt_pipeline():
    """The library is asked for words a task has not met, and for nothing else."""
    data = sp._model_bytes(sp.MODEL_PATH)
    codec = sp.Codec(data)
    texts = [sentence(i, 80) for i in range(30)] + ["  odd\tspaces  ", "你好 é"]
    first = codec.checked(texts)

    class Silent:
        def encode(self, *_, **__):
            raise AssertionError("asked again")

    codec.reference = Silent()
    again = codec.checked(texts * 2)
    assert again[0].tolist() == first[0].tolist() * 2 and again[2].all()
    codec._forget()
    with pytest.raises(AssertionError, match="asked again"):
        codec.checked(texts)


def test_words_of_a_batch_go_with_it():
    codec = sp.Codec(sp._model_bytes(sp.MODEL_PATH))
    gc.disable()                                       # what only the collector frees stays
    try:
        codec.encode(["alpha quetzal beta", "quetzal gamma"])
        held = [x for x in gc.get_objects() if isinstance(x, defaultdict) and f"{sp.MARK}quetzal" in x]
    finally:
        gc.enable()
    assert not held and f"{sp.MARK}quetzal" in codec.index


def test_words_are_looked_up_once_a_batch():
    """The large table of words is asked for a batch's distinct words, not for each of its words; its arrays grow by doubling."""
    codec = sp.Codec(sp._model_bytes(sp.MODEL_PATH))
    texts = [sentence(i, 80) for i in range(30)]
    first = codec.checked(texts)
    asked = []

    class Counting(dict):
        def __getitem__(self, word):
            asked.append(word)
            return super().__getitem__(word)

    codec.index = Counting(codec.index)
    again = codec.checked(texts * 10)
    assert again[0].tolist() == first[0].tolist() * 10 and again[1].tolist() == first[1].tolist() * 10
    assert len(asked) == len(set(asked)) == len(codec.index)
    rooms = {id(codec.ids.room)}
    for i in range(40):
        codec.checked([f"w{i}x{j}y" for j in range(50)])
        rooms.add(id(codec.ids.room))
    assert len(rooms) < 10 and codec.size.n == codec.start.n == codec.same.n == len(codec.index)
    assert codec.checked(texts)[0].tolist() == first[0].tolist()


# ------------------------------------------------------------------ samples and weights

def test_languages_of_many_copies_are_learnt(spark):
    """Copies count once: two German texts of ten thousand rows each are both learnt, beside many English ones."""
    german = ["der hund läuft über die straße", "die katze schläft auf dem sofa"]
    rows = spark.range(20_000).select(F.when(F.col("id") % 2 == 0, german[0]).otherwise(german[1]).alias("text"), F.lit("de").alias("lang"))
    rows = rows.unionByName(spark.createDataFrame([(f"{sentence(i, 9)} number {i}", "en") for i in range(400)], "text string, lang string"))
    texts, langs = li.training_sample(rows)
    assert {t.decode() for t, x in zip(texts, langs) if x == "de"} == set(german) and langs.count("en") == 400


def test_a_text_of_many_copies_is_learnt(spark):
    rows = spark.range(5_000).select(F.lit("write to someone@example.org or call +49 30 1234567 today").alias("text"))
    assert pii.fit_tagger(rows) is not None


def test_weights_never_reach_zero():
    """One deterministic bucket and a million words: an unseen token still has a probability."""
    cell = np.array([5 * lm._NEVER * lm._NEVER])
    w = lm.learned_weights(cell, np.array([1e12]), np.array([1e12]), np.array([1e11]), 1_000_000)
    assert (w[:, 2] > 0).all() and np.allclose(w.sum(axis=1), 1) and w[5, 0] > 0.999
    assert np.isfinite(np.log10(w[5, 2] / 1_000_001))


def test_tables_go_when_a_stage_fails(spark, monkeypatch):
    before = {t.name for t in spark.catalog.listTables()}
    monkeypatch.setattr(lm, "learned_weights", lambda *a: (_ for _ in ()).throw(RuntimeError("stop")))
    docs = spark.createDataFrame([(1, "a b c"), (2, "a b d")], "doc_id long, text string")
    with pytest.raises(RuntimeError, match="stop"):
        lm.interpolated_scores(spark, docs, F.lit(True))
    assert {t.name for t in spark.catalog.listTables()} == before
