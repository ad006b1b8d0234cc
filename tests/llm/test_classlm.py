import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from helpers import GRAPH, docs, rows, small

from rollkeeper import session
from rollkeeper.llm import classlm as m
from rollkeeper.llm.common import word_hashes


def held(i):
    return zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2


def case(seed, n=250):
    r = random.Random(seed)
    endings = {"en": ["ing", "ed", "s"], "de": ["ung", "keit", "en"]}
    words = {k: ["".join(r.choices("abcdefgh", k=r.randrange(2, 6))) + r.choice(e) for _ in range(400)] for k, e in endings.items()}
    odd = [None, "", " \n\t", "Ä é x", "a\x1cb a\x1cb"]
    texts = list(odd)
    for _ in range(n):
        lang = r.choice(["en", "de"])
        own = [words[lang][min(399, int(r.expovariate(0.02)))] for _ in range(r.choice([1, 10, 80, 400]))]
        if r.random() < 0.3:
            own.append(f"rare{r.randrange(10**6)}")
        texts.append(" ".join(w.upper() if r.random() < 0.1 else w for w in own))
    return texts + [texts[9]] * 4


def brute_base(texts, ids):
    split = [[*GRAPH.findall(small(t)), None] for t in texts]
    c = Counter(w for s, i in zip(split, ids, strict=True) if not held(i) for w in s)
    n, v = sum(c.values()), len(c)
    return [(i, held(i), len(s), sum(c[w] > 0 for w in s), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in s)) for i, s in zip(ids, split, strict=True)], split, c


def hashed(word):
    raw = np.frombuffer(word.encode(), np.uint8)
    return int(word_hashes(raw, np.array([0]), np.array([len(raw)]))[0])


@pytest.mark.parametrize(("kept", "exchanged"), [(m.KEPT, 100), (60, 40)])
def test_base_and_model_scores(spark, tmp_path, kept, exchanged):
    texts = case(1)
    ids = [None, *range(1, len(texts))]
    frame = spark.read.parquet(docs(tmp_path, texts, ids) + "/documents.parquet")
    want, split, c = brute_base(texts, ids)
    train = frame.filter(~m.held_out(frame.doc_id))
    words = m.Words(m.vocabulary(train.select("text")), train.count(), kept)
    assert len(words.hashes) <= kept and (words.n, words.v) == (want[0][4], len(c))
    numbered = m.numbered_texts(frame, words, "doc_id", "text")
    classes, pairs = m.clustered(numbered.filter("not held_out"), words, exchanged, 8, 3)
    model = m.Model(words, classes, pairs)
    got = sorted(rows(m.scored(numbered, words, model)), key=lambda x: x["place"])
    number = {int(h): k + 1 for k, h in enumerate(words.hashes)}

    def kind(w):
        if w is None:
            return 0
        raw = w.encode()
        ending = raw[-1] | (raw[-2] << 8 if len(raw) > 1 else 0)
        return int(classes[number.get(hashed(w), len(words.hashes) + 1 + ending)])

    flow, size, sort = Counter(), Counter(), Counter()
    for s, i in zip(split, ids, strict=True):
        if not held(i):
            flow.update((kind(a), kind(b)) for a, b in zip([None, *s], s, strict=False))
    for w, n in c.items():
        size[kind(w)] += n
        sort[kind(w)] += 1
    assert {(a, b): int(pairs[a, b]) for a in range(8) for b in range(8) if pairs[a, b]} == dict(flow)
    total = sum(flow.values())
    for x, s, w in zip(got, split, want, strict=True):
        assert (x["doc_id"], x["held_out"], x["n_tokens"], x["n_known"], x["train_tokens"]) == w[:5]
        assert abs(x["base_score"] - w[5]) < 1e-6 * max(1, abs(w[5]))
        score, last = 0.0, 0
        for word in s:
            k = kind(word)
            one = (sum(n for (_, b), n in flow.items() if b == k) + 1) / (total + 8)
            of_last = sum(n for (a, _), n in flow.items() if a == last)
            score += math.log10((flow[last, k] + m.BACK_OFF * one) / (of_last + m.BACK_OFF))
            if word is not None:
                score += math.log10((c[word] + m.DELTA) / (size[k] + m.DELTA * (sort[k] + 1)))
            last = k
        assert abs(x["score"] - score) < 1e-6 * max(1, abs(score))
    out = [x for x in got if x["held_out"]]
    assert out and sum(x["score"] for x in out) > sum(x["base_score"] for x in out)


def test_exchange_raises_the_likelihood_and_parts_languages(spark, tmp_path):
    texts = case(2, 400)
    frame = spark.read.parquet(docs(tmp_path, texts) + "/documents.parquet")
    words = m.Words(m.vocabulary(frame.select("text")), len(texts), m.KEPT)
    numbered = m.numbered_texts(frame, words, "doc_id", "text")
    top = 200
    start = np.random.default_rng(1).integers(1, 4, top + 1)
    start[0] = 0
    classes = m.by_ending(words, start, top, 4)
    first = m.class_counts(numbered, classes, top, 4)
    better = m.by_ending(words, m.exchange(classes[: top + 1], *first), top, 4)
    assert m.likelihood(m.class_counts(numbered, better, top, 4)[0]) > m.likelihood(first[0])


def test_moves_are_those_of_the_greatest_likelihood():
    r = np.random.default_rng(3)
    n, size = 5, 12
    kind = np.concatenate([[0], r.integers(1, n, size)])
    text = np.append(r.integers(0, size + 1, 500), 0)
    before = np.append(0, text[:-1])

    def counted(kind):
        out = np.zeros((n, n))
        np.add.at(out, (kind[before], kind[text]), 1)
        return out

    pairs = counted(kind)
    words = [w for w in range(1, size + 1) if not ((text == w) & (before == w)).any()]  # a word beside itself changes two cells at once
    left, right = np.zeros((len(words), n)), np.zeros((len(words), n))
    for k, w in enumerate(words):
        np.add.at(left[k], kind[before[text == w]], 1)
        np.add.at(right[k], kind[text[before == w]], 1)
    got = m.moved(kind[words], left, right, pairs)
    for w, new in zip(words, got, strict=True):
        likely = []
        for c in range(1, n):
            other = kind.copy()
            other[w] = c
            likely.append(m.likelihood(counted(other)))
        assert likely[new - 1] >= max(likely) - 1e-6


@pytest.mark.parametrize("kept", [m.KEPT, 60])
def test_words_beyond_the_exchanged_are_exchanged_too(spark, tmp_path, kept):
    texts = case(4)
    ids = list(range(len(texts)))
    frame = spark.read.parquet(docs(tmp_path, texts, ids) + "/documents.parquet")
    train = frame.filter(~m.held_out(frame.doc_id))
    words = m.Words(m.vocabulary(train.select("text")), train.count(), kept)
    numbered = m.numbered_texts(frame, words, "doc_id", "text")
    ended = m.clustered(numbered.filter("not held_out"), words, 40, 8, 3)
    sums = words.rare_n.sum(), words.rare_v.sum()
    known = rows(numbered)
    first = m.rest_classes(numbered.filter("not held_out"), words, *ended, 40)
    assert first.count() == words.v - 1 - 40  # every other word of the training texts is judged
    moved, classes, pairs = m.refined(numbered, words, *ended, 40, 16)
    assert m.likelihood(pairs) > m.likelihood(ended[1])
    assert (words.rare_n.sum(), words.rare_v.sum()) == sums
    after = {x["place"]: x for x in rows(moved)}
    flow, rare = Counter(), {}
    for x in known:
        old, new = np.frombuffer(x["ids"], "<u4"), np.frombuffer(after[x["place"]]["ids"], "<u4")
        assert len(old) == len(new) and (old[old <= len(words.hashes)] == new[old <= len(words.hashes)]).all()
        kinds = classes[new].tolist()
        for h, c in zip(np.frombuffer(x["rare"], "<u8").tolist(), classes[new[old > len(words.hashes)]].tolist(), strict=True):
            assert rare.setdefault(h, c) == c
        if not x["held_out"]:
            flow.update(zip([0, *kinds], kinds, strict=False))
    assert {(a, b): int(pairs[a, b]) for a in range(8) for b in range(8) if pairs[a, b]} == dict(flow)
    got = rows(m.scored(moved, words, m.Model(words, classes, pairs)))
    want = {x["place"]: x for x in rows(m.scored(numbered, m.Words(m.vocabulary(train.select("text")), train.count(), kept), m.Model(words, classes, pairs)))}
    for x in got:
        assert abs(x["base_score"] - want[x["place"]]["base_score"]) < 1e-6 * max(1, abs(x["base_score"]))
        assert math.isfinite(x["score"]) and x["n_known"] == want[x["place"]]["n_known"]


def test_empty_and_all_held_out(spark, tmp_path):
    assert m.op8_classes(spark, docs(tmp_path, [])).collect() == []
    only = next(i for i in range(100) if held(i))
    frame = spark.createDataFrame([(only, "a b"), (only, None)], "doc_id long, text string")
    got = rows(m.score_documents(frame))
    assert [(x["n_tokens"], x["n_known"], x["train_tokens"]) for x in sorted(got, key=lambda x: -x["n_tokens"])] == [(3, 0, 0), (1, 0, 0)]
    assert all(math.isfinite(x["score"]) and x["score"] <= 0 for x in got)


def test_neighbours_are_counted_and_used_steps_go(spark, tmp_path, monkeypatch):
    texts = case(5)
    frame = spark.read.parquet(docs(tmp_path, texts) + "/documents.parquet")
    train = frame.filter(~m.held_out(frame.doc_id))
    words = m.Words(m.vocabulary(train.select("text")), train.count(), 60)
    numbered = m.numbered_texts(frame, words, "doc_id", "text").filter("not held_out")
    classes, _ = m.clustered(numbered, words, 40, 8, 1)
    counted = m.rest_counts(numbered, words, classes, 40, 8)
    want = Counter()
    for x in rows(numbered):
        ids, rare = np.frombuffer(x["ids"], "<u4"), iter(np.frombuffer(x["rare"], "<i8").tolist())
        kinds = classes[ids].tolist()
        for k, i in enumerate(ids.tolist()):
            if i > 40:
                far = i > len(words.hashes)
                h = next(rare) if far else int(words.hashes[i - 1].view(np.int64))
                want[h, ((far * 8 + kinds[k]) * 8 + (kinds[k - 1] if k else 0)) * 8 + kinds[k + 1]] += 1
    assert {(x["hash"], c["code"]): c["n"] for x in rows(counted) for c in x["cells"]} == want
    monkeypatch.setattr(session, "shared_folder", lambda _: str(tmp_path / "steps"))
    m.score_documents(frame, kept=60, exchanged=40, n_classes=8).collect()
    left = {p.name.rsplit("-", 1)[0] for p in (tmp_path / "steps").iterdir()}
    assert left == {"vocabulary", "recoded", "scored", "rare-words"}
