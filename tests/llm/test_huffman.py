import heapq
import random
import zlib

import numpy as np
import pytest
from helpers import docs, rows
from tokenizers import Tokenizer

from rollkeeper.llm import huffman as h


def cost_of_huffman(counts):
    heap, cost = [c for c in counts if c], 0
    heapq.heapify(heap)
    while len(heap) > 1:
        a = heapq.heappop(heap) + heapq.heappop(heap)
        cost += a
        heapq.heappush(heap, a)
    return cost


@pytest.mark.parametrize("seed", range(4))
def test_lengths_are_optimal_and_limited(seed):
    r = np.random.default_rng(seed)
    counts = (r.pareto(1, 300) * 10).astype(int)
    free = h.code_lengths(counts, 24)
    assert (free * counts).sum() == cost_of_huffman(counts)
    tight = h.code_lengths(counts, 9)
    assert tight.max() <= 9 and ((tight > 0) == (counts > 0)).all()
    for lengths in (free, tight):
        assert abs((0.5 ** lengths[lengths > 0].astype(float)).sum() - 1) < 1e-9
    assert h.code_lengths(np.array([1, 1, 2, 4, 8, 16]), 3).max() == 3


@pytest.mark.parametrize("vocabulary", [1, 2, 50, 5000])
def test_round_trip(vocabulary):
    r = np.random.default_rng(vocabulary)
    ids = np.minimum(vocabulary - 1, r.geometric(0.02, 20_000) - 1).astype(np.int64)
    counts = np.array([1, 1, 511, 512, 513, 1, 20_000 - 1539])
    lengths = h.code_lengths(np.bincount(ids), 16)
    codes = h.canonical(lengths)
    code, n_bytes, inside = h.encode(ids, counts, codes, lengths)
    plain, at = "", 0
    for n in counts:
        bits = "".join(f"{codes[i]:0{lengths[i]}b}" for i in ids[at : at + n])
        plain += bits + "0" * (-len(bits) % 8)
        at += n
    assert code.tobytes() == int(plain, 2).to_bytes(len(plain) // 8, "big")
    starts = (np.cumsum(n_bytes) - n_bytes) * 8
    assert (h.decode(code, starts, counts, h.table(lengths, 16), 16) == ids).all()


def test_documents(spark, tmp_path):
    r = random.Random(1)
    texts = [None, "", "a<|endoftext|>", "é x" * 7000] + [" ".join(r.choice("the of word Äpfel 42 !").join("ab") for _ in range(r.randrange(900))) for _ in range(80)]
    ids = [*range(1000, 900, -1)][: len(texts)]
    ids[5] = None
    ids[6] = ids[7] = 3
    path = docs(tmp_path, texts, ids)
    plain = Tokenizer.from_file(h.public_path())
    all_ids = {}
    for i, t in zip(ids, texts, strict=True):
        all_ids.setdefault(i, []).append([*plain.encode(t or "", add_special_tokens=False).ids, 2])
    got = sorted(rows(h.op6_huffman(spark, path)), key=lambda x: x["start"])
    assert [x["doc_id"] for x in got] == sorted(ids, key=lambda i: (i is not None, i))
    start = 0
    for x in got:
        assert x["start"] == start
        start += x["n_tokens"]
        crcs = [(len(p), zlib.crc32(np.array(p, "<u4").tobytes())) for p in all_ids[x["doc_id"]]]
        assert (x["n_tokens"], x["ids_crc32"]) in crcs


def test_ids_come_back_and_empty(spark, tmp_path):
    frame = spark.createDataFrame([(2, "b c", 1), (1, "a " * 3000, 2)], "doc_id long, text string, place int")
    files = h.write_corpus(frame, h.public_path())
    plain = Tokenizer.from_file(h.public_path())
    for x in rows(h.read_files(files, with_ids=True)):
        want = [*plain.encode({1: "a " * 3000, 2: "b c"}[x["doc_id"]], add_special_tokens=False).ids, 2]
        assert np.frombuffer(x["ids"], "<u4").tolist() == want
    assert h.op6_huffman(spark, docs(tmp_path, [])).collect() == []
