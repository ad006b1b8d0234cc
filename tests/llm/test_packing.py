import random
import zlib

import numpy as np
import pytest
from helpers import docs, rows
from tokenizers import Tokenizer

from rollkeeper.llm import packing as p
from rollkeeper.llm.common import text_blocks
from rollkeeper.llm.tokens import WordEncoder

ODD = [
    None, "", " \t\n", "a<|endoftext|>b", "<|startoftext|>", "x <|startoftext|> y<|", "don't I'll 's 're", "ΣΑΣ Σ İ ß ŉ",
    "é ́   x　y\x1c\x1dz\x85", "123 4٠5 ½", "​﻿ a‍b", "日本語 テキスト 👩‍👩‍👧 🇩🇪", "a\x00b \x7f", "퟿",
]


def test_word_encoder_equals_the_tokenizer():
    plain = Tokenizer.from_file(p.public_path())
    r = random.Random(1)
    alphabet = "aAH̱'<|>sst  \n\t.,!é́Σ日 \x1c19½_👩‍"
    texts = ODD + ["".join(r.choice(alphabet) for _ in range(r.randrange(200))) for _ in range(300)]
    import pyarrow as pa

    mine, encoder = [], WordEncoder(p.public_path())
    for _, _, data, offsets in text_blocks(pa.array(texts, pa.string()), 4000):
        ids, counts = encoder.block(data, offsets)
        mine += [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]
    assert mine == [plain.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_pieces_and_places(spark, tmp_path):
    r = random.Random(2)
    word = lambda: "".join(r.choice("abcdeé") for _ in range(r.randrange(1, 9)))
    texts = ODD + [" ".join(word() for _ in range(r.choice([0, 1, 5, 200, 600, 2500, 9000]))) for _ in range(60)]
    texts += ["same text"] * 200
    path = docs(tmp_path, texts)
    plain = Tokenizer.from_file(p.public_path())
    want = {}
    for i, t in enumerate(texts):
        ids = [*plain.encode(t or "", add_special_tokens=False).ids, 1]
        for k in range(0, len(ids), 4096):
            part = ids[k : k + 4096]
            want[i, k // 4096] = (k, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))
    got = rows(p.op9_packing(spark, path))
    assert {(x["doc_id"], x["piece"]): (x["start"], x["length"], x["ids_crc32"]) for x in got} == want
    assert len(got) == len(want)
    by = {}
    for x in got:
        by.setdefault(x["sequence_id"], []).append((x["offset"], x["length"]))
    for parts in by.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 4096
    assert len(by) <= 1.03 * sum(x["length"] for x in got) / 4096 + 2


@pytest.mark.parametrize("scale", [1, 50])
def test_plan_is_whole_and_near_the_bound(scale):
    r = np.random.default_rng(3)
    sizes = np.minimum(1024, r.lognormal(4, 1.2, 3000).astype(int) + 1)
    counts = np.bincount(sizes, minlength=1025)[1:] * scale
    configs = p.rounded(counts, p.solve(counts))
    total = np.zeros_like(counts)
    for config, n in configs:
        assert sum(c * k for c, k in config.items()) <= 1024 and n > 0
        for c, k in config.items():
            total[c - 1] += n * k
    assert (total == counts).all()
    bound = (np.arange(1, 1025) * counts).sum() / 1024
    assert p.Plan(configs).sequences <= 1.02 * bound + 1


def test_solver_finds_the_known_optimum():
    counts = np.zeros(10, np.int64)
    counts[[5, 3, 2]] = [100, 100, 200]  # 6 + 4, and 3 + 3 + 3
    used = sum(n for _, n in p.rounded(counts, p.solve(counts)))
    assert used in range(167, 172)


def test_priced_against_brute_force():
    r = np.random.default_rng(4)
    for _ in range(20):
        value = r.random(12) * r.integers(0, 2, 12)
        best = [0.0] * 31
        for c in range(1, 31):
            best[c] = max([best[c - 1], *(best[c - k] + value[k - 1] for k in range(1, min(c, 12) + 1))])
        chosen = p.priced(value, 30)
        assert chosen.sum() <= 30 and abs(value[chosen - 1].sum() - best[30]) < 1e-9


def test_empty_and_real_sequences(spark, tmp_path):
    path = docs(tmp_path, [])
    assert p.op9_packing(spark, path).collect() == []
    frame = spark.createDataFrame([(1, "a b c", 3), (2, None, 4), (2, "a b c", 5)], "doc_id long, text string, length int")
    packed = p.pack(p.pieces(frame, p.public_path(), with_ids=True))
    out = rows(p.sequences(packed))
    assert sum(len(x["ids"]) // 4 for x in out) == 9 and sum(len(x["pieces"]) for x in out) == 3
