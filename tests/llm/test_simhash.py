import random

import pytest
import xxhash
from helpers import GRAPH, docs, rows, small

from rollkeeper.llm import simhash as s
from rollkeeper.llm.components import components


def fingerprint(text):
    words = GRAPH.findall(small(text))
    if not words:
        return 0
    parts = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(nodes, linked):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if linked(a, b):
                parent[root(a)] = root(b)
    return root


def case(seed):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcéÄ") for _ in range(r.randrange(1, 6)))
    texts = [None, "", " \n", "one", "One two", "one two three", "one two three four", "é\x1cx y\xa0z a b"]
    for _ in range(12):
        words = [word() for _ in range(r.choice([5, 40, 150]))]
        for _ in range(r.choice([1, 2, 12])):
            own = list(words)
            for _ in range(r.randrange(4)):
                own[r.randrange(len(own))] = word()
            texts.append(r.choice([" ", "\t", "  "]).join(own))
    texts.append(" ".join(word() for _ in range(40_000)))
    return texts + texts[10:14]


@pytest.mark.parametrize("seed", range(2))
def test_against_brute_force(spark, tmp_path, seed):
    texts = case(seed)
    ids = [None if i == 1 else 1000 - i for i in range(len(texts))]
    fps = [fingerprint(t) for t in texts]
    root = classes(sorted(set(fps)), lambda a, b: (a ^ b).bit_count() <= 4)
    first = {}
    for i, f in zip(ids, fps, strict=True):
        if i is not None:
            first[root(f)] = min(i, first.get(root(f), i))
    want = sorted(((i, f"{f:016x}", first[root(f)]) for i, f in zip(ids, fps, strict=True)), key=repr)
    path = docs(tmp_path, texts, ids)
    assert sorted((tuple(x) for x in s.op4_simhash(spark, path).collect()), key=repr) == want
    frame = spark.read.parquet(f"{path}/documents.parquet")
    kept = s.keep_one(frame)
    assert kept.columns == frame.columns
    assert sorted(x.doc_id for x in kept.collect()) == sorted(first.values())


@pytest.mark.parametrize("seed", range(2))
def test_links_of_random_fingerprints(spark, seed):
    r = random.Random(seed)
    fps = set()
    for _ in range(40):
        centre = r.getrandbits(64)
        for _ in range(r.choice([1, 2, 30])):
            f = centre
            for _ in range(r.randrange(7)):
                f ^= 1 << r.randrange(64)
            fps.add(f - (1 << 64) if f >> 63 else f)
    fps = sorted(fps)
    mask = (1 << 64) - 1
    root = classes(fps, lambda a, b: ((a ^ b) & mask).bit_count() <= 4)
    least = {}
    for f in fps:
        least[root(f)] = min(f, least.get(root(f), f))
    got = {x.a: x.b for x in s.link_components(spark.createDataFrame([(f,) for f in fps], "fp long"), 4).collect()}
    assert got == {f: least[root(f)] for f in fps if f != least[root(f)]}


def test_a_pair_shares_a_variant_for_every_pattern():
    for bits in (1, 2, 3, 4, 5):
        parts = s.segments(bits)
        assert sum(n for _, n in parts) == 64 and 2 * len(parts) > bits


def test_components_of_chains_and_hubs(spark):
    links = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5000, 5000)]
    got = {x.a: x.b for x in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 201)} | {1000 + i: 1000 for i in range(1, 300)}


def test_empty(spark, tmp_path):
    assert rows(s.op4_simhash(spark, docs(tmp_path, []))) == []
