"""What a task holds at once, whatever the size of its batches."""

import numpy as np
import pyarrow as pa
from helpers import docs

from rollkeeper.llm import classlm
from rollkeeper.llm import packing as p
from rollkeeper.llm.tokens import WordEncoder


def test_pieces_are_cut_from_small_blocks(spark, tmp_path, monkeypatch):
    taken, seen = [], []

    class Recorder(WordEncoder):
        def block(self, data, offsets, end=None):
            seen.append(len(data))
            return super().block(data, offsets, end)

    monkeypatch.setattr(p, "mapped", lambda df, run, schema: taken.append(run) or df)
    monkeypatch.setattr(p, "encoder", Recorder)
    p.pieces(spark.read.parquet(docs(tmp_path, ["a"]) + "/documents.parquet"), p.public_path())
    texts = ["some words " * 1000] * 300
    batch = pa.RecordBatch.from_arrays([pa.array(range(300)), pa.array(texts)], names=["doc_id", "text"])
    out = list(taken[0]([batch]))
    assert sum(seen) == sum(map(len, texts)) and max(seen) <= 1 << 20
    assert sum(x.num_rows for x in out) == 300


def test_words_are_hashed_and_numbered_in_small_blocks(spark, tmp_path, monkeypatch):
    taken, seen, tokens = [], [], classlm.tokens
    monkeypatch.setattr(classlm, "tokens", lambda data, offsets: seen.append(len(data)) or tokens(data, offsets))
    frame = spark.read.parquet(docs(tmp_path, ["a b a"]) + "/documents.parquet")
    words = classlm.Words(classlm.vocabulary(frame.select("text")), 1, classlm.KEPT)
    monkeypatch.setattr(classlm, "mapped", lambda df, run, schema: taken.append(run) or spark.createDataFrame([], schema))
    classlm.vocabulary(frame.select("text"))
    classlm.numbered_texts(frame, words, "doc_id", "text")
    texts = [f"some words{k} " * 1000 for k in range(300)]
    count, number = taken
    out = pa.Table.from_batches(count([pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])]))
    assert len(out) == 301 and sorted(out.column("c").to_pylist()) == [1000] * 300 + [300_000]
    batch = pa.RecordBatch.from_arrays([pa.array(range(300)), pa.array([False] * 300), pa.array(texts)], names=["doc_id", "held_out", "text"])
    out = list(number([batch]))
    assert sum(x.num_rows for x in out) == 300 and all(len(i) == 4 * 2001 for x in out for i in x.column("ids").to_pylist())
    assert sum(seen) == 2 * sum(map(len, texts)) and max(seen) <= 1 << 20


def test_numbers_are_taken_by_their_bytes():
    counts = [5000] * 500 + [1 << 20] + [1] * 7
    batch = pa.RecordBatch.from_arrays([pa.array([k.to_bytes(4, "little") * n for k, n in enumerate(counts)])], names=["ids"]).slice(3)
    got = list(classlm._streams(batch))
    assert [n for _, _, own in got for n in own.tolist()] == counts[3:]
    assert [k for k, _, _ in got] == np.cumsum([0, *(len(own) for _, _, own in got)])[:-1].tolist()
    assert (np.concatenate([ids for _, ids, _ in got]) == np.repeat(np.arange(3, len(counts)), counts[3:])).all()
    assert all(len(ids) <= 1 << 19 or len(own) == 1 for _, ids, own in got)
