"""Rows that the docstrings name, through every query on documents: none is lost, none breaks it."""

import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from helpers import rows

from rollkeeper.llm.queries import QUERIES

NAMES = [n for n in QUERIES if n.split("_")[0] in ("op1", "op2", "op3", "op4", "op5", "op6", "op7", "op8", "op9", "op12")]
CLASHES = ["fp", "root", "value", "key", "_found", "_place", "_body", "sid", "tokens", "n", "place", "_count", "sequence_id", "lower"]


def table(path, ids, texts, langs):
    columns = {"doc_id": pa.array(ids, pa.int64()), "text": pa.array(texts, pa.string()), "lang": pa.array(langs, pa.string())}
    columns |= {c: pa.array([c] * len(ids), pa.string()) for c in CLASHES}
    path.mkdir()
    pq.write_table(pa.table(columns), path / "documents.parquet")
    items = {"item_id": pa.array(["i", "i", None, "j"]), "text": pa.array(["w1 w2 w3", None, "", "w4 " * 20])}
    pq.write_table(pa.table(items), path / "benchmark.parquet")
    return str(path)


@pytest.fixture(scope="module")
def folders(tmp_path_factory):
    r = random.Random(1)
    made = tmp_path_factory.mktemp("cases")
    long = " ".join(f"w{r.randrange(3000)}" for _ in range(60_000))
    texts = [None, "", " \n", "one", long, long, "x" * 100_000, "w1 w2 w3 " * 30, "w1 w2 w3 " * 30, "é" * 500 + "\x00\x1c", None]
    ids = [1, 2, 3, 4, 5, 6, 7, 8, 8, 10, None]
    langs = [None, "en", "", "en", "en", "en", "fr", "en", "en", "zz", None]
    return table(made / "odd", ids, texts, langs), table(made / "empty", [], [], []), ids


@pytest.mark.parametrize("name", NAMES)
def test_odd_rows_and_clashing_columns(spark, folders, name):
    got = sorted({r["doc_id"] for r in rows(QUERIES[name](spark, folders[0]))}, key=repr)
    assert got == sorted(set(folders[2]), key=repr)


@pytest.mark.parametrize("name", NAMES)
def test_empty_table(spark, folders, name):
    assert rows(QUERIES[name](spark, folders[1])) == []
