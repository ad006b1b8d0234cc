"""Small tables with awkward rows, and plain Python pieces for brute force."""

import re

import pyarrow as pa
import pyarrow.parquet as pq

GRAPH = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def small(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def table(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def folder(tmp_path, **tables):
    """A folder of Parquet tables: name -> (columns as dict, types as dict)."""
    for name, (columns, types) in tables.items():
        pq.write_table(pa.table(columns, schema=pa.schema(list(types.items()))), tmp_path / f"{name}.parquet")
    return str(tmp_path)


DOCS = {"doc_id": pa.int64(), "text": pa.string(), "lang": pa.string(), "source": pa.string(), "n_chars": pa.int64()}


def docs(tmp_path, texts, ids=None, langs=None, **more):
    n = len(texts)
    columns = {
        "doc_id": list(range(n)) if ids is None else ids,
        "text": texts,
        "lang": ["en"] * n if langs is None else langs,
        "source": ["s"] * n,
        "n_chars": [len(t or "") for t in texts],
    }
    return folder(tmp_path, documents=(columns, DOCS), **more)


def rows(df):
    return [r.asDict(recursive=True) for r in df.collect()]
