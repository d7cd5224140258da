"""A shuffle of very many small keys as few large rows.

A batch's (document, key) entries are dealt to buckets by key and travel as one binary row per bucket: the documents,
how many keys each has, and the keys. A row per entry would cost several times the bytes and far more time. Buckets
hold about ENTRIES entries each, and each task takes BUCKETS_A_TASK of them, so that the numbers of both grow with the
input and a task's memory does not.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronofold.llm.session import release
from chronofold.llm.words import mix

ENTRIES, LEAST_BUCKETS, BUCKETS_A_TASK = 1_000_000, 32, 2
SCHEMA = "bucket int, section int, blob binary"
ANSWERS = "doc_id bigint, blob binary"


def buckets_for(entries: float) -> int:
    return max(LEAST_BUCKETS, -(-int(entries) // ENTRIES))


def in_buckets(dealt: DataFrame, buckets: int, f, schema: str) -> DataFrame:
    """f(table of a bucket's rows) of each bucket, in as many tasks as the buckets ask for."""

    def run(table: pa.Table) -> pa.Table:
        release()  # of the bucket before
        return f(table)

    return dealt.repartition(-(-buckets // BUCKETS_A_TASK), "bucket").groupBy("bucket").applyInArrow(run, schema)


def text_bytes(docs: DataFrame, text_col: str) -> int:
    return docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0


def by_key(keys: np.ndarray, buckets: int) -> np.ndarray:
    return ((keys >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)


def by_document(docs: np.ndarray, buckets: int) -> np.ndarray:
    return by_key(mix(docs.astype(np.uint64)), buckets)


def deal(section: int, bucket: np.ndarray, docs: np.ndarray, keys: np.ndarray, more: np.ndarray | None = None) -> list[tuple[int, int, bytes]]:
    """Rows of SCHEMA; more: a second half of each key."""
    if not docs.size:
        return []
    order = np.lexsort((docs, bucket))
    bucket, docs, keys = bucket[order], docs[order], keys[order]
    more = None if more is None else more[order]
    edges = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])).tolist() + [bucket.size]
    out = []
    for a, b in zip(edges, edges[1:]):
        d = docs[a:b]
        first = np.flatnonzero(np.append(True, d[1:] != d[:-1]))
        counts = np.diff(np.append(first, d.size)).astype(np.uint32)
        head = np.array([first.size, d.size, more is not None], np.int64)
        parts = [head, d[first].astype(np.int64), counts, keys[a:b]] + ([more[a:b]] if more is not None else [])
        out.append((int(bucket[a]), section, b"".join(p.tobytes() for p in parts)))
    return out


def rows(dealt: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    cols = list(zip(*dealt)) or [[], [], []]
    return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.binary())], ["bucket", "section", "blob"])


def gather(table: pa.Table, section: int) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    """(documents, keys, second halves) of all of a bucket's entries of a section."""
    docs, keys, more = [], [], []
    for s, blob in zip(table["section"].to_pylist(), table["blob"]):
        if s != section:
            continue
        data = blob.as_buffer()
        n, m, two = np.frombuffer(data, np.int64, 3).tolist()
        d, c = np.frombuffer(data, np.int64, n, 24), np.frombuffer(data, np.uint32, n, 24 + 8 * n)
        at = 24 + 12 * n
        docs.append(np.repeat(d, c))
        keys.append(np.frombuffer(data, np.uint64, m, at))
        if two:
            more.append(np.frombuffer(data, np.uint64, m, at + 8 * m))
    if not docs:
        return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.uint64)
    return np.concatenate(docs), np.concatenate(keys), np.concatenate(more) if more else None


def answers(docs: np.ndarray, keys: np.ndarray) -> pa.Table:
    """Rows of ANSWERS: each document's keys."""
    order = np.argsort(docs, kind="stable")
    docs, raw = docs[order], keys[order].tobytes()
    first = np.flatnonzero(np.append(True, docs[1:] != docs[:-1])) if docs.size else np.empty(0, np.int64)
    edges = (8 * np.append(first, docs.size)).tolist()
    return pa.table([pa.array(docs[first], pa.int64()), pa.array([raw[a:b] for a, b in zip(edges, edges[1:])], pa.binary())], ["doc_id", "blob"])


def of_documents(answered: DataFrame) -> DataFrame:
    """doc_id, blobs: all of a document's answers (as many as it has words at most)."""
    return answered.groupBy("doc_id").agg(F.collect_list("blob").alias("blobs"))


def keys_of(blobs: list[bytes] | None) -> np.ndarray:
    """The sorted keys of a document's answers."""
    return np.unique(np.concatenate([np.frombuffer(b, np.uint64) for b in blobs])) if blobs else np.empty(0, np.uint64)


def contains(sorted_keys: np.ndarray, keys: np.ndarray) -> np.ndarray:
    if not sorted_keys.size:
        return np.zeros(keys.size, bool)
    at = np.searchsorted(sorted_keys, keys)
    at[at == sorted_keys.size] = 0
    return sorted_keys[at] == keys
