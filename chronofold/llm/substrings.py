"""Substring deduplication with difference-cover anchors.

A window is LENGTH = 13 words. Two copies of a window at word places i and j have, for some k < 7, both i + k and
j + k in the cover {0, 1, 3} modulo 7, as the cover's differences reach every residue. So both copies hold an equal
anchor, the 7 words from that place, and only anchors at cover places (three of seven) are hashed and compared:

1. Anchors that more than one document holds are found and sent back to their documents.
2. Each document extends them to the windows that hold such an anchor, and only those windows' 128-bit hashes are
   compared; a window that starts in a document with a smaller id is sent back as removable.
3. Each document drops the words that its removable windows cover, judged on the input.

Batches answer what they can see themselves and send one entry of each key on, so a key that a third of all documents
share stays a row of each batch. Exact but for collisions of 128-bit hashes (of 64-bit word hashes).

Defined results: a null text has no words; documents of fewer than 13 words lose none; rows that repeat an id count as
one document (they never remove words of each other) and get a row each; other columns are ignored (clean() keeps
them); an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronofold.llm import dealing
from chronofold.llm import words as W
from chronofold.llm.session import bounded_batches, forget, store

LENGTH, PERIOD, COVER = 13, 7, (0, 1, 3)
ANCHOR = LENGTH - PERIOD + 1
IN_COVER = np.isin(np.arange(PERIOD), COVER)
#: Bytes of text whose entries are dealt at once.
DEAL_BYTES = 4 << 20


def _places(block: W.Block, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word numbers, texts, places in the text) of all starts of width words within a text."""
    owner = block.owners()
    at = np.arange(owner.size)
    ok = at + width <= block.first[1:][owner]
    at, owner = at[ok], owner[ok]
    return at, owner, at - block.first[owner]


def _anchors(block: W.Block, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word numbers, texts, hashes) of the anchors of texts that hold a window."""
    at, owner, place = _places(block, ANCHOR)
    ok = IN_COVER[place % PERIOD] & (block.counts[owner] >= LENGTH)
    return at[ok], owner[ok], W.windows(hashes, ANCHOR, 0)[at[ok]]


def _distinct(docs: np.ndarray, *keys: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct (keys, document) entries, sorted by keys, then document."""
    order = np.lexsort((docs, *keys[::-1]))
    docs, keys = docs[order], [k[order] for k in keys]
    if docs.size:
        same = docs[1:] == docs[:-1]
        for k in keys:
            same &= k[1:] == k[:-1]
        keep = np.append(True, ~same)
        docs, keys = docs[keep], [k[keep] for k in keys]
    return docs, *keys


def _heads(*keys: np.ndarray) -> np.ndarray:
    """Where a new key begins in sorted keys."""
    if not keys[0].size:
        return np.zeros(0, bool)
    return np.append(True, np.logical_or.reduce([k[1:] != k[:-1] for k in keys]))


def _find_anchors(buckets: int):
    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for a, b, block in W.blocks(batch.column(1), W.BLANKS, False, DEAL_BYTES):
                _, owner, key = _anchors(block, block.hashes())
                docs, key = _distinct(ids[a:b][owner], key)
                head = _heads(key)
                group = np.cumsum(head) - 1
                many = np.bincount(group)[group] > 1 if key.size else head
                out = dealing.deal(0, dealing.by_key(key[head], buckets), docs[head], key[head])
                out += dealing.deal(1, dealing.by_document(docs[many], buckets), docs[many], key[many])
                yield dealing.rows(out)

    return run


def _shared_anchors(table: pa.Table) -> pa.Table:
    docs, key, _ = dealing.gather(table, 0)
    docs, key = _distinct(docs, key)
    head = _heads(key)
    group = np.cumsum(head) - 1
    many = np.bincount(group)[group] > 1 if key.size else head
    known_docs, known, _ = dealing.gather(table, 1)
    return dealing.answers(np.concatenate([docs[many], known_docs]), np.concatenate([key[many], known]))


def _find_windows(buckets: int):
    def run(batches):
        for batch in batches:
            ids, blobs = batch.column(0).to_numpy(zero_copy_only=False), batch.column(2)
            for a, b, block in W.blocks(batch.column(1), W.BLANKS, False, DEAL_BYTES):
                hashes = block.hashes()
                at, owner, key = _anchors(block, hashes)
                flagged = np.zeros(hashes.size + 1, np.int64)
                edges = np.searchsorted(owner, np.arange(b - a + 1))
                for d in np.unique(owner).tolist():
                    got = dealing.keys_of(blobs[a + d].as_py())
                    part = slice(edges[d], edges[d + 1])
                    flagged[at[part][dealing.contains(got, key[part])] + 1] = 1
                before = np.cumsum(flagged)  # flagged anchors before each word
                at, owner, _ = _places(block, LENGTH)
                ok = before[at + PERIOD] > before[at]
                at, owner = at[ok], owner[ok]
                one, two = (W.windows(hashes, LENGTH, s)[at] for s in (1, 2))
                docs, one, two = _distinct(ids[a:b][owner], one, two)
                head = _heads(one, two)
                out = dealing.deal(0, dealing.by_key(one[head], buckets), docs[head], one[head], two[head])
                out += dealing.deal(1, dealing.by_document(docs[~head], buckets), docs[~head], one[~head])
                yield dealing.rows(out)

    return run


def _removable(table: pa.Table) -> pa.Table:
    docs, one, two = _distinct(*dealing.gather(table, 0))
    later = ~_heads(one, two)  # the first of a key has the smallest id
    known_docs, known, _ = dealing.gather(table, 1)
    return dealing.answers(np.concatenate([docs[later], known_docs]), np.concatenate([one[later], known]))


def kept_words(block: W.Block, hashes: np.ndarray, d: int, removable: np.ndarray) -> np.ndarray:
    """Which words of text d stay."""
    lo, hi = int(block.first[d]), int(block.first[d + 1])
    keep = np.ones(hi - lo, bool)
    if removable.size and hi - lo >= LENGTH:
        hit = np.flatnonzero(dealing.contains(removable, W.windows(hashes[lo:hi], LENGTH, 1)))
        cover = np.zeros(hi - lo + 1, np.int64)
        np.add.at(cover, hit, 1)
        np.add.at(cover, hit + LENGTH, -1)
        keep = np.cumsum(cover)[:-1] == 0
    return keep


def removable_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and blobs of the hashes of a document's removable windows."""
    bounded_batches(docs.sparkSession)
    slim = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")).where(F.col("doc_id").isNotNull())
    words = dealing.text_bytes(slim, "text") / 6
    buckets = dealing.buckets_for(words * len(COVER) / PERIOD)
    shared = dealing.in_buckets(slim.mapInArrow(_find_anchors(buckets), dealing.SCHEMA), buckets, _shared_anchors, dealing.ANSWERS)
    shared = store(shared, "anchors")
    held = slim.join(dealing.of_documents(shared), "doc_id").select("doc_id", "text", "blobs")
    removable = dealing.in_buckets(held.mapInArrow(_find_windows(buckets), dealing.SCHEMA), buckets, _removable, dealing.ANSWERS)
    removable = store(removable, "windows")
    forget(shared)
    return dealing.of_documents(removable)


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and, if asked for, kept_text: the words that stay, joined by one space."""
    removable = removable_windows(docs, id_col, text_col)
    slim = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches):
        for batch in batches:
            blobs, counts, gone, sums, texts = batch.column(2), [], [], [], []
            for a, b, block in W.blocks(batch.column(1), W.BLANKS, False):
                edges, hashes, whole = block.first.tolist(), None, block.raw.tobytes()
                for d in range(b - a):
                    lo, hi = edges[d], edges[d + 1]
                    got = dealing.keys_of(blobs[a + d].as_py())
                    if got.size:
                        hashes = block.hashes() if hashes is None else hashes
                        keep = lo + np.flatnonzero(kept_words(block, hashes, d, got))
                        words = [whole[s:e] for s, e in zip(block.start[keep].tolist(), block.end[keep].tolist())]
                    else:
                        words = whole[block.start[lo] : block.end[hi - 1]].split() if hi > lo else []
                    text = b" ".join(words)
                    counts.append(hi - lo)
                    gone.append(hi - lo - len(words))
                    sums.append(hashlib.sha256(text).hexdigest())
                    texts.append(text.decode() if with_text else "")
            cols = [batch.column(0), pa.array(counts, pa.int64()), pa.array(gone, pa.int64()), pa.array(sums, pa.string())] + [pa.array(texts, pa.string())] * with_text
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n_words", "n_removed", "kept_sha256"] + ["kept_text"] * with_text)

    schema = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string" + ", kept_text string" * with_text
    return slim.join(removable, "doc_id", "left").select("doc_id", "text", "blobs").mapInArrow(run, schema)
