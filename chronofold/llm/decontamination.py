"""Benchmark decontamination with a generalised suffix automaton of the normalised test items.

A-Z are lower-cased; words are runs of letters, digits and everything beyond ASCII. The automaton accepts every run
of words of every item; streaming a document's words through it keeps the longest match that ends at each word.
A word is hit where a match of LENGTH words (or a whole item of fewer words) covers it. Words that no item has, and
neighbours that no item has side by side, end any match, so only runs of known neighbours that are long enough to
hold a window are streamed; the rest of the text is passed over in numpy.

The benchmark is split into shards of about SHARD_WORDS words, each built by a task. The driver passes them on one after
another as the bytes that came from the task, and holds one at a time; a document's words meet one shard after the other.

Defined results: a null or empty text or item has no words (no hit, no window); a repeated item counts once by its
id; repeated documents get a row each; an empty benchmark hits nothing; other columns stay as they are.
"""

from __future__ import annotations

import hashlib
import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronofold.llm import words as W
from chronofold.llm.session import bounded_batches, release

LENGTH = 10
SHARD_WORDS = 50_000
#: Bytes of a word and what parts it from the next, as a guess that the number of shards follows from.
WORD_BYTES = 6
#: Shards that a task keeps loaded; any further one is loaded anew for each batch.
KEPT_SHARDS = 4


class Automaton:
    """Generalised suffix automaton over word numbers; state 0 is the root."""

    def __init__(self, length: int):
        self.length = length
        self.next: dict[int, int] = {}
        self.edges: list[list[int]] = [[]]  # words that leave each state; only while building
        self.size, self.link = [0], [-1]
        self.number: dict[int, int] = {}  # of a word's hash
        self.pairs: set[int] = set()
        self.texts: list[tuple[str, list[int]]] = []
        self.least = length

    def _copy(self, of: int, size: int) -> int:
        new = len(self.size)
        self.size.append(size)
        self.link.append(self.link[of])
        self.edges.append(list(self.edges[of]))
        for c in self.edges[of]:
            self.next[new << 32 | c] = self.next[of << 32 | c]
        return new

    def _extend(self, last: int, c: int) -> int:
        nxt, size, link = self.next, self.size, self.link

        def split(p: int, q: int) -> int:
            if size[q] == size[p] + 1:
                return q
            clone = self._copy(q, size[p] + 1)
            link[q] = clone
            while p >= 0 and nxt.get(p << 32 | c) == q:
                nxt[p << 32 | c] = clone
                p = link[p]
            return clone

        if (q := nxt.get(last << 32 | c)) is not None:
            return split(last, q)
        new = len(size)
        size.append(size[last] + 1)
        link.append(0)
        self.edges.append([])
        p = last
        while p >= 0 and (p << 32 | c) not in nxt:
            nxt[p << 32 | c] = new
            self.edges[p].append(c)
            p = link[p]
        if p >= 0:
            link[new] = split(p, nxt[p << 32 | c])
        return new

    def add(self, item: str, hashes: list[int]) -> None:
        ids = [self.number.setdefault(h, len(self.number)) for h in hashes]
        self.pairs.update(a << 32 | b for a, b in zip(ids, ids[1:]))
        self.least = min(self.least, len(ids))
        self.texts.append((item, ids))
        last = 0
        for c in ids:
            last = self._extend(last, c)

    def finish(self) -> "Automaton":
        """Per state: the items whose windows of full length end there, short items that end there, the next state up the links with one."""
        n, length = len(self.size), self.length
        self.items: list[set[str]] = [set() for _ in range(n)]
        self.short: list[dict[int, set[str]]] = [{} for _ in range(n)]
        for item, ids in self.texts:
            state = 0
            for at, c in enumerate(ids, 1):
                state = self.next[state << 32 | c]
                if at >= length:
                    self.items[self.window(state)].add(item)
            if len(ids) < length:
                while self.size[self.link[state]] >= len(ids):
                    state = self.link[state]
                self.short[state].setdefault(len(ids), set()).add(item)
        self.up = [-1] * n  # nearest state above that a short item ends in
        for s in sorted(range(1, n), key=self.size.__getitem__):
            p = self.link[s]
            self.up[s] = p if self.short[p] else self.up[p]
        self.hashes = np.array(sorted(self.number), np.uint64)
        self.of_hash = np.array([self.number[int(h)] for h in self.hashes], np.int64)
        self.known_pairs = np.array(sorted(self.pairs), np.int64)
        del self.edges, self.pairs, self.number, self.texts
        return self

    def window(self, state: int) -> int:
        """The state of the last `length` words of what state stands for."""
        while self.size[self.link[state]] >= self.length:
            state = self.link[state]
        return state

    def match(self, ids: list[int]) -> tuple[list[tuple[int, int]], set[str]]:
        """(from, to) ranges that windows cover, and the windows' items."""
        nxt, size, link, ranges, items = self.next, self.size, self.link, [], set()
        state = matched = 0
        for at, c in enumerate(ids, 1):
            while state and (state << 32 | c) not in nxt:
                state = link[state]
                matched = size[state]
            got = nxt.get(state << 32 | c)
            if got is None:
                continue
            state, matched = got, matched + 1
            if matched >= self.length:
                ranges.append((at - self.length, at))
                items |= self.items[self.window(state)]
            s = state if self.short[state] else self.up[state]
            while s > 0:
                for m, found in self.short[s].items():
                    if m <= matched:
                        ranges.append((at - m, at))
                        items |= found
                s = self.up[s]
        return ranges, items

    def hits(self, hashes: np.ndarray, first: np.ndarray) -> list[tuple[int, np.ndarray, set[str]]]:
        """(text, numbers of hit words, items) of texts with a hit, out of a block's."""
        if not hashes.size or not self.hashes.size:
            return []
        at = np.searchsorted(self.hashes, hashes)
        at[at == self.hashes.size] = 0
        known = self.hashes[at] == hashes
        places = np.flatnonzero(known)
        if not places.size:
            return []
        ids = self.of_hash[at[places]]
        owner = np.searchsorted(first, places, "right") - 1
        joined = (np.diff(places) == 1) & (np.diff(owner) == 0)
        if self.known_pairs.size:
            pair = ids[:-1] << 32 | ids[1:]
            k = np.searchsorted(self.known_pairs, pair)
            k[k == self.known_pairs.size] = 0
            joined &= self.known_pairs[k] == pair
        else:
            joined[:] = False
        starts = np.flatnonzero(np.append(True, ~joined))
        lengths = np.diff(np.append(starts, places.size))
        found: dict[int, tuple[list, set]] = {}
        for run in np.flatnonzero(lengths >= self.least).tolist():
            i, j = int(starts[run]), int(starts[run] + lengths[run])
            ranges, items = self.match(ids[i:j].tolist())
            if ranges:
                base = int(places[i])
                spans, all_items = found.setdefault(int(owner[i]), ([], set()))
                spans += [(base + a, base + b) for a, b in ranges]
                all_items |= items
        return [(d, np.unique(np.concatenate([np.arange(a, b) for a, b in spans])), items) for d, (spans, items) in sorted(found.items())]


def shards(benchmark: DataFrame, length: int = LENGTH, item_col: str = "item_id", text_col: str = "text"):
    """Automata over the benchmark's items, pickled, about SHARD_WORDS words or one item each. A task builds each."""
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).alias("text")).where("item IS NOT NULL AND text IS NOT NULL").distinct()
    n = max(1, -(-(items.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // (WORD_BYTES * SHARD_WORDS)))

    def build(table: pa.Table) -> pa.Table:
        made = Automaton(length)
        for at, _, block in W.blocks(table["text"], W.MARKS, True):
            hashes, first = block.hashes().tolist(), block.first.tolist()
            for d, item in enumerate(table["item"].slice(at, block.n).to_pylist()):
                if first[d] < first[d + 1]:
                    made.add(item, hashes[first[d] : first[d + 1]])
        return pa.table([pa.array([pickle.dumps(made.finish())], pa.binary())], ["automaton"])

    dealt = items.withColumn("shard", F.pmod(F.xxhash64("item", "text"), F.lit(n)).cast("int")).repartition(n, "shard")
    for row in dealt.groupBy("shard").applyInArrow(build, "automaton binary").toLocalIterator():
        yield bytes(row[0])


def _scan(docs: DataFrame, benchmark: DataFrame, length: int, text_col: str, make, schema):
    """make(batch, per text (n_words, hit words' numbers in the text, items, spans of bytes)) -> RecordBatch."""
    spark = docs.sparkSession
    bounded_batches(spark)
    sent = [spark.sparkContext.broadcast(automaton) for automaton in shards(benchmark, length)]

    def run(batches):
        held: dict[int, Automaton] = {}
        for batch in batches:
            results = [(0, np.empty(0, np.int64), set(), None, None)] * batch.num_rows
            parts = list(W.blocks(batch.column(text_col), W.MARKS, True))
            for at, _, block in parts:
                for d, n in enumerate(block.counts.tolist()):
                    results[at + d] = (n, np.empty(0, np.int64), set(), None, None)
            for number, shipped in enumerate(sent):
                if (automaton := held.get(number)) is None:
                    automaton = pickle.loads(shipped.value)
                    del shipped._value
                    if number < KEPT_SHARDS:
                        held[number] = automaton
                for at, _, block in parts:
                    for d, hit, items in automaton.hits(block.hashes(), block.first):
                        n, before, old, _, _ = results[at + d]
                        lo = int(block.first[d])
                        results[at + d] = (n, np.union1d(before, hit - lo), old | items, block, d)
                del automaton
            yield make(batch, results)
        release()

    return docs.mapInArrow(run, schema)


def report(docs: DataFrame, benchmark: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_words, n_hit, n_items, items_sha256, contaminated of each document."""
    kind = docs.schema[id_col].dataType.simpleString()

    def make(batch, results):
        ids = [hashlib.sha256(",".join(sorted(r[2])).encode()).hexdigest() for r in results]
        cols = [batch.column(id_col), pa.array([r[0] for r in results], pa.int64()), pa.array([len(r[1]) for r in results], pa.int64()), pa.array([len(r[2]) for r in results], pa.int64()), pa.array(ids, pa.string()), pa.array([len(r[1]) > 0 for r in results], pa.bool_())]
        return pa.RecordBatch.from_arrays(cols, [id_col, "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])

    return _scan(docs.select(id_col, text_col), benchmark, length, text_col, make, f"`{id_col}` {kind}, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean")


def clean(docs: DataFrame, benchmark: DataFrame, length: int = LENGTH, max_coverage: float = 0.5, text_col: str = "text", size_col: str | None = "n_chars") -> DataFrame:
    """docs without the spans of hit words (from a run's first word to its last), and without documents of which
    more than max_coverage of the words are hit. size_col, if there is one, is set to the characters left."""
    names = docs.columns

    def make(batch, results):
        texts, keep = batch.column(text_col).to_pylist(), []
        for i, (n, hit, _, block, d) in enumerate(results):
            keep.append(len(hit) <= max_coverage * n)
            if not len(hit) or not keep[-1]:
                continue
            w = hit + int(block.first[d])
            cuts = np.flatnonzero(np.diff(w) != 1)
            begin, end = block.start[w[np.append(0, cuts + 1)]], block.end[w[np.append(cuts, w.size - 1)]]
            # the text's own bytes lie between its neighbours' in the block
            raw, at, out = texts[i].encode(), int(block.bounds[d]), []
            last = 0
            for a, b in zip((begin - at).tolist(), (end - at).tolist()):
                out.append(raw[last:a])
                last = b
            texts[i] = b"".join([*out, raw[last:]]).decode()
        cols = list(batch.columns)
        cols[names.index(text_col)] = pa.array(texts, pa.string())
        if size_col in names:
            i = names.index(size_col)
            cols[i] = pa.array([None if t is None else len(t) for t in texts], batch.schema.field(i).type)
        return pa.RecordBatch.from_arrays(cols, names).filter(pa.array(keep, pa.bool_()))

    return _scan(docs, benchmark, length, text_col, make, docs.schema)
