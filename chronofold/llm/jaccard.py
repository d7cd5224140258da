"""N-gram Jaccard similarity join with PartEnum signatures, and the groups it links.

A text's set is its distinct shingles of WIDTH words. Sets of size a <= b can only reach the similarity if
a >= 0.75 b, and then differ in at most (a + b) / 7 elements. Sizes are cut into bands; a band's sets, together with
the sets a little larger that they may link with, share one partition of the element domain into n parts. A set that
may differ from its partners in k elements agrees with each on all but k parts. The subset of a set that falls into
one part is a signature, a hash; a set with v parts that are not empty agrees with any partner on at least v - k of
those. There are more parts than elements, so that what unrelated texts have in common rarely makes up v - k of them.
Signatures are therefore counted first, and each set keeps, of those that another set has too, all but its
v - k - 1 most frequent ones: two linked sets still share one, and what many unrelated texts have in common drops out.
A set with v <= k also signs its empty parts and keeps all.

Sets that share a kept signature form a group. Each group's members are verified against its first one, and links are
joined to components; in groups that still hold several components all members are compared in blocks, without a row
per pair. A group of a signature that SPLIT sets or more have is dealt out by its members: each slice is verified
against a first member of its own, and those against the first of them. Every verification counts the intersection
exactly. Texts with equal sets are one node throughout (a 64-bit hash of the set), so copies cost nothing.

Defined results: a null text or one without words has an empty set, is linked with nothing and its own component; a
text of fewer than WIDTH words has one shingle, all of it; rows that repeat an id are documents of their own under one
id; a null id is no candidate for the smallest one, and a component without an id has a null component_id; other
columns are ignored (keep_first() keeps them); an empty table gives an empty table.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronofold.llm import dealing
from chronofold.llm import words as W
from chronofold.llm.components import components
from chronofold.llm.session import bounded_batches, forget, release, store

WIDTH, NUMERATOR, DENOMINATOR = 5, 3, 4
#: Bytes of sets in a block that is compared with others, pairs of it and occurrences that are looked at at once.
BLOCK_BYTES, COMPARED, OCCURRENCES = 1 << 20, 1 << 18, 1 << 20
#: Bytes of texts whose signatures are made at once.
SIGN_BYTES = 1 << 20
#: Parts beyond the largest size of a band, so that what many texts share lies in parts of its own.
SPARE = 30
#: Sets of one batch that share a signature make it one of the most frequent everywhere, without counting on.
HOT = 64
HOT_COUNT = (1 << 16) - 1
#: A signature of so many sets has its group dealt out by member; values that a join on a group, which may be large, is salted with.
SPLIT, SALTS = 4096, 16
#: Kinds of rows that groups give out: a pair to verify, a member of a group, the first member of a slice of a group.
PAIR, MEMBER, SLICE = range(3)


@lru_cache(maxsize=4096)
def band(j: int) -> tuple[int, int, int]:
    """Of band j: smallest and largest size of the smaller set, and the number of parts."""
    low = 1
    for _ in range(j):
        low = max(low + 1, low * DENOMINATOR // NUMERATOR)
    top = max(low + 1, low * DENOMINATOR // NUMERATOR) - 1
    return low, top, top + min(top, SPARE)


def most_different(size: int, top: int) -> int:
    """In how many elements a set may differ from any it links with in a band whose smaller sets have up to top elements."""
    partner = top if size > top else size * DENOMINATOR // NUMERATOR
    return (size + partner) * (DENOMINATOR - NUMERATOR) // (DENOMINATOR + NUMERATOR)


@lru_cache(maxsize=1 << 16)
def bands(size: int) -> tuple[int, ...]:
    """The bands that a set takes part in: its own, and those below whose sets may link with it."""
    j = 0
    while band(j)[1] < size:
        j += 1
    out = [j]
    while j and band(j - 1)[1] * DENOMINATOR // NUMERATOR >= size:
        j -= 1
        out.append(j)
    return tuple(out)


def shingles(block: W.Block) -> tuple[np.ndarray, np.ndarray]:
    """(text, shingle) of all sets, distinct, sorted by text."""
    hashes, counts = block.hashes(), block.counts
    owner = block.owners()
    at = np.arange(owner.size)
    full = at + WIDTH <= block.first[1:][owner]
    full = at[full]
    value, text = W.windows(hashes, WIDTH, 0)[full], owner[full]
    few = np.flatnonzero((counts > 0) & (counts < WIDTH))
    if few.size:
        extra = [W.windows(hashes[block.first[d] : block.first[d + 1]], int(counts[d]), int(counts[d]))[:1] for d in few.tolist()]
        value, text = np.concatenate([value, *extra]), np.concatenate([text, few])
    order = np.lexsort((value, text))
    value, text = value[order], text[order]
    if value.size:
        keep = np.append(True, (value[1:] != value[:-1]) | (text[1:] != text[:-1]))
        value, text = value[keep], text[keep]
    return text, value


def nodes(text: np.ndarray, value: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(size, node) of each text's set; the node is a hash of the set."""
    size = np.bincount(text, minlength=n).astype(np.int64)
    total = np.zeros(n, np.uint64)
    np.add.at(total, text, W.mix(value ^ np.uint64(0x51ED270B7F3C2A95)))
    return size, W.mix(total + size.astype(np.uint64)).view(np.int64)


def signatures(size: np.ndarray, text: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int, int]]]:
    """(text, signature) of all sets, and (text, band % 4, guaranteed agreements) of each set and band. A signature's two lowest bits are its band % 4."""
    first = np.concatenate([[0], np.cumsum(size)])
    jobs: list[tuple[int, int]] = [(d, j) for d in np.flatnonzero(size).tolist() for j in bands(int(size[d]))]
    if not jobs:
        return np.empty(0, np.int64), np.empty(0, np.uint64), []
    who, which = np.array([d for d, _ in jobs]), np.array([j for _, j in jobs])
    parts = np.array([band(j)[2] for _, j in jobs])
    differ = np.array([most_different(int(size[d]), band(j)[1]) for d, j in jobs])
    base = np.concatenate([[0], np.cumsum(parts)])
    reach = size[who]
    job = np.repeat(np.arange(len(jobs)), reach)
    element = np.arange(job.size) - np.repeat(np.cumsum(reach) - reach, reach) + first[who][job]
    h = W.mix(value[element] + which[job].astype(np.uint64) * np.uint64(0xD1342543DE82EF95))
    cell = base[job] + ((h >> np.uint64(32)) * parts[job].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
    total, filled = np.zeros(base[-1], np.uint64), np.zeros(base[-1], bool)
    np.add.at(total, cell, W.mix(h ^ np.uint64(0x2545F4914F6CDD1D)))
    filled[cell] = True
    owner = np.repeat(np.arange(len(jobs)), parts)
    sure = np.add.reduceat(filled, base[:-1], dtype=np.int64) - differ
    signed = filled | (sure <= 0)[owner]
    place = (np.arange(base[-1]) - base[owner]).astype(np.uint64)
    code = which[owner].astype(np.uint64) << np.uint64(32) | place << np.uint64(1) | filled.astype(np.uint64)
    key = W.mix(total ^ W.mix(code)) & ~np.uint64(3) | (which[owner] % 4).astype(np.uint64)
    meta = list(zip(who.tolist(), (which % 4).tolist(), np.maximum(sure, 1).tolist()))
    return who[owner][signed], key[signed], meta


def _profile(batches):
    """Rows of doc_id, row, node, n and, for each band, band % 4 and the guaranteed agreements."""
    for batch in batches:
        for a, b, block in W.blocks(batch.column(2), W.BLANKS, True, SIGN_BYTES):
            text, value = shingles(block)
            size, node = nodes(text, value, b - a)
            _, _, meta = signatures(size, text, value)
            sure: list[list[int]] = [[] for _ in range(b - a)]
            for d, j, r in meta:
                sure[d] += [j, r]
            own = [batch.column(c).slice(a, b - a) for c in range(2)]
            yield pa.RecordBatch.from_arrays([*own, pa.array(node, pa.int64()), pa.array(size, pa.int64()), pa.array(sure, pa.list_(pa.int32()))], ["doc_id", "row", "node", "n", "sure"])
    release()


def _sign(buckets: int):
    def run(batches):
        for batch in batches:
            for a, b, block in W.blocks(batch.column(0), W.BLANKS, True, SIGN_BYTES):
                text, value = shingles(block)
                size, node = nodes(text, value, b - a)
                once = np.zeros(b - a, bool)
                once[np.unique(node, return_index=True)[1]] = True
                keep = once[text]
                size = np.where(once, size, 0)
                who, key, _ = signatures(size, text[keep], value[keep])
                who = node[who]
                order = np.argsort(key, kind="stable")
                who, key = who[order], key[order]
                head = np.append(True, key[1:] != key[:-1]) if key.size else np.zeros(0, bool)
                group = np.cumsum(head) - 1
                hot = np.bincount(group)[group] >= HOT if key.size else head
                marks = key[hot & head]
                out = dealing.deal(0, dealing.by_key(key[~hot], buckets), who[~hot], key[~hot])
                out += dealing.deal(1, dealing.by_document(who[hot], buckets), who[hot], key[hot])
                out += dealing.deal(2, dealing.by_key(marks, buckets), np.zeros(marks.size, np.int64), marks)
                yield dealing.rows(out)
        release()

    return run


def is_split(key: np.ndarray) -> np.ndarray:
    """Whether keys as ordered() makes them are of groups that are dealt out by member."""
    return key >> np.uint64(48) >= np.uint64(SPLIT)


def ordered(key: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Keys that sort by frequency first; their two lowest bits stay."""
    return np.minimum(count, HOT_COUNT).astype(np.uint64) << np.uint64(48) | (key >> np.uint64(18)) << np.uint64(2) | key & np.uint64(3)


def _count(table: pa.Table) -> pa.Table:
    who, key, _ = dealing.gather(table, 0)
    order = np.lexsort((who, key))
    who, key = who[order], key[order]
    if key.size:
        keep = np.append(True, (key[1:] != key[:-1]) | (who[1:] != who[:-1]))
        who, key = who[keep], key[keep]
    head = np.append(True, key[1:] != key[:-1]) if key.size else np.zeros(0, bool)
    group = np.cumsum(head) - 1
    count = np.bincount(group)[group] if key.size else np.empty(0, np.int64)
    marked = dealing.contains(np.unique(dealing.gather(table, 2)[1]), key)
    count = np.where(marked, HOT_COUNT, count)
    shared = count > 1
    hot_who, hot, _ = dealing.gather(table, 1)
    keys = np.concatenate([ordered(key[shared], count[shared]), ordered(hot, np.full(hot.size, HOT_COUNT))])
    return dealing.answers(np.concatenate([who[shared], hot_who]), keys)


def _keep(buckets: int):
    """Of each set, the kept signatures; those of very many sets go by the set, so that no bucket gets all of a group."""

    def run(batches):
        for batch in batches:
            who, key = [], []
            for node, blobs, sure in zip(*(batch.column(c).to_pylist() for c in range(3))):
                keys = dealing.keys_of(blobs)
                code = keys & np.uint64(3)
                for j, r in zip(sure[0::2], sure[1::2]):
                    own = keys[code == j]
                    if own.size >= r:
                        own = own[: own.size - r + 1]
                        key.append(own)
                        who.append(np.full(own.size, node))
            if key:
                who, key = np.concatenate(who), np.concatenate(key)
                bucket = np.where(is_split(key), dealing.by_document(who, buckets), dealing.by_key(W.mix(key), buckets))
                yield dealing.rows(dealing.deal(0, bucket, who, key))
        release()

    return run


def _groups(table: pa.Table) -> pa.Table:
    """kind, a, b: PAIRs of every group's first member with the others; MEMBERs (signature, set) of groups of three or
    more, and SLICEs (signature, first member here) of groups that other buckets hold parts of."""
    who, key, _ = dealing.gather(table, 0)
    order = np.lexsort((W.mix(who.view(np.uint64)), key))
    who, key = who[order], key[order]
    if key.size:
        keep = np.append(True, (key[1:] != key[:-1]) | (who[1:] != who[:-1]))
        who, key = who[keep], key[keep]
    head = np.append(True, key[1:] != key[:-1]) if key.size else np.zeros(0, bool)
    group = np.cumsum(head) - 1
    size = np.bincount(group)[group] if key.size else np.empty(0, np.int64)
    pivot = who[np.flatnonzero(head)][group] if key.size else who
    x, y = np.minimum(pivot, who)[~head], np.maximum(pivot, who)[~head]
    if x.size:
        order = np.lexsort((y, x))
        x, y = x[order], y[order]
        keep = np.append(True, (x[1:] != x[:-1]) | (y[1:] != y[:-1]))
        x, y = x[keep], y[keep]
    apart = is_split(key)
    many, first = (size > 2) | apart, head & apart
    kind = np.repeat(np.array([PAIR, MEMBER, SLICE], np.int32), [x.size, int(many.sum()), int(first.sum())])
    a, b = np.concatenate([x, key[many].view(np.int64), key[first].view(np.int64)]), np.concatenate([y, who[many], who[first]])
    return pa.table([pa.array(kind), pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["kind", "a", "b"])


def _sets(batches):
    for batch in batches:
        for a, b, block in W.blocks(batch.column(0), W.BLANKS, True):
            text, value = shingles(block)
            size, node = nodes(text, value, b - a)
            edges, raw = (8 * np.concatenate([[0], np.cumsum(size)])).tolist(), value.tobytes()
            yield pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array([raw[i:j] for i, j in zip(edges, edges[1:])], pa.binary())], ["node", "set"])
    release()


def _verify(batches):
    for batch in batches:
        x, y = [], []
        for a, b, p, q in zip(*(batch.column(c) for c in range(4))):
            p, q = np.frombuffer(p.as_buffer(), np.uint64), np.frombuffer(q.as_buffer(), np.uint64)
            both = int(dealing.contains(p, q).sum())
            if DENOMINATOR * both >= NUMERATOR * (p.size + q.size - both):
                x.append(a.as_py())
                y.append(b.as_py())
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(y, pa.int64())], ["u", "v"])


def _linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """u, v of the pairs (a, b) that reach the similarity."""
    sizes = sets.select("node", "set", (F.octet_length("set") / 8).cast("bigint").alias("n"))
    left = pairs.join(sizes.select(F.col("node").alias("a"), F.col("set").alias("p"), F.col("n").alias("na")), "a")
    full = left.join(sizes.select(F.col("node").alias("b"), F.col("set").alias("q"), F.col("n").alias("nb")), "b")
    close = (F.least("na", "nb") * DENOMINATOR >= F.greatest("na", "nb") * NUMERATOR) & (F.col("na") > 0)
    return full.where(close).select("a", "b", "p", "q").mapInArrow(_verify, "u bigint, v bigint")


def _salted(left: DataFrame, right: DataFrame, key: str, by: str) -> DataFrame:
    """left joined with the one row of right that has its key; a key of very many rows of left is dealt out by another column."""
    salt = F.pmod(F.xxhash64(by, F.lit(31)), F.lit(SALTS)).cast("int")
    every = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return left.withColumn("_salt", salt).join(every, [key, "_salt"]).drop("_salt")


def link(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(doc_id, row, node, n of each row; node, label of linked nodes). row: a hash of id and text."""
    bounded_batches(docs.sparkSession)
    id_, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    slim = docs.select(id_.cast("bigint").alias("doc_id"), row_hash(id_, text).alias("row"), text.alias("text"))
    profile = store(slim.mapInArrow(_profile, "doc_id bigint, row bigint, node bigint, n bigint, sure array<int>"), "profile")
    total = profile.agg(F.sum("n")).first()[0] or 0
    buckets = dealing.buckets_for(0.9 * total)
    counted = dealing.in_buckets(slim.select("text").mapInArrow(_sign(buckets), dealing.SCHEMA), buckets, _count, dealing.ANSWERS)
    counted = store(counted, "signatures")
    of_node = profile.where("n > 0").groupBy("node").agg(F.first("sure").alias("sure"), F.min("row").alias("row"))
    held = dealing.of_documents(counted).join(of_node.select(F.col("node").alias("doc_id"), "sure"), "doc_id").select("doc_id", "blobs", "sure")
    met = dealing.in_buckets(held.mapInArrow(_keep(buckets), dealing.SCHEMA), buckets, _groups, "kind int, a bigint, b bigint")
    met = store(met, "groups")
    forget(counted)
    slices = met.where(F.col("kind") == SLICE).select(F.col("a").alias("key"), F.col("b").alias("node"))
    tops = slices.groupBy("key").agg(F.min("node").alias("top"))
    across = slices.join(tops, "key").where("node <> top").select(F.col("top").alias("a"), F.col("node").alias("b"))
    pairs = met.where(F.col("kind") == PAIR).select("a", "b").unionByName(across).distinct()
    members = met.where(F.col("kind") == MEMBER).select(F.col("a").alias("key"), F.col("b").alias("node"))
    touched = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    rows = touched.join(of_node.select("node", "row"), "node").select("row").distinct()
    sets = slim.join(rows, "row", "left_semi").select("text").mapInArrow(_sets, "node bigint, set binary")
    sets = store(sets.groupBy("node").agg(F.first("set").alias("set")), "sets")
    edges = store(_linked(pairs, sets), "edges")
    labels = components(edges)
    named = members.join(labels, "node", "left").select("key", "node", F.coalesce("label", "node").alias("label"))
    several = named.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi").select("key")
    named = store(_salted(named, several, "key", "node"), "open")
    if named.isEmpty():
        forget(met, sets, edges, named)
        return profile, labels
    across = store(_across(named, sets), "across")
    forget(met, sets, named, labels)
    labels = components(edges.unionByName(across))
    forget(edges, across)
    return profile, labels


def row_hash(id_: Column, text: Column) -> Column:
    return F.xxhash64(id_, text, id_.isNull(), text.isNull())


def _across(named: DataFrame, sets: DataFrame) -> DataFrame:
    """u, v: links between components within the groups (key, node, label), at least one for each two components that a
    group's members link.

    Groups overlap: each goes with its member that is in most groups, and groups that go with one member are compared
    as one. Its members are dealt to blocks of BLOCK_BYTES of sets, and every two blocks are compared in one task,
    which counts intersections from an inverted list and gives out links only, no pairs."""
    often = named.groupBy("node").agg(F.count(F.lit(1)).alias("keys"))
    lead = named.join(often, "node").groupBy("key").agg(F.max(F.struct("keys", "node"))["node"].alias("lead"))
    together = _salted(named, lead, "key", "node").select("lead", "node", "label").distinct()
    held = together.join(sets, "node")
    weight = held.groupBy("lead").agg(F.ceil(F.sum(F.octet_length("set")) / BLOCK_BYTES).cast("int").alias("blocks"))
    held = _salted(held, weight, "lead", "node").withColumn("block", F.pmod(F.xxhash64("node", F.lit(29)), "blocks").cast("int"))
    dealt = held.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("lead", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node", "label", "set")
    return dealt.groupBy("lead", "i", "j").applyInArrow(_compare, "u bigint, v bigint")


def _compare(table: pa.Table) -> pa.Table:
    node, label, block = (table[c].to_numpy() for c in ("node", "label", "block"))
    sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in table["set"]]
    i = table["i"][0].as_py()
    left = np.flatnonzero(block == i)
    right = left if i == table["j"][0].as_py() else np.flatnonzero(block != i)
    u, v = [], []
    if left.size and right.size:
        size = np.array([x.size for x in sets], np.int64)
        value, owner = np.concatenate([sets[k] for k in left]), np.repeat(np.arange(left.size), size[left])
        order = np.argsort(value, kind="stable")
        value, owner = value[order], owner[order]
        step = max(1, COMPARED // max(1, left.size))
        for at in range(0, right.size, step):
            part = right[at : at + step]
            asked, asker = np.concatenate([sets[k] for k in part]), np.repeat(np.arange(part.size), size[part])
            lo, hi = np.searchsorted(value, asked, "left"), np.searchsorted(value, asked, "right")
            n = hi - lo
            both = np.zeros(part.size * left.size, np.int64)
            ends = np.cumsum(n)
            begin = 0
            while begin < n.size:  # so many occurrences at once
                end = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + OCCURRENCES, "right")))
                k = n[begin:end]
                hit = owner[np.repeat(lo[begin:end] - (np.cumsum(k) - k), k) + np.arange(k.sum())]
                both += np.bincount(np.repeat(asker[begin:end], k) * left.size + hit, minlength=both.size)
                begin = end
            both = both.reshape(part.size, left.size)
            union = size[part][:, None] + size[left][None, :] - both
            x, y = np.nonzero((DENOMINATOR * both >= NUMERATOR * union) & (label[part][:, None] != label[left][None, :]))
            a, b = part[x], left[y]
            pair = np.stack([np.minimum(label[a], label[b]), np.maximum(label[a], label[b])])
            once = np.unique(pair, axis=1, return_index=True)[1]
            u.append(node[a[once]])
            v.append(node[b[once]])
    u, v = (np.concatenate(z) if z else np.empty(0, np.int64) for z in (u, v))
    return pa.table([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])


def _firsts(profile: DataFrame, labels: DataFrame) -> DataFrame:
    """node and first (none: whether the id is null, doc_id, row) of each node's component, the smallest."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first")
    of_node = profile.where("n > 0").groupBy("node").agg(first)
    linked = labels.select("node", "label").unionByName(labels.select(F.col("label").alias("node"), "label").distinct())
    least = linked.join(of_node, "node").groupBy("label").agg(F.min("first").alias("better"))
    better = _salted(linked, least, "label", "node").select("node", "better")
    return of_node.join(better, "node", "left").select("node", F.coalesce("better", "first").alias("first"))


def group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest id reachable by links) of each document."""
    profile, labels = link(docs, id_col, text_col)
    named = profile.join(_firsts(profile, labels), "node", "left")
    return named.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("component_id"))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of docs, all its columns, of each group: that with the smallest id.

    Rows without words are in no group and stay. A row with a null id stays only where its group has no other id, and
    then one of them does; of rows that repeat an id and belong to one group one text stays; and of rows that repeat
    both id and text one row."""
    profile, labels = link(docs, id_col, text_col)
    kept = _firsts(profile, labels).select(F.col("first.row").alias("_row")).unionByName(profile.where("n = 0").select(F.col("row").alias("_row")))
    kept = store(kept.distinct(), "kept")
    forget(profile, labels)
    own = [f"_c{i}" for i in range(len(docs.columns))]
    row = row_hash(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")).alias("_row")
    rows = docs.select(row, *[F.col(f"`{c}`").alias(o) for c, o in zip(docs.columns, own)]).join(kept, "_row", "left_semi")
    one = Window.partitionBy("_row").orderBy("_row")
    rows = rows.withColumn("_nth", F.row_number().over(one)).where("_nth = 1")
    return rows.select(*[F.col(o).alias(c) for c, o in zip(docs.columns, own)])
