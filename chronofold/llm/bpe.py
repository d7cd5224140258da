"""Byte-level BPE encoding and decoding by batched numpy merge rounds.

A block of many texts is handled as one array of characters. The pre-tokenizer's pattern is a rule on runs of letters,
numbers, white space and other characters, so its matches are found for the whole block at once; they are numbered by
content, and only the distinct words that are not remembered are merged. The symbols of many words lie in one flat
array. A round looks every adjacent pair up by binary search over the sorted pair keys, takes the lowest rank of each
word, and merges that pair wherever it stands in the word, left to right without overlap. A merge's result can only
take part in later merges, so rounds equal one-at-a-time merging. Ids, their decimal text and their bytes are then
gathered for the whole block.

A word of very many symbols is merged in pieces of LONG symbols. Tokens are the encoding of their text if each two
neighbours are the encoding of theirs, so two pieces are joined by merging anew some tokens on both sides of the seam,
more of them until the outermost ones come out as they were.

Defined results: a null text is encoded as the empty text; an empty text has no ids; repeated rows and ids each get
their own row; other columns of the input are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from chronofold.llm.session import bounded_batches, by_weight, release

#: The published pre-tokenizer pattern of byte-level BPE, which cut() finds the matches of, and its contractions.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")
OTHER, LETTER, NUMBER, BLANK = range(4)
#: Distinct words in each of the two generations that a worker remembers.
CACHE_WORDS = 60_000
#: Symbols of one merge batch.
BATCH_SYMBOLS = 1 << 18
#: Characters of texts that are encoded at once; a longer text is cut.
BATCH_CHARS = 1 << 19
#: Bytes of the longest word that is remembered; symbols of the pieces of a longer one that are merged at first, and tokens on each side of a seam.
CACHE_BYTES, LONG, SEAM = 128, 256, 8
#: A vocabulary file beyond this is refused, as it is broadcast.
MAX_VOCABULARY_BYTES = 64 << 20


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in vocabulary files."""
    plain = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


def character_kinds() -> np.ndarray:
    """OTHER, LETTER, NUMBER or BLANK of each code point."""
    every = "".join(map(chr, range(0x110000)))
    out = np.full(len(every), OTHER, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (BLANK, r"\s+")):
        for m in regex.finditer(pattern, every):
            out[m.start() : m.end()] = kind
    return out


def ranges(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """begin[0], begin[0] + 1, ... (size[0] of them), begin[1], ..."""
    ends = np.cumsum(size)
    return np.repeat(begin - (ends - size), size) + np.arange(ends[-1] if ends.size else 0)


class ByteBPE:
    def __init__(self, vocabulary: bytes):
        spec = json.loads(vocabulary)
        ids: dict[str, int] = spec["model"]["vocab"]
        symbols = byte_symbols()
        back = {c: b for b, c in enumerate(symbols)}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        keys = np.array([ids[a] << 32 | ids[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.merged = np.array([ids[a + b] for a, b in pairs], np.int64)  # by rank
        self.of_byte = np.array([ids[c] for c in symbols], np.int64)
        special: dict[str, int] = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        n = max([*ids.values(), *special.values()]) + 1
        table = [b""] * n
        for word, i in ids.items():
            table[i] = bytes(back[c] for c in word)
        for word, i in special.items():
            table[i] = bytes(back[c] for c in word) if all(c in back for c in word) else word.encode()
        self.size = np.array([len(x) for x in table], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.bytes = np.frombuffer(b"".join(table), np.uint8)
        decimal = [b"%d," % i for i in range(n)]
        self.digits_size = np.array([len(x) for x in decimal], np.int64)
        width = int(self.digits_size.max())
        self.digits = np.frombuffer(b"".join(x.ljust(width) for x in decimal), np.uint8).reshape(n, width)
        self.kind = character_kinds()
        self.special = {k.encode(): np.int32(i).tobytes() for k, i in special.items()}
        each = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True))) or r"(?!)")
        self.at_special, self.each_special = each.search, each.finditer
        self.may_cut = regex.compile(r"(?<=\S) (?=\S)").search  # there a match always begins
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def rounds(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words in one array, and where each word's begin, the end included."""
        lengths = np.array([len(w) for w in words], np.int64)
        symbols = self.of_byte[np.frombuffer(b"".join(words), np.uint8)]
        owner = np.repeat(np.arange(len(words)), lengths)
        done_s, done_o, none = [], [], len(self.ranks)
        while symbols.size:
            keys = symbols[:-1] << 32 | symbols[1:]
            at = np.searchsorted(self.keys, keys)
            at[at == none] = none - 1
            rank = np.where((self.keys[at] == keys) & (owner[:-1] == owner[1:]), self.ranks[at], none)
            rank = np.append(rank, none)
            heads = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            sizes = np.diff(np.append(heads, owner.size))
            least = np.repeat(np.minimum.reduceat(rank, heads), sizes)
            alive = least < none
            if not alive.all():  # words without a further merge leave
                done_s.append(symbols[~alive])
                done_o.append(owner[~alive])
                symbols, owner, rank, least = symbols[alive], owner[alive], rank[alive], least[alive]
                if not symbols.size:
                    break
            hit = np.flatnonzero(rank == least)
            fresh = np.append(True, np.diff(hit) != 1)  # of a run of overlapping pairs every second one merges
            run = np.flatnonzero(fresh)
            hit = hit[(np.arange(hit.size) - np.repeat(run, np.diff(np.append(run, hit.size)))) % 2 == 0]
            symbols[hit] = self.merged[rank[hit]]
            keep = np.ones(symbols.size, bool)
            keep[hit + 1] = False
            symbols, owner = symbols[keep], owner[keep]
        if not done_s:
            return np.empty(0, np.int32), np.zeros(len(words) + 1, np.int64)
        owner = np.concatenate(done_o)
        order = np.argsort(owner, kind="stable")
        ends = np.cumsum(np.bincount(owner, minlength=len(words)))
        return np.concatenate(done_s)[order].astype(np.int32), np.append(0, ends)

    def merge(self, words: list[bytes]) -> list[bytes]:
        """The ids, as bytes of int32, of each word."""
        words, long = list(words), [i for i, w in enumerate(words) if len(w) > LONG]
        if long:
            split = [[words[i][at : at + LONG] for at in range(0, len(words[i]), LONG)] for i in long]
            for i, ids in zip(long, self._long(split)):
                words[i] = ids
            rest = sorted({*range(len(words))} - {*long})
            for i, ids in zip(rest, self.merge([words[i] for i in rest])):
                words[i] = ids
            return words
        ids, starts = self.rounds(words)
        raw, starts = ids.tobytes(), (4 * starts).tolist()
        return [raw[a:b] for a, b in zip(starts, starts[1:])]

    def _long(self, split: list[list[bytes]]) -> list[bytes]:
        """The ids of words that are given in pieces."""
        ids, starts = self.rounds([p for own in split for p in own])
        merged, at = np.split(ids, starts[1:-1]), 0
        out: list[list] = []
        for own in split:
            out.append(merged[at : at + len(own)])
            at += len(own)
        while any(len(parts) > 1 for parts in out):  # join each two neighbouring pieces of every word
            self._join([(parts, i) for parts in out for i in range(0, len(parts) - 1, 2)])
            for parts in out:
                parts[:] = [p for p in parts if p is not None]
        return [parts[0].tobytes() for parts in out]

    def _join(self, seams: list[tuple[list, int]]) -> None:
        """Of each seam (parts, i), parts[i] becomes the encoding of itself and parts[i + 1], which becomes None."""
        reach = SEAM
        while seams:
            around = [np.concatenate([parts[i][-reach:], parts[i + 1][:reach]]) for parts, i in seams]
            ids, starts = self.rounds([self.decoded(x)[0].tobytes() for x in around])
            again = []
            for (parts, i), was, now in zip(seams, around, np.split(ids, starts[1:-1])):
                a, b = parts[i], parts[i + 1]
                if (len(a) <= reach or now[0] == was[0]) and (len(b) <= reach or now[-1] == was[-1]):
                    parts[i], parts[i + 1] = np.concatenate([a[:-reach], now, b[reach:]]), None
                else:
                    again.append((parts, i))
            seams, reach = again, 2 * reach

    def cut(self, codes: np.ndarray, edges: np.ndarray) -> np.ndarray:
        """Where the pre-tokenizer's matches begin in texts of these code points; text i stands at edges[i]:edges[i + 1] and is not empty.

        Letters, numbers and others make a match with a space before them; white space before a further character
        leaves its last one to that; an apostrophe that begins a match takes a contraction's letters along."""
        n = codes.size
        kind = self.kind[codes]
        begins = np.empty(n, bool)
        begins[0] = True
        np.not_equal(kind[1:], kind[:-1], out=begins[1:])
        begins[edges[:-1]] = True
        last = np.zeros(n, bool)  # of a text
        last[edges[1:] - 1] = True
        run = np.flatnonzero(begins)
        end = np.append(run[1:], n)
        blank = (kind[run] == BLANK) & ~last[end - 1]
        tail = end[blank] - 1
        begins[tail] = True
        begins[tail[codes[tail] == 0x20] + 1] = False
        lone = run[(end - run == 1) & (codes[run] == 0x27) & ~last[run]]
        lone = lone[begins[lone] & (kind[lone + 1] == LETTER)]
        if lone.size:
            one = codes[lone + 1]
            inside = ~last[lone + 1]
            two = np.where(inside, codes[np.minimum(lone + 2, n - 1)], 0)
            taken = np.zeros(lone.size, np.int64)
            for c in CONTRACTIONS:
                fits = one == ord(c[0])
                if len(c) == 2:
                    fits &= two == ord(c[1])
                taken[fits] = len(c)
            lone, taken = lone[taken > 0], taken[taken > 0]
            begins[lone + 1] = False
            after = lone + 1 + taken
            begins[after[after < n]] = True
        return np.flatnonzero(begins)

    def ids_of(self, words: list[bytes]) -> list[bytes]:
        """The ids, as bytes of int32, of distinct words."""
        young, old = self.young, self.old
        got = list(map(young.get, words))
        new = []
        for i, known in enumerate(got):
            if known is None:
                w = words[i]
                known = got[i] = old.get(w) or self.special.get(w)
                if known is None:
                    new.append(i)
                else:
                    young[w] = known
        for at, to in by_weight([words[i] for i in new], BATCH_SYMBOLS):
            for i, ids in zip(new[at:to], self.merge([words[i] for i in new[at:to]])):
                got[i] = ids
                if len(words[i]) <= CACHE_BYTES:
                    young[words[i]] = ids
        if len(young) > CACHE_WORDS:
            self.young, self.old = {}, young
        return got

    def pieces(self, texts: list[str]) -> Iterator[tuple[int, str]]:
        """(number of the text, part of it): special tokens stand alone, and a very long text is cut where a match begins."""
        for n, text in enumerate(texts):
            parts, end = [], 0
            if self.special and self.at_special(text):
                for m in self.each_special(text):
                    parts += [text[end : m.start()], m.group()]
                    end = m.end()
            for part in [*parts, text[end:]]:
                at = 0
                while len(part) - at > BATCH_CHARS and (m := self.may_cut(part, at + BATCH_CHARS)):
                    yield n, part[at : m.start()]
                    at = m.start()
                if at < len(part):
                    yield n, part[at:]

    def blocks(self, texts: list[str]) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
        """(numbers of the texts that parts are of, ids, where each part's ids begin, the end included), in the texts' order."""
        pieces = list(self.pieces(texts))
        for at, to in by_weight([p for _, p in pieces], BATCH_CHARS):
            parts = [p for _, p in pieces[at:to]]
            ids, edges = self._encode(parts)
            yield [n for n, _ in pieces[at:to]], ids, edges

    def _encode(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        text = "".join(parts)
        data = text.encode()
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        edges = np.cumsum([0, *map(len, parts)])
        begins = self.cut(codes, edges)
        if self.special:  # what is a special token is one match
            whole = [i for i, p in enumerate(parts) if p.encode() in self.special]
            for i in whole:
                begins = begins[(begins <= edges[i]) | (begins >= edges[i + 1])]
        first = np.searchsorted(begins, edges)
        if len(data) == codes.size:
            place = begins
        else:
            width = np.ones(codes.size, np.int64)
            for limit in (0x80, 0x800, 0x10000):
                width += codes >= limit
            place = (np.cumsum(width) - width)[begins]
        offsets = np.append(place, len(data)).astype(np.int64)
        words = pa.Array.from_buffers(pa.large_binary(), begins.size, [None, pa.py_buffer(offsets), pa.py_buffer(data)]).dictionary_encode()
        raw = self.ids_of(words.dictionary.to_pylist())
        size = np.fromiter(map(len, raw), np.int64, len(raw)) // 4
        number = words.indices.to_numpy()
        n = size[number]
        ids = np.frombuffer(b"".join(raw), np.int32)[ranges((np.cumsum(size) - size)[number], n)]
        return ids, np.append(0, np.cumsum(n))[first]

    def decimals(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each id in decimal and a comma, in one array of bytes, and where each begins, the end included."""
        size = self.digits_size[ids]
        shown = np.arange(self.digits.shape[1])[None, :] < size[:, None]
        return self.digits[ids][shown], np.append(0, np.cumsum(size))

    def decoded(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of the ids in one array, and where each id's begin, the end included."""
        size = self.size[ids]
        return self.bytes[ranges(self.start[ids], size)], np.append(0, np.cumsum(size))

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text."""
        out: list[list] = [[] for _ in texts]
        for owners, ids, edges in self.blocks(texts):
            for n, i, j in zip(owners, edges, edges[1:]):
                out[n].append(ids[i:j])
        for parts in out:
            yield np.concatenate(parts) if parts else np.empty(0, np.int32)

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids, special tokens included; malformed UTF-8 becomes U+FFFD."""
        return self.decoded(ids)[0].tobytes().decode("utf-8", "replace") if len(ids) else ""


_LOADED: dict[str, ByteBPE] = {}


def _loaded(vocabulary: bytes) -> ByteBPE:
    key = hashlib.sha256(vocabulary).hexdigest()
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = ByteBPE(vocabulary)
    return _LOADED[key]


def _read(vocabulary_path: str) -> bytes:
    with open(vocabulary_path, "rb") as f:
        data = f.read(MAX_VOCABULARY_BYTES + 1)
    if len(data) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{vocabulary_path} is larger than {MAX_VOCABULARY_BYTES} bytes")
    return data


def encode_documents(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """One row per document: id, n_tokens, token_ids (with_ids), ids_sha256, decoded_sha256 of the ids decoded again.

    A narrow map without a shuffle. The vocabulary is read on the driver and broadcast (its size is checked)."""
    spark = docs.sparkSession
    bounded_batches(spark)
    shipped = spark.sparkContext.broadcast(_read(vocabulary_path))
    kind = docs.schema[id_col].dataType.simpleString()
    names = ["n_tokens"] + ["token_ids"] * with_ids + ["ids_sha256", "decoded_sha256"]
    schema = f"`{id_col}` {kind}, n_tokens bigint, " + "token_ids array<int>, " * with_ids + "ids_sha256 string, decoded_sha256 string"

    def of(bpe: ByteBPE, texts: list[str]) -> list[pa.Array]:
        counts, every = [0] * len(texts), []
        sums, decoded = [hashlib.sha256() for _ in texts], [hashlib.sha256() for _ in texts]
        for owners, ids, edges in bpe.blocks(texts):
            text, shown = bpe.decimals(ids)
            raw, starts = bpe.decoded(ids)
            text, raw, edges = text.tobytes(), raw.tobytes(), edges.tolist()
            for n, i, j in zip(owners, edges, edges[1:]):
                if counts[n]:
                    sums[n].update(b",")
                counts[n] += j - i
                sums[n].update(text[shown[i] : shown[j] - 1])
                decoded[n].update(raw[starts[i] : starts[j]].decode("utf-8", "replace").encode())
            if with_ids:
                every.append(ids)
        out = [pa.array(counts, pa.int64())]
        if with_ids:
            ends = np.cumsum([0, *counts]).astype(np.int32)
            out.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*every, np.empty(0, np.int32)]))))
        return out + [pa.array([x.hexdigest() for x in hashes], pa.string()) for hashes in (sums, decoded)]

    def run(batches):
        bpe = _loaded(shipped.value)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *of(bpe, texts)], [id_col, *names])
        release()

    return docs.select(id_col, text_col).mapInArrow(run, schema)
