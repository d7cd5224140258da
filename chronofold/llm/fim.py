"""Fill-in-middle transformation: whole batches cut at once, over Arrow's UTF-8 buffers.

A text is cut into units (blanks before a word, and the word; blanks at the end). A byte-class table marks blanks; a
unit begins where a blank follows a non-blank, or at a text's first byte; the running count of beginnings, reset at each
text, numbers the units, and one searchsorted over it finds the cuts of all rows together. Draws come from SHA-256 of
"seed:id", so that a row's form depends on nothing but its id, and any task that is run again gives the same rows.

Forms: plain (the text), psm (<P>prefix<S>suffix<M>middle), spm (<S>suffix<P>prefix<M>middle). A text that is empty or
holds a mark stays plain, so a marked output holds each mark once and restore() is exact.

Defined results: a null text counts as the empty one; a null id draws as an empty one; repeated rows get a row each; very
long texts make blocks of their own; other columns are ignored by digests() and kept by transform(), where form,
prefix_chars, middle_chars and n replace columns of those names; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronofold.llm.session import bounded_batches

#: Percent of texts that are transformed, and of those the percent in spm form.
RATE, SPM = 50, 80
MARKS = {"P": b"<P>", "S": b"<S>", "M": b"<M>"}
#: Bytes of texts that are cut at once; a longer text stands alone.
BLOCK_BYTES = 4 << 20
FORMS = np.array(["plain", "psm", "spm"])
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_MARKS_BYTES = np.frombuffer(b"".join(MARKS.values()), np.uint8)


def draws(id_col: str, seed: int = 42) -> list[Column]:
    """h1 to h4: the first four 32-bit numbers of SHA-256 of "seed:id"."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("bigint").alias(f"h{k + 1}") for k in range(4)]


def _buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes, and where each row begins (the end of the last included); a null is an empty text."""
    column = column.cast(pa.large_string())
    column = column.fill_null("") if column.null_count else column
    _, offsets, data = column.buffers()
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8), offsets


def _runs(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    at = 0
    while at < len(offsets) - 1:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + BLOCK_BYTES, "right")) - 1)
        yield at, to
        at = to


def _places(data: np.ndarray, kind: str) -> np.ndarray:
    """Where a mark of this kind begins."""
    hit = np.flatnonzero(data[1:-1] == ord(kind)) if data.size > 2 else np.empty(0, np.int64)
    return hit[(data[hit] == ord("<")) & (data[hit + 2] == ord(">"))]


class Cut:
    """The cuts of a block of texts. n: units; a, b: bytes of data where the prefix and the middle end; form: of FORMS."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, h: np.ndarray, rate: int = RATE, spm: int = SPM):
        """offsets: from 0 to data.size; h: four draws a row."""
        first, last = offsets[:-1], offsets[1:]
        blank = _BLANK[data]
        begins = np.empty(data.size, bool)
        begins[:1] = True
        np.greater(blank[1:], blank[:-1], out=begins[1:])  # a blank behind a non-blank
        begins[first[first < last]] = True
        running = np.cumsum(begins, dtype=np.int32 if data.size < 1 << 31 else np.int64)  # beginnings up to each byte
        before, upto = (np.where(x > 0, np.append(running, 0)[x - 1], 0).astype(np.int64) for x in (first, last))
        self.n = upto - before
        draw = h[:, :2] % (self.n + 1)[:, None]
        units = np.column_stack([draw.min(1), draw.max(1)])
        # unit k of a text begins where the count, from the text's own on, first exceeds k; behind its last unit stands its end
        cuts = np.searchsorted(running, (before[:, None] + units).astype(running.dtype), "right")
        self.a, self.b = np.minimum(cuts, last[:, None]).T
        del running
        marked = np.zeros(self.n.size, bool)
        for kind in MARKS:
            at = _places(data, kind)
            row = np.searchsorted(offsets, at, "right") - 1
            marked[row[at + 3 <= last[row]]] = True
        plain = (first == last) | marked | (h[:, 2] % 100 >= rate)
        self.form = np.where(plain, 0, np.where(h[:, 3] % 100 < spm, 2, 1))
        letters = np.append(np.cumsum((data & 0xC0) != 0x80, dtype=np.int32 if data.size < 1 << 31 else np.int64), 0)
        letters = lambda x, upto=letters: np.where(x > 0, upto[x - 1], 0).astype(np.int64)  # noqa: E731  code points before byte x
        self.prefix_chars, self.middle_chars = letters(self.a) - letters(first), letters(self.b) - letters(self.a)
        self.data, self.first, self.last = data, first, last

    def outputs(self) -> tuple[bytes, np.ndarray]:
        """All outputs in one buffer, and where each begins."""
        z, (p, s, m) = self.data.size, ((self.data.size + 3 * k, self.data.size + 3 * k + 3) for k in range(3))
        f, a, b, e, none = self.first, self.a, self.b, self.last, np.zeros_like(self.first)
        full = lambda x: np.full(f.size, x)
        pieces = {
            0: [(f, e)] + 5 * [(none, none)],
            1: [map(full, p), (f, a), map(full, s), (b, e), map(full, m), (a, b)],
            2: [map(full, s), (b, e), map(full, p), (f, a), map(full, m), (a, b)],
        }
        begin, end = (np.empty((f.size, 6), np.int64) for _ in range(2))
        for form, parts in pieces.items():
            rows = self.form == form
            for k, (x, y) in enumerate(parts):
                begin[rows, k], end[rows, k] = x[rows], y[rows]
        out = _joined(np.concatenate([self.data, _MARKS_BYTES]) if z else _MARKS_BYTES, begin, end)
        return out, np.concatenate([[0], np.cumsum((end - begin).sum(1))])


def _joined(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> bytes:
    view = memoryview(np.ascontiguousarray(data))
    return b"".join(map(view.__getitem__, map(slice, begin.ravel().tolist(), end.ravel().tolist())))


def restored(out: np.ndarray, offsets: np.ndarray, form: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The texts, from outputs and forms alone, in one buffer, and where each begins."""
    first, last = offsets[:-1], offsets[1:]
    at = {}
    for kind in MARKS:
        place = _places(out, kind)
        row = np.searchsorted(offsets, place, "right") - 1
        fits = (form[row] > 0) & (place + 3 <= last[row])
        at[kind] = np.zeros_like(first)
        at[kind][row[fits]] = place[fits]
    p, s, m = at["P"], at["S"], at["M"]
    psm = form == 1
    begin = np.column_stack([p + 3, m + 3, s + 3])
    end = np.column_stack([np.where(psm, s, m), last, np.where(psm, m, p)])
    plain = form == 0
    begin[plain], end[plain] = 0, 0
    begin[plain, 0], end[plain, 0] = first[plain], last[plain]
    return _joined(out, begin, end), np.concatenate([[0], np.cumsum((end - begin).sum(1))])


def _hashes(data: bytes, offsets: np.ndarray) -> list[str]:
    view, edges = memoryview(data), offsets.tolist()
    return [hashlib.sha256(view[a:b]).hexdigest() for a, b in zip(edges, edges[1:])]


def _strings(data: bytes, offsets: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.large_string(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(data)]).cast(pa.string())


def _cuts(batch: pa.RecordBatch, rate: int, spm: int) -> Iterator[tuple[int, int, Cut]]:
    data, offsets = _buffers(batch["t"])
    h = np.column_stack([batch[f"h{k}"].to_numpy() for k in range(1, 5)])
    for at, to in _runs(offsets):
        yield at, to, Cut(data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at], h[at:to], rate, spm)


def _columns(cut: Cut) -> list[pa.Array]:
    plain = cut.form == 0
    return [pa.array(cut.n, pa.int64()), pa.array(FORMS[cut.form], pa.string()), pa.array(cut.prefix_chars, pa.int64(), mask=plain), pa.array(cut.middle_chars, pa.int64(), mask=plain)]


def _nothing(names: list[str]) -> list[Column]:
    return [F.lit(None).cast("string" if c.endswith(("form", "sha256")) else "bigint").alias(c) for c in names]


def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 42, rate: int = RATE, spm: int = SPM) -> DataFrame:
    """docs with the transformed text in text_col, and n, form, prefix_chars, middle_chars."""
    bounded_batches(docs.sparkSession)
    new = ["n", "form", "prefix_chars", "middle_chars"]
    keep = [c for c in docs.columns if c not in (text_col, *new)]
    rows = docs.select(F.struct(*keep).alias("row") if keep else F.lit(None).cast("int").alias("row"), F.col(text_col).alias("t"), *draws(id_col, seed))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, cut in _cuts(batch, rate, spm):
                yield pa.RecordBatch.from_arrays([batch["row"].slice(at, to - at), _strings(*cut.outputs()), *_columns(cut)], ["row", "t", *new])

    out = rows.mapInArrow(run, rows.select("row", "t", *_nothing(new)).schema)
    own = {c: F.col("t") if c == text_col else F.col(f"row.`{c}`") for c in docs.columns if c not in new}
    return out.select(*[v.alias(k) for k, v in own.items()], *new)


def restore(docs: DataFrame, text_col: str = "text", form_col: str = "form") -> DataFrame:
    """docs of transform() with the first texts again in text_col; a null form counts as plain."""
    bounded_batches(docs.sparkSession)
    keep = [c for c in docs.columns if c != text_col]
    rows = docs.select(F.struct(*keep).alias("row"), F.col(text_col).alias("t"), F.coalesce(F.col(form_col), F.lit("plain")).alias("f"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = _buffers(batch["t"])
            form = np.searchsorted(FORMS, batch["f"].to_numpy(zero_copy_only=False).astype(str))
            for at, to in _runs(offsets):
                text = restored(data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at], form[at:to])
                yield pa.RecordBatch.from_arrays([batch["row"].slice(at, to - at), _strings(*text)], ["row", "t"])

    out = rows.mapInArrow(run, rows.select("row", "t").schema)
    return out.select(*[(F.col("t") if c == text_col else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 42, rate: int = RATE, spm: int = SPM) -> DataFrame:
    """id, n, form, prefix_chars, middle_chars, and SHA-256 of each output and of the text that is restored from it."""
    bounded_batches(docs.sparkSession)
    names = ["id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"), *draws(id_col, seed))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, cut in _cuts(batch, rate, spm):
                out, edges = cut.outputs()
                back, back_edges = restored(np.frombuffer(out, np.uint8), edges, cut.form)
                yield pa.RecordBatch.from_arrays([batch["id"].slice(at, to - at), *_columns(cut), pa.array(_hashes(out, edges)), pa.array(_hashes(back, back_edges))], names)

    return rows.mapInArrow(run, rows.select("id", *_nothing(names[1:])).schema).withColumnRenamed("id", id_col)
