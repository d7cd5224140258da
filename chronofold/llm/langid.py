"""Language identification by a byte-level convolutional network, trained and applied in numpy.

The text's UTF-8 bytes are cut into fixed-length windows that cover all of it. Filters of several widths slide over
a window; as bytes are one-hot inputs, a filter's response is a sum of one weight per offset, so a pair of adjacent
offsets is looked up at once in a table of byte pairs. Each filter keeps its largest response in the window, a
softmax layer turns those into class probabilities, and a document's probability is the mean of its windows' log
probabilities, by their bytes, normalised again.

Defined results: a null text, an empty one and one without a letter are `und` with score 0; equally likely languages
give the first by name; repeated rows get a row each; other columns are ignored; without a labelled row every text is `und`; an empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronofold.llm import labelled
from chronofold.llm.session import bounded_batches, release

WINDOW, WIDTHS, FILTERS = 256, (2, 3, 4), 8
#: Training documents in all, shared out among the languages, and bytes of all of them.
SAMPLE_DOCS, SAMPLE_BYTES = 1200, 4 << 20
EPOCHS, BATCH, RATE = 4, 64, 0.02
#: Windows that are scored at once.
CHUNK = 1024
UNDETERMINED = "und"
HAS_LETTER = regex.compile(r"\p{L}").search


class ByteCNN:
    """weights[w]: (width, 256, FILTERS); out: (widths * FILTERS, classes)."""

    def __init__(self, classes: list[str], seed: int = 7):
        rng = np.random.default_rng(seed)
        self.classes = classes
        self.weights = [rng.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.out = rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, len(classes))).astype(np.float32)
        self.bias = np.zeros(len(classes), np.float32)
        self.pairs: list | None = None

    def compile(self) -> "ByteCNN":
        """Tables of byte pairs for each two offsets of a width; an odd last offset keeps its own table."""
        self.pairs = [[(j, (w[j][:, None] + w[j + 1][None]).reshape(65536, -1)) if j + 1 < len(w) else (j, w[j]) for j in range(0, len(w), 2)] for w in self.weights]
        return self

    def responses(self, x: np.ndarray) -> list[np.ndarray]:
        """x: (n, WINDOW) of bytes. For each width (n, positions, FILTERS)."""
        x = x.astype(np.int64)
        two, out = x[:, :-1] << 8 | x[:, 1:], []
        for w, tables in zip(self.weights, self.pairs):
            n = x.shape[1] - len(w) + 1
            total = None
            for j, table in tables:
                got = table[(two if len(table) == 65536 else x)[:, j : j + n]]
                total = got if total is None else total + got
            out.append(total)
        return out

    def log_probabilities(self, x: np.ndarray) -> np.ndarray:
        pooled = np.maximum(np.concatenate([r.max(1) for r in self.responses(x)], 1), 0)
        z = pooled @ self.out + self.bias
        z -= z.max(1, keepdims=True)
        return z - np.log(np.exp(z).sum(1, keepdims=True))

    def fit(self, x: np.ndarray, y: np.ndarray, seed: int = 11) -> "ByteCNN":
        """Adam on the cross entropy; the gradient of a pooled filter reaches the bytes at its largest response only."""
        rng = np.random.default_rng(seed)
        params = [*self.weights, self.out, self.bias]
        m, v, t = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
        for _ in range(EPOCHS):
            order = rng.permutation(len(x))
            for i in range(0, len(x), BATCH):
                part = order[i : i + BATCH]
                xb, yb, n = x[part].astype(np.int64), y[part], len(part)
                best, pooled = [], []
                for w in self.weights:
                    span = xb.shape[1] - len(w) + 1
                    r = sum(w[j][xb[:, j : j + span]] for j in range(len(w)))
                    at = r.argmax(1)
                    best.append(at)
                    pooled.append(np.take_along_axis(r, at[:, None], 1)[:, 0])
                raw = np.concatenate(pooled, 1)
                h = np.maximum(raw, 0)
                z = h @ self.out + self.bias
                p = np.exp(z - z.max(1, keepdims=True))
                p /= p.sum(1, keepdims=True)
                p[np.arange(n), yb] -= 1
                p /= n
                back, grads = (p @ self.out.T) * (raw > 0), []
                for k, w in enumerate(self.weights):
                    g, share = np.zeros_like(w), back[:, k * FILTERS : (k + 1) * FILTERS]
                    for j in range(len(w)):
                        byte = np.take_along_axis(xb, best[k] + j, 1)
                        np.add.at(g[j], (byte, np.broadcast_to(np.arange(FILTERS), byte.shape)), share)
                    grads.append(g)
                grads += [h.T @ p, p.sum(0)]
                t += 1
                for q, g, a, b in zip(params, grads, m, v):
                    a += 0.1 * (g - a)
                    b += 0.001 * (g * g - b)
                    q -= RATE * (a / (1 - 0.9**t)) / (np.sqrt(b / (1 - 0.999**t)) + 1e-7)
        return self.compile()

    def predict(self, texts: list[bytes]) -> list[tuple[str, float]]:
        """Of each text, not empty, its language and probability."""
        sizes = np.array([len(t) for t in texts], np.int64)
        counts = -(-sizes // WINDOW)
        owner = np.repeat(np.arange(len(texts)), counts)
        padded = np.frombuffer(b"".join(t.ljust(c * WINDOW, b" ") for t, c in zip(texts, counts.tolist())), np.uint8).reshape(-1, WINDOW)
        logs = np.concatenate([self.log_probabilities(padded[i : i + CHUNK]) for i in range(0, len(padded), CHUNK)])
        firsts = np.cumsum(counts) - counts
        held = np.minimum(WINDOW, sizes[owner] - (np.arange(owner.size) - firsts[owner]) * WINDOW)
        mean = np.add.reduceat(logs * held[:, None], firsts) / sizes[:, None]
        p = np.exp(mean - mean.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        return [(self.classes[k], float(q[k])) for k, q in zip(p.argmax(1).tolist(), p)]


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> ByteCNN | None:
    """Fit on all windows of the whole texts of SAMPLE_DOCS documents, as many of each language, or of as many as SAMPLE_BYTES hold."""
    slim = docs.select(id_col, F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    n_langs = min(labelled.MOST_CLASSES, slim.select("lang").where(F.col("lang").isNotNull()).distinct().count())
    if not n_langs:
        return None
    ids, shares = labelled.sample(slim.where(F.col("text").rlike(r"\p{L}")).select(id_col, "lang"), id_col, "lang", max(8, SAMPLE_DOCS // n_langs))
    rows = slim.join(F.broadcast(ids.select(id_col).distinct()), id_col).where(F.col("lang").isin(*shares) if shares else F.lit(False))
    got = sorted((str(r[0]), r[1], r[2]) for r in labelled.within_bytes(rows, id_col, "text", SAMPLE_BYTES).collect() if r[2])
    if not got:
        return None
    classes = sorted({r[1] for r in got})
    at = {k: i for i, k in enumerate(classes)}
    texts = [r[2].encode() for r in got]
    counts = [-(-len(t) // WINDOW) for t in texts]
    x = np.frombuffer(b"".join(t.ljust(c * WINDOW, b" ") for t, c in zip(texts, counts)), np.uint8).reshape(-1, WINDOW)
    return ByteCNN(classes).fit(x, np.repeat([at[r[1]] for r in got], counts))


def predict(docs: DataFrame, model: ByteCNN | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, lang_pred and score of each document; a narrow map over whole texts."""
    bounded_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    parts = None if model is None else (model.classes, model.weights, model.out, model.bias)

    def run(batches):
        net = None
        if parts:
            net = ByteCNN(parts[0])
            net.weights, net.out, net.bias = parts[1:]
            net.compile()
        for batch in batches:
            texts = batch.column(1).to_pylist()
            good = [i for i, t in enumerate(texts) if net is not None and t and HAS_LETTER(t)]
            langs, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
            for at in range(0, len(good), 64):
                for i, (k, q) in zip(good[at : at + 64], net.predict([texts[i].encode() for i in good[at : at + 64]])):
                    langs[i], scores[i] = k, min(1.0, max(0.0, q))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], [id_col, "lang_pred", "score"])
        release()

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, lang_pred string, score double")
