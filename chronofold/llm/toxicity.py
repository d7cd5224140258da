"""Toxicity by compression distance between two trained Zstandard dictionaries.

The ordinary dictionary is trained on windows of three words of ordinary texts. The toxic one is trained on passages of
toxic texts: of each text, the words that toxic texts have far more often than ordinary ones, one passage a text. (Trained
on whole toxic texts it holds mostly what both classes share.) A window to be judged is a case-folded word without its
marks, a long word cut into pieces, between two fixed fillers, so that the compressor can look it up in full and never
falls back to a raw block. Its gain is how many bytes shorter it gets with the ordinary and the toxic dictionary in
use than with the ordinary one alone, so that what both classes share leaves no difference. A window is suspect where
its gain reaches the threshold calibrated for its length on ordinary texts that no dictionary was trained on; a document's score
is logistic in the suspect windows' surplus and in how many windows it has, so that the chance hits of a long text do
not add up, calibrated at the classes' own shares.

Defined results: null and empty texts, and texts without a word, get the score of a text of no windows;
repeated rows get a row each; other columns are ignored; without labels of both classes every score is the share of
label 1 (0 without labels); an empty table gives an empty table.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronofold.llm import labelled
from chronofold.llm.session import bounded_batches, release

#: Labelled documents of each class that a model is fitted on, each with its whole text, and bytes of all of them.
SAMPLE_DOCS, SAMPLE_BYTES = 3000, 64 << 20
#: Bytes of the dictionaries, of the segments that they are put together from, and of the shortest match that counts.
TOXIC_BYTES, TOXIC_SEGMENT, ORDINARY_BYTES, ORDINARY_SEGMENT, LEAST_MATCH = 8192, 100, 262144, 32, 6
#: Of ten ordinary texts so many train their dictionary, on all their words, three at a time; the others calibrate.
TRAINING_TENTHS = 7
#: A toxic text's word belongs to its passage if so large a share of toxic texts has it, and with this logarithm of odds.
MARK_SHARE, MARK_ODDS = 0.01, 2.5
#: Characters of the longest window.
WINDOW = 24
#: Share of calibration texts in which a window of a given length may be suspect, and the least gain of any.
FALSE_SHARE, LEAST_GAIN = 0.01, 2
#: Windows whose gain a worker remembers, in each of two generations.
CACHE_WINDOWS = 100_000
FILLER = b"0123456789abcdef" * 3
MARKS = ".,;:!?*#$%&()[]{}<>|\"'`~^_=+-/\\"


def words(text: str) -> list[str]:
    return [w for w in (w.strip(MARKS) for w in text.lower().split()) if w]


def windows(text: str) -> set[str]:
    out = set(words(text))
    long = [w for w in out if len(w) > WINDOW]
    for w in long:
        out.remove(w)
        out.update(w[i : i + WINDOW] for i in range(0, len(w), WINDOW))
    return out


def trained(samples: list[bytes], size: int, segment: int, least: int) -> bytes:
    """A dictionary trained on samples; where there is too little to train on, as many of them as fit."""
    try:
        return zstandard.train_dictionary(size, samples, k=segment, d=least, steps=4, level=5).as_bytes()
    except zstandard.ZstdError:
        return b"".join(dict.fromkeys(samples))[-size:]


class Gains:
    """Gain of windows, remembered."""

    def __init__(self, toxic: bytes, ordinary: bytes):
        self.both, self.ordinary = self.compressor(ordinary + toxic), self.compressor(ordinary)
        self.young: dict[str, int] = {}
        self.old: dict[str, int] = {}

    @staticmethod
    def compressor(content: bytes) -> zstandard.ZstdCompressor:
        how = zstandard.ZstdCompressionParameters(window_log=20, chain_log=17, hash_log=17, search_log=6, min_match=4, target_length=64, strategy=zstandard.STRATEGY_LAZY2, write_content_size=False, write_dict_id=False)
        return zstandard.ZstdCompressor(compression_params=how, dict_data=zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT))

    def __call__(self, window: str) -> int:
        if (got := self.young.get(window)) is None:
            if (got := self.old.get(window)) is None:
                block = FILLER + b" " + window.encode() + b" " + FILLER
                got = len(self.ordinary.compress(block)) - len(self.both.compress(block))
            if len(self.young) >= CACHE_WINDOWS:
                self.young, self.old = {}, self.young
            self.young[window] = got
        return got


class Model:
    """What a fit leaves: two dictionaries, thresholds by window length, and three logistic coefficients."""

    def __init__(self, toxic: bytes, ordinary: bytes, thresholds: list[int], slopes: tuple[float, float], intercept: float):
        self.toxic, self.ordinary, self.thresholds, self.slopes, self.intercept = toxic, ordinary, thresholds, slopes, intercept

    def features(self, gains: Gains, text: str) -> tuple[float, float]:
        """Surplus of the suspect windows, and number of windows, both as logarithms."""
        over, bag = 0, windows(text)
        for w in bag:
            if (d := gains(w) - self.thresholds[min(len(w), WINDOW)]) >= 0:
                over += 1 + d
        return math.log1p(over), math.log1p(len(bag))

    def score(self, gains: Gains, text: str) -> float:
        z = sum(a * b for a, b in zip(self.slopes, self.features(gains, text))) + self.intercept
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def fit(texts: list[str], labels: list[int], shares: dict[int, float]) -> Model:
    """shares: of each label, the share of its documents that the sample holds."""
    classes = Counter(labels)
    if len(classes) < 2:
        return Model(b" ", b" ", [1 << 20] * (WINDOW + 1), (0.0, 0.0), 30.0 if classes.get(1) else -30.0)
    shared: dict[str, str] = {}  # one copy of a word that many texts hold
    bags = [{shared.setdefault(w, w) for w in windows(t)} for t in texts]
    del shared
    toxic, ordinary = dictionaries(texts, bags, labels)
    gains = Gains(toxic, ordinary)
    calm = calibrating(labels)
    worst: list[Counter] = [Counter() for _ in range(WINDOW + 1)]
    for i in calm:
        top: dict[int, int] = {}
        for w in bags[i]:
            k = min(len(w), WINDOW)
            top[k] = max(top.get(k, -99), gains(w))
        for k, d in top.items():
            worst[k][d] += 1
    thresholds = []
    for counts in worst:
        over, limit = 0, LEAST_GAIN
        for d in sorted(counts, reverse=True):
            over += counts[d]
            if over > FALSE_SHARE * len(calm):
                limit = max(LEAST_GAIN, d + 1)
                break
        thresholds.append(limit)
    model = Model(toxic, ordinary, thresholds, (0.0, 0.0), 0.0)
    used = sorted([*calm, *(i for i, y in enumerate(labels) if y == 1)])
    kept = {0: shares[0] * len(calm) / classes[0], 1: shares[1]}
    x, y = np.array([model.features(gains, texts[i]) for i in used]), np.array([labels[i] for i in used], float)
    *slopes, model.intercept = map(float, labelled.logistic(x, y, np.array([1 / max(kept[labels[i]], 1e-9) for i in used])))
    model.slopes = tuple(slopes)
    return model


def calibrating(labels: list[int]) -> list[int]:
    """The numbers of the ordinary texts that calibrate; the others train."""
    ordinary = [i for i, y in enumerate(labels) if y == 0]
    return [i for n, i in enumerate(ordinary) if n % 10 >= TRAINING_TENTHS] or ordinary


def dictionaries(texts: list[str], bags: list[set[str]], labels: list[int]) -> tuple[bytes, bytes]:
    """(toxic, ordinary) dictionaries."""
    seen = {k: Counter(w for b, y in zip(bags, labels) if y == k for w in b) for k in (0, 1)}
    n0, n1 = labels.count(0), labels.count(1)
    odds = {w: math.log((n + 0.5) / (n1 + 1)) - math.log((seen[0][w] + 0.5) / (n0 + 1)) for w, n in seen[1].items()}
    marked = {w for w, n in seen[1].items() if n >= max(3, MARK_SHARE * n1) and odds[w] > MARK_ODDS}
    passages = [[w for w in dict.fromkeys(words(t)) if w in marked] for t, y in zip(texts, labels) if y == 1]
    samples = [(" " + "  ".join(p) + " ").encode() for p in passages if p]
    toxic = trained(2 * samples, TOXIC_BYTES, TOXIC_SEGMENT, LEAST_MATCH)
    held, three = set(calibrating(labels)), []
    for i, t in enumerate(texts):
        if labels[i] == 0 and (i not in held or n0 < 10):
            w = words(t)
            three += [(" " + " ".join(w[j : j + 3]) + " ").encode() for j in range(0, max(1, len(w)), 3)]
    return toxic, trained(three, ORDINARY_BYTES, ORDINARY_SEGMENT, LEAST_MATCH + 2)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Fit on a bounded sample of whole texts: SAMPLE_DOCS documents of each class, or as many as SAMPLE_BYTES hold."""
    picked, shares = labelled.sample(labels.select(id_col, F.col(label_col).cast("int").alias(label_col)).where(F.col(label_col).isin(0, 1)), id_col, label_col, SAMPLE_DOCS)
    rows = docs.select(id_col, F.col(text_col).alias("text")).where(F.col("text").isNotNull()).join(F.broadcast(picked), id_col)
    sizes = [tuple(r) for r in rows.select(id_col, label_col, F.octet_length("text")).limit(8 * SAMPLE_DOCS).collect()]
    if sum(n for _, _, n in sizes) > SAMPLE_BYTES:
        had, left, ids = Counter(y for _, y, _ in sizes), SAMPLE_BYTES, set()
        for i, _, n in sorted(sizes, key=lambda r: (zlib.crc32(str(r[0]).encode()), str(r[0]))):
            if (left := left - n) < 0:
                break
            ids.add(i)
        kept = Counter(y for i, y, _ in sizes if i in ids)
        shares = {k: x * kept[k] / max(1, had[k]) for k, x in shares.items()}
        rows = rows.where(F.col(id_col).isin(list(ids)))
    got = sorted((r[id_col], r["text"], r[label_col]) for r in rows.limit(8 * SAMPLE_DOCS).collect())
    return fit([r[1] for r in got], [r[2] for r in got], shares)


_LOADED: list = [None, None]


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, score (0 to 1) and the windows' surplus of each document; a narrow map."""
    bounded_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    key = hash((model.toxic, model.ordinary))

    def run(batches):
        if _LOADED[0] != key:
            _LOADED[:] = [key, Gains(model.toxic, model.ordinary)]
        gains = _LOADED[1]
        for batch in batches:
            got = [model.score(gains, t or "") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got, pa.float64())], [id_col, "score"])
        release()

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, score double")
