"""Bounded, deterministic samples of labelled documents, and small fits in numpy."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Buckets of the hash by which rows are sampled.
BUCKETS = 1 << 20
#: Labels that are learnt at most, the most frequent ones.
MOST_CLASSES = 512


def crc_mod(id_col: str, n: int) -> Column:
    """crc32 of the id as text, modulo n."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(n))


def sample(rows: DataFrame, id_col: str, label_col: str, per_class: int, classes: int = MOST_CLASSES) -> tuple[DataFrame, dict]:
    """About per_class rows of each label, chosen by a hash of the id, and the share of each label that was kept.

    One aggregation counts the labels, of which the most frequent ones (ties by the label) are learnt: MOST_CLASSES is a
    bound that no set of languages reaches, but that junk in a label column does. A filter then keeps each row or not by
    itself, so nothing is gathered and no task sees more than its own rows. About per_class rows of a label are expected;
    a bound of twice as many, in the order of the same hash, holds whatever the hash does."""
    rows = rows.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    most = rows.groupBy(label_col).count().orderBy(F.desc("count"), label_col).limit(classes).collect()
    shares = {r[0]: min(1.0, per_class / r[1]) for r in most}
    if not shares:
        return rows.limit(0), {}
    at = F.pmod(F.xxhash64(F.col(id_col), F.lit(17)), F.lit(BUCKETS))
    limits = F.create_map(*[F.lit(x) for k, share in shares.items() for x in (k, int(share * BUCKETS))])
    kept = rows.where(at < F.coalesce(F.try_element_at(limits, F.col(label_col)), F.lit(0)))
    return kept.orderBy(at, id_col).limit(2 * per_class * len(shares)), shares


def within_bytes(rows: DataFrame, id_col: str, text_col: str, most: int) -> DataFrame:
    """Of a bounded sample as many whole rows, in the order of a hash of the id, as hold most bytes of text."""
    sizes = rows.select(id_col, F.octet_length(text_col).alias("_size")).where(F.col("_size").isNotNull())
    so_far = F.sum("_size").over(Window.orderBy(F.xxhash64(id_col, F.lit(23)), id_col).rowsBetween(Window.unboundedPreceding, 0))
    ids = sizes.withColumn("_so_far", so_far).where(F.col("_so_far") <= most).select(id_col).distinct()
    return rows.join(F.broadcast(ids), id_col, "left_semi")


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Weighted ridge logistic regression by Newton steps; the last coefficient is the intercept, unpenalised."""
    x = np.column_stack([x, np.ones(len(x))])
    b, penalty = np.zeros(x.shape[1]), np.append(np.full(x.shape[1] - 1, ridge), 1e-6)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        slope = x.T @ (weight * (y - p)) - penalty * b
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(penalty + 1e-9)
        step = np.linalg.solve(curve, slope)
        b += np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-8:
            break
    return b
