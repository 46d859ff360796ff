"""Quality classifier by compression.

One zstandard dictionary is built from text labelled good, one from text labelled bad. A text is
cut into blocks of ``BLOCK`` bytes, so that the dictionaries and not the text's own past decide;
every block is compressed with both, and ``(bad - good) / (bad + good)`` of the summed sizes is the
evidence. A logistic curve fitted on labelled documents that built neither dictionary turns the
evidence into the probability of label 1.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.common import small_batches

BLOCK = 1024
LEVEL = 1
#: Bounds of the fit: documents of a class for the dictionaries and as many for the curve, and the
#: characters taken of each. Nothing else of the corpus reaches the driver.
FIT_DOCS = 1500
FIT_CHARS = 2048
DICTIONARY_BYTES = 112_640
THRESHOLD = 0.3


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    data = zstandard.ZstdCompressionDict(dictionary)
    data.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(
        level=LEVEL, dict_data=data, write_content_size=False, write_checksum=False, write_dict_id=False
    )


def build_dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary, or the samples themselves where they are too few to train on."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY_BYTES:]


def _evidence(raw: bytes, good: zstandard.ZstdCompressor, bad: zstandard.ZstdCompressor) -> float:
    """Normalised compressed-size difference over all blocks; 0 for an empty text."""
    g = b = 0
    for at in range(0, len(raw), BLOCK):
        block = raw[at : at + BLOCK]
        g += len(good.compress(block))
        b += len(bad.compress(block))
    return (b - g) / (b + g) if raw else 0.0


def _curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of a ridge-penalised logistic curve."""
    scale = float(np.std(x)) or 1.0
    design = np.column_stack([x / scale, np.ones_like(x)])
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (y - p) - 1e-2 * beta
        hessian = (design * (p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        beta += step
        if abs(step).max() < 1e-9:
            break
    return float(beta[0] / scale), float(beta[1])


def fit(docs: DataFrame, labels: DataFrame) -> dict:
    """Dictionaries and curve from the rows (doc_id, quality) of ``labels`` that may be learned from.

    The sample: of each class the ``2 * FIT_DOCS`` labels whose hashed ids come first, and the first
    ``FIT_CHARS`` characters of their documents; every second one builds dictionaries, the others
    fit the curve. Ids are chosen before texts are read, so only a bounded list is broadcast. Null
    texts and labels other than 0 and 1 are left out. Without both classes every score is the share
    of label 1 (0.5 if there are no labels).
    """
    usable = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", "quality")
    order = F.xxhash64(F.col("doc_id").cast("string"))
    chosen = [usable.where(F.col("quality") == q).orderBy(order, "doc_id").limit(2 * FIT_DOCS) for q in (1, 0)]
    rows = (
        docs.select("doc_id", F.substring("text", 1, FIT_CHARS).alias("text"))
        .where(F.col("text").isNotNull())
        .join(F.broadcast(chosen[0].union(chosen[1])), "doc_id")
        .select("quality", "text", order.alias("h"))
        .collect()
    )
    rows.sort(key=lambda r: (r.h, r.text))
    sample = {q: [r.text.encode("utf-8", "surrogatepass") for r in rows if r.quality == q] for q in (1, 0)}
    share = usable.agg(F.avg(F.col("quality").cast("double"))).first()[0]
    if not all(sample.values()):
        share = 0.5 if share is None else min(max(share, 1e-6), 1 - 1e-6)
        return {"good": b"", "bad": b"", "slope": 0.0, "intercept": math.log(share / (1 - share))}
    good, bad = (build_dictionary(sample[q][::2]) for q in (1, 0))
    cg, cb = _compressor(good), _compressor(bad)
    held = {q: sample[q][1::2] or sample[q] for q in (1, 0)}
    x = np.array([_evidence(t, cg, cb) for q in (1, 0) for t in held[q]])
    y = np.array([q for q in (1, 0) for _ in held[q]], float)
    slope, intercept = _curve(x, y)
    intercept += math.log(share / (1 - share)) - math.log(y.mean() / (1 - y.mean()))
    return {"good": good, "bad": bad, "slope": slope, "intercept": intercept}


def scorer(spark: SparkSession, model: dict) -> Callable[[Column], Column]:
    """A function from a text column to the score of each whole text; null and empty texts get the curve's middle.

    Equal texts get equal scores; a text of any length is compressed block by block.
    """
    small_batches(spark)
    slope, intercept = model["slope"], model["intercept"]

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        good, bad = (_compressor(model[k]) if slope else None for k in ("good", "bad"))
        for texts in batches:
            raw = [t.encode("utf-8", "surrogatepass") if isinstance(t, str) else b"" for t in texts]
            z = [slope and slope * _evidence(t, good, bad) for t in raw]
            yield pd.Series([1 / (1 + math.exp(-max(-700.0, min(700.0, v + intercept)))) for v in z], dtype=float)

    return score


def predicted(value: str = "score") -> Column:
    return F.when(F.col(value) >= THRESHOLD, 1).otherwise(0).cast("int")
