"""Quality classifier by positive-unlabelled learning.

Each text becomes a few ratios of its characters and words, cut into bins. All documents, as
unlabelled text, and the trusted positives among them are counted by combination of bins, so the risk
below covers the whole corpus, and the table of combinations is small whatever the corpus is (at most the
product of the numbers of bins). The model is linear in indicators of the bins. It minimises the
non-negative unbiased risk ``pi R_p(+1) + max(0, R_u(-1) - pi R_p(-1))`` with the sigmoid loss, where ``pi`` is
the class prior, estimated from the labelled training rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusgauge.llm.common import groups_of
from corpusgauge.llm.toxicity import held_out

BINS = (
    ("words", (1, 5, 20, 50, 500)),
    ("symbols_per_word", (0.005, 0.05, 0.1, 0.3)),
    ("shouts_per_word", (0.01, 0.1, 0.3)),
    ("upper_share", (0.02, 0.1, 0.3, 0.6)),
    ("digit_share", (0.01, 0.05, 0.2)),
    ("mean_word", (2.5, 4.0, 6.0, 9.0)),
    ("marks_per_word", (0.05, 0.15, 0.4)),
    ("packed_share", (0.06, 0.12, 0.2, 0.3)),
)
"""Features and the edges between their bins."""

_KIND = np.zeros(256, np.uint8)  # 0: any other byte
for _kind, _bytes in enumerate((b"\t\n\x0b\x0c\r ", b"#*$%&|<>", b"!", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".,;:?\"'()[]{}-_/\\+=~^`@"), 1):
    _KIND[list(_bytes)] = _kind
_KIND[0x80:0xC0] = 7  # later bytes of a character


def features(texts: list[bytes]) -> np.ndarray:
    """(texts, features) as in ``BINS``."""
    counts = np.zeros((len(texts), 9))
    lengths = np.array([len(t) for t in texts], np.int64)
    kind = _KIND[np.frombuffer(b"".join(texts), np.uint8)]
    owner = np.repeat(np.arange(len(texts)), lengths)
    counts[:, :8] = np.bincount(owner * 8 + kind, minlength=8 * len(texts)).reshape(-1, 8)
    # a word starts at a byte that is no space and follows a space or begins its text
    space = kind == 1
    begins = ~space
    begins[1:] &= space[:-1] | (owner[1:] != owner[:-1])
    counts[:, 8] = np.bincount(owner, begins, len(texts))
    words = np.maximum(counts[:, 8], 1)
    zip_ = zstandard.ZstdCompressor(level=1).compress
    packed = np.array([len(zip_(t)) for t in texts])  # repetition shows as a small share
    chars = np.maximum(lengths - counts[:, 7] - counts[:, 1], 1)
    return np.stack([
        counts[:, 8], counts[:, 2] / words, counts[:, 3] / words, counts[:, 4] / chars, counts[:, 5] / chars, chars / words, counts[:, 6] / words,
        packed / np.maximum(lengths, 1),
    ], axis=1)


def cells_of(texts: list[bytes]) -> np.ndarray:
    """The combination of bins of each text as one number."""
    x, cell = features(texts), np.zeros(len(texts), np.int64)
    for i, (_, edges) in enumerate(BINS):
        cell = cell * (len(edges) + 1) + np.searchsorted(edges, x[:, i], "right")
    return cell


def indicators(cells: np.ndarray) -> np.ndarray:
    """(cells, all bins): one indicator for each feature's bin."""
    blocks = []
    for _, edges in reversed(BINS):
        n = len(edges) + 1
        blocks.append(np.eye(n)[cells % n])
        cells = cells // n
    return np.concatenate(blocks[::-1], axis=1)


def _cells(batches):
    for part, texts in groups_of(batches, "text"):
        yield pa.record_batch({**{c: part.column(c) for c in part.schema.names if c != "text"}, "cell": cells_of(texts)})


def _binned(docs: DataFrame, *keep) -> DataFrame:
    rows = docs.select(*keep, F.col("text").cast("binary").alias("text"))
    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema if f.name != "text")
    return rows.mapInArrow(_cells, kinds + "cell long")


def minimise(x: np.ndarray, positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = 2000, l2: float = 1e-5) -> np.ndarray:
    """Weights (the last is the bias) of least non-negative risk. ``positive`` and ``unlabelled``: how many
    texts of each kind share a row of ``x``."""
    x = np.append(x, np.ones((len(x), 1)), axis=1)
    p, u = positive / positive.sum(), unlabelled / unlabelled.sum()
    w, m, v = np.zeros(x.shape[1]), np.zeros(x.shape[1]), np.zeros(x.shape[1])
    for step in range(1, steps + 1):
        plus = 1 / (1 + np.exp(-(x @ w)))  # loss of calling a text good; 1 - plus: of calling it bad
        slope = plus * (1 - plus)
        # an estimate below 0, which no risk can have, gives no slope
        spare = (u - prior * p) @ plus >= 0
        grad = x.T @ (slope * (-prior * p + ((u - prior * p) if spare else 0)))
        grad[:-1] += l2 * w[:-1]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        w = w - 0.02 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w


def fit(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, float]:
    """(weights, class prior). Trusted positives: documents with quality 1 whose crc32 modulo 3 is not 1.
    Without positives the model is the prior alone."""
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id", 3, 1))
    known = known.groupBy(F.col("doc_id").alias("_l")).agg(F.max("quality").alias("quality"))
    prior = known.agg(F.avg(F.col("quality").cast("double"))).first()[0]
    good = known.where("quality = 1").select("_l", F.lit(1).alias("_good"))
    counted = _binned(docs, "doc_id").join(good, F.col("doc_id") == F.col("_l"), "left").groupBy("cell").agg(
        F.count(F.lit(1)).alias("u"), F.count("_good").alias("p")
    ).orderBy("cell").collect()  # at most the product of the numbers of bins
    width = sum(len(e) + 1 for _, e in BINS) + 1
    prior = min(max(prior if prior is not None else 0.5, 1e-3), 1 - 1e-3)
    p = np.array([r["p"] for r in counted], float)
    if not p.sum():
        return np.append(np.zeros(width - 1), np.log(prior / (1 - prior))), prior
    u = np.array([r["u"] for r in counted], float)
    return minimise(indicators(np.array([r["cell"] for r in counted])), p, u, prior), prior


def _scores(weights: np.ndarray):
    def task(batches):
        for part, texts in groups_of(batches, "text"):
            z = indicators(cells_of(texts)) @ weights[:-1] + weights[-1]
            yield pa.record_batch({**{c: part.column(c) for c in part.schema.names if c != "text"}, "score": 1 / (1 + np.exp(-z))})

    return task


def score(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``held_out``, ``score``, ``predicted``.

    Only ``doc_id`` and ``text``, and ``doc_id`` and ``quality`` of ``labels`` are read, so other columns cannot
    clash. NULL and empty texts share the bin of no words and are scored by it. A NULL id is scored, and not
    held out; labels without id or value teach nothing, of several labels of one id the larger counts.
    Repeated rows are scored each. Empty tables: no rows; without positives all scores are the prior.
    """
    weights, _ = fit(docs, labels)
    rows = docs.select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), F.col("text").cast("binary").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    done = rows.mapInArrow(_scores(weights), f"doc_id {kind}, held_out boolean, score double")
    return done.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
