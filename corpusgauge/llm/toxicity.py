"""Toxicity by multiple-instance learning: a document is a bag of sentences.

A sentence has the probability ``sigmoid(b + sum of its words' weights)``. A document is toxic if any sentence
is: ``1 - product(1 - p)``, the noisy-or, which is fitted to the labels of whole documents. Words count
by themselves and by their first bytes, so inflected forms share a weight. The fit uses at most ``most``
labelled documents, those with the smallest hashes of their ids, in one task; features are chosen among
these by their association with the label. All documents are then scored whole, and sentences over the
threshold are located.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusgauge.llm.common import PLAIN, Words, groups_of

PREFIXES = (3, 4, 5, 6)
_END = np.zeros(256, bool)
_END[list(b".!?\n")] = True


class Sentences:
    """Words of texts with their features (one row of hashes per kind) and sentences."""

    def __init__(self, texts: list[bytes]):
        words = Words([t.translate(PLAIN) for t in texts], prefixes=PREFIXES)
        self.features = np.stack([words.hashes[0], *words.prefixes])
        self.text = words.text_of()
        ended = np.cumsum(_END[np.frombuffer(b" ".join(texts), np.uint8)], dtype=np.int64)
        at = ended[words.starts]
        new = np.ones(len(at), bool)
        new[1:] = (at[1:] != at[:-1]) | (self.text[1:] != self.text[:-1])
        self.first = np.flatnonzero(new)  # first word of each sentence
        self.of_word = np.cumsum(new) - 1
        self.of = self.text[self.first]  # text of each sentence
        self.starts, self.ends, self.offsets = words.starts, words.ends, words.offsets


def _lookup(features: np.ndarray, known: np.ndarray):
    """(word, place in ``known``) of every feature that is known. A bitmap by low bits comes first."""
    if not len(known):
        none = np.zeros(0, np.int64)
        return none, none
    mask = np.uint64((1 << 22) - 1)
    some = np.zeros(1 << 22, bool)
    some[known & mask] = True
    kind, word = np.nonzero(some[features & mask])
    value = features[kind, word]
    at = np.minimum(np.searchsorted(known, value), len(known) - 1)
    hit = known[at] == value
    return word[hit], at[hit]


def _fit(most_features: int, least_df: int, steps: int, l2: float):
    """All labelled documents of the sample to (feature, weight); feature 0 is the bias."""

    def group(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("order", "ascending"), ("text", "ascending")])
        label = rows.column("label").to_numpy().astype(float)
        texts = rows.column("text").to_pylist()
        stretches = range(0, len(texts), 128)
        read = lambda at: Sentences([t or b"" for t in texts[at : at + 128]])
        rate, mask = label.mean(), np.uint64((1 << 22) - 1)

        def association(df, toxic):
            """Squared deviation from the mean share of toxic documents, in units of its variance."""
            g = (toxic - df * rate) ** 2 / (df * rate * (1 - rate) + 1e-9)
            g[(df < least_df) | (g < 12)] = 0
            return g

        # first by the features' low bits, in little memory; then by the features that these leave
        df, toxic = np.zeros(1 << 22), np.zeros(1 << 22)
        for at in stretches:
            x = read(at)
            pair = np.unique((x.features & mask).astype(np.int64).ravel() * 128 + np.tile(x.text, len(x.features)))
            np.add.at(df, pair // 128, 1)
            np.add.at(toxic, pair // 128, label[at + pair % 128])
        some = association(df, toxic) > 0
        features, sentences, owners, n_sentences = [], [], [], 0
        for at in stretches:
            x = read(at)
            kind, word = np.nonzero(some[x.features & mask])
            features.append(x.features[kind, word])
            sentences.append(x.of_word[word] + n_sentences)
            owners.append(x.of + at)
            n_sentences += len(x.of)
        feature, sentence, owner = map(np.concatenate, (features, sentences, owners))
        known, place = np.unique(feature, return_inverse=True)
        pair = np.unique(place.astype(np.int64) * len(texts) + owner[sentence])
        df = np.bincount(pair // len(texts), minlength=len(known))
        g = association(df, np.bincount(pair // len(texts), label[pair % len(texts)], len(known)))
        chosen = np.sort(np.argsort(-g, kind="stable")[: min(most_features, int((g > 0).sum()))])
        column = np.full(len(known), -1)
        column[chosen] = np.arange(len(chosen))
        column = column[place]
        keep = column >= 0
        column, sentence = column[keep], sentence[keep]
        w, b = np.zeros(len(chosen)), -6.0
        m, v = np.zeros(len(chosen) + 1), np.zeros(len(chosen) + 1)
        for step in range(1, steps + 1):
            z = b + np.bincount(sentence, w[column], n_sentences)
            total = np.bincount(owner, np.logaddexp(0, z), len(label))  # -log of the share that no sentence is toxic
            slope = np.where(label > 0, -1 / np.expm1(np.clip(total, 1e-6, 500)), 1.0)
            dz = slope[owner] / (1 + np.exp(-z)) / len(label)
            grad = np.append(np.bincount(column, dz[sentence], len(chosen)) + l2 * w, dz.sum())
            m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
            move = 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
            w, b = w - move[:-1], b - move[-1]
        return pa.table({"feature": np.append(np.uint64(0), known[chosen]).view(np.int64), "weight": np.append(b, w)})

    return group


def held_out(id_column: str, parts: int, part: int):
    """Whether crc32 of the id as text leaves ``part``; false for a NULL id."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_column).cast("string").cast("binary")), F.lit(parts)) == part, F.lit(False))


def sample_of(docs: DataFrame, labels: DataFrame, label: str, parts: int, part: int, most: int) -> DataFrame:
    """(order, label, text): the labelled documents to fit, at most ``most`` ids by the order of a hash,
    and one text of each id: that of the smallest hash."""
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id", parts, part))
    known = known.groupBy(F.col("doc_id").alias("_l")).agg(F.max(label).alias("label"))
    chosen = known.orderBy(F.xxhash64("_l"), "_l").limit(most).select("_l", F.col("label").cast("int").alias("label"))
    text = F.col("text").cast("binary").alias("text")
    rows = docs.select("doc_id", text).join(F.broadcast(chosen), F.col("doc_id") == F.col("_l"))
    rows = rows.groupBy("doc_id", "label").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))  # at most ``most`` rows
    return rows.select(F.xxhash64("doc_id").alias("order"), "label", "text")


def fit(docs: DataFrame, labels: DataFrame, most: int = 12_000, most_features: int = 20_000, least_df: int = 4, steps: int = 250, l2: float = 1e-5):
    """(bias, sorted feature hashes, weights). Without labelled documents every score is 0."""
    rows = sample_of(docs, labels, "toxic", 4, 2, most)
    task = _fit(most_features, least_df, steps, l2)
    found = rows.withColumn("all", F.lit(0)).groupBy("all").applyInArrow(task, "feature long, weight double").collect()  # most_features + 1 rows at most
    feature = np.array([r["feature"] for r in found], np.int64).view(np.uint64)
    weight = np.array([r["weight"] for r in found], float)
    if not len(found):
        return -np.inf, feature, weight
    by = np.argsort(feature[1:])
    return float(weight[0]), feature[1:][by], weight[1:][by]


def _scores(model, threshold: float):
    """Task: score, number of sentences, and the offending sentences of each text."""
    bias, known, weight = model

    def task(batches):
        for part, texts in groups_of(batches, "text"):
            x = Sentences(texts)
            n = len(x.of)
            word, at = _lookup(x.features, known)
            z = bias + np.bincount(x.of_word[word], weight[at], n) if n else np.zeros(0)
            score = -np.expm1(-np.bincount(x.of, np.logaddexp(0, z), len(texts)))
            p = 1 / (1 + np.exp(-np.clip(z, -700, 700)))
            spans: list[list[dict]] = [[] for _ in texts]
            last = np.append(x.first[1:], len(x.starts)) - 1
            for i in np.flatnonzero(p >= threshold).tolist():
                t = int(x.of[i])
                a, b = int(x.starts[x.first[i]] - x.offsets[t]), int(x.ends[last[i]] - x.offsets[t])
                spans[t].append({"start": a, "end": b, "score": float(p[i]), "text": texts[t][a:b].decode("utf-8", "replace")})
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("text", pa.string())]))
            yield pa.record_batch({
                **{c: part.column(c) for c in part.schema.names if c != "text"},
                "score": score, "n_sentences": np.bincount(x.of, minlength=len(texts)).astype(np.int64), "offending": pa.array(spans, kind),
            })

    return task


def score(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, model=None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per row of ``docs``: the columns ``keep``, ``held_out``, ``score``, ``predicted``, ``n_sentences``,
    ``offending`` (sentences at or over the threshold: start and end in UTF-8 bytes, score, text).

    Only these columns, ``doc_id`` and ``text``, and ``doc_id`` and ``toxic`` of ``labels`` are read. Labels
    come from rows whose crc32 modulo 4 is not 2; rows without id or label teach nothing, of several
    labels of one id the larger counts. NULL, empty and wordless texts: score 0. A NULL id is scored, and not
    held out. Repeated rows are scored each. Empty tables: no rows; without labels all scores are 0.
    """
    model = model or fit(docs, labels)
    rows = docs.select(*keep, held_out("doc_id", 4, 2).alias("held_out"), F.col("text").cast("binary").alias("text"))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "text")
    spans = "array<struct<start:bigint,end:bigint,score:double,text:string>>"
    done = rows.mapInArrow(_scores(model, threshold), f"{kept}, score double, n_sentences long, offending {spans}")
    return done.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def clean(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """``docs`` with all its columns, without the rows that are predicted toxic. NULL and empty texts stay."""
    model = fit(docs, labels)
    task = _flags(model)
    rows = docs.select(F.struct("*").alias("_row"), F.col("text").cast("binary").alias("_text"))
    flag = F.pandas_udf(task, "double")
    return rows.where(F.coalesce(flag("_text"), F.lit(0.0)) < threshold).select("_row.*")


def _flags(model):
    """Scores of a series of texts."""
    bias, known, weight = model

    def scores(texts: pd.Series) -> pd.Series:
        out, at = [], 0
        values = [t or b"" for t in texts]
        while at < len(values):
            to, size = at, 0
            while to < len(values) and (to == at or size < 1 << 20):
                size += len(values[to])
                to += 1
            x = Sentences(values[at:to])
            word, place = _lookup(x.features, known)
            z = bias + np.bincount(x.of_word[word], weight[place], len(x.of)) if len(x.of) else np.zeros(0)
            out.append(-np.expm1(-np.bincount(x.of, np.logaddexp(0, z), to - at)))
            at = to
        return pd.Series(np.concatenate(out) if out else np.zeros(0))

    return scores
