"""Toxicity: a character n-gram linear classifier scaled by naive Bayes log-count ratios (operator 7).

Features are the n-grams of three to six lower-cased characters (white space counts as one space, so word edges show), hashed to ``BUCKETS``
buckets, present or not.  Spark counts, over all labelled training rows, in how many texts of
either class each bucket is present.  From these counts come the log-count ratios and the
buckets that tell the classes apart: every one beyond ``LEAST_Z``.  A logistic regression on the
scaled features is then fitted, by one task on an executor, on at most ``SAMPLE`` training rows
of each class (those with the smallest hash of id and text), the only bounded step; every other
figure covers all rows.  The model has ``BUCKETS`` weights at most whatever the corpus, and
scoring is one pass over the texts.

Cases: null and empty texts have no feature and get the score of the intercept; rows without
a label, with a null label or a null id are scored and never trained on; a document that is
labelled twice counts as toxic if any label says so; training rows of one class only give that
class's share as every score; repeated rows score alike; very long texts are read whole; an
empty table gives an empty result; extra columns are ignored by :func:`score` and returned by
:func:`drop_toxic`.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from marlspike.llm.common import chunked, materialise, maybe_in, texts

BUCKETS, SAMPLE = 1 << 20, 3000
#: Characters that are hashed together: of one long text, and of several short ones.
PIECE, SLICE = 1 << 20, 1 << 20
#: Standard errors by which a bucket's shares must differ (the best ``FEW`` stay in any case).
LEAST_Z, FEW = 5.0, 64
SIZES = (3, 4, 5, 6)
_blank = re.compile(r"\s+")
FOLDS = 5
_MULT = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1, 0xB5297A4D], np.uint32)


def _hashed(c: np.ndarray) -> list[np.ndarray]:
    """Bucket numbers of the n-grams of an array of characters, an array for each size."""
    shift = np.uint32(32 - BUCKETS.bit_length() + 1)
    out = []
    for n in SIZES:
        if len(c) < n:
            out.append(np.zeros(0, np.uint32))
            continue
        h = np.full(len(c) - n + 1, n * 0x51ED270B & 0xFFFFFFFF, np.uint32)
        for k in range(n):
            h = (h ^ c[k : len(c) - n + 1 + k]) * _MULT[k]
            h ^= h >> np.uint32(15)
        out.append(h >> shift)
    return out


def grams(rows: list[str]) -> list[np.ndarray]:
    """Bucket numbers of all n-grams of each text: with repeats, but of texts beyond ``PIECE`` characters, which are read in pieces, once each."""
    low = [_blank.sub(" ", f" {t.lower()} ") for t in rows]
    short = [t if len(t) <= PIECE else "" for t in low]
    edge = np.concatenate([[0], np.cumsum([len(t) for t in short])])
    hashed = _hashed(np.frombuffer("".join(short).encode("utf-32-le", "surrogatepass"), np.uint32))
    out = [np.concatenate([h[a : max(a, b - n + 1)] for n, h in zip(SIZES, hashed)]) for a, b in zip(edge[:-1], edge[1:])]
    for i, t in enumerate(low):
        if len(t) > PIECE:
            seen = np.zeros(BUCKETS, bool)
            for a in range(0, len(t), PIECE):
                c = np.frombuffer(t[a : a + PIECE + SIZES[-1] - 1].encode("utf-32-le", "surrogatepass"), np.uint32)
                for h in _hashed(c):
                    seen[h] = True
            out[i] = np.flatnonzero(seen).astype(np.uint32)
    return out


@dataclass(frozen=True)
class Model:
    """``slot`` gives each bucket's feature (-1: none); ``weights`` already hold the ratios."""

    slot: np.ndarray
    weights: np.ndarray
    bias: float

    def features(self, rows: list[str]) -> list[np.ndarray]:
        return [np.unique(s[s >= 0]) for s in (self.slot[g] for g in grams(rows))]

    def scores(self, rows: list[str]) -> np.ndarray:
        z = np.array([self.weights[f].sum() + self.bias for f in self.features(rows)])
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def telling(counts: DataFrame, n_toxic: int, n_clean: int) -> DataFrame:
    """Buckets that tell the classes apart: ``bucket``, ``z`` and ``ratio`` (log-count ratio).

    ``counts`` has each bucket's number of ``toxic`` and ``clean`` texts.  Those beyond ``LEAST_Z``
    come back, all of them, and the best ``FEW`` in any case.
    """
    p, q = F.col("toxic") / float(max(n_toxic, 1)), F.col("clean") / float(max(n_clean, 1))
    mean = (F.col("toxic") + F.col("clean")) / float(max(n_toxic + n_clean, 1))
    spread = F.sqrt(F.greatest(mean * (1 - mean), F.lit(1e-12)) * (1 / max(n_toxic, 1) + 1 / max(n_clean, 1)))
    ratio = F.log(((F.col("toxic") + 1.0) / (n_toxic + 2)) / ((F.col("clean") + 1.0) / (n_clean + 2)))
    rows = counts.filter("toxic + clean > 1").select("bucket", (F.abs(p - q) / spread).alias("z"), ratio.alias("ratio")).filter("z > 0")
    rows = materialise(rows, "buckets")
    best = [F.desc("z"), F.asc("bucket")]
    return rows.filter(F.col("z") > LEAST_Z).unionByName(rows.orderBy(*best).limit(FEW)).distinct()


def fit(rows: list[np.ndarray], labels: np.ndarray, ratios: np.ndarray, prior: float, steps: int = 300, l2: float = 1e-2) -> tuple[np.ndarray, float]:
    """Logistic regression on present features scaled by ``ratios``; ``prior`` is the share of toxic rows to calibrate to."""
    n, m = len(rows), len(ratios)
    share = float(labels.mean()) if n else prior
    if not 0 < share < 1 or not m:
        return np.zeros(m), 40.0 if share == 1 else -40.0 if n else 0.0
    # Passes go over a slice of the rows at a time, so that the work arrays stay small.
    parts = []
    for a in range(0, n, 128):
        part = rows[a : a + 128]
        parts.append((slice(a, a + len(part)), np.concatenate(part).astype(np.int32), np.array([len(r) for r in part])))
    weight = np.where(labels == 1, prior / share, (1 - prior) / (1 - share))
    weight = weight / weight.sum()
    w, b = np.zeros(m), float(np.log(prior / (1 - prior)))
    mean_w, mean_b, second_w, second_b = np.zeros(m), 0.0, np.zeros(m), 0.0
    for t in range(1, steps + 1):
        scaled, gw, gb = w * ratios, np.zeros(m), 0.0
        for at, idx, count in parts:
            home = np.repeat(np.arange(len(count)), count)
            z = np.bincount(home, weights=scaled[idx], minlength=len(count)) + b
            err = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - labels[at]) * weight[at]
            np.add.at(gw, idx, err[home])
            gb += err.sum()
        gw = gw * ratios + l2 * w / m
        mean_w, mean_b = 0.9 * mean_w + 0.1 * gw, 0.9 * mean_b + 0.1 * gb
        second_w, second_b = 0.999 * second_w + 0.001 * gw * gw, 0.999 * second_b + 0.001 * gb * gb
        fix1, fix2 = 1 - 0.9**t, 1 - 0.999**t
        rate = 0.02 * (1 - t / (steps + 1))
        w = w - rate * (mean_w / fix1) / (np.sqrt(second_w / fix2) + 1e-8)
        b = b - rate * (mean_b / fix1) / (second_b**0.5 / fix2**0.5 + 1e-8)
    return w * ratios, b


def _fitter(ratios: np.ndarray, prior: float) -> Callable[[pa.Table], pa.Table]:
    """Fits the one group of sampled rows; comes back as ``feature`` and ``weight``, the bias as feature -1."""

    def run(sample: pa.Table) -> pa.Table:
        y = sample.column("_y").to_numpy().astype(float)
        rows = [f.values.to_numpy() for f in sample.column("features")]
        order = sorted(range(len(y)), key=lambda i: (y[i], rows[i].tobytes()))  # a fit that does not depend on the order of arrival
        weights, bias = fit([rows[i] for i in order], y[order], ratios, prior)
        out = [pa.array(np.arange(-1, len(weights)), pa.int32()), pa.array(np.concatenate([[bias], weights]), pa.float64())]
        return pa.Table.from_arrays(out, ["feature", "weight"])

    return run


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in chunked(whole, "_text", 8 << 20):
            packed = [zlib.compress(t.encode(), 1) for t in texts(batch.column("_text"))]
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(packed, pa.binary())], ["_id", "_packed"])


def _unpacked(batch: pa.RecordBatch) -> Iterator[tuple[list[str], list[int]]]:
    """Texts of a packed batch with their labels, about ``SLICE`` characters at a time."""
    held, marks, size = [], [], 0
    for p, y in zip(batch.column("_packed"), batch.column("_y").to_pylist()):
        held.append(zlib.decompress(p.as_py()).decode())
        marks.append(y)
        size += len(held[-1])
        if size >= SLICE:
            yield held, marks
            held, marks, size = [], [], 0
    if held:
        yield held, marks


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros((2, BUCKETS), np.int64)
    for batch in batches:
        for part, y in _unpacked(batch):
            for g, label in zip(grams(part), y):
                counts[label, np.unique(g)] += 1
    hit = np.flatnonzero(counts.sum(axis=0))
    for a in range(0, len(hit), 1 << 16):
        h = hit[a : a + (1 << 16)]
        yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(counts[1, h]), pa.array(counts[0, h])], ["bucket", "toxic", "clean"])


def _sampler(best: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot = np.full(BUCKETS, -1, np.int32)
        slot[best] = np.arange(len(best))
        model = Model(slot, np.zeros(len(best)), 0.0)
        for batch in batches:
            for part, y in _unpacked(batch):
                found = [f.astype(np.int32) for f in model.features(part)]
                yield pa.RecordBatch.from_arrays([pa.array(y, pa.int32()), pa.array(found, pa.list_(pa.int32()))], ["_y", "features"])

    return run


def fold(id_col: str) -> Column:
    """crc32 of an id's text modulo ``FOLDS``; 0 is held out of training."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """A model of the labelled rows of ``docs`` outside the held-out fold."""
    marked = labels.filter(F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(F.max(F.col(label_col).cast("int")).alias("_y"))
    # Texts travel packed: the join moves every text that may have a label once, and what it keeps is written for the two passes to come.
    text = docs.filter(fold(id_col) != 0).select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    kind = docs.schema[id_col].dataType.simpleString()
    text = maybe_in(text, marked.select(F.col("_id").cast(kind)), "_id")
    packed = text.mapInArrow(_pack, f"_id {kind}, _packed binary")
    # The labels grow with the corpus, so they are never broadcast.
    rows = packed.join(marked.hint("merge"), "_id").select("_id", "_packed", F.when(F.col("_y") > 0, 1).otherwise(0).alias("_y"))
    rows = materialise(rows, "labelled")
    sizes = rows.groupBy("_y").agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct(F.xxhash64("_id", "_packed")).alias("d")).collect()
    n, distinct = {r["_y"]: r["n"] for r in sizes}, {r["_y"]: r["d"] for r in sorted(sizes)}
    n_toxic, n_clean = n.get(1, 0), n.get(0, 0)
    counted = rows.select("_packed", "_y").mapInArrow(_count, "bucket long, toxic long, clean long")
    counts = counted.groupBy("bucket").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    found = telling(counts, n_toxic, n_clean).toArrow().sort_by("bucket")  # BUCKETS rows at most
    best, ratios = found.column("bucket").to_numpy().astype(np.int64), found.column("ratio").to_numpy()
    # The sample: the SAMPLE distinct rows of each class with the smallest hash; a repeated row counts once in it.
    sample = None
    for y, several in distinct.items():
        # A hash below which twice as many are expected: few rows are sorted, and the limit holds whatever is repeated.
        few = rows.filter(F.col("_y") == y).withColumn("h", F.pmod(F.xxhash64("_id", "_packed"), F.lit(1 << 40)))
        few = few.filter(F.col("h") < 2 * SAMPLE / several * (1 << 40)).dropDuplicates(["_id", "h"]).orderBy("h", "_id").limit(SAMPLE)
        sample = few if sample is None else sample.unionByName(few)
    if sample is None:
        return Model(np.full(BUCKETS, -1, np.int32), np.zeros(0), 0.0)
    got = sample.select("_packed", "_y").mapInArrow(_sampler(best), "_y int, features array<int>")
    prior = n_toxic / max(n_toxic + n_clean, 1)
    # The fit is one task of an executor: only weights come to the driver.
    fitted = got.withColumn("all", F.lit(1)).groupBy("all").applyInArrow(_fitter(ratios, prior), "feature int, weight double").toArrow().sort_by("feature")
    fitted = fitted.column("weight").to_numpy() if len(fitted) else np.zeros(1 + len(best))
    weights, bias = fitted[1:], fitted[0]
    slot = np.full(BUCKETS, -1, np.int32)
    slot[best] = np.arange(len(best))
    return Model(slot, weights, float(bias))


def _scorer(best: np.ndarray, weights: np.ndarray, bias: float, inside: str | None = None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot = np.full(BUCKETS, -1, np.int32)
        slot[best] = np.arange(len(best))
        model = Model(slot, weights, bias)
        for whole in batches:
            if inside is not None:
                whole = whole.append_column("_text", pc.struct_field(whole.column("_row"), [inside]))
            for batch in chunked(whole, "_text"):
                keep = [k for k in batch.schema.names if k != "_text"]
                z = pa.array(model.scores(texts(batch.column("_text"))), pa.float64())
                yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keep), z], [*keep, "score"])

    return run


def score(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``held_out``, ``score`` and ``predicted`` of every row."""
    kind = df.schema[id_col].dataType.simpleString()
    best = np.flatnonzero(model.slot >= 0)
    src = df.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    out = src.mapInArrow(_scorer(best, model.weights, model.bias), f"_id {kind}, score double").withColumnRenamed("_id", id_col)
    held = F.coalesce(fold(id_col) == 0, F.lit(False))
    return out.select(id_col, held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(df: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that the model does not call toxic, with all their columns."""
    best = np.flatnonzero(model.slot >= 0)
    row = F.struct(*(F.col(f"`{c}`") for c in df.columns))
    kind = df.select(row.alias("r")).schema["r"].dataType.simpleString()
    # A text that is a string already travels once, inside its row.
    inside = text_col if df.schema[text_col].dataType == StringType() else None
    src = df.select(row.alias("_row"), *([] if inside else [F.col(text_col).cast("string").alias("_text")]))
    out = src.mapInArrow(_scorer(best, model.weights, model.bias, inside), f"_row {kind}, score double")
    return out.filter("score < 0.5").select("_row.*")
