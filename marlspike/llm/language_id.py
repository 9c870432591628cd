"""Language identification by a bidirectional gated recurrent network over bytes (operator 13).

Texts are cut into windows of ``WINDOW`` bytes, all of them, and the network reads each window in both directions.  Every
byte (position) gets a probability for each language from both states there, and a document's probabilities are the means over
all its bytes.  Windows go through the network side by side, as numpy arrays with a column a window, so that the work of a
text is in proportion to its bytes and short and long texts share the same steps.

The network (``HIDDEN`` units a direction) is trained in numpy by backpropagation through time, by one task of an executor.  It
sees at most ``SAMPLE`` distinct texts of each language (those with the smallest hash) and at most ``PIECES`` evenly spaced windows of
each; that is the only bounded step.  Languages are the values that the training rows have: their number is that of the output
layer's rows.

Cases: null texts and texts without a letter are ``und`` with score 0 and never trained on; rows with a null id have no fold, are
scored as not held out and never trained on; without training rows every text is ``und``; with one language that is the answer for every text with a
letter; equal probabilities go to the language first by code point; repeated texts count once in the sample; very long texts are read
whole; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlspike.llm.common import chunked, materialise, utf8_buffer
from marlspike.llm.toxicity import fold

WINDOW, HIDDEN = 128, 8
#: Texts of a language in the sample, and windows of a text.
SAMPLE, PIECES = 400, 8
#: Windows of a training step, passes over the sample, the first step's size; windows that are scored side by side.
STEP, PASSES, RATE, LANES = 256, 8, 0.02, 1024
PAD, SYMBOLS = 256, 257
UNKNOWN = "und"
Weights = dict[str, np.ndarray]


def start(languages: int, seed: int = 7) -> Weights:
    """Random weights: ``x`` bytes to gates (2 directions, 3 gates of ``HIDDEN``), ``h`` states to gates, ``o`` both states to languages, ``b`` its bias."""
    r = np.random.default_rng(seed)
    shape = {"x": (2, 3 * HIDDEN, SYMBOLS), "h": (2, 3 * HIDDEN, HIDDEN), "o": (languages, 2 * HIDDEN)}
    w = {k: (r.standard_normal(s) * (0.3 if k == "x" else s[-1] ** -0.5)).astype(np.float32) for k, s in shape.items()}
    return w | {"b": np.zeros((languages, 1), np.float32)}


def _sigmoid(x: np.ndarray) -> np.ndarray:
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def states(w: Weights, steps: np.ndarray, tape: list | None = None) -> np.ndarray:
    """Both directions' states at every position: (positions, 2 ``HIDDEN``, windows).

    ``steps`` are the bytes of the windows, a row a position, ``PAD`` beyond a window's end, where states are 0.
    """
    long, lanes = steps.shape
    n, h = HIDDEN, np.zeros((2, HIDDEN, lanes), np.float32)
    out = np.empty((long, 2, n, lanes), np.float32)
    x, u = (np.empty((2, 3 * n, lanes), np.float32) for _ in range(2))
    inside = steps != PAD
    whole = inside.all()
    for t in range(long):
        at = (t, long - 1 - t)
        for d in (0, 1):
            np.take(w["x"][d], steps[at[d]], axis=1, out=x[d], mode="clip")
        np.matmul(w["h"], h, out=u)
        gates = _sigmoid(x[:, : 2 * n] + u[:, : 2 * n])
        z, r = gates[:, :n], gates[:, n:]
        new = r * u[:, 2 * n :]
        new += x[:, 2 * n :]
        np.tanh(new, out=new)
        prior = h
        h = prior - new
        h *= z
        h += new
        if not whole:
            h *= np.stack([inside[at[0]], inside[at[1]]])[:, None]
        out[at[0], 0], out[at[1], 1] = h[0], h[1]
        if tape is not None:
            tape.append((z, r, new, u[:, 2 * n :].copy(), prior))
    return out.reshape(long, 2 * n, lanes)


def probabilities(w: Weights, seen: np.ndarray) -> np.ndarray:
    """Each position's probabilities: (positions, languages, windows)."""
    p = np.matmul(w["o"], seen)
    p += w["b"]
    p -= p.max(axis=1, keepdims=True)
    np.exp(p, out=p)
    p /= p.sum(axis=1, keepdims=True)
    return p


def gradients(w: Weights, steps: np.ndarray, label: np.ndarray) -> tuple[Weights, float]:
    """Gradients of the mean cross entropy over all positions, back through time, and its value."""
    tape: list = []
    seen = states(w, steps, tape)
    p = probabilities(w, seen)
    long, n = len(steps), HIDDEN
    inside = (steps != PAD).astype(np.float32)
    lanes = np.arange(steps.shape[1])
    total = max(float(inside.sum()), 1.0)
    loss = float(-(np.log(np.maximum(p[:, label, lanes], 1e-12)) * inside).sum() / total)
    p[:, label, lanes] -= 1
    p *= inside[:, None] / total
    g = {"o": np.einsum("tkl,thl->kh", p, seen, optimize=True), "b": p.sum(axis=(0, 2))[:, None], "h": np.zeros_like(w["h"])}
    back = np.matmul(w["o"].T, p).reshape(long, 2, n, -1)
    dx = np.empty((2, 3 * n, long, steps.shape[1]), np.float32)
    carry = np.zeros((2, n, steps.shape[1]), np.float32)
    for t in range(long - 1, -1, -1):
        at = (t, long - 1 - t)
        z, r, new, u, prior = tape[t]
        carry = (carry + np.stack([back[at[0], 0], back[at[1], 1]])) * np.stack([inside[at[0]], inside[at[1]]])[:, None]
        dnew = carry * (1 - z) * (1 - new * new)
        dz, dr = carry * (prior - new) * z * (1 - z), dnew * u * r * (1 - r)
        du = np.concatenate([dz, dr, dnew * r], axis=1)
        g["h"] += np.matmul(du, prior.transpose(0, 2, 1))
        for d in (0, 1):
            dx[d, : 2 * n, at[d]], dx[d, 2 * n :, at[d]] = du[d, : 2 * n], dnew[d]
        carry = carry * z + np.matmul(w["h"].transpose(0, 2, 1), du)
    place = steps.ravel()
    g["x"] = np.stack([[np.bincount(place, row.ravel(), SYMBOLS) for row in dx[d]] for d in (0, 1)]).astype(np.float32)
    return g, loss


def windows(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the windows of a batch of texts begin, their lengths, and the text of each."""
    count = -(-np.diff(offsets) // WINDOW)
    home = np.repeat(np.arange(len(count)), count)
    at = offsets[home] + (np.arange(len(home)) - np.repeat(np.cumsum(count) - count, count)) * WINDOW
    return at, np.minimum(offsets[home + 1] - at, WINDOW), home


def laid_out(raw: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The bytes of windows, a row a position."""
    t = np.arange(int(size.max()))[:, None]
    return np.where(t < size, raw[np.minimum(at + t, len(raw) - 1)].astype(np.intp), PAD)


def fit(pieces: list[bytes], label: np.ndarray, languages: int) -> Weights:
    """Weights after ``PASSES`` over the windows (Adam, a step size that falls to 0); the same for the same windows in the same order."""
    w = start(languages)
    raw = np.frombuffer(b"".join(pieces), np.uint8)
    size = np.array([len(p) for p in pieces])
    at = np.cumsum(size) - size
    share = np.bincount(label, minlength=languages)
    mean, second = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    r = np.random.default_rng(11)
    rounds = [(o, s) for o in range(PASSES) for s in range(0, len(pieces), STEP)]
    chance = 1 / share[label] / np.count_nonzero(share)
    for k, (_, s) in enumerate(rounds, 1):
        some = r.choice(len(pieces), min(STEP, len(pieces)), p=chance)  # languages by turns, whatever their share
        g, _ = gradients(w, laid_out(raw, at[some], size[some]), label[some])
        length = np.sqrt(sum(float((v * v).sum()) for v in g.values()))
        for name, v in g.items():
            v = v / max(length, 1.0)
            mean[name] += 0.1 * (v - mean[name])
            second[name] += 0.001 * (v * v - second[name])
            step = RATE * (1 - k / (len(rounds) + 1)) * (mean[name] / (1 - 0.9**k)) / (np.sqrt(second[name] / (1 - 0.999**k)) + 1e-8)
            w[name] = (w[name] - step).astype(np.float32)
    return w


def pooled(w: Weights, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Each text's mean probabilities over its bytes: (texts, languages)."""
    at, size, home = windows(raw, offsets)
    sums = np.zeros((len(offsets) - 1, len(w["b"])))
    for a in range(0, len(at), LANES):
        some = slice(a, a + LANES)
        steps = laid_out(raw, at[some], size[some])
        p = probabilities(w, states(w, steps))
        if (size[some] != len(steps)).any():
            p *= (steps != PAD)[:, None]
        np.add.at(sums, home[some], p.sum(axis=0).T)
    return sums / np.maximum(np.diff(offsets), 1)[:, None]


class Model:
    """The languages, in order, and the weights (None without training rows)."""

    def __init__(self, languages: list[str], weights: Weights | None) -> None:
        self.languages, self.weights = languages, weights


def _letters(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def _fitter(languages: list[str]) -> Callable[[pa.Table], pa.Table]:
    def run(sample: pa.Table) -> pa.Table:
        rows = sorted((lang, p) for lang, many in zip(sample.column("_lang").to_pylist(), sample.column("_pieces").to_pylist()) for p in many)
        place = {x: i for i, x in enumerate(languages)}
        w = fit([p for _, p in rows], np.array([place[x] for x, _ in rows]), len(languages))
        names = list(w)
        return pa.table({"name": names, "shape": [list(w[n].shape) for n in names], "value": [w[n].ravel().astype(float).tolist() for n in names]})

    return run


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """A model of the rows of ``docs`` with a language outside the held-out fold."""
    text = F.col(text_col).cast("string")
    rows = docs.filter(fold(id_col) != 0).select(F.col(lang_col).cast("string").alias("_lang"), text.alias("_text"))
    rows = rows.filter(F.col("_lang").isNotNull() & _letters(F.col("_text"))).withColumn("_h", F.pmod(F.xxhash64("_text"), F.lit(1 << 40)))
    found = rows.groupBy("_lang").agg(F.approx_count_distinct("_h").alias("n")).collect()  # a row a language
    languages = sorted(r["_lang"] for r in found)
    if not languages:
        return Model([], None)
    # A hash below which twice as many texts are expected, so that few rows are moved; then the SAMPLE smallest of each language.
    rates = docs.sparkSession.createDataFrame([(r["_lang"], min(1 << 40, int(2 * SAMPLE / r["n"] * (1 << 40)))) for r in found], "_lang string, _most long")
    few = rows.join(F.broadcast(rates), "_lang").filter("_h <= _most")
    size = F.octet_length("_text")
    place = F.transform(F.sequence(F.lit(0), F.lit(PIECES - 1)), lambda i: F.floor(i * F.greatest(size - WINDOW, F.lit(0)) / (PIECES - 1)).cast("int"))
    pieces = F.transform(F.array_distinct(place), lambda s: F.substring(F.col("_text").cast("binary"), s + 1, F.lit(WINDOW)))
    few = few.select("_lang", "_h", pieces.alias("_pieces")).dropDuplicates(["_lang", "_h"])
    ranked = few.withColumn("_n", F.row_number().over(Window.partitionBy("_lang").orderBy("_h"))).filter(F.col("_n") <= SAMPLE)
    sample = materialise(ranked.select("_lang", "_pieces"), "windows")
    # The fit is one task of an executor: only the weights come to the driver.
    fitted = sample.groupBy(F.lit(1).alias("all")).applyInArrow(_fitter(languages), "name string, shape array<long>, value array<double>").collect()
    return Model(languages, {r["name"]: np.array(r["value"], np.float32).reshape(r["shape"]) for r in fitted})


def _predictor(model: Model) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    names, w = np.array(model.languages, object), model.weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in chunked(whole, "_text"):
                keep = [n for n in batch.schema.names if n != "_text"]
                p = pooled(w, *utf8_buffer(batch.column("_text")))
                best = p.argmax(axis=1)
                score = np.clip(np.round(p[np.arange(len(p)), best], 6), 0, 1)
                yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in keep), pa.array(names[best], pa.string()), pa.array(score)], [*keep, "lang_pred", "score"])

    return run


def identify(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``held_out``, ``lang_pred`` and ``score`` of every row."""
    text = F.col(text_col).cast("string")
    src = df.select(F.col(id_col).alias("_id"), _letters(text).alias("_letters"), text.alias("_text"))
    if model.weights is None:
        out = src.select("_id", "_letters", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    else:
        kind = df.schema[id_col].dataType.simpleString()
        out = src.mapInArrow(_predictor(model), f"_id {kind}, _letters boolean, lang_pred string, score double")
    out = out.withColumnRenamed("_id", id_col)
    held = F.coalesce(fold(id_col) == 0, F.lit(False))
    known = F.col("_letters")
    return out.select(id_col, held.alias("held_out"), F.when(known, F.col("lang_pred")).otherwise(UNKNOWN).alias("lang_pred"), F.when(known, F.col("score")).otherwise(0.0).alias("score"))
