"""The language network: its gradients, its pooling, its accuracy on held-out rows, and hostile tables."""

import zlib

import numpy as np
import pytest

from marlspike.llm import language_id


def test_gradients_against_differences():
    rng = np.random.default_rng(0)
    steps = rng.integers(97, 101, (6, 5))
    steps[3:, 1] = language_id.PAD
    label = np.array([0, 1, 2, 1, 0])
    w = language_id.start(3)
    got, _ = language_id.gradients(w, steps, label)
    for name in w:
        for flat in np.argsort(-np.abs(got[name]).ravel())[:4]:
            at = np.unravel_index(flat, w[name].shape)
            sides = []
            for shift in (0.01, -0.01):
                moved = w | {name: w[name].copy()}
                moved[name][at] += shift
                sides.append(language_id.gradients(moved, steps, label)[1])
            assert got[name][at] == pytest.approx((sides[0] - sides[1]) / 0.02, rel=0.02, abs=1e-5)


def plain_states(w, data):
    """One window through both directions, byte by byte."""
    n, out = language_id.HIDDEN, []
    for d, order in ((0, data), (1, data[::-1])):
        h, seen = np.zeros(n), []
        for byte in order:
            x, u = w["x"][d][:, byte].astype(float), w["h"][d].astype(float) @ h
            z, r = (1 / (1 + np.exp(-(x[k : k + n] + u[k : k + n]))) for k in (0, n))
            new = np.tanh(x[2 * n :] + r * u[2 * n :])
            h = new + z * (h - new)
            seen.append(h)
        out.append(seen if d == 0 else seen[::-1])
    return np.concatenate([np.array(out[0]), np.array(out[1])], axis=1)


def test_pooling_reads_whole_texts():
    rng = np.random.default_rng(4)
    w = language_id.start(3)
    texts = [bytes(rng.integers(0, 256, k, dtype=np.uint8)) for k in (0, 1, 5, 127, 128, 129, 700, 3000)]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    got = language_id.pooled(w, np.frombuffer(b"".join(texts), np.uint8), offsets)
    for t, row in zip(texts, got):
        p = []
        for at in range(0, len(t), language_id.WINDOW):
            z = plain_states(w, t[at : at + language_id.WINDOW]) @ w["o"].T.astype(float) + w["b"].T
            p.append(np.exp(z) / np.exp(z).sum(axis=1, keepdims=True))
        assert np.allclose(row, np.concatenate(p).mean(axis=0) if p else 0, atol=1e-4)


def test_held_out_accuracy_and_hostile_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language_id.train(docs)
    assert model.languages == ["de", "en", "es", "fr"]
    lang = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    got = language_id.identify(docs, model).collect()
    held = [r for r in got if r["held_out"]]
    assert len(got) == len(lang) and {r["doc_id"] for r in held} == {i for i in lang if zlib.crc32(str(i).encode()) % 5 == 0}
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) >= 0.98 * len(held)
    again = {r["doc_id"]: r for r in language_id.identify(docs.repartition(3), language_id.train(docs)).collect()}
    assert sum(again[r["doc_id"]]["lang_pred"] != r["lang_pred"] for r in got) == 0
    long = "Then the thing is that the end of the other " * 30_000
    odd = spark.createDataFrame(
        [(1, None, "x"), (2, "", "x"), (3, "12 34 !?", "x"), (4, long, "x"), (4, long, "x"), (None, "the and of the", None)], "doc_id long, text string, _letters string"
    )
    out = sorted(language_id.identify(odd, model).collect(), key=str)
    by = {r["doc_id"]: r for r in out}
    assert len(out) == 6 and all((by[i]["lang_pred"], by[i]["score"]) == ("und", 0.0) for i in (1, 2, 3))
    assert by[4]["lang_pred"] == "en" and by[4]["score"] > 0.5 and by[None]["held_out"] is False
    assert all(0 <= r["score"] <= 1 for r in [*got, *out])


def test_nothing_to_learn_from(spark):
    schema = "doc_id long, text string, lang string"
    for rows in ([], [(1, "abc", None), (2, None, "en"), (3, "12", "fr"), (None, "abc", "de")]):
        df = spark.createDataFrame(rows, schema)
        out = language_id.identify(df, language_id.train(df)).collect()
        assert len(out) == len(rows) and all(r["lang_pred"] == "und" and r["score"] == 0 for r in out)
    one = spark.createDataFrame([(i, "some words of it", "en") for i in range(20)], schema)
    assert {r["lang_pred"] for r in language_id.identify(one, language_id.train(one)).collect()} == {"en"}
