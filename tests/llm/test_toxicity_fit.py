"""The toxicity model keeps every telling n-gram and is fitted outside the driver."""

import random

from marlspike.llm import toxicity
from marlspike.llm.common import maybe_in


def test_rare_toxic_words_keep_their_features(spark):
    rng = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyz"
    word = lambda n: "".join(rng.choices(letters, k=n))
    plain = [word(6) for _ in range(100)]
    loud = " ".join(word(40) for _ in range(150))  # more n-grams, all with a higher z than those of the rare word, than a short list holds
    rows, labels = [], []
    for i in range(1000):
        kind = i % 10
        text = " ".join(rng.choices(plain, k=40))
        text += f" {loud}" if kind < 4 else " grumblesnarkery" * (kind == 4)
        rows.append((i, text))
        labels.append((i, int(kind < 5)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.train(df, spark.createDataFrame(labels, "doc_id long, toxic int"))
    got = {r["doc_id"]: r for r in toxicity.score(df, model).collect()}
    rare = [got[i] for i in range(4, 1000, 10) if got[i]["held_out"]]
    clean = [got[i] for i in range(1000) if i % 10 > 4 and got[i]["held_out"]]
    assert rare and all(r["predicted"] for r in rare)
    assert clean and not any(r["predicted"] for r in clean)


def test_scores_are_calibrated_to_the_share_seen(spark):
    rows = [(i, "plain words " + ("odd sign" if i % 4 == 0 else "no mark")) for i in range(2000)]
    labels = [(i, int(i % 4 == 0 and i % 20 < 8)) for i in range(2000)]  # two in five of the odd texts, a tenth of all
    df = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.train(df, spark.createDataFrame(labels, "doc_id long, toxic int"))
    odd = [r for r in toxicity.score(df, model).collect() if r["doc_id"] % 4 == 0]
    assert abs(sum(r["score"] for r in odd) / len(odd) - 0.4) < 0.05 and not any(r["predicted"] for r in odd)


def test_repeated_rows_do_not_swell_the_sample(spark, monkeypatch):
    seen = []
    plan = toxicity._sampler

    def watched(best):
        seen.append(best)
        run = plan(best)

        def counted(batches):
            for out in run(batches):
                rows.add(out.num_rows)
                yield out

        return counted

    rows = spark.sparkContext.accumulator(0)
    monkeypatch.setattr(toxicity, "_sampler", watched)
    monkeypatch.setattr(toxicity, "SAMPLE", 50)
    # Each of these ids is repeated; by chance some of them would enter a sample with all their rows.
    texts = [(i % 40, f"text {i % 40} " + ("bad sign" if i % 2 else "fine")) for i in range(8000)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    toxicity.train(df, spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int"))
    assert seen and 0 < rows.value <= 100


def test_long_texts_in_pieces_have_the_same_features(monkeypatch):
    rng = random.Random(9)
    rows = ["".join(rng.choices("abc dé\n\t ", k=n)) for n in (0, 1, 2, 5, 40, 1000, 3001)]
    whole = [set(g.tolist()) for g in toxicity.grams(rows)]
    for piece in (7, 100, 999):
        monkeypatch.setattr(toxicity, "PIECE", piece)
        assert [set(g.tolist()) for g in toxicity.grams(rows)] == whole


def test_counts_and_ratios_equal_brute_force(spark):
    """Counts of texts by bucket, their log-count ratios and deviations, over every labelled training row."""
    import math
    import zlib

    rng = random.Random(11)
    rows = [(i, " ".join(rng.choices(["good", "bad", "odd", "fine", "Evil", "très"], k=12))) for i in range(300)]
    labels = [(i, int("Evil" in t and i % 3 > 0)) for i, t in rows if i % 7]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.train(df, spark.createDataFrame(labels, "doc_id long, toxic int"))
    marked = dict(labels)
    seen = [(set(toxicity.grams([t])[0].tolist()), marked[i]) for i, t in rows if i in marked and zlib.crc32(str(i).encode()) % 5]
    n = [sum(y == k for _, y in seen) for k in (0, 1)]
    z, ratio = {}, {}
    for b in set().union(*(g for g, _ in seen)):
        p = [sum(b in g for g, y in seen if y == k) for k in (0, 1)]
        mean = sum(p) / sum(n)
        if sum(p) > 1 and p[0] * n[1] != p[1] * n[0]:
            z[b] = abs(p[1] / n[1] - p[0] / n[0]) / math.sqrt(max(mean * (1 - mean), 1e-12) * (1 / n[0] + 1 / n[1]))
            ratio[b] = math.log(((p[1] + 1) / (n[1] + 2)) / ((p[0] + 1) / (n[0] + 2)))
    kept = {b for b in z if z[b] > toxicity.LEAST_Z + 1e-9}
    assert kept and kept <= set((model.slot >= 0).nonzero()[0].tolist())
    counts = spark.createDataFrame([(b, sum(b in g for g, y in seen if y), sum(b in g for g, y in seen if not y)) for b in ratio], "bucket long, toxic long, clean long")
    for r in toxicity.telling(counts, n[1], n[0]).collect():
        assert abs(r["z"] - z[r["bucket"]]) < 1e-9 and abs(r["ratio"] - ratio[r["bucket"]]) < 1e-9


def test_bitmap_of_ids_loses_none(spark):
    ids = spark.createDataFrame([(i * 37,) for i in range(500)] + [(None,)], "_id long")
    rows = spark.range(200_000).selectExpr("id as _id", "cast(id as string) as _text").unionByName(spark.createDataFrame([(None, "x")], "_id long, _text string"))
    got = [r["_id"] for r in maybe_in(rows, ids, "_id").collect()]
    assert {i * 37 for i in range(500)} <= set(got) and len(set(got)) <= len(got) < 700
    words = spark.createDataFrame([("a",), ("b",)], "_id string")
    assert [r["_id"] for r in maybe_in(words, words.filter("_id = 'a'"), "_id").collect()] == ["a"]
    assert maybe_in(rows, ids.limit(0), "_id").count() == 0
