"""The pipeline's near-dedup stage against brute force over all pairs."""

import random

import numpy as np
import pyarrow as pa

from marlspike.llm import near_dedup


def _shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or {tuple(words)}


def _kept(rows):
    """Smallest id of each group that pairs at a five-word Jaccard similarity of 0.8 or more join."""
    sets = [(i, _shingles(t)) for i, t in rows]
    root = {i: i for i, _ in rows}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for x, (i, a) in enumerate(sets):
        for j, b in sets[:x]:
            if 5 * len(a & b) >= 4 * len(a | b):
                i_top, j_top = top(i), top(j)
                root[max(i_top, j_top)] = min(i_top, j_top)
    return sorted({top(i) for i in root})


def _edited(rng, words, n):
    words = list(words)
    for p in rng.sample(range(len(words)), n):
        words[p] = f"edit{rng.randrange(10**6)}"
    return " ".join(words)


def _rows():
    rng = random.Random(7)
    vocabulary = [f"w{k}" for k in range(3000)]
    texts = ["", None, "one", "One ", "a b c d e", "a b c d f"]
    for edits in (1, 2, 4, 8, 8, 16, 40):
        for _ in range(6):
            base = rng.choices(vocabulary, k=rng.randrange(200, 600))
            texts += [" ".join(base), _edited(rng, base, edits)]
    base = rng.choices(vocabulary, k=400)  # a group above near_dedup.BUCKET, and texts that share half of its words
    texts += [_edited(rng, base, rng.randrange(1, 7)) for _ in range(60)]
    texts += [" ".join(base[:200] + rng.choices(vocabulary, k=120)) for _ in range(40)]
    return list(enumerate(texts))


def test_near_dedup_stage_equals_brute_force(spark, small):
    import corpus_pipeline

    rows = _rows()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = corpus_pipeline.near_dedup_stage(spark, df, small)
    assert sorted(r["doc_id"] for r in got.collect()) == _kept(rows)
    assert corpus_pipeline.near_dedup_stage(spark, df.filter("false"), small).count() == 0


def test_crowded_buckets_are_split_again(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BUCKET", 1)
    rows = _rows()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r["doc_id"] for r in near_dedup.drop_near_copies(df).collect()) == _kept(rows)


def test_fingerprint_is_the_simhash_of_the_shingles():
    found = near_dedup.shingle_set(" ".join(f"w{k}" for k in range(300)).encode())
    assert len(found) > 255
    hashes = near_dedup.bit_hashes(found, 3).tolist()
    want = [sum((2 * sum(row[w] >> b & 1 for row in hashes) > len(found)) << b for b in range(64)) for w in range(3)]
    assert near_dedup.fingerprint(found, 3).tolist() == want


def test_near_copies_share_a_deletion_variant():
    segments, width = near_dedup.layout(1000)
    words = near_dedup._words(segments, width)
    rng = np.random.default_rng(5)
    for shared, one, two, pairs in ((4, 1, 0, 100), (12, 2, 1, 100), (20, 3, 2, 100), (160, 20, 20, 200), (160, 40, 0, 200)):
        for _ in range(pairs):
            h = rng.integers(0, 1 << 64, shared + one + two, np.uint64)
            x, y = h[: shared + one], np.concatenate([h[:shared], h[shared + one :]])
            n = words * (1 + (max(len(x), len(y)) <= near_dedup.SHORT))
            prints = np.stack([near_dedup.fingerprint(s, n) for s in (x, y)])
            assert np.bitwise_count(prints[0, :2] ^ prints[1, :2]).sum() <= near_dedup.FAR
            keys = [near_dedup.variant_keys(prints[:, a : a + words], 0, segments, width) for a in range(0, n, words)]
            assert any(set(k[0].tolist()) & set(k[1].tolist()) for k in keys)


def test_buckets_that_batches_cut_are_whole():
    sizes = [1, 2, 3, 1, 30, 4, 1, 25, 1, 2]
    key = np.repeat(np.arange(len(sizes)), sizes)
    rows = pa.table({"key": key, "node": np.arange(len(key)), "f1": np.full(len(key), -1), "f2": np.zeros(len(key), np.int64)})
    pairs = {(x, y, None) for x in range(len(key)) for y in range(x + 1, len(key)) if key[x] == key[y] and sizes[key[x]] <= 4}
    heads = {(x, int(np.searchsorted(key, key[x])), int(key[x])) for x in range(len(key)) if sizes[key[x]] > 4}
    for cut in (1, 3, 7, 100):
        out = [r for b in near_dedup._meet(4)(iter(rows.to_batches(cut))) for r in b.to_pylist()]
        assert {(r["a"], r["b"], r["key"]) for r in out} == pairs | heads and len(out) == len(pairs | heads)


def test_near_copies_share_a_variant_in_a_cell():
    segments, width = near_dedup.layout(1000)
    words = near_dedup._words(segments, width)
    count, bits = near_dedup.tables(1000, segments, width)
    rng = np.random.default_rng(6)
    for shared, one, two, pairs in ((4, 1, 0, 60), (12, 2, 1, 60), (20, 3, 2, 60), (160, 20, 20, 100), (160, 40, 0, 100)):
        for _ in range(pairs):
            h = rng.integers(0, 1 << 64, shared + one + two, np.uint64)
            x, y = h[: shared + one], np.concatenate([h[:shared], h[shared + one :]])
            n = words * (1 + (max(len(x), len(y)) <= near_dedup.SHORT))
            prints = np.stack([near_dedup.fingerprint(s, n) for s in (x, y)])
            assert near_dedup.may_match(prints[:1, :words], prints[1:, :words], np.array([min(len(x), len(y))])).all()

            def meet(half, table):
                if len(set(near_dedup._cells_of(half, table, segments, bits, width).tolist())) > 1:
                    return False
                keys = [near_dedup.variant_keys(half, s, s + 1, width) for s in near_dedup.drawn(table, segments, bits, width)[0]]
                return any(set(k[0].tolist()) & set(k[1].tolist()) for k in keys)

            assert any(meet(prints[:, a : a + words], t) for a in range(0, n, words) for t in range(count))


def test_cells_that_batches_cut_are_whole():
    cell = np.repeat(np.arange(6), [3, 1, 40, 2, 25, 1])
    rows = pa.table({"cell": cell, "node": np.arange(len(cell))})
    for cut in (1, 3, 7, 100):
        seen = []
        list(near_dedup._each_cell(lambda t: seen.append((t["cell"].to_pylist(), t["node"].to_pylist())) or [])(iter(rows.to_batches(cut))))
        assert seen == [(cell[cell == c].tolist(), np.flatnonzero(cell == c).tolist()) for c in range(6)]


def test_large_groups_are_not_verified_pair_by_pair(spark, monkeypatch):
    rng = random.Random(9)
    vocabulary = [f"w{k}" for k in range(3000)]
    base, other = rng.choices(vocabulary, k=300), rng.choices(vocabulary, k=240)
    texts = [_edited(rng, base, rng.randrange(1, 4)) for _ in range(150)]  # near copies
    texts += [" ".join(other + rng.choices(vocabulary, k=64)) for _ in range(150)]  # alike at about 0.65, which is too little
    verified, counts = near_dedup._verified, []

    def counted(pairs, *rest):
        counts.append(pairs.count())
        return verified(pairs, *rest)

    monkeypatch.setattr(near_dedup, "_verified", counted)
    rows = list(enumerate(texts))
    got = near_dedup.drop_near_copies(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(r["doc_id"] for r in got.collect()) == _kept(rows)
    assert sum(counts) < 10 * len(rows), counts
