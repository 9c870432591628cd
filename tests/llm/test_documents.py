"""The document operators against brute force, on rows that are null, empty, long, tied and repeated, with clashing extra columns."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from marlspike.llm import bpe, exact_dedup, media, mixing, passages, sharding, simhash, suffix_dedup, token_counts, toxicity
from marlspike.llm.components import components

SCHEMA = "doc_id long, text string, source string, size long, fp long, _k1 long, kept string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def prose(seed: int, words: int) -> str:
    rnd = random.Random(seed)
    return " ".join("".join(rnd.choice("abcdefgé") for _ in range(rnd.randint(1, 9))) for _ in range(words))


@pytest.fixture(scope="module")
def rows():
    shared = prose(1, 120)
    out = [
        (1, None, "b"), (2, "", "b"), (3, " \n\t", None), (4, "word", "a"), (5, prose(2, 300), "a"), (6, prose(2, 300), "a"), (6, prose(2, 300), "a"),
        (7, prose(2, 300).replace(" ", "\n"), "b"), (8, prose(3, 80) + " " + shared + " " + prose(4, 80), "a"), (9, prose(5, 30) + " " + shared, None),
        (10, shared + shared, "c"), (11, "x" * 3000, "c"), (12, "ab" * 700 + prose(6, 50), "c"), (None, prose(7, 90), "c"), (13, "Zwei <|endoftext|> Wörter  ▁ 😀\r\n", "d"),
        (14, prose(8, 40000), "a"), (15, prose(2, 300) + " tail", "a"), (4, "other", "a"),
    ]
    return [(i, t, s, 5, 6, 7, "x") for i, t, s in out]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def raw(t):
    return (t or "").encode()


def removed(texts: list[bytes], n: int = 400) -> list[np.ndarray]:
    seen = Counter(hash(b[i : i + n]) for b in texts for i in range(len(b) - n + 1))
    out = []
    for b in texts:
        edge = np.zeros(len(b) + 1, np.int64)
        for i in range(len(b) - n + 1):
            if seen[hash(b[i : i + n])] > 1:
                edge[i] += 1
                edge[i + n] -= 1
        out.append(np.cumsum(edge)[: len(b)] > 0)
    return out


@pytest.mark.parametrize("crowd", [512, 1])
def test_suffix_dedup(docs, rows, monkeypatch, crowd):
    monkeypatch.setattr(suffix_dedup, "CROWD", crowd)
    monkeypatch.setattr(suffix_dedup, "BLOCK", 1 << 16)  # the long text spans blocks
    want = Counter()
    for (i, t, *_), gone in zip(rows, removed([raw(r[1]) for r in rows])):
        b = np.frombuffer(raw(t), np.uint8)
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        want[i, len(b), int(gone.sum()), runs, hashlib.sha256(b[~gone].tobytes()).hexdigest()] += 1
    got = suffix_dedup.remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert Counter(map(tuple, got)) == want


@pytest.mark.parametrize("crowd", [512, 1])
def test_suffix_dedup_survives_equal_hashes_of_segments(docs, rows, monkeypatch, crowd):
    """Segments and pieces whose hashes collide all the time are told apart by their bytes."""
    plain = suffix_dedup._segment_rows

    def weak(batches):
        for batch in plain(batches):
            few = pa.array(batch.column("same").to_numpy() & 1)
            yield batch.set_column(batch.schema.get_field_index("same"), "same", few)

    strong = suffix_dedup.xxhash.xxh3_64_intdigest
    monkeypatch.setattr(suffix_dedup, "_segment_rows", weak)
    monkeypatch.setattr(suffix_dedup, "xxhash", SimpleNamespace(xxh3_64_intdigest=lambda data, seed=None: strong(data) & 1 if seed is None else strong(data, seed)))
    monkeypatch.setattr(suffix_dedup, "CROWD", crowd)
    got = suffix_dedup.remove_repeats(docs).select("doc_id", "n_removed").collect()
    assert Counter(map(tuple, got)) == Counter((r[0], int(gone.sum())) for r, gone in zip(rows, removed([raw(r[1]) for r in rows])))


def _passage_words(rows, n=51):
    """Words of each row in windows of ``n`` words that a row of another id or text has as well."""
    split = [re.sub("[A-Z]", lambda m: m[0].lower(), t or "") for _, t, *_ in rows]
    split = [[w.encode() for w in WORD.findall(t)] for t in split]
    seen = defaultdict(set)
    for (i, t, *_), words in zip(rows, split):
        for k in range(len(words) - n + 1):
            seen[hash(tuple(words[k : k + n]))].add((i, t))
    out = []
    for words in split:
        hit = np.zeros(len(words), bool)
        for k in range(len(words) - n + 1):
            hit[k : k + n] |= len(seen[hash(tuple(words[k : k + n]))]) > 1
        out.append(int(hit.sum()))
    return out


def test_shared_passages(spark, rows, docs, monkeypatch):
    got = suffix_dedup.remove_repeats(docs, report=passages.shared_passages).select("doc_id", "n_passage_words").collect()
    assert Counter(map(tuple, got)) == Counter(zip([r[0] for r in rows], _passage_words(rows)))
    monkeypatch.setattr(suffix_dedup, "BLOCK", 200)  # texts span blocks
    rng, words = random.Random(8), [f"w{k}" for k in range(400)]
    common, line = rng.choices(words, k=70), rng.choices(words, k=40)
    made = []
    for i in range(60):
        parts = [rng.choices(words, k=rng.randrange(120)), line, rng.choices(words, k=rng.randrange(9))]
        cut = rng.randrange(30)
        parts += [common[cut : cut + rng.randrange(45, 60)]] if i % 3 else [common] * (i % 2 + 1)
        parts += [rng.choices(words, k=rng.randrange(60))]
        made.append((i, " ".join(w for p in parts for w in p), None, 0, 0, 0, ""))
    got = suffix_dedup.remove_repeats(spark.createDataFrame(made, SCHEMA).repartition(3), report=passages.shared_passages).select("doc_id", "n_passage_words").collect()
    assert Counter(map(tuple, got)) == Counter(zip(range(60), _passage_words(made))) and max(r["n_passage_words"] for r in got) > 60


def test_suffix_sort_orders_and_classes():
    rnd = random.Random(5)
    text = bytes(rnd.choice(b"ab") for _ in range(900)) * 3 + b"c" * 1500
    data = np.frombuffer(text, np.uint8)
    at = np.arange(len(text) - 399)
    cell = np.sort(np.arange(len(at)) % 2)
    order, _ = suffix_dedup.suffix_sort(data, suffix_dedup.Hashes(data), at, cell)
    keys = [(int(cell[i]), text[at[i] : at[i] + 400]) for i in order]
    assert keys == sorted(keys)
    seen = {}
    want = [seen.setdefault((int(c), text[p : p + 400]), i) for i, (p, c) in enumerate(zip(at.tolist(), cell.tolist()))]
    assert suffix_dedup.repeated(data, at, cell).tolist() == want


def test_suffix_sort_survives_equal_hashes(monkeypatch):
    text = prose(3, 400).encode()[:1600]
    data = np.frombuffer(text, np.uint8)
    at = np.arange(0, 1200, 7)
    monkeypatch.setattr(suffix_dedup.Hashes, "of", lambda self, start, length: np.zeros(len(start), np.uint64))
    assert suffix_dedup.repeated(data, at, np.zeros(len(at), np.int64)).tolist() == list(range(len(at)))


def test_sharding(docs, rows):
    got = sharding.shard_documents(docs, shards=5).collect()
    assert len(got) == len(rows)
    slots, homes = defaultdict(list), defaultdict(set)
    texts = Counter((i, len(raw(t)) + 16, zlib.crc32(raw(t))) for i, t, *_ in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == texts
    for r in got:
        slots[r["shard"]].append(r["slot"])
        homes[r["text_sha256"]].add(r["shard"])
        assert r["law"] == "bytes" and r["grown_shard"] is None
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and all(len(h) == 1 for h in homes.values())


def test_schedule_is_longest_first():
    sizes = [(5, "a"), (4, "b"), (3, "c"), (3, "d"), (3, "e")]
    shard = sharding.schedule(sizes, 2)
    load = Counter()
    for size, key in sizes:
        load[shard[key]] += size
    assert sorted(load.values()) == [8, 10] and shard["a"] == 0 and shard["b"] == 1


def fill(sizes: dict, weights: dict, ask: float) -> dict:
    open_, out = set(sizes), {}
    while open_:
        level = ask / sum(weights[s] for s in open_)
        over = [s for s in open_ if level * weights[s] > 2 * sizes[s]]
        if not over:
            return out | {s: level * weights[s] for s in open_}
        for s in over:
            out[s] = 2.0 * sizes[s]
            ask -= out[s]
            open_.discard(s)
    return out


def test_mixing(docs, rows):
    size = Counter()
    for _, t, s, *_ in rows:
        size[s] += len(WORD.findall(t or ""))
    order = sorted(size, key=lambda s: (s is None, s))
    want = fill(dict(size), {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}, 1.5 * sum(size.values()))
    got = mixing.mix(docs).collect()
    again = mixing.mix(docs.repartition(2)).collect()
    pick = lambda rs: sorted((str(r["doc_id"]), r["size"], r["taken"]) for r in rs)
    assert len(got) == len(rows) and pick(got) == pick(again)
    taken, largest = Counter(), Counter()
    for r in got:
        assert abs(r["target"] - want[r["source"]]) <= 1e-9 * max(1, want[r["source"]]) and r["source_size"] == size[r["source"]]
        assert r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    assert all(abs(taken[s] - want[s]) <= largest[s] / 2 + 1 for s in size)
    mixed = mixing.mixed_rows(docs)
    assert mixed.columns == docs.columns
    words = Counter()
    for r in mixed.collect():
        words[r["source"]] += len(WORD.findall(r["text"] or ""))
    assert {s: w for s, w in words.items() if w} == {s: w for s, w in taken.items() if w}


def test_mixing_prefers_quality(spark):
    df = spark.range(4000).selectExpr("id as doc_id", "'a b c d' as text", "'s' as source", "if(id % 2 = 0, 1.0, 0.1) as q")
    from pyspark.sql import functions as F

    got = mixing.mix(df, weight=F.col("q")).groupBy((F.col("doc_id") % 2).alias("odd")).agg(F.sum("epochs").alias("n")).collect()
    n = {r["odd"]: r["n"] for r in got}
    assert n[0] + n[1] == 6000 and n[0] > n[1] + 800


def test_bpe(docs, rows):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    got = bpe.bpe_encode(docs, path, want=("n_tokens", "ids", "ids_sha256", "decoded", "decoded_sha256")).collect()
    want = Counter((i, tuple(library.encode(t or "", add_special_tokens=False).ids), t or "") for i, t, *_ in rows)
    assert Counter((r["doc_id"], tuple(r["ids"]), r["decoded"]) for r in got) == want
    for r in got:
        assert r["n_tokens"] == len(r["ids"]) and r["ids_sha256"] == hashlib.sha256(np.array(r["ids"], "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(r["decoded"].encode()).hexdigest()


def test_bpe_and_counts_match_libraries_on_odd_text():
    import sentencepiece
    from tokenizers import Tokenizer

    rnd = random.Random(9)
    parts = ["a", "b", " ", "  ", "\n", "\t", "▁", "é", "中", "'s", "'", "1", "²", "½", "一", "_", "\x1c", "\x85", "\xa0", "<|endoftext|>", "<s>", "!", "😀", "é", "ǅ", "٣", "Hello", " world", "\x00", "aaaaaaa"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 25))) for _ in range(3000)]
    path = public_tokenizers.path("byte_bpe_50k.json")
    vocab, library = bpe.vocabulary(path), Tokenizer.from_file(path)
    coded = [np.frombuffer(c, "<u4") for c in vocab.encode_batch(texts)]
    assert [c.tolist() for c in coded] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [vocab.decode(c) for c in coded] == library.decode_batch([c.tolist() for c in coded], skip_special_tokens=False)
    model = public_tokenizers.path("piece_bpe_32k.model")
    assert token_counts.count_batch(texts, model) == [len(x) for x in sentencepiece.SentencePieceProcessor(model_file=model).encode(texts)]


def test_bpe_decode_of_ids(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    ids = spark.createDataFrame([(1, [31373, 995]), (2, []), (3, None), (4, [50256])], "doc_id long, ids array<int>")
    assert {r["doc_id"]: r["text"] for r in bpe.bpe_decode(ids, path).collect()} == {1: "hello world", 2: "", 3: "", 4: "<|endoftext|>"}


def test_bpe_table_of_known_words_stays_right(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    path = public_tokenizers.path("byte_bpe_50k.json")
    vocab = bpe.Vocabulary(path)
    texts = [prose(i % 4, 30) for i in range(12)]
    fresh = bpe.Vocabulary(path)
    for t in texts:
        a = vocab.encode_batch([t])[0]
        fresh.known = [{}, {}]
        assert a == fresh.encode_batch([t])[0]


def test_token_counts(docs, rows):
    import sentencepiece

    model = public_tokenizers.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    want = Counter((i, len(raw(t)), n := len(sp.encode(t or "")), n > 4096) for i, t, *_ in rows)
    assert Counter(map(tuple, token_counts.token_counts(docs, model).collect())) == want


def test_exact_groups(docs, rows):
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    groups = defaultdict(list)
    for i, t, *_ in rows:
        groups[norm(t)].append((-len(t or ""), i is None, i))
    got = exact_dedup.exact_groups(docs).collect()
    want = Counter()
    for i, t, *_ in rows:
        g = groups[norm(t)]
        want[i, min(g)[2], len(g), hashlib.sha256(norm(t).encode()).hexdigest()] += 1
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got) == want
    assert sum(r["kept"] for r in got) == len(groups)
    left = exact_dedup.drop_exact_copies(docs)
    assert left.columns == docs.columns and left.count() == len(groups)


def test_exact_groups_with_colliding_hashes(docs, monkeypatch):
    """Chunks whose hashes collide are named by digest, and the groups stay right."""
    pick = lambda df: sorted((str(r["doc_id"]), r["group_size"], r["text_sha256"]) for r in exact_dedup.exact_groups(df).collect())
    want = pick(docs)
    real = exact_dedup.chunk_store
    from pyspark.sql import functions as F

    monkeypatch.setattr(exact_dedup, "chunk_store", lambda df, c="text": real(df, c).withColumn("verified", F.col("h") % 2 == 0))
    assert pick(docs) == want


def test_chunks_do_not_depend_on_neighbours():
    a, b = prose(1, 2000).encode(), prose(2, 3000).encode()
    data = np.frombuffer(a + b, np.uint8)
    starts, home = exact_dedup.cut_points(data, np.array([0, len(a), len(a) + len(b)]))
    alone, _ = exact_dedup.cut_points(np.frombuffer(b, np.uint8), np.array([0, len(b)]))
    assert (starts[home == 1] - len(a)).tolist() == alone.tolist() and len(alone) > 5


def near(rows):
    prints = [simhash.fingerprint(raw(t)) for _, t, *_ in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    low = {}
    for i, r in enumerate(rows):
        ids = low.setdefault(find(i), [])
        ids += [r[0]] if r[0] is not None else []
    return prints, [min(low[find(i)], default=None) for i in range(len(rows))]


@pytest.mark.parametrize("bucket", [256, 1])
def test_near_groups(docs, rows, monkeypatch, bucket):
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    prints, comp = near(rows)
    got = simhash.near_groups(docs).collect()
    assert Counter((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got) == Counter((r[0], f"{p:016x}", c) for r, p, c in zip(rows, prints, comp))
    left = simhash.drop_near_copies(docs)
    assert left.columns == docs.columns and left.count() == len(set(map(str, comp)))


def test_links_lose_nothing_in_crowded_buckets(spark, monkeypatch):
    rnd = random.Random(4)
    base = rnd.getrandbits(64)
    prints = set()
    for _ in range(150):
        x = base
        for _ in range(rnd.randint(0, 5)):
            x ^= 1 << rnd.randrange(64)
        prints.add(x)
    prints |= {rnd.getrandbits(64) for _ in range(50)}
    signed = np.array(sorted(prints), np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(x,) for x in signed], "fp long")

    def parts(pairs):
        root = {x: x for x in signed}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in pairs:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
        return {x: find(x) for x in signed}

    want = parts((a, b) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 3)
    for bucket in (256, 1):
        monkeypatch.setattr(simhash, "BUCKET", bucket)
        found = simhash.links(df)
        assert parts((r["a"], r["b"]) for r in found.collect()) == want
        roots = {r["node"]: r["root"] for r in components(found).collect()}
        assert {x: roots.get(x, x) for x in signed} == want


def test_components_of_a_long_chain(spark):
    df = spark.range(300).selectExpr("id as a", "id + 1 as b").unionByName(spark.createDataFrame([(500, 500), (None, 3)], "a long, b long"))
    got = components(df).collect()
    assert {r["root"] for r in got} == {0} and len(got) == 300


def test_media_round_trip(docs, rows):
    got = media.media_columns(docs).collect()
    want = Counter()
    for i, t, *_ in rows:
        b = raw(t)
        p = b + b"\0" * (media.pad(len(b)) - len(b))
        want[i, len(b), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:])] += 1
    assert Counter((r["doc_id"], r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) for r in got) == want
    by = defaultdict(set)
    for r in got:
        by[r["payload_sha256"], r["n_bytes"]].add((r["media_sha256"], r["media_bytes"], r["feature"]))
    assert all(len(v) == 1 for v in by.values())


def test_media_detects_shots():
    rng = np.random.default_rng(1)
    dark, light = rng.integers(0, 60, media.FRAME * 6), rng.integers(180, 255, media.FRAME * 5)
    x = np.concatenate([dark, light]).astype(np.uint8)
    film = media.read_films(media.store_texts(x, np.array([0, len(x)])))[0]
    assert film["clips"] == [(0.0, 6 / 25, 6), (6 / 25, 11 / 25, 5)] and film["payload"] == x.tobytes()
    with pytest.raises(ValueError):
        media.parse_avi(b"RIFF\4\0\0\0WAVE")


def test_clip_rows(docs):
    features = media.film_features(media.to_films(docs))
    clips = media.clip_rows(features).groupBy("doc_id").sum("frames").collect()
    assert all(r[1] >= 1 for r in clips)


def labelled(n):
    out = []
    for i in range(n):
        t = prose(i, 60)
        if i % 4 == 0:
            words = t.split()
            words[10] = "grumblesnark"
            t = " ".join(words)
        out.append((i, t, int(i % 4 == 0)))
    return out


def test_toxicity(spark, none, docs):
    rows = labelled(600)
    df = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(None, None), (9999, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(0, 0), (5, None), (None, 1)], "doc_id long, toxic int")
    model = toxicity.train(df, labels)
    got = toxicity.score(df, model).collect()
    y = {i: v for i, _, v in rows}
    held = [r for r in got if r["held_out"] and r["doc_id"] in y]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got if r["doc_id"] is not None)
    assert len(held) > 80 and sum(r["predicted"] == y[r["doc_id"]] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got) and len(got) == 602
    clean = toxicity.drop_toxic(df.withColumn("score", df["doc_id"]), model)
    assert clean.columns == ["doc_id", "text", "score"] and 430 <= clean.count() <= 460
    one_class = toxicity.train(df, labels.filter("toxic = 0"))
    assert all(r["predicted"] == 0 for r in toxicity.score(docs, one_class).collect())
    nothing = toxicity.train(df, labels.filter("false"))
    assert toxicity.score(none, nothing).count() == 0


def test_empty_tables(none):
    path, model = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    for df in (
        suffix_dedup.remove_repeats(none), sharding.shard_documents(none), mixing.mix(none), mixing.mixed_rows(none), bpe.bpe_encode(none, path), exact_dedup.exact_groups(none),
        exact_dedup.drop_exact_copies(none), token_counts.token_counts(none, model), simhash.near_groups(none), simhash.drop_near_copies(none), media.media_columns(none),
    ):
        assert df.count() == 0


def test_near_groups_by_several_fingerprints(spark):
    rnd = random.Random(12)
    rows = []
    for i in range(25):
        words = prose(100 + i, 150).split()
        rows.append((2 * i, " ".join(words)))
        for _ in range(1):
            words[rnd.randrange(150)] = "changed"
        rows.append((2 * i + 1, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    sets = {i: simhash.fingerprint_set(t.encode(), extra=3) for i, t in rows}
    close = lambda a, b: any((x ^ y).bit_count() <= 3 for x, y in zip(sets[a], sets[b]))
    want = {2 * i + k: 2 * i if close(2 * i, 2 * i + 1) else 2 * i + k for i in range(25) for k in (0, 1)}
    assert {r["doc_id"]: r["component_id"] for r in simhash.near_groups(df, extra=3).collect()} == want
    assert len(set(want.values())) < 40 and len({r["component_id"] for r in simhash.near_groups(df).collect()}) > len(set(want.values()))
