"""The whole pipeline against a plain Python version on rows with planted toxic texts, exact copies and near copies."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from tokenizers import Tokenizer

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _rows():
    rng = random.Random(21)
    vocabulary = ["".join(rng.choices("abcdefghijklmnop", k=rng.randrange(3, 9))) for _ in range(1500)]
    prose = lambda n: rng.choices(vocabulary, k=n)
    texts = []
    for i in range(700):
        words = prose(rng.randrange(40, 160))
        if i % 5 == 0:  # toxic: a few words of a kind that no other text has
            for _ in range(6):
                words[rng.randrange(len(words))] = "zqxvile" + rng.choice(["ly", "ness", ""])
        texts.append(" ".join(words))
    clean = [t for t in texts if "zqx" not in t]
    for t in rng.sample(clean, 40):  # exact copies up to white space
        texts += [t.replace(" ", "\n"), "  " + t]
    for t in rng.sample([t for t in clean if len(t.split()) > 100], 40):  # near copies, from one edited word to too many
        for edits in (1, 2, 30):
            words = t.split()
            for p in rng.sample(range(len(words)), edits):
                words[p] = rng.choice(vocabulary)
            texts.append(" ".join(words))
    texts += ["", None, "One", "one"]
    return [(i, t, rng.choice(["a", "a", "b", "c", None])) for i, t in enumerate(texts)]


def _shingles(text):
    words = [w.lower() for w in WORD.findall(text or "")]
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or {tuple(words)}


def _without_near_copies(rows):
    sets, root, by = {i: _shingles(t) for i, t, _ in rows}, {i: i for i, _, _ in rows}, defaultdict(set)

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, found in sets.items():
        for j in set().union(*(by[s] for s in found)):
            both = len(found & sets[j])
            if 5 * both >= 4 * (len(found) + len(sets[j]) - both):
                x, y = top(i), top(j)
                root[max(x, y)] = min(x, y)
        for s in found:
            by[s].add(i)
    return [r for r in rows if top(r[0]) == r[0]]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rows, path = _rows(), str(tmp_path_factory.mktemp("tables"))
    rng = random.Random(1)
    labels = [(i, int("zqx" in (t or ""))) for i, t, _ in rows if rng.random() < 0.6]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{path}/labels.parquet")
    return path, rows


def test_every_stage_keeps_what_it_should(spark, folder):
    import corpus_pipeline

    path, rows = folder
    stages, docs, kept = dict(corpus_pipeline.STAGES), spark.read.parquet(f"{path}/documents.parquet"), {}
    for name in ("toxicity", "exact_dedup", "near_dedup"):
        docs = corpus_pipeline.materialise(stages[name](spark, docs, path), name)
        kept[name] = {r["doc_id"] for r in docs.collect()}
    clean = [r for r in rows if "zqx" not in (r[1] or "")]
    assert kept["toxicity"] == {r[0] for r in clean}
    best = {}
    for i, t, _ in clean:
        key = re.sub(r"[\x20\x09-\x0D]", "", t or "")
        best[key] = min(best.get(key, (0, i)), (-len(t or ""), i))
    exact = [r for r in clean if (-len(r[1] or ""), r[0]) in best.values()]
    assert kept["exact_dedup"] == {r[0] for r in exact}
    assert kept["near_dedup"] == {r[0] for r in _without_near_copies(exact)} and len(kept["near_dedup"]) < len(exact) - 60


def test_the_mix_and_its_tokens(spark, folder):
    import corpus_pipeline

    path, rows = folder
    text = {i: t for i, t, _ in rows}
    source = {i: s for i, _, s in rows}
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:3]:
        docs = corpus_pipeline.materialise(stage(spark, docs, path), name)
    left = [r["doc_id"] for r in docs.collect()]
    out = corpus_pipeline.run(spark, path).collect()
    taken = Counter(r["doc_id"] for r in out)
    assert set(taken) <= set(left) and max(taken.values()) <= 2
    size = {i: len(WORD.findall(text[i] or "")) for i in left}
    held = Counter()
    for i in left:
        held[source[i]] += size[i]
    ordered, weight = sorted(held, key=lambda s: (s is None, s)), {}
    for k, s in enumerate(ordered):
        weight[s] = (3, 1, 2)[k % 3]
    target, open_, rest = {}, set(ordered), 1.5 * sum(held.values())
    while open_:
        level = rest / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > 2 * held[s]}
        if not full:
            target |= {s: level * weight[s] for s in open_}
            break
        target |= {s: 2.0 * held[s] for s in full}
        rest -= sum(target[s] for s in full)
        open_ -= full
    got = Counter()
    for i, n in taken.items():
        got[source[i]] += n * size[i]
    for s in ordered:
        assert abs(got[s] - target[s]) <= max(size.values())
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for r in out:
        ids = library.encode(text[r["doc_id"]] or "", add_special_tokens=False).ids
        assert list(r["ids"]) == ids and r["n_tokens"] == len(ids)
        assert r["decoded_sha256"] == hashlib.sha256((text[r["doc_id"]] or "").encode()).hexdigest()
