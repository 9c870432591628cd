"""Alignment against a walk over both tokenisations by their own libraries."""

import hashlib
import json
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from marlspike.llm import alignment
from marlspike.llm.bpe import byte_symbols

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def walk():
    import sentencepiece
    from tokenizers import Tokenizer

    one = Tokenizer.from_file(A)
    one.encode_special_tokens = True
    two = sentencepiece.SentencePieceProcessor(model_file=B)
    byte_of = {c: b for b, c in byte_symbols().items()}
    spelled = {i: bytes(byte_of[c] for c in s) for s, i in json.load(open(A, encoding="utf-8"))["model"]["vocab"].items()}

    def piece(i):
        p = two.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if p.startswith("<0x") else p.replace("▁", " ").encode()

    def run(text):
        """Token counts, groups as text, and links with their numbers."""
        if not text:
            return 0, 0, "", Counter()
        a, b = one.encode(" " + text, add_special_tokens=False).ids, two.encode(text)
        x, y = [spelled[i] for i in a], [piece(i) for i in b]
        if not b"".join(x) == b"".join(y) == (" " + text).encode():
            return 0, 0, "", Counter()
        ends = [list(np.cumsum([len(t) for t in z])) for z in (x, y)]
        links = Counter()
        j = 0
        for i, end in enumerate(ends[0]):
            while ends[1][j] <= end - len(x[i]):
                j += 1
            k = j
            while k < len(b) and ends[1][k] - len(y[k]) < end:
                links[a[i], b[k]] += 1
                k += 1
        groups, i, j = [], 0, 0
        for end in sorted(set(ends[0]) & set(ends[1])):
            p, q = ends[0].index(end) + 1, ends[1].index(end) + 1
            groups.append(",".join(map(str, a[i:p])) + "|" + ",".join(map(str, b[j:q])))
            i, j = p, q
        return len(a), len(b), ";".join(groups), links

    return run


def hostile(n, seed=1):
    rng = random.Random(seed)
    pieces = ["a", "foo", "Bar", " ", "  ", "\n", "\t", " ", "é", "日本", "😀", "▁", "<|endoftext|>", "<s>", "</s>", "<0x41>", "<unk>", "'s", "'ll", ".", ",", "23", "\x00", "\x1c", "\x85", "　", "ﬁ", "\r\n"]
    return ["".join(rng.choices(pieces, k=rng.randint(0, 12))) for _ in range(n)]


def test_batch_against_the_libraries(walk):
    rows = hostile(3000) + ["x" * 5000, "word " * 3000, " ", "▁"]
    both = alignment.Tokenizers(A, B)
    for at in range(0, len(rows), 250):
        part = rows[at : at + 250]
        got = {k: v.to_pylist() for k, v in alignment.align_batch(both, part).items()}
        for i, text in enumerate(part):
            n_a, n_b, groups, links = walk(text)
            size = len(both.sizes[1])
            found = {((v >> 32) // size, (v >> 32) % size): v & 0xFFFFFFFF for v in got["links"][i]}
            assert (got["n_a"][i], got["n_b"][i], got["groups"][i], found) == (n_a, n_b, groups, dict(links)), text
            assert (got["n_links"][i], got["n_groups"][i]) == (sum(links.values()), groups.count("|"))


def test_pieces_of_the_merge_are_independent_of_their_length():
    rng = np.random.default_rng(2)
    for _ in range(60):
        total = int(rng.integers(1, 80))
        a, b = (np.append(np.sort(rng.choice(total, rng.integers(0, total), replace=False) + 1), total + 1) for _ in range(2))
        want = alignment.merge_ends(a, b, 10_000)
        for steps in (1, 2, 3, 7, 64):
            assert all(np.array_equal(x, y) for x, y in zip(alignment.merge_ends(a, b, steps), want))
        common = sorted(set(a.tolist()) & set(b.tolist()))
        assert a[want[2]].tolist() == common == b[want[3]].tolist()


@pytest.mark.parametrize("hot", [1 << 17, 60, 0])
def test_counts_and_scores(spark, walk, monkeypatch, hot):
    """Pairs that are broadcast and pairs that are joined give the same figures; repeated rows are documents of their own."""
    monkeypatch.setattr(alignment, "HOT", hot)
    texts = hostile(120, 9) + ["the cat sat on the mat, the end."] * 30 + [None, "", "▁", "unbelievable tokenisation " * 2000]
    rows = list(enumerate(texts)) + [(3, texts[3]), (None, "the cat"), (None, None)]
    df = spark.createDataFrame([(i, t, "c", 1) for i, t in rows], "doc_id long, text string, links string, _row int")
    each = [(i, *walk(t)) for i, t in rows]
    count = Counter(p for r in each for p in r[4])
    most = {}
    for (a, _), n in count.items():
        most[a] = max(most.get(a, 0), n)
    want = Counter(
        (i, n_a, n_b, g.count("|"), sum(links.values()), sum(n for p, n in links.items() if count[p] == most[p[0]]), sum(n * count[p] for p, n in links.items()),
         hashlib.sha256(g.encode()).hexdigest() if g else "")
        for i, n_a, n_b, g, links in each
    )
    assert Counter(map(tuple, alignment.scored_alignment(df, A, B).collect())) == want


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.scored_alignment(df, A, B).count() == 0
