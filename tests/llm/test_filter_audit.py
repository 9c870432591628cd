"""The filter audit against a plain count."""

import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np

from marlspike.llm import filter_audit

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_measures(text):
    words = WORD.findall(text)
    return len(words), len(set(words)), len(re.findall("[A-Z]", text)), len(text), len(re.findall(r"[#$%&*|]", text))


def measured(texts):
    coded = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(c) for c in coded])]).astype(np.int64)
    found = filter_audit.measure(np.frombuffer(b"".join(coded), np.uint8), offsets)
    return [tuple(int(found[m][i]) for m in filter_audit.MEASURES) for i in range(len(texts))]


def test_transducer_and_span_table():
    rng = random.Random(3)
    pieces = ["a", "B", "é", "日本", "😀", " ", "\t", "\n", "\x0b", "#", "|", "x" * 9, "y" * 17, "z" * 70, "Z" * 8, " ", "\x1c"]
    texts = ["", " ", "a", "aa aa", "é", "日", "x" * 64 + " " + "x" * 65 + " " + "x" * 64, "q" * 300 + "a " + "q" * 300 + "b"]
    texts += ["".join(rng.choices(pieces, k=rng.randint(0, 60))) for _ in range(400)]
    texts.append(" ".join(f"w{i % 5000}" for i in range(20_000)))
    assert measured(texts) == [plain_measures(t) for t in texts]


def test_span_table_verifies_where_hashes_collide():
    words = [b"alpha", b"beta", b"alpha", b"gamma" * 5, b"gamma" * 5, b"delta" * 20, b"delta" * 20, b"delta" * 19 + b"deltb"]
    raw = np.frombuffer(b"".join(words), np.uint8)
    size = np.array([len(w) for w in words])
    spans = filter_audit.Spans(raw, np.array([0, 0, 0, 0, 0, 0, 0, 0]), np.cumsum(size) - size, size)
    spans.hash[:] = 5
    assert spans.insert().tolist() == [True, True, False, True, False, True, False, True]


def brute(docs, labels):
    """Rows of the audit by walking every order over every document."""
    least = {}
    for i, text, _ in docs:
        if i is not None:
            least[text or ""] = min(least.get(text or "", i), i)
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    fails = defaultdict(list)
    for i, text, part in docs:
        words, distinct, capitals, points, symbols = plain_measures(text or "")
        f = "A" * (words < 50) + "B" * (100 * distinct < 65 * words) + "C" * (100 * capitals > 5 * points) + "D" * (symbols > 0)
        fails[part or ""].append((f + "E" * (i is not None and least[text or ""] < i), i in good, i in toxic))
    out, share = {}, Counter()
    for part, rows in fails.items():
        for order in map("".join, permutations("ABCDE")):
            for step in range(1, 6):
                now, before = order[step - 1], set(order[: step - 1])
                gone = [bool(before & set(f)) for f, _, _ in rows]
                hit = [now in f for f, _, _ in rows]
                lost = [h and not g for h, g in zip(hit, gone)]
                out[part, order, step] = [
                    sum(not h and not g for h, g in zip(hit, gone)), sum(lost), sum(h and g for h, g in zip(hit, gone)), sum(f == now for f, _, _ in rows),
                    sum(x and g for x, (_, g, _) in zip(lost, rows)), sum(x and t for x, (_, _, t) in zip(lost, rows)),
                ]
                share[part, now] += sum(lost)
    return {k: (*v, share[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_audit_against_every_order(spark):
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(80)] + ["ABC", "X#", "é"]
    texts = [None, "", " ", "same words " * 40, "SHOUT " * 60] + [" ".join(rng.choices(vocab, k=rng.choice([5, 49, 50, 60, 90, 200]))) for _ in range(60)]
    docs = [(k, rng.choice(texts), rng.choice(["a", "b", None, ""])) for k in range(200)]
    docs += [docs[7], docs[7], (None, "same words " * 40, "a"), (None, None, None), (999, "w " * 400_000, "long")]
    labels = [(k, rng.choice([0, 1, None]), rng.choice([0, 1])) for k in range(0, 200, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1), (5000, 1, 1)]
    d = spark.createDataFrame([(*x, "m", 0) for x in docs], "doc_id long, text string, source string, mask string, n_words int")
    q = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {(r[0], r[1], r[2]): tuple(r[3:]) for r in filter_audit.audit(d, q).collect()}
    assert got == brute(docs, labels)


def test_audit_of_an_empty_table(spark):
    d = spark.createDataFrame([], "doc_id long, text string, source string")
    q = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(d, q).count() == 0
