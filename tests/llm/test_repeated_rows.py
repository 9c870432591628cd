"""Rows that repeat under one id: the search of operator 1 sees each once, whatever the number of copies."""

import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from marlspike.llm import suffix_dedup
from marlspike.llm.common import row_key
from test_documents import removed


def made(copies):
    rng = random.Random(2)
    word = lambda: "".join(rng.choices("abcdefgh", k=6))
    long = " ".join(word() for _ in range(700))
    shared = long[1000:1900]
    rows = [(1, long)] * copies + [(2, f"{word()} {shared} {word()}"), (3, "short"), (3, "short"), (4, None), (None, long[:450]), (None, long[:450])]
    return rows + [(k, " ".join(word() for _ in range(90))) for k in range(10, 30)] + [(40, "z" * 399)] * 2 + [(41, "y" * 400)] * 2


@pytest.mark.parametrize("copies", [1, 2, 50, 400])
def test_against_brute_force(spark, copies):
    rows = made(copies)
    texts = [(t or "").encode() for _, t in rows]
    want = Counter((i, len(b), int(gone.sum()), hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()) for (i, _), b, gone in zip(rows, texts, removed(texts)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = suffix_dedup.remove_repeats(df).select("doc_id", "n_bytes", "n_removed", "kept_sha256").collect()
    assert Counter(map(tuple, got)) == want


def test_what_is_searched_does_not_grow_with_copies(spark):
    """Segments that are cut and compared: as many for 400 copies as for 50."""

    def segments(copies):
        df = spark.createDataFrame(made(copies), "doc_id long, text string").repartition(3)
        rows = df.select(*row_key("doc_id", F.coalesce("text", F.lit(""))), F.coalesce("text", F.lit("")).alias("_text"))
        once, whole = suffix_dedup._once(rows)
        found = once.mapInArrow(suffix_dedup._segment_rows, "anchor long, same long, _k1 long, _k2 long, at long, count int, back int").count()
        return once.count(), found, whole.count()

    assert segments(50) == segments(400) == (27, segments(50)[1], 3)
