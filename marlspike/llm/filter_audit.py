"""Interaction audit of document filters (operator 12).

A finite-state transducer over bytes, given as two tables (:data:`NEXT`, :data:`EMIT`), reads every text once.  It tells
where words begin and end and which bytes are capitals, symbols and first bytes of characters.  All bytes but the
continuation bytes of UTF-8 lead to one state from every state, so the states of a whole batch follow from its bytes at
once; continuation bytes take three rounds more.  The spans of the words go into a hash table with open addressing; a
span is another's repeat only where document, length and bytes agree.

From the counts come the filters (:data:`FILTERS`, conditions in SQL), and from these a mask a document.  What any order of
filters keeps and removes depends only on how many documents each part has of each mask, so the corpus is reduced to
these counts (32 a part) before the orders are laid out.  The filter on repeated texts needs the smallest id of each text: texts meet by
their SHA-256, and documents are told by text and id together, so that a text that many documents share is no hot key.

Cases: a null text is the empty one, a null part is the empty string; a row with a null id repeats no one and is no one's
original; rows that agree in id and text do not repeat each other; a document labelled twice has a label if any row says
so, rows without a label count as neither; malformed UTF-8 (which Spark's own readers do not give) counts each stray byte as a
character; very long texts are read whole; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import permutations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlspike.llm.common import chunked, materialise, utf8_buffer

# Classes of bytes.
SPACE, UPPER, SYMBOL, PLAIN, CONT, LEAD2, LEAD3, LEAD4 = range(8)
# States: between words; in a word; in a word with one, two, three bytes of a character to come.
OUT, WORD, NEED1, NEED2, NEED3 = range(5)
# What is emitted at a byte.
STARTS, ENDS, CAPITAL, MARK, POINT = 1, 2, 4, 8, 16
#: Bytes of a word that are kept as numbers, and the length from which a word is hashed by itself.
LANE, LONG = 8, 64


def _classes() -> np.ndarray:
    kind = np.full(256, PLAIN, np.uint8)
    kind[[0x20, *range(0x09, 0x0E)]] = SPACE
    kind[ord("A") : ord("Z") + 1] = UPPER
    kind[list(b"#$%&*|")] = SYMBOL
    kind[0x80:0xC0], kind[0xC0:0xE0], kind[0xE0:0xF0], kind[0xF0:0xF8] = CONT, LEAD2, LEAD3, LEAD4
    return kind


def _next() -> np.ndarray:
    table = np.full((5, 8), WORD, np.uint8)
    table[:, SPACE], table[:, LEAD2], table[:, LEAD3], table[:, LEAD4] = OUT, NEED1, NEED2, NEED3
    table[NEED2, CONT], table[NEED3, CONT] = NEED1, NEED2
    return table


def _emit() -> np.ndarray:
    table = np.full((5, 8), POINT, np.uint8)
    table[NEED1:, CONT] = 0
    table[OUT] |= STARTS
    table[WORD:, SPACE] |= ENDS
    table[OUT, SPACE] = POINT
    table[:, UPPER] |= CAPITAL
    table[:, SYMBOL] |= MARK
    return table


CLASS, NEXT, EMIT = _classes(), _next(), _emit()
_MASK = np.array([(1 << 8 * k) - 1 for k in range(LANE)] + [2**64 - 1], np.uint64)
_K = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def transduce(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What each byte emits, and the state after it; every text starts between words."""
    kind = CLASS[raw]
    state = NEXT[OUT][kind]
    tail = np.flatnonzero(kind == CONT)
    first = offsets[:-1][offsets[:-1] < offsets[1:]]
    if len(tail):
        before, opens = tail - 1, np.isin(tail, first)
        for _ in range(3):  # a character has three continuation bytes at most
            state[tail] = np.where(opens, NEXT[OUT, CONT], NEXT[state[before], CONT])
    prior = np.empty_like(state)
    prior[1:] = state[:-1]
    prior[first] = OUT
    return EMIT.ravel()[prior * np.uint8(8) + kind], state


def _lanes(raw: np.ndarray, at: np.ndarray, size: np.ndarray, k: int) -> np.ndarray:
    """Bytes ``8 k`` to ``8 k + 7`` of each span as a number, zero beyond its end; ``raw`` ends in that many spare bytes."""
    words = np.ndarray((len(raw) - LANE + 1,), "<u8", raw, strides=(1,))
    left = np.clip(size - LANE * k, 0, LANE)
    return words[np.minimum(at + LANE * k, len(words) - 1)] & _MASK[left]


class Spans:
    """A hash table of byte spans; :meth:`insert` tells for each span whether its document has it for the first time."""

    def __init__(self, raw: np.ndarray, home: np.ndarray, at: np.ndarray, size: np.ndarray, bits: int = 64) -> None:
        self.raw = np.concatenate([raw, np.zeros(LANE, np.uint8)])
        self.home, self.at, self.size = home, at, size
        self.low, self.high = _lanes(self.raw, at, size, 0), _lanes(self.raw, at, size, 1)
        h = (self.low ^ (self.high * _K[0]) ^ (size.astype(np.uint64) * _K[1])) * _K[2] + home.astype(np.uint64) * _K[0]
        long = np.flatnonzero(size > 2 * LANE)
        for k in range(2, LONG // LANE):
            long = long[size[long] > LANE * k]
            if not len(long):
                break
            h[long] = (h[long] ^ (h[long] >> np.uint64(29)) ^ _lanes(self.raw, at[long], size[long], k)) * _K[k % 3]
        for i in np.flatnonzero(size > LONG):
            h[i] ^= np.uint64(xxhash.xxh3_64_intdigest(self.raw[at[i] : at[i] + size[i]].data))
        h = (h ^ (h >> np.uint64(32))) * _K[0]
        self.hash = (h ^ (h >> np.uint64(29))) >> np.uint64(64 - bits)

    def same(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether spans ``a`` and ``b`` agree in document, length and every byte."""
        out = (self.home[a] == self.home[b]) & (self.size[a] == self.size[b]) & (self.low[a] == self.low[b]) & (self.high[a] == self.high[b])
        long = np.flatnonzero(out & (self.size[a] > 2 * LANE))
        for k in range(2, LONG // LANE):
            long = long[out[long] & (self.size[a[long]] > LANE * k)]
            if not len(long):
                break
            i, j = a[long], b[long]
            out[long] = _lanes(self.raw, self.at[i], self.size[i], k) == _lanes(self.raw, self.at[j], self.size[j], k)
        for x in np.flatnonzero(out & (self.size[a] > LONG) & (a != b)):
            i, j, n = self.at[a[x]], self.at[b[x]], self.size[a[x]]
            out[x] = self.raw[i : i + n].tobytes() == self.raw[j : j + n].tobytes()
        return out

    def insert(self) -> np.ndarray:
        n = len(self.at)
        places = np.uint64((1 << max(4, (2 * n).bit_length())) - 1)
        table = np.full(int(places) + 1, -1, np.int64)
        new = np.zeros(n, bool)
        todo, slot = np.arange(n), (self.hash & places).astype(np.int64)
        while len(todo):
            free = table[slot] < 0
            table[slot[free][::-1]] = todo[free][::-1]  # of several spans the first takes a free place
            held = table[slot]
            found = self.same(todo, held)
            new[todo[found & (held == todo)]] = True
            todo, slot = todo[~found], (slot[~found] + 1) & int(places)
        return new


MEASURES = ("n_words", "n_distinct", "n_capitals", "n_points", "n_symbols")


def measure(raw: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """Words, distinct words, capitals, code points and symbols of each text of a batch."""
    emitted, state = transduce(raw, offsets)
    per = lambda at: np.diff(np.searchsorted(at, offsets))
    start = np.flatnonzero(emitted & STARTS)
    stop = np.flatnonzero(emitted & ENDS)
    last = offsets[1:][offsets[:-1] < offsets[1:]]  # the end of a text ends a word as a space does
    stop = np.union1d(stop, last[state[last - 1] != OUT])
    words = per(start)
    home = np.repeat(np.arange(len(words)), words)
    new = Spans(raw, home, start, stop - start).insert()
    return {
        "n_words": words, "n_distinct": np.bincount(home[new], minlength=len(words)), "n_capitals": per(np.flatnonzero(emitted & CAPITAL)),
        "n_points": np.diff(offsets) - per(np.flatnonzero(emitted & POINT == 0)), "n_symbols": per(np.flatnonzero(emitted & MARK)),
    }


def _measurer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in chunked(whole, "_text"):
            found = measure(*utf8_buffer(batch.column("_text")))
            keep = [n for n in batch.schema.names if n != "_text"]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in keep), *(pa.array(found[m].astype(np.int64)) for m in MEASURES)], [*keep, *MEASURES])


def text_measures(df: DataFrame, keep: dict[str, Column], text_col: str = "text") -> DataFrame:
    """The columns of ``keep`` and the :data:`MEASURES` of every text."""
    src = df.select(*(c.alias(n) for n, c in keep.items()), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields if f.name != "_text")
    return src.mapInArrow(_measurer, ", ".join([kinds, *(f"{m} long" for m in MEASURES)]))


#: The filters on one text by letter, as conditions under which a document fails; ``REPEATS`` is the filter on repeated texts.
FILTERS = {
    "A": "n_words < 50", "B": "100 * n_distinct < 65 * n_words", "C": "100 * n_capitals > 5 * n_points", "D": "n_symbols > 0",
}
REPEATS = "E"


def failures(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """``_id``, ``part`` and ``mask`` of every document; bit k of the mask is set where it fails the k-th filter."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    keep = {"_id": F.col(id_col), "part": F.coalesce(F.col(part_col).cast("string"), F.lit("")), "_digest": F.unhex(F.sha2(text, 256))}
    bits = reduce(lambda a, b: a + b, (F.when(F.expr(c), 1 << k).otherwise(0) for k, c in enumerate(FILTERS.values())))
    rows = materialise(text_measures(df, keep, text_col).select(*keep, bits.alias("_bits")), "masks")
    firsts = rows.filter("_id is not null").groupBy("_digest").agg(F.min("_id").alias("_id")).withColumn("_first", F.lit(True))
    repeats = 1 << len(FILTERS)
    told = rows.filter("_id is not null").join(firsts, ["_digest", "_id"], "left")
    told = told.select("_id", "part", (F.col("_bits") + F.when(F.col("_first"), 0).otherwise(repeats)).alias("mask"))
    return told.unionByName(rows.filter("_id is null").select("_id", "part", F.col("_bits").alias("mask")))


def interactions(masks: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Every part, order of filters and step, with what the step's filter does there."""
    letters = "".join([*FILTERS, REPEATS])
    says = lambda c: F.max(F.coalesce(F.col(c) == 1, F.lit(False))).alias(c)
    marks = labels.filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(says("quality"), says("toxic"))
    known = masks.filter("_id is not null").join(marks, "_id", "left").select("part", "mask", "quality", "toxic")
    no = F.lit(None).cast("boolean")
    known = known.unionByName(masks.filter("_id is null").select("part", "mask", no.alias("quality"), no.alias("toxic")))
    cells = known.groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"), F.count_if("quality").alias("good"), F.count_if("toxic").alias("toxic"))
    # One row a part from here on: at most 32 masks each.
    parts = cells.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("c"))
    orders = F.array(*(F.lit("".join(p)) for p in permutations(letters)))
    rows = parts.select("*", F.explode(orders).alias("filter_order")).select("*", F.explode(F.sequence(F.lit(1), F.lit(len(letters)))).alias("step"))
    bit = reduce(lambda a, b: a + b, (F.when(F.substr("filter_order", "step", F.lit(1)) == x, 1 << k).otherwise(0) for k, x in enumerate(letters)))
    earlier = F.substr("filter_order", F.lit(1), F.col("step") - 1)
    before = reduce(lambda a, b: a + b, (F.when(F.instr(earlier, x) > 0, 1 << k).otherwise(0) for k, x in enumerate(letters)))
    rows = rows.select("part", "filter_order", "step", "c", bit.alias("bit"), before.alias("before"))

    def total(condition: str, value: str = "x.n") -> Column:
        return F.expr(f"aggregate(filter(c, x -> {condition}), 0L, (a, x) -> a + {value})")

    fails, gone = "(x.mask & bit) != 0", "(x.mask & before) != 0"
    return rows.select(
        "part", "filter_order", "step", total(f"not ({fails}) and not ({gone})").alias("kept"), total(f"{fails} and not ({gone})").alias("removed"),
        total(f"{fails} and {gone}").alias("redundant"), total("x.mask = bit").alias("unique_fails"), total(f"{fails} and not ({gone})", "x.good").alias("good_lost"),
        total(f"{fails} and not ({gone})", "x.toxic").alias("toxic_lost"),
        # A document falls to each filter that it fails in an equal share of the orders.
        total(fails, f"x.n * cast({len(list(permutations(letters)))} / bit_count(x.mask) as bigint)").alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """:func:`interactions` of the filters over ``docs``."""
    return interactions(failures(docs, id_col, text_col, part_col), labels, id_col)
