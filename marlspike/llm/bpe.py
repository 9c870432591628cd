"""Byte-level BPE with a pair occurrence index (operator 5).

The words of a batch that are not yet known are laid out in one symbol array.  An index maps
each adjacent pair to all its positions; the active ranks (pairs that occur and have a merge)
wait in a heap.  The lowest rank is applied at all its positions from left to right, and the
lists of the pairs beside each merge are updated, which may activate further ranks.  Words do
not touch each other, so the order of ranks over the batch is the order within each word.

Cases: null and empty texts give no ids and the empty text back; the strings of added tokens
inside a text become those tokens, as in the library's default; very long texts are encoded
whole; repeated rows give repeated rows; an empty table gives an empty result; extra columns
are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlspike.llm.common import chunked, texts

#: Words remembered by a worker, and the longest word worth remembering.
REMEMBERED, LONGEST = 100_000, 64
#: Bytes of text merged together, and positions of a rank from which they are merged as vectors.
BATCH_BYTES, VECTOR = 2 << 20, 12

# Fixed value: the word pattern of byte-level vocabularies of this kind.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
_words = regex.compile(WORDS)
#: The same pattern for texts whose characters the standard library classes alike, which it scans faster.
_plain = re.compile(r"[\t\n\r\x0b\x0c\x20-\x7e\xc0-\xd6\xd8-\xf6\xf8-ɏ–-…]*")
_L = r"A-Za-z\xc0-\xd6\xd8-\xf6\xf8-ɏ"
_fast = re.compile(rf" ?[{_L}]++| ?[0-9]++|'(?:[stmd]|re|ve|ll)| ?[^\s{_L}0-9]++|\s+(?!\S)|\s+")


def byte_symbols() -> dict[int, str]:
    """The printable character that stands for each byte: itself where printable, else one from 256 on, in order."""
    own = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Vocabulary:
    """Merge ranks, ids and bytes of a byte-level BPE file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        ids = spec["model"]["vocab"]
        symbols = byte_symbols()
        byte_of = {c: b for b, c in symbols.items()}
        self.first = [ids[symbols[b]] for b in range(256)]
        self.added = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.bytes_of: dict[int, bytes] = {i: bytes(byte_of[c] for c in s) for s, i in ids.items()}
        self.bytes_of |= {i: s.encode() for s, i in self.added.items()}
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        #: left id * 2**32 + right id -> rank
        self.merges = {ids[a] << 32 | ids[b]: rank for rank, (a, b) in enumerate(pairs)}
        self.pair_at = [(ids[a], ids[b], ids[a + b]) for a, b in pairs]
        made: dict[int, int] = {}
        for rank, (x, y, z) in enumerate(self.pair_at):
            if made.get(x, -1) >= rank or made.get(y, -1) >= rank:
                raise ValueError("merges that use a symbol before it is made")
            made.setdefault(z, rank)
        self.split_added = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        self.rank_of_bytes = np.full((256, 256), -1, np.int32)
        byte_at = {i: b for b, i in enumerate(self.first)}
        self.after: dict[int, list] = {}  # by left id: right ids and ranks, and the reverse
        self.before: dict[int, list] = {}
        for rank, (x, y, _) in enumerate(self.pair_at):
            if x in byte_at and y in byte_at:
                self.rank_of_bytes[byte_at[x], byte_at[y]] = rank
            self.after.setdefault(x, []).append((y, rank))
            self.before.setdefault(y, []).append((x, rank))
        for table in (self.after, self.before):
            for k, v in table.items():
                table[k] = np.array(sorted(v), np.int32).T.copy()
        self.first_ids = np.array(self.first, np.int32)
        size = max(self.bytes_of) + 1
        self.sizes = np.array([len(self.bytes_of.get(i, b"")) for i in range(size)], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.flat = np.frombuffer(b"".join(self.bytes_of.get(i, b"") for i in range(size)), np.uint8)
        #: Ids of words met of late and before; a word of the older table that is met again moves to the newer.
        self.known: list[dict[str, bytes]] = [{}, {}]

    def words(self, text: str) -> list[str]:
        """The words of a text; the strings of added tokens stand alone."""
        if self.split_added is None or not any(a in text for a in self.added):
            return (_fast if _plain.fullmatch(text) else _words).findall(text)
        out: list[str] = []
        for k, part in enumerate(self.split_added.split(text)):
            out += [part] if k % 2 else _words.findall(part)
        return out

    def merge_words(self, words: list[str]) -> list[bytes]:
        """Ids of each word (little-endian, 32 bits), all words merged together through the pair occurrence index.

        A rank with many positions is applied to all of them as vectors, one with few (or of a
        symbol with itself, where the leftmost pair goes first) position by position.
        """
        coded = [w.encode() for w in words]
        raw = np.frombuffer(b"".join(coded), np.uint8)
        lens = np.fromiter(map(len, coded), np.int64, len(coded))
        place = np.arange(len(raw)) + np.repeat(np.arange(1, len(words) + 1), lens)
        n = len(raw) + len(words) + 1
        sym = np.full(n, -1, np.int32)  # -1 between words: no pair reaches over it
        sym[place] = self.first_ids[raw]
        nxt, prv = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n - 1, dtype=np.int32)
        rank = np.where(np.diff(place) == 1, self.rank_of_bytes[raw[:-1], raw[1:]], -1) if len(raw) else np.zeros(0, np.int32)
        at = np.flatnonzero(rank >= 0)
        at = at[np.argsort(rank[at], kind="stable")]
        active, edge = np.unique(rank[at], return_index=True)
        start: dict[int, np.ndarray] = dict(zip(active.tolist(), np.split(place[at], edge[1:]))) if len(at) else {}
        later: dict[int, list[int]] = {}
        heap = list(start)
        heapq.heapify(heap)
        msym, mnxt, mprv = memoryview(sym), memoryview(nxt), memoryview(prv)
        rank_of, pair_at = self.merges.get, self.pair_at

        def note(positions: list[int], ranks: list[int]) -> None:
            for p, r in zip(positions, ranks):
                if r in later:
                    later[r].append(p)
                else:
                    later[r] = [p]
                    if r not in start:
                        heapq.heappush(heap, r)

        while heap:
            now = heapq.heappop(heap)
            a, b, made = pair_at[now]
            early, late = start.pop(now, None), later.pop(now, None)
            count = (0 if early is None else len(early)) + (0 if late is None else len(late))
            if count < VECTOR or a == b:
                todo = [*(() if early is None else early.tolist()), *(late or ())]
                if a == b:
                    todo.sort()
                for i in todo:
                    j = mnxt[i]
                    if msym[i] != a or msym[j] != b:
                        continue
                    msym[i], msym[j] = made, -2
                    mnxt[i] = k = mnxt[j]
                    mprv[k] = i
                    if (s := msym[k]) >= 0 and (r := rank_of(made << 32 | s)) is not None:
                        note((i,), (r,))
                    h = mprv[i]
                    if (s := msym[h]) >= 0 and (r := rank_of(s << 32 | made)) is not None:
                        note((h,), (r,))
                continue
            i = np.unique(late) if early is None else early if late is None else np.unique(np.concatenate([early, late]))
            j = nxt[i]
            ok = (sym[i] == a) & (sym[j] == b)
            i, j = i[ok], j[ok]
            sym[i], sym[j] = made, -2
            k = nxt[j]
            nxt[i] = k
            prv[k] = i
            for table, ends, held in ((self.after, k, i), (self.before, (h := prv[i]), h)):
                if (pairs := table.get(made)) is not None:
                    s = sym[ends]
                    hit = np.minimum(np.searchsorted(pairs[0], s), pairs.shape[1] - 1)
                    good = pairs[0][hit] == s
                    note(held[good].tolist(), pairs[1][hit[good]].tolist())
        left = sym >= 0
        per = np.cumsum(left)[np.concatenate([[0], np.cumsum(lens + 1)])].tolist()
        ids = sym[left].astype("<u4").tobytes()
        return [ids[4 * x : 4 * y] for x, y in zip(per, per[1:])]

    def encode_batch(self, rows: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        if len(self.known[0]) > REMEMBERED:
            self.known[:] = [{}, self.known[0]]
        known, older = self.known
        parts = [self.words(t) for t in rows]
        found = [list(map(known.get, p)) for p in parts]
        wanted = {w for p, f in zip(parts, found) if None in f for w, x in zip(p, f) if x is None}
        known.update({w: older[w] for w in wanted.intersection(older)})
        fresh = [w for w in wanted if w not in known]
        known.update(zip(fresh, self.merge_words(fresh)))
        known.update({w: np.array([self.added[w]], "<u4").tobytes() for w in fresh if w in self.added})
        out = [b"".join([known[w] if x is None else x for w, x in zip(p, f)] if None in f else f) for p, f in zip(parts, found)]
        for w in fresh:
            if len(w) > LONGEST:
                del known[w]
        return out

    def decode(self, ids: np.ndarray) -> str:
        """The text of an array of ids; added tokens are written out."""
        if not len(ids):
            return ""
        if int(ids.min()) < 0 or int(ids.max()) >= len(self.sizes):
            raise ValueError("an id that the vocabulary lacks")
        size = self.sizes[ids]
        ends = np.cumsum(size)
        at = np.arange(int(ends[-1])) + np.repeat(self.starts[ids] - (ends - size), size)
        return self.flat[at].tobytes().decode("utf-8", "replace")


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def _encoder(path: str, want: tuple[str, ...]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for whole in batches:
            for batch in chunked(whole, "_text", BATCH_BYTES):
                coded = vocab.encode_batch(texts(batch.column("_text")))
                cols = {"n_tokens": pa.array([len(c) // 4 for c in coded], pa.int64())}
                if "ids" in want:
                    edges = np.concatenate([[0], np.cumsum([len(c) // 4 for c in coded])]).astype(np.int32)
                    flat = pa.array(np.frombuffer(b"".join(coded), "<u4").astype(np.int32))
                    cols["ids"] = pa.ListArray.from_arrays(pa.array(edges), flat)
                if "ids_sha256" in want:
                    cols["ids_sha256"] = pa.array([hashlib.sha256(c).hexdigest() for c in coded])
                if "decoded" in want or "decoded_sha256" in want:
                    back = [vocab.decode(np.frombuffer(c, "<u4")) for c in coded]
                    cols["decoded"] = pa.array(back, pa.string())
                    cols["decoded_sha256"] = pa.array([hashlib.sha256(t.encode()).hexdigest() for t in back])
                yield pa.RecordBatch.from_arrays([batch.column("_id"), *(cols[k] for k in want)], ["_id", *want])

    return run


_KINDS = {"n_tokens": "long", "ids": "array<int>", "ids_sha256": "string", "decoded": "string", "decoded_sha256": "string"}


def bpe_encode(
    df: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text", want: tuple[str, ...] = ("n_tokens", "ids")
) -> DataFrame:
    """``id_col`` and the columns of ``want``: ``n_tokens``, ``ids``, ``ids_sha256``, ``decoded``, ``decoded_sha256``."""
    kind = df.schema[id_col].dataType.simpleString()
    src = df.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    schema = ", ".join([f"_id {kind}", *(f"{k} {_KINDS[k]}" for k in want)])
    return src.mapInArrow(_encoder(vocab_path, tuple(want)), schema).withColumnRenamed("_id", id_col)


def _decoder(path: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for batch in batches:
            back = [vocab.decode(np.array(x or [], np.int64)) for x in batch.column("_ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(back, pa.string())], ["_id", "text"])

    return run


def bpe_decode(df: DataFrame, vocab_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``id_col`` and the ``text`` of its ids; null ids are the empty text; an unknown id is an error."""
    kind = df.schema[id_col].dataType.simpleString()
    src = df.select(F.col(id_col).alias("_id"), F.col(ids_col).cast("array<int>").alias("_ids"))
    return src.mapInArrow(_decoder(vocab_path), f"_id {kind}, text string").withColumnRenamed("_id", id_col)
