"""Token counts without token ids (operator 8).

Texts are encoded in batches of near-equal bytes inside Arrow functions and only lengths come
back.  A long text is split where the encoding cannot reach across: before a space that
follows a character which is neither a space nor the library's space mark, provided that no
vocabulary piece has a space mark after another character (checked when the model is loaded;
a model that breaks this is encoded whole).  The dropped space is what the encoder itself puts
in front of each unit.  Since any such unit encodes alike wherever it stands, each distinct
unit of a batch is encoded once, and a bounded table remembers lengths between batches.

Cases: null and empty texts have no tokens; runs of spaces, leading and trailing spaces, the
literal space mark and control characters follow the library; very long texts are split, not
cut; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlspike.llm.common import chunked, texts

MARK = "▁"
#: Units remembered by a worker, and the longest unit worth remembering.
REMEMBERED, LONGEST = 200_000, 64


@lru_cache(maxsize=4)
def _model(path: str) -> tuple:
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
    splits = not any(MARK in p.lstrip(MARK) for p in pieces) and sp.encode("a b", out_type=str) == [
        *sp.encode("a", out_type=str), *sp.encode("b", out_type=str),
    ]
    return sp, splits, [{}, {}]  # lengths of units met of late, and before


_SAFE = re.compile(f"(?<=[^ {MARK}]) ")


def units(text: str, splits: bool = True) -> list[str]:
    """The parts of a text that encode independently; their token counts add up to the text's."""
    if not splits:
        return [text]
    if text[:1] != " " and "  " not in text and MARK not in text:
        return text.split(" ")
    return _SAFE.split(text)


def count_batch(rows: list[str], path: str) -> list[int]:
    """Token counts of a batch of texts."""
    sp, splits, tables = _model(path)
    parts = [units(t, splits) for t in rows]
    if len(tables[0]) > REMEMBERED:
        tables[:] = [{}, tables[0]]
    known, older = tables
    new = set().union(*parts).difference(known)
    known.update({u: older[u] for u in new.intersection(older)})
    fresh = list(new.difference(known))
    known.update(zip(fresh, map(len, sp.encode(fresh, num_threads=1))))
    known[""] = 1  # what a final space leaves: a lone space mark; only the empty text has no token
    out = [sum(map(known.__getitem__, p)) if t else 0 for t, p in zip(rows, parts)]
    for u in fresh:
        if len(u) > LONGEST:
            del known[u]
    return out


def counter(path: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """An Arrow function that adds ``n_tokens`` to batches with ``_text`` and drops the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in chunked(whole, "_text"):
                counts = pa.array(count_batch(texts(batch.column("_text")), path), pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("n_bytes"), counts], ["_id", "n_bytes", "n_tokens"])

    return run


def token_counts(df: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 4096) -> DataFrame:
    """``id_col``, ``n_bytes``, ``n_tokens`` and ``over_limit`` of every row."""
    kind = df.schema[id_col].dataType.simpleString()
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    src = df.select(F.col(id_col).alias("_id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("_text"))
    out = src.mapInArrow(counter(model), f"_id {kind}, n_bytes long, n_tokens long")
    return out.select(F.col("_id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
