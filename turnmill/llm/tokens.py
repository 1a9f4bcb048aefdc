"""Sizes of texts in tokens of a public tokenizer, whose files lie in a folder given by parameter."""

from __future__ import annotations

import base64
import os
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Where the vocabulary files are, unless the environment names another folder.
TOKENIZERS = os.environ.get("TURNMILL_TOKENIZERS", "/opt/tokenizers")
#: File of byte-level merges.
RANKS = "byte_bpe_50k.tiktoken"
#: How that vocabulary splits a text before its merges.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Bins of terms: document frequencies are a table of this fixed size.
TERM_BINS = 1 << 18
#: Scripts without spaces between words: Thai, Lao, Myanmar, Khmer, Tibetan, kana, Han.
_UNSPACED = "฀-๿຀-໿က-႟ក-៿ༀ-࿿぀-ヿ㐀-䶿一-鿿豈-﫿"
_TERM = re.compile(rf"[{_UNSPACED}]+|[^\W\d_{_UNSPACED}]{{3,}}")
_UNSPACED_RUN = re.compile(f"[{_UNSPACED}]")


@lru_cache(maxsize=2)
def encoder(folder: str, ranks: str = RANKS):
    """The tokenizer; read once in each worker."""
    import tiktoken

    with open(f"{folder}/{ranks}", "rb") as f:
        merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("public", pat_str=SPLIT, mergeable_ranks=merges, special_tokens={})


def terms(text: str) -> list[str]:
    """Words of three letters and more; in scripts without spaces all pairs of neighbouring letters."""
    out = []
    for w in _TERM.findall(text.lower()):
        if w[0] >= "\u0e00" and _UNSPACED_RUN.match(w):
            out += [w[i:i + 2] for i in range(len(w) - 1)]
        else:
            out.append(w)
    return out


def term_bins(text: str) -> Counter:
    """How often each term, as a bin, occurs in a text."""
    return Counter(zlib.crc32(w.encode()) % TERM_BINS for w in terms(text))


def token_sizes(df: DataFrame, keys: list[str], column: str, folder: str = TOKENIZERS, terms: bool = False) -> DataFrame:
    """``keys`` and ``tokens``; with ``terms`` also ``bins`` and ``counts`` of the terms. A null or empty text has 0 tokens and no terms."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    n = len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(folder)
        for b in batches:
            texts = b.column(n).to_pylist()
            cols = {k: b.column(i) for i, k in enumerate(keys)}
            cols["tokens"] = pa.array([len(enc.encode_ordinary(t)) if t else 0 for t in texts], pa.int64())
            if terms:
                bags = [term_bins(t) if t else Counter() for t in texts]
                offsets = pa.array(np.concatenate([[0], np.cumsum([len(c) for c in bags])]).astype(np.int32))
                cols["bins"] = pa.ListArray.from_arrays(offsets, pa.array([x for c in bags for x in c], pa.int32()))
                cols["counts"] = pa.ListArray.from_arrays(offsets, pa.array([x for c in bags for x in c.values()], pa.int32()))
            yield pa.RecordBatch.from_pydict(cols)

    schema = ", ".join(f"`{k}` {kinds[k]}" for k in keys) + ", tokens bigint" + (", bins array<int>, counts array<int>" if terms else "")
    return df.select(*keys, F.col(column).cast("string")).mapInArrow(run, schema)
