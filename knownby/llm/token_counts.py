"""Token counts of whole texts by a two-tier lookup on the map side.

For a tokenizer that never joins what white space separates (``encoder`` refuses any other) a text has as
many tokens as its pre-tokens (runs without blank, tab and line breaks) have one by one. The lengths of frequent pre-tokens are
broadcast in a compact table of 64-bit hashes and lengths; all others are looked up in a cache that
every Python worker keeps, and encoded by the library where that misses. Pre-tokens are never shuffled.

Which ones are frequent is counted over all documents: a task keeps a bounded summary of its
counts (the least frequent go when it is full) and hands over its ``SUMMARY`` most frequent, and of
their sums the ``FREQUENT`` highest make the table. This decides about speed only, never about a count.

Special strings inside a text are recognised as the library's default has it; they contain no
white space. No begin, end or added tokens, no truncation, no padding.

Defined cases: a null text counts as empty and has no tokens; repeated rows are counted alike.
"""

from __future__ import annotations

import functools
import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knownby.llm import words as W
from knownby.llm.tables import text_or_empty

FREQUENT, SUMMARY, HELD = 65_536, 16_384, 200_000
TABLE_BITS = 19
CACHED = 500_000
LIMIT = 2048
#: White space of every tokenizer's definition; the wider kinds stay inside a pre-token.
_BLANKS = np.array([0 if b in (0x09, 0x0A, 0x0D, 0x20) else 1 for b in range(256)], np.uint8)

Encoder = Callable[[list[str]], list[int]]


@functools.lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """Numbers of tokens of texts by the library that belongs to the file; loaded once in a worker."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        encode = lambda texts: model.encode(texts, num_threads=1)
        return _by_word(encode, path)
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return _by_word(lambda texts: [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)], path)


def _by_word(encode: Callable[[list[str]], list[list[int]]], path: str) -> Encoder:
    one, two, both = encode(["one", "two", "one \t\n two"])
    if one + two != both:
        raise ValueError(f"{path}: its tokens depend on the white space between words")
    return lambda texts: [len(ids) for ids in encode(texts)]


@functools.lru_cache(maxsize=4)
def _cache(path: str) -> dict[bytes, int]:
    return {}


def _text(word: bytes) -> str:
    return word.decode("utf-8", "replace")


def _frequent_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[int, list] = {}

    def cut(most: int) -> None:
        kept = sorted(held.items(), key=lambda e: -e[1][0])[:most]
        held.clear()
        held.update(kept)

    for b in batches:
        for piece in W.pieces(b["text"]):
            w = W.words(piece, _BLANKS, W.AS_IS)
            hashes, first, n = np.unique(w.hashes, return_index=True, return_counts=True)
            data = piece.data
            for h, i, c in zip(hashes.tolist(), first.tolist(), n.tolist()):
                entry = held.get(h)
                if entry is not None:
                    entry[0] += c
                elif c > 1 or len(held) < HELD:
                    held[h] = [c, bytes(data[w.starts[i] : w.ends[i]])]
            if len(held) > HELD:
                cut(HELD // 2)
    cut(SUMMARY)
    yield pa.RecordBatch.from_pydict({
        "word": pa.array([w for _, w in held.values()], pa.binary()), "n": pa.array([n for n, _ in held.values()], pa.int64()),
    })


def frequent_table(docs: DataFrame, path: str) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, lengths) in slots by the hash's first bits; of two words for a slot the more frequent one stays."""
    counts = docs.select("text").mapInArrow(_frequent_batches, "word binary, n bigint")
    top = counts.groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(FREQUENT).toArrow()
    words = top["word"].to_pylist()[::-1]
    hashes, lengths = np.zeros(1 << TABLE_BITS, np.uint64), np.zeros(1 << TABLE_BITS, np.uint16)
    texts = [_text(w) for w in words]
    own = [W.words(p, _BLANKS, W.AS_IS).hashes for p in W.pieces(pa.array(texts, pa.string()))]
    if own:
        own = np.concatenate(own)
        n = np.array(encoder(path)(texts))
        fits = n < 1 << 16
        slots = (own >> np.uint64(64 - TABLE_BITS)).astype(np.int64)
        hashes[slots[fits]], lengths[slots[fits]] = own[fits], n[fits]
    return hashes, lengths


def count_tokens(texts: pa.Array, table: tuple[np.ndarray, np.ndarray], path: str) -> np.ndarray:
    cache, counts = _cache(path), []
    for piece in W.pieces(texts):
        w = W.words(piece, _BLANKS, W.AS_IS)
        slots = (w.hashes >> np.uint64(64 - TABLE_BITS)).astype(np.int64)
        length = np.where(table[0][slots] == w.hashes, table[1][slots], 0).astype(np.int64)
        missed = np.flatnonzero(table[0][slots] != w.hashes)
        data = piece.data.tobytes()
        words = [data[s:e] for s, e in zip(w.starts[missed].tolist(), w.ends[missed].tolist())]
        if len(cache) > CACHED:
            cache.clear()
        new = list({word for word in words if word not in cache})
        if new:
            cache.update(zip(new, encoder(path)([_text(word) for word in new])))
        length[missed] = [cache[word] for word in words]
        counts.append(np.bincount(w.text, length, minlength=piece.n_texts).astype(np.int64))
    return np.concatenate(counts) if counts else np.zeros(0, np.int64)


def token_counts(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row of ``docs`` (doc_id, text).

    ``path``: a vocabulary file of a public tokenizer, there on every worker.
    """
    shared = docs.sparkSession.sparkContext.broadcast(frequent_table(docs, path))

    @F.arrow_udf("bigint")
    def tokens(texts: pa.Array) -> pa.Array:
        return pa.array(count_tokens(texts, shared.value, path), pa.int64())

    return docs.select(
        "doc_id", F.octet_length(text_or_empty()).cast("bigint").alias("n_bytes"), tokens("text").alias("n_tokens")
    ).withColumn("over_limit", F.col("n_tokens") > LIMIT)
