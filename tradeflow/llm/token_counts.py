"""Operator 4: token counts of a SentencePiece model by overlap resynchronisation.

A document longer than ``chunk`` UTF-8 bytes is encoded in overlapping chunks
that carry their offsets. Two neighbouring encodings are spliced at a *common
token*: a token with the same begin and end in both, whose neighbours on the
used sides are real tokens of their chunk. For a greedy best-pair-first BPE a
token sequence is the encoding of its text exactly if every adjacent pair of
tokens is the encoding of that pair's text. All adjacent pairs of the spliced
sequence occur in one of the two chunk encodings, so the splice is proven equal
to encoding the whole text. If the overlap holds no common token it is doubled,
up to encoding both chunks as one.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, texts

CHUNK, OVERLAP, LIMIT = 1 << 14, 256, 4096         # bytes, bytes, tokens
Token = tuple[int, int]
_MODELS: dict[str, object] = {}


def model(path: str):
    """The SentencePiece processor of ``path``, loaded once per Python worker."""
    if path not in _MODELS:
        import sentencepiece
        _MODELS[path] = sentencepiece.SentencePieceProcessor(model_file=path)
    return _MODELS[path]


def offsets_encoder(processor) -> Callable[[bytes, bool], list[Token]]:
    """encode(raw, first) -> byte spans (begin, end) of the tokens of UTF-8 ``raw``.

    The model writes a space as a mark and puts one mark before any text. A later
    chunk begins at a space, which is left out and comes back as that mark, so
    the model sees exactly the chunk's own characters. Of the byte tokens of one
    character at most one has a span of its own.
    """
    def encode(raw: bytes, first: bool) -> list[Token]:
        spans = processor.encode(raw if first else raw[1:], return_type="offset_mapping", return_bytes=True)["offsets"]
        if first:
            return list(map(tuple, spans))
        shifted = [(b + 1, e + 1) for b, e in spans]
        if shifted:
            shifted[0] = (0, shifted[0][1])
        return shifted
    return encode


def char_end(raw: bytes, at: int) -> int:
    """``at``, or the end of the character that ``at`` cuts."""
    while at < len(raw) and raw[at] & 0xC0 == 0x80:
        at += 1
    return at


def splice(left: list[Token], right: list[Token], begin: int) -> tuple[int, int] | None:
    """(i, j): left[i] and right[j] are one common token, not the first of ``right`` nor the last of ``left``.

    Only tokens with a text of their own (end > begin) can be common, and of the
    byte tokens of one character none can.
    """
    starts = {}
    for j, (b, e) in enumerate(right[1:], 1):
        whole = e > b and (j + 1 == len(right) or right[j + 1][0] >= e and right[j + 1][1] > right[j + 1][0])
        if whole:
            starts[(b, e)] = j
    for i in range(len(left) - 2, -1, -1):
        if left[i][0] < begin:
            return None
        if left[i] in starts and left[i + 1][1] > left[i + 1][0]:
            return i, starts[left[i]]
    return None


def count_tokens(raw: bytes, encode: Callable[[bytes, bool], list[Token]], count: Callable[[bytes], int],
                 chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Number of tokens of ``raw``, the same as ``count(raw)``.

    Chunks end after any character and begin at a space, looked for backwards
    from the end of the previous chunk minus the overlap. Only the tokens of two
    neighbouring chunks are held.
    """
    if len(raw) <= chunk:
        return count(raw)
    total, begin, end = 0, 0, char_end(raw, chunk)
    left, skip = encode(raw[:end], True), 0            # tokens before ``skip`` are counted
    while end < len(raw):
        wide, found = overlap, None
        while found is None:
            start = raw.rfind(b" ", begin + 1, max(begin + 1, end - wide))
            if start < 0:                              # widened down to the chunk's own start
                break
            stop = char_end(raw, min(len(raw), max(start + chunk, end + overlap)))
            right = [(b + start, e + start) for b, e in encode(raw[start:stop], False)]
            found = splice(left, right, start)
            wide *= 2
        if found is None:                              # no proven boundary: a longer chunk instead
            mark = left[skip]
            end = char_end(raw, min(len(raw), begin + 2 * (end - begin)))
            left = [(b + begin, e + begin) for b, e in encode(raw[begin:end], begin == 0)]
            if skip and (skip >= len(left) or left[skip] != mark):
                return count(raw)
            continue
        i, j = found
        if i < skip:
            return count(raw)
        total += i - skip
        left, skip, begin, end = right, j, start, stop
    return total + len(left) - skip


def token_counts(docs: DataFrame, model_path: str, limit: int = LIMIT, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit), one row per document; NULL text counts as empty, with no tokens."""
    def run(batches):
        processor = model(model_path)
        encode = offsets_encoder(processor)

        def plain(raw: bytes) -> int:
            return len(processor.encode(raw))

        for batch in batches:
            values = batch.column("text").cast(pa.binary()).to_pylist()
            counts = [len(x) for x in processor.encode([t if len(t) <= chunk else b"" for t in values], num_threads=1)]
            for k, raw in enumerate(values):
                if len(raw) > chunk:
                    counts[k] = count_tokens(raw, encode, plain, chunk, overlap)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(t) for t in values], pa.int64()), pa.array(counts, pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens"])
    out = texts(docs).mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
