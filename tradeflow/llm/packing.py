"""Operator 6: order-preserving packing of token sequences by dynamic programming.

Documents keep their order within an input partition. Their tokens form one
stream with candidate cuts: document ends (free), sentence ends (a small
truncation penalty) and, inside long sentences, every ``stride`` tokens (a
larger one). Windows of at most ``capacity`` tokens are chosen so that padding
plus penalties is least; the best predecessor of a cut is the minimum of a
sliding window, kept by a monotone queue.
"""

from __future__ import annotations

import os
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from .common import table, texts

CAPACITY, END_ID = 2048, 1
SENTENCE_COST, SPLIT_COST, STRIDE = 4, 24, 8           # penalties in tokens of padding; tokens
BLOCK_WINDOWS, CACHE_WORDS = 256, 1 << 19
_SENTENCE_END = re.compile(r"[.!?][\"')\]]*$")


def _byte_letters() -> dict[int, str]:
    """Byte-level letters of U+00C0 to U+00FF: printable bytes stand for themselves, the others, in order, for U+0100 and on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in plain]
    letter = {b: chr(b) if b in plain else chr(256 + others.index(b)) for b in range(256)}
    return {c: "".join(letter[b] for b in chr(c).encode("utf-8")) for c in range(0xC0, 0x100)}


_BYTE_LETTERS = _byte_letters()
_SIMPLE_WORD = re.compile("[!-~\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF]+")
_SIMPLE_TEXT = re.compile("[\t\n\r -~\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF]*")
# the vocabulary's own pre-tokens, on lower-case words of the characters above (fixed values); in whole texts a run
# of signs takes the blank behind it along, so that it is known to end its word
_LETTERS = "a-z\u00DF-\u00F6\u00F8-\u00FF"
_PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^0-9{_LETTERS}]+")
_TEXT_PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^0-9{_LETTERS}\t\n\r ]+[\t\n\r ]?")
_BLANKS, _WORD_MARK = "\t\n\r ", "\n"
_NOT_BLANK = re.compile("[\x1c-\x1f]")                # blanks to Python, not to the tokenizer


class WordEncoder(dict):
    """Token ids of texts, by way of distinct pieces and words (this dictionary: piece, or marked word -> number).

    The tokenizer drops white space and cuts words into pieces before it merges,
    so the ids of a text are those of its pieces in a row. Texts of ASCII and
    Latin-1 letters are cut into pieces here, and each distinct piece goes to the
    tokenizer's model once. Any other text, and one that may hold a special
    token, goes word by word; words with other characters or a special token go
    through the whole tokenizer.
    """

    def __init__(self, path: str):
        super().__init__()
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self._clear()

    def _clear(self) -> None:
        self.clear()
        self.pieces: dict[str, list[int]] = {}
        self.ids = np.empty(1 << 16, dtype=np.uint32)   # ids of the known words, end to end
        self.starts = np.zeros(1 << 14, dtype=np.int64)
        self.ends_sentence = np.zeros(1 << 14, dtype=bool)
        self.filled = 0
        self.new_ids: list[int] = []                    # of the words met since the arrays were last filled
        self.new_ends: list[int] = []
        self.new_sentences: list[bool] = []

    @staticmethod
    def _room(array: np.ndarray, size: int) -> np.ndarray:
        return array if len(array) >= size else np.concatenate([array, np.zeros(max(size, len(array)), array.dtype)])

    def _ids(self, piece: str) -> list[int]:
        part = self.pieces.get(piece)
        if part is None:
            coded = piece if piece.isascii() else piece.translate(_BYTE_LETTERS)
            part = self.pieces[piece] = [t.id for t in self.model.tokenize(coded)]
        return part

    def __missing__(self, key: str) -> int:
        """Learn a piece of a text, or a word (behind a mark): its number."""
        if key[0] == _WORD_MARK:
            word, ends = key[1:], True
            if _SIMPLE_WORD.fullmatch(word) and "<|" not in word:
                for piece in _PIECES.findall(word.lower()):
                    self.new_ids += self._ids(piece)
            else:
                self.new_ids += self.tokenizer.encode(word, add_special_tokens=False).ids
        elif key[-1] in _BLANKS:
            word, ends = key[:-1], True
            self.new_ids += self._ids(word)
        else:
            word, ends = key, False
            coded = key if key.isascii() else key.translate(_BYTE_LETTERS)
            self.new_ids += [t.id for t in self.model.tokenize(coded)]
        self.new_ends.append(len(self.new_ids))
        self.new_sentences.append(ends and _SENTENCE_END.search(word[-8:]) is not None)
        self[key] = number = len(self)
        return number

    def _store_new(self) -> None:
        """Move the words learnt into the arrays."""
        count, first = len(self.new_ends), len(self) - len(self.new_ends)
        if not count:
            return
        self.starts = self._room(self.starts, first + count + 1)
        self.ends_sentence = self._room(self.ends_sentence, first + count)
        self.ids = self._room(self.ids, self.filled + len(self.new_ids))
        self.starts[first + 1:first + count + 1] = np.array(self.new_ends) + self.filled
        self.ends_sentence[first:first + count] = self.new_sentences
        self.ids[self.filled:self.filled + len(self.new_ids)] = self.new_ids
        self.filled += len(self.new_ids)
        self.new_ids, self.new_ends, self.new_sentences = [], [], []

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """(ids, sentence ends as positions behind their last id)."""
        if "<|" not in text and _SIMPLE_TEXT.fullmatch(text):
            words = _TEXT_PIECES.findall(text.lower() + "\n")
        else:
            words = text.split() if _NOT_BLANK.search(text) is None else [w for w in re.split("[ \n\t\r]+", text) if w]
            words = [_WORD_MARK + w for w in words]
        if not words:
            return np.empty(0, np.uint32), np.empty(0, np.int64)
        if len(self) > CACHE_WORDS:
            self._clear()
        codes = np.fromiter(map(self.__getitem__, words), dtype=np.int64, count=len(words))
        self._store_new()
        starts = self.starts[codes]
        lengths = self.starts[codes + 1] - starts
        behind = np.cumsum(lengths)
        places = np.arange(behind[-1]) + np.repeat(starts - (behind - lengths), lengths)
        return self.ids[places], behind[self.ends_sentence[codes] & (lengths > 0)]


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def candidate_cuts(length: int, sentences: np.ndarray, stride: int, sentence_cost: int, split_cost: int):
    """(positions, penalties) inside and at the end of a document of ``length`` ids; the end is free."""
    ends = np.unique(np.concatenate([sentences[sentences < length], [length]])).astype(np.int64)
    inside = np.arange(stride, length, stride, dtype=np.int64)
    following = ends[np.searchsorted(ends, inside)] if len(inside) else inside
    before = np.where(np.searchsorted(ends, inside) > 0, ends[np.searchsorted(ends, inside) - 1], 0) if len(inside) else inside
    inside = inside[(following - inside >= stride // 2) & (inside - before >= stride // 2)]
    positions = np.concatenate([ends, inside])
    penalties = np.concatenate([np.full(len(ends), sentence_cost), np.full(len(inside), split_cost)])
    penalties[len(ends) - 1] = 0
    order = np.argsort(positions, kind="stable")
    return positions[order], penalties[order]


def best_cuts(positions: np.ndarray, penalties: np.ndarray, capacity: int, last: bool) -> list[int]:
    """Window ends of least total padding and penalty over the stream [0, positions[-1]).

    cost(i, j) = capacity - (j - i) + penalty(j) for j - i <= capacity. With
    key(j) = best(j) + j = capacity + penalty(j) + min(key(i)), the minimum runs
    over a window that only moves on, so its suffix minima form a monotone queue.
    Cuts are solved a window's length at a time from the suffix minima of the
    solved keys; up to the first cut for which a key of the same stretch is as
    small they are final, and the next stretch starts there. Of equal keys the
    later one is taken. If more tokens follow (``last`` is False), the window left
    open at the end costs nothing and is not returned as a cut.
    """
    places = np.concatenate([[0], np.asarray(positions, np.int64)])
    costs = np.concatenate([[0], np.asarray(penalties, np.int64)]) + capacity
    keys, back = np.zeros(len(places), np.int64), np.zeros(len(places), np.int64)
    done, end = 0, len(places) - 1
    while done < end:
        stop = int(np.searchsorted(places, places[done] + capacity, "right"))
        low = int(np.searchsorted(places, places[done + 1] - capacity))
        solved = keys[low:done + 1][::-1]
        minima = np.minimum.accumulate(solved)
        falls = np.concatenate([[True], minima[1:] < minima[:-1]])
        at = np.maximum.accumulate(np.where(falls, np.arange(len(solved)), 0))
        reach = done - np.searchsorted(places[low:done + 1], places[done + 1:stop] - capacity) - low
        new = costs[done + 1:stop] + minima[reach]
        inside = np.minimum.accumulate(new[:-1]) <= minima[reach[1:]]
        final = int(np.argmax(inside)) + 1 if inside.any() else len(new)
        keys[done + 1:done + 1 + final] = new[:final]
        back[done + 1:done + 1 + final] = done - at[reach[:final]]
        done += final
    at = end
    if not last:                                       # the cheapest state that can still be extended
        first = max(1, int(np.searchsorted(places, places[-1] - capacity + 1)))
        values = (keys - places)[first:][::-1]
        at = end - int(np.argmin(values))
    cuts = []
    while at > 0:
        cuts.append(int(places[at]))
        at = int(back[at])
    return cuts[::-1]


def remainder(length: int, capacity: int, split_cost: int) -> list[int]:
    """Lengths of the sequences for the last ``length`` ids of a partition: one padded
    sequence, or powers of two, which need no padding, if their cuts cost less."""
    if length in (0, capacity):
        return [length] if length else []
    powers = [1 << k for k in range(length.bit_length() - 1, -1, -1) if length >> k & 1]
    return powers if (len(powers) - 1) * split_cost < capacity - length else [length]


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int | None = END_ID, with_ids: bool = False,
         sentence_cost: int = SENTENCE_COST, split_cost: int = SPLIT_COST, stride: int = STRIDE) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids, little-endian uint32).

    Each partition is packed as a stream: blocks of ``BLOCK_WINDOWS`` windows are
    solved, and the open last window goes on into the next block, so memory does
    not grow with the partition beyond its longest document. sequence_id is
    unique over partitions (partition number and a counter); a partition run
    anew gives the same rows. NULL and empty texts give a piece of ``end_id``
    alone (none without an end id). Equal rows are packed separately. Texts of any
    length are packed whole; an empty table gives no rows. Only doc_id and text
    are read, so other columns may have any name.
    """
    fields = ["doc_id long", "start long", "length long", "ids_crc32 long", "doc_tokens long", "sequence_id long", "offset long"]
    fields += ["ids binary"] * with_ids

    def run(batches):
        encode = encoder(tokenizer_path).encode
        first_sequence = TaskContext.get().partitionId() << 40
        made = 0
        held: list[list] = []                          # [doc_id, ids, ids before, doc_tokens, cut positions, penalties]
        held_tokens = 0

        def emit(lengths: list[int]):
            """Rows of the sequences of the given lengths, taken from the front of ``held``."""
            nonlocal made, held, held_tokens
            rows, doc, used = [], 0, 0
            for want in lengths:
                offset = 0
                while offset < want:
                    doc_id, ids, before, total, _, _ = held[doc]
                    take = min(want - offset, len(ids) - used)
                    raw = ids[used:used + take].astype("<u4").tobytes()
                    rows.append((doc_id, before + used, take, zlib.crc32(raw), total, first_sequence + made, offset) + ((raw,) if with_ids else ()))
                    offset, used = offset + take, used + take
                    if used == len(ids):
                        doc, used = doc + 1, 0
                made += 1
            held = held[doc:]
            if used:                                   # the front document is cut
                doc_id, ids, before, total, cuts, penalties = held[0]
                left = cuts > used
                held[0] = [doc_id, ids[used:], before + used, total, cuts[left] - used, penalties[left]]
            held_tokens -= sum(lengths)
            return rows

        def solve(last: bool):
            bases = np.cumsum([0] + [len(h[1]) for h in held[:-1]])
            positions = np.concatenate([h[4] + b for h, b in zip(held, bases)])
            penalties = np.concatenate([h[5] for h in held])
            cuts = best_cuts(positions, penalties, capacity, False)
            lengths = np.diff([0] + cuts).tolist()
            return emit(lengths + (remainder(held_tokens - sum(lengths), capacity, split_cost) if last else []))

        def batch_of(rows):
            columns = list(zip(*rows))
            types = [pa.int64()] * 7 + [pa.binary()] * with_ids
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=[f.split()[0] for f in fields])

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids, sentences = encode(text)
                if end_id is not None:
                    ids = np.append(ids, np.uint32(end_id))
                if not len(ids):
                    continue
                cuts, penalties = candidate_cuts(len(ids), sentences, stride, sentence_cost, split_cost)
                held.append([doc_id, ids, 0, len(ids), cuts, penalties])
                held_tokens += len(ids)
                if held_tokens >= BLOCK_WINDOWS * capacity:
                    rows = solve(False)
                    if rows:
                        yield batch_of(rows)
        if held:
            yield batch_of(solve(True))

    return texts(docs).mapInArrow(run, ", ".join(fields))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
