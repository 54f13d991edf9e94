"""Byte-pair encoding on a contiguous array of part boundaries and adjacent ranks, and decoding.

A word starts as one part per byte. Two parallel lists hold the id of each part and, beside it,
the rank of the merge with its right neighbour. The smallest rank is found by a scan (leftmost
first), the boundary between the two parts is deleted, and the ranks of the two neighbouring
pairs are refreshed; words are so short that scanning a contiguous list beats any cleverer
structure. Words beyond ``SHORT`` bytes (unbroken runs in junk text) would make the scans
quadratic; they take the same merges in the same order from a heap.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from voltlake.llm.chunks import Memo, chunks
from voltlake.llm.common import texts
from voltlake.llm.vocabulary import BITS, ID, NONE, WORDS, Vocabulary, load

SHORT = 200
MATRIX = 32  # words up to here are merged many at a time


def merge_word(word: bytes, vocabulary: Vocabulary) -> list[int]:
    """Token ids of one pre-tokenized word."""
    parts = list(map(vocabulary.byte_ids.__getitem__, word))
    if len(parts) > SHORT:
        return _merge_long(parts, vocabulary)
    find = vocabulary.merges.get
    # adjacent[i] belongs to the pair (parts[i], parts[i + 1]): its rank and the merged token.
    adjacent = [find(a << BITS | b, NONE) for a, b in pairwise(parts)]
    while adjacent:
        least = min(adjacent)
        if least == NONE:
            break
        at = adjacent.index(least)
        parts[at] = merged = least & ID
        del parts[at + 1], adjacent[at]
        if at < len(adjacent):
            adjacent[at] = find(merged << BITS | parts[at + 1], NONE)
        if at:
            adjacent[at - 1] = find(parts[at - 1] << BITS | merged, NONE)
    return parts


def merge_words(words: list[bytes], vocabulary: Vocabulary) -> list[bytes]:
    """The ids of many words, each as bytes of 32-bit integers.

    The arrays of all words of similar length are the rows of two matrices, and every step
    deletes one boundary in each row that has a merge left.
    """
    coded: list[bytes] = [b""] * len(words)
    by_length: dict[int, list[int]] = {}
    for at, word in enumerate(words):
        size = len(word)
        if size > MATRIX:
            coded[at] = np.array(merge_word(word, vocabulary), dtype="<u4").tobytes()
        else:
            by_length.setdefault(size, []).append(at)
    byte_ids = np.array(vocabulary.byte_ids, dtype=np.int64)
    for size, places in by_length.items():
        raw = np.frombuffer(b"".join([words[at] for at in places]), dtype=np.uint8)
        parts = byte_ids[raw].reshape(len(places), size)
        where = np.array(places)
        for row in _merge_matrix(parts, where, vocabulary):
            for at, ids in row:
                coded[at] = ids
    return coded


def _merge_matrix(parts: np.ndarray, where: np.ndarray, vocabulary: Vocabulary):
    """Yields (place, ids as bytes) of rows as they are finished."""
    find = vocabulary.find_merges
    adjacent = find(parts[:, :-1], parts[:, 1:])
    while len(parts):
        width = parts.shape[1]
        if width > 1:
            at = adjacent.argmin(axis=1)
            least = adjacent[np.arange(len(at)), at]
            finished = least == NONE
        else:
            finished = np.ones(len(parts), dtype=bool)
        if finished.any():
            raw, step = parts[finished].astype("<u4").tobytes(), 4 * width
            yield [(p, raw[k * step : k * step + step]) for k, p in enumerate(where[finished].tolist())]
            going = ~finished
            if not going.any():
                return
            parts, adjacent, where = parts[going], adjacent[going], where[going]
            at, least = at[going], least[going]
        rows = np.arange(len(parts))
        merged = least & ID
        # Deleting a boundary: what stands behind it moves up by one place.
        keep = np.ones(parts.shape, dtype=bool)
        keep[rows, at + 1] = False
        parts = parts[keep].reshape(len(rows), width - 1)
        parts[rows, at] = merged
        keep = np.ones(adjacent.shape, dtype=bool)
        keep[rows, at] = False
        adjacent = adjacent[keep].reshape(len(rows), width - 2)
        after = at < width - 2
        adjacent[rows[after], at[after]] = find(merged[after], parts[rows[after], at[after] + 1])
        before = at > 0
        adjacent[rows[before], at[before] - 1] = find(parts[rows[before], at[before] - 1], merged[before])


def _merge_long(parts: list[int], vocabulary: Vocabulary) -> list[int]:
    """The same merges with neighbours in linked lists and the ranks in a heap."""
    find, size = vocabulary.merges.get, len(parts)
    left, right = list(range(-1, size - 1)), list(range(1, size + 1))
    heap = []

    def offered(at: int):
        other = right[at]
        if other < size and (found := find(parts[at] << BITS | parts[other])) is not None:
            yield found >> BITS, at, parts[at], parts[other], found & ID

    for at in range(size - 1):
        heap.extend(offered(at))
    heapify(heap)
    while heap:
        _, at, first, second, merged = heappop(heap)
        other = right[at]
        if parts[at] != first or other >= size or parts[other] != second:
            continue  # one of the two has been merged meanwhile
        parts[at], parts[other] = merged, -1
        right[at] = right[other]
        if right[at] < size:
            left[right[at]] = at
        for place in (at, left[at]):
            if place >= 0:
                for offer in offered(place):
                    heappush(heap, offer)
    return [p for p in parts if p >= 0]


class Codec:
    """Encodes and decodes whole texts; remembers a bounded number of words and chunks."""

    def __init__(self, path: str, remembered: int = 400_000):
        self.vocabulary = load(path)
        self._memo = Memo(self._chunk, remembered)

    def _chunk(self, chunk: str) -> bytes:
        words = WORDS.findall(chunk)
        if len(words) == 1:
            return np.array(merge_word(chunk.encode(), self.vocabulary), dtype="<u4").tobytes()
        return b"".join([self._memo[word] for word in words])

    def _learn(self, found: set[str]) -> None:
        new = {chunk: WORDS.findall(chunk) for chunk in self._memo.new(found)}
        words = self._memo.new(set(chain.from_iterable(new.values())))
        self._memo.update(zip(words, merge_words([w.encode() for w in words], self.vocabulary)))
        of = self._memo.__getitem__
        for chunk, parts in new.items():
            if len(parts) > 1:
                self._memo[chunk] = b"".join(map(of, parts))

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        """Ids as the library gives them without added special tokens; special strings that
        stand in a text itself become their ids."""
        special, of = self.vocabulary.special, self._memo.__getitem__
        cut = [
            [part if k % 2 else chunks(part) for k, part in enumerate(self.vocabulary.cut_specials(t))]
            for t in texts
        ]
        found = {c for parts in cut for part in parts[::2] for c in part}
        self._learn(found)
        coded = []
        for parts in cut:
            raw = [
                special[part].to_bytes(4, "little") if k % 2 else b"".join(map(of, part))
                for k, part in enumerate(parts)
            ]
            coded.append(np.frombuffer(b"".join(raw), dtype="<u4"))
        self._memo.age(found)
        return coded

    def encode(self, text: str) -> list[int]:
        return self.encode_batch([text])[0].tolist()

    def decode(self, ids: list[int]) -> str:
        """The text of the ids, special ones included; bytes that are no UTF-8 become U+FFFD."""
        return b"".join(map(self.vocabulary.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """One per Python worker and vocabulary."""
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and token_ids (array of int) of every whole text; null and empty give no ids."""
    source = texts(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path)
        for batch in batches:
            for part in in_pieces(batch):
                ids = coder.encode_batch(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([i.astype(np.int32) for i in ids], pa.list_(pa.int32()))],
                    ["doc_id", "token_ids"],
                )

    return source.mapInArrow(run, f"doc_id {source.dtypes[0][1]}, token_ids array<int>")


def round_trip(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, round_trips for every row of ``docs``.

    Texts are encoded whole and decoded from the ids. Null counts as empty (no ids). Equal rows
    give equal results; a null id is carried along; other columns play no part.
    """
    source = texts(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path)
        shown = [str(k) for k in range(len(coder.vocabulary.bytes_of))]
        for batch in batches:
            for part in in_pieces(batch):
                found = []
                whole = part.column("text").to_pylist()
                for text, coded in zip(whole, coder.encode_batch(whole)):
                    ids = coded.tolist()
                    decoded = coder.decode(ids)
                    listed = ",".join(map(shown.__getitem__, ids))
                    found.append(
                        (
                            len(ids),
                            hashlib.sha256(listed.encode()).hexdigest(),
                            hashlib.sha256(decoded.encode()).hexdigest(),
                            decoded == text,
                        )
                    )
                columns = list(zip(*found))
                kinds = (pa.int64(), pa.string(), pa.string(), pa.bool_())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "round_trips"],
                )

    kind = source.dtypes[0][1]
    return source.mapInArrow(
        run,
        f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string, round_trips boolean",
    )


def in_pieces(batch: pa.RecordBatch, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """A batch in slices of about ``most`` bytes, so that results of long texts stay small."""
    rows = batch.num_rows
    each = max(1, int(rows * most / max(batch.nbytes, 1))) if rows else 1
    for start in range(0, rows, each):
        yield batch.slice(start, each)
