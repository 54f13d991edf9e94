"""Token ids as Parquet list columns, written in document order and read selectively.

One table of files, sorted by document id over all of them: a row has the id of its document, the
number of its tokens, where they start within the file, and the ids themselves. Ids are
dictionary-encoded (a vocabulary is a small dictionary), the sorted or small counters are
delta-encoded, row groups and pages are kept small, and Parquet's column and offset indexes allow
a reader to fetch the pages of a few documents. Reading lengths or ids of documents never touches
the column of tokens.
"""

from __future__ import annotations

import string
import zlib
from collections.abc import Iterator, Sequence
from itertools import pairwise, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voltlake.llm.chunks import SPACE, chunks
from voltlake.llm.common import texts
from voltlake.llm.rank_bpe import in_pieces
from voltlake.llm.vocabulary import load

FORMAT = {
    "parquet.writer.version": "PARQUET_2_0",  # has the delta encodings
    "parquet.enable.dictionary": "false",
    "parquet.enable.dictionary#token_ids.list.element": "true",
    "parquet.dictionary.page.size": str(1 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "1000",
    "compression": "zstd",
}

LOT = 1000
SIGNS = string.punctuation
LETTER_LAST = "[A-Za-zÀ-ÖØ-öø-ɏ]$"  # Latin ones, which are letters to every version of Unicode
# Texts with single blanks and single line ends only are cut at each of them.
UNUSUAL = "[" + SPACE.replace(" ", "").replace("\n", "") + "]|[ \n][ \n]"


class LibraryEncoder:
    """Ids from the tokenizers library.

    Texts are cut into chunks by Arrow, and only the distinct chunks of a batch are Python objects.
    Most of them have been seen before: the ids of a bounded number are remembered, the most used
    longest, and the library encodes the new ones of a whole batch together, on lines of their own.
    That is exact for byte-level files; for any other kind, and for texts that hold a special
    string, the library gets the whole text.
    """

    def __init__(self, path: str, remembered: int = 400_000):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.no_truncation()
        self._tokenizer.no_padding()
        self._remembered = remembered
        # Place n has sizes[n] ids from starts[n] on, and so many batches have used it. Place 0 is the empty chunk.
        self._places = {"": 0}
        self._ids = np.zeros(0, dtype="<i4")
        self._starts, self._sizes, self._uses = (np.zeros(1, dtype=np.int64) for _ in range(3))
        self._line_end = None
        try:
            vocabulary = load(path)
        except ValueError:
            return
        self._special = list(vocabulary.special)
        self._line_end = vocabulary.id_of[b"\n"]

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, dtype="<i4")

    def _learn(self, new: list[str]) -> None:
        """Remembers the ids of new chunks, none of them empty."""
        lines = [c for c in new if not c.isspace()]
        if lines:
            ids = np.array(self._line_ids(lines), dtype="<i4")
            ends = np.flatnonzero(ids == self._line_end)
            if len(ends) == len(lines) - 1:
                starts = np.concatenate(([0], ends + 1))
                self._remember(lines, ids, starts, np.append(ends, len(ids)) - starts)
            else:  # white space of its own kind is among them
                lines = []
        if len(lines) < len(new):
            alone = [c for c in new if c not in self._places]
            each = list(map(self._whole, alone))
            sizes = np.fromiter(map(len, each), dtype=np.int64, count=len(each))
            self._remember(alone, np.concatenate(each), np.cumsum(sizes) - sizes, sizes)

    def _line_ids(self, lines: list[str]) -> list[int]:
        """The ids of lines, cut into lots that the processor's caches hold."""
        ids = []
        for k in range(0, len(lines), LOT):
            text = "\n".join(lines[k : k + LOT])
            ids += self._tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids
            ids.append(self._line_end)
        return ids[:-1]

    def _remember(self, new: list[str], ids: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> None:
        self._starts = np.concatenate((self._starts, len(self._ids) + starts))
        self._sizes = np.concatenate((self._sizes, sizes))
        self._uses = np.concatenate((self._uses, np.zeros(len(new), dtype=np.int64)))
        self._ids = np.concatenate((self._ids, ids))
        self._places.update(zip(new, range(len(self._places), len(self._places) + len(new))))

    def _ids_of(self, distinct: pa.Array) -> pa.ListArray:
        """The ids of each chunk."""
        parts = _without_signs(distinct).dictionary_encode()
        words = parts.dictionary.to_numpy(zero_copy_only=False).tolist()
        at = np.fromiter(map(self._places.get, words, repeat(-1)), dtype=np.int64, count=len(words))
        missing = np.flatnonzero(at < 0)
        if len(missing):
            new = [words[k] for k in missing.tolist()]
            self._learn(new)
            at[missing] = [self._places[w] for w in new]
        self._uses[at] += 1
        used = at[parts.indices.to_numpy()].reshape(2, -1).T.ravel()  # each chunk and its signs
        sizes = self._sizes[used]
        ends = np.concatenate(([0], np.cumsum(sizes)[1::2])).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(self._ids[_ranges(self._starts[used], sizes)]))

    def _age(self) -> None:
        """Forgets the less used half once there are too many; what stays counts half from then on."""
        if len(self._places) <= self._remembered:
            return
        rank = max(len(self._uses) - self._remembered // 2, 0)
        kept = self._uses > np.partition(self._uses, rank)[rank]
        kept[0] = True
        self._ids = self._ids[_ranges(self._starts[kept], self._sizes[kept])]
        chunks_kept = [c for c, k in zip(self._places, kept.tolist()) if k]
        self._places = dict(zip(chunks_kept, range(len(chunks_kept))))
        self._sizes, self._uses = self._sizes[kept], self._uses[kept] >> 1
        self._starts = np.cumsum(self._sizes) - self._sizes

    def _cut(self, texts: pa.Array) -> tuple[pa.Array, list[int]]:
        """Each text with a NUL between its chunks, and which are left empty, for the library to
        get them whole."""
        whole = pc.match_substring(texts, "\0")
        for special in self._special:
            whole = pc.or_(whole, pc.match_substring(texts, special))
        cut = pc.replace_substring(pc.replace_substring(texts, " ", "\0 "), "\n", "\0\n\0")
        other = pc.or_(whole, pc.match_substring_regex(texts, UNUSUAL))
        if pc.any(other).as_py():
            by_hand = ["" if w else "\0".join(chunks(t)) for t, w in zip(texts.filter(other).to_pylist(), whole.filter(other).to_pylist())]
            cut = pc.replace_with_mask(cut, other, pa.array(by_hand, texts.type))
        return cut, np.flatnonzero(whole.to_numpy(zero_copy_only=False)).tolist()

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all whole texts, one after another, and their numbers; null is not allowed here."""
        if self._line_end is None:
            each = [self._whole(t) for t in texts.to_pylist()]
            return np.concatenate([np.zeros(0, dtype="<i4"), *each]), np.array([len(e) for e in each], dtype=np.int64)
        if not len(texts):
            return np.zeros(0, dtype="<i4"), np.zeros(0, dtype=np.int64)
        cut, whole = self._cut(texts.cast(pa.string()))
        lists = pc.split_pattern(cut, "\0")
        coded = lists.flatten().dictionary_encode()
        found = self._ids_of(coded.dictionary).take(coded.indices)
        ids = found.flatten().to_numpy()
        ends = found.offsets.to_numpy()[lists.offsets.to_numpy()].astype(np.int64)
        numbers = np.diff(ends)
        if whole:
            each = [self._whole(texts[k].as_py()) for k in whole]
            parts = np.split(ids, ends[whole])
            ids = np.concatenate([parts[0], *(x for pair in zip(each, parts[1:]) for x in pair)])
            numbers[whole] = list(map(len, each))
        self._age()
        return ids, numbers

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """The ids of each whole text, as bytes of little-endian 32-bit integers."""
        ids, numbers = self.encode_column(pa.array(texts, pa.string()))
        raw, ends = ids.tobytes(), 4 * np.cumsum(numbers)
        return [raw[a:b] for a, b in zip((ends - 4 * numbers).tolist(), ends.tolist())]


def _without_signs(chunks: pa.Array) -> pa.Array:
    """All chunks without the ASCII signs that follow a letter at their end, which never merge with
    it, then these signs of all chunks."""
    before = pc.utf8_rtrim(chunks, SIGNS)
    before = pc.if_else(pc.match_substring_regex(before, LETTER_LAST), before, chunks)
    ends = np.frombuffer(chunks.buffers()[1], dtype=np.int32)[chunks.offset :][: len(chunks) + 1].astype(np.int64)
    sizes = np.diff(ends) - pc.binary_length(before).to_numpy()
    signs = np.frombuffer(chunks.buffers()[2] or b"", dtype=np.uint8)[_ranges(ends[1:] - sizes, sizes)]
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    signs = pa.StringArray.from_buffers(len(chunks), pa.py_buffer(offsets), pa.py_buffer(signs))
    return pa.concat_arrays([before, signs])


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[k] to starts[k] + sizes[k] - 1, for all k one after another."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))


_encoders: dict[str, LibraryEncoder] = {}


def encoder(path: str) -> LibraryEncoder:
    """One per Python worker and vocabulary."""
    if path not in _encoders:
        _encoders[path] = LibraryEncoder(path)
    return _encoders[path]


def write_tokens(
    docs: DataFrame,
    tokenizer: str,
    out: str,
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    row_group_bytes: int = 32 << 20,
) -> None:
    """Writes the ids of every whole text, ``end_id`` after each, in ascending order of doc_id.

    Null counts as empty: the end id alone. Rows that share an id follow one another, ordered by
    their texts; null ids come first. An empty table writes no rows. Other columns play no part.
    """
    source = texts(docs, id_col, text_col)
    end = np.array([end_id], dtype="<i4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part, start = encoder(tokenizer), TaskContext.get().partitionId(), 0
        for batch in batches:
            for piece in in_pieces(batch, 8 << 20):
                ids, sizes = coder.encode_column(piece.column("text"))
                cuts = np.concatenate(([0], np.cumsum(sizes)))
                values = np.concatenate([x for a, b in pairwise(cuts.tolist()) for x in (ids[a:b], end)])
                ends = cuts + np.arange(len(cuts))
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("doc_id"),
                        pa.array(np.full(len(sizes), part, dtype=np.int32)),
                        pa.array(start + ends[:-1]),
                        pa.array(sizes + 1),
                        pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(values)),
                    ],
                    ["doc_id", "part", "start_in_part", "n_tokens", "token_ids"],
                )
                start += int(ends[-1])

    (
        source.repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
        .mapInArrow(
            run,
            f"doc_id {source.dtypes[0][1]}, part int, start_in_part long, n_tokens long,"
            " token_ids array<int>",
        )
        .write.options(**FORMAT, **{"parquet.block.size": str(row_group_bytes)})
        .parquet(out)
    )


def with_start(spark: SparkSession, path: str, rows: DataFrame) -> DataFrame:
    """Adds ``start``, the tokens of all documents before, to rows read from the files.

    Files follow each other in document order, so ``start`` is the place within the file plus the
    tokens of the files before it. Those are summed from the column of lengths alone, and their
    running total is over one small row per file.
    """
    parts = spark.read.parquet(path).groupBy("part").agg(F.sum("n_tokens").alias("tokens"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("part", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("offset"))
    return (
        rows.join(offsets, "part")
        .withColumn("start", F.col("offset") + F.col("start_in_part"))
        .drop("offset", "part", "start_in_part")
    )


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, n_tokens, start of every document; reads no token."""
    columns = spark.read.parquet(path).select("doc_id", "part", "start_in_part", "n_tokens")
    return with_start(spark, path, columns)


def read_tokens(spark: SparkSession, path: str, doc_ids: Sequence | None = None) -> DataFrame:
    """doc_id, n_tokens and token_ids, of all documents or of a few; the ids of the wanted ones
    are pushed down to row groups and pages."""
    rows = spark.read.parquet(path)
    if doc_ids is not None:
        rows = rows.filter(F.col("doc_id").isin(list(doc_ids)))
    return rows.select("doc_id", "part", "start_in_part", "n_tokens", "token_ids")


def checksums(rows: DataFrame) -> DataFrame:
    """Adds ids_crc32, the crc32 of the ids as little-endian unsigned 32-bit integers, to the
    columns of :func:`read_tokens`, in place of the ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("token_ids")
            ends = lists.offsets.to_numpy()
            raw = memoryview(np.ascontiguousarray(lists.values.to_numpy(), dtype="<i4")).cast("B")
            sums = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(ends[:-1], ends[1:])]
            kept = [batch.column(c) for c in names[:-1]]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sums, pa.int64())], names)

    names = ["doc_id", "part", "start_in_part", "n_tokens", "ids_crc32"]
    return rows.mapInArrow(
        run,
        f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, part int, start_in_part long,"
        " n_tokens long, ids_crc32 long",
    )
