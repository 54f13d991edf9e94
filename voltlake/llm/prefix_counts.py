"""Exact token counts of every prefix of a text, by dynamic programming.

A sequence of tokens is what byte-pair encoding gives for a word if and only if each two
neighbours, encoded together, come out as just these two. So the encoding of a prefix of a word
ends in the one token that is compatible with the last token of the shorter prefix before it, and

    count[end] = count[end - len(token)] + 1

fills a table from left to right without encoding any prefix. Words never influence each other,
with two exceptions that depend on where the text ends: white space at the very end is one word,
and a contraction ('re, 've, 'll) that is cut is no contraction. Both are put right in the table.
With the table, "how many tokens are the first n characters" and "what is the longest prefix of at
most b tokens" are look-ups.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltlake.llm.chunks import SPACE, Memo, chunks
from voltlake.llm.common import texts
from voltlake.llm.rank_bpe import MATRIX, in_pieces, merge_words
from voltlake.llm.vocabulary import BITS, ID, NONE, WORDS, load

_RUN = re.compile(f"[{SPACE}]{{2,}}")
_CUT_CONTRACTIONS = ("'re", "'ve", "'ll")


class PrefixCounter:
    """Counts for whole texts; the tables of a bounded number of words and chunks are remembered."""

    def __init__(self, path: str, remembered: int = 300_000):
        self.vocabulary = known = load(path)
        self._memo = Memo(self._chunk_counts, remembered)
        # How each token is made: its rank, and the two tokens it is made of.
        size = len(known.bytes_of)
        self._made, self._left, self._right = (np.full(size, -1, dtype=np.int64) for _ in range(3))
        for pair, merge in known.merges.items():
            token = merge & ID
            self._made[token], self._left[token], self._right[token] = merge >> BITS, pair >> BITS, pair & ID
        self._making = list(zip(self._made.tolist(), self._left.tolist(), self._right.tolist()))
        # Tokens by their bytes, as a tree: node and byte give the next node, nodes give tokens.
        steps: dict[int, int] = {}
        token_at = [-1]
        whole = [(raw, token) for raw, token in known.id_of.items()]
        for (raw, token), coded in zip(whole, merge_words([raw for raw, _ in whole], known)):
            if len(coded) != 4:
                continue  # a token that no text is encoded as
            node = 0
            for byte in raw:
                node = steps.setdefault(node << 8 | byte, len(token_at))
                if node == len(token_at):
                    token_at.append(-1)
            token_at[node] = token
        self._token_at = np.array(token_at, dtype=np.int64)
        self._step_of = steps
        self._fits = Memo(self._pair_fits, remembered)
        self._token_list = token_at
        self._steps = np.array(sorted(steps), dtype=np.int64)
        self._nodes = np.array([steps[k] for k in sorted(steps)], dtype=np.int64)

    def compatible(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """For pairs of tokens side by side: are they what their bytes together are encoded as?

        Undoes the merges on both sides of the border, latest first. The border holds if at no
        time its two neighbours could merge before the next merge that involves one of them; of
        equal ranks the left one comes first.
        """
        holds = np.ones(len(first), dtype=bool)
        rows, next_rank = np.arange(len(first)), np.full(len(first), NONE >> BITS)
        while len(rows):
            merged = (self.vocabulary.find_merges(first, second) >> BITS) < next_rank
            holds[rows[merged]] = False
            left, right = self._made[first], self._made[second]
            undo_left = left > right
            going = ~merged & (undo_left | (right >= 0))
            rows, first, second, undo_left = rows[going], first[going], second[going], undo_left[going]
            next_rank = np.where(undo_left, left[going], right[going] + 1)
            first, second = (
                np.where(undo_left, self._right[first], first),
                np.where(undo_left, second, self._left[second]),
            )
        return holds

    def _pair_fits(self, pair: int) -> bool:
        """As ``compatible``, for one pair."""
        merge, made = self.vocabulary.merges.get, self._making
        first, second, next_rank = pair >> BITS, pair & ID, NONE >> BITS
        while True:
            if merge(first << BITS | second, NONE) >> BITS < next_rank:
                return False
            (left, _, first_right), (right, second_left, _) = made[first], made[second]
            if left > right:
                next_rank, first = left, first_right
            elif right >= 0:
                next_rank, second = right + 1, second_left
            else:
                return True

    def _count_matrix(self, raw: np.ndarray) -> np.ndarray:
        """Tokens of every prefix in bytes, for words of one length: a row of bytes each."""
        words, size = raw.shape
        last = np.full((words, size + 1), -1, dtype=np.int64)
        count = np.zeros((words, size + 1), dtype=np.int32)
        for start in range(size):
            rows, node = np.arange(words), np.zeros(words, dtype=np.int64)
            for end in range(start + 1, size + 1):
                key = node << 8 | raw[rows, end - 1]
                at = np.searchsorted(self._steps, key)
                at[at == len(self._steps)] = 0
                hit = self._steps[at] == key
                rows, node = rows[hit], self._nodes[at[hit]]
                if not len(rows):
                    break
                token = self._token_at[node]
                open_ = (token >= 0) & (last[rows, end] < 0)
                found, token = rows[open_], token[open_]
                if start and len(found):
                    fits = self.compatible(last[found, start], token)
                    found, token = found[fits], token[fits]
                last[found, end] = token
                count[found, end] = count[found, start] + 1
        return count[:, 1:]

    def _count_long(self, raw: bytes) -> np.ndarray:
        """The same for one long word; here a step at a time costs less than a row at a time."""
        step, token_at = self._step_of.get, self._token_list
        size = len(raw)
        last, count = [-1] * (size + 1), [0] * (size + 1)
        for start in range(size):
            node = 0
            for end in range(start + 1, size + 1):
                node = step(node << 8 | raw[end - 1])
                if node is None:
                    break
                token = token_at[node]
                if token >= 0 and last[end] < 0 and (not start or self._fits[last[start] << BITS | token]):
                    last[end], count[end] = token, count[start] + 1
        return np.array([count[1:]], dtype=np.int32)

    def word_tables(self, words: list[str]) -> list[bytes]:
        """Tokens of each prefix in characters, the words whole at the end, as 32-bit integers."""
        tables: list[bytes] = [b""] * len(words)
        raw_words = [w.encode() for w in words]
        by_length: dict[int, list[int]] = {}
        for at, raw in enumerate(raw_words):
            by_length.setdefault(len(raw), []).append(at)
        for size, places in by_length.items():
            most = 20_000 if size <= MATRIX else 1
            for some in range(0, len(places), most):
                part = places[some : some + most]
                raw = np.frombuffer(b"".join([raw_words[at] for at in part]), dtype=np.uint8)
                raw = raw.reshape(len(part), size)
                if size <= MATRIX:
                    counts = self._count_matrix(raw.astype(np.int64))
                else:
                    counts = self._count_long(raw_words[part[0]])
                # A character ends where the next byte does not continue it.
                ends = np.ones(raw.shape, dtype=bool)
                ends[:, :-1] = (raw[:, 1:] & 0xC0) != 0x80
                cuts = 4 * np.concatenate(([0], np.cumsum(ends.sum(axis=1))))
                flat, cuts = counts[ends].tobytes(), cuts.tolist()
                for k, at in enumerate(part):
                    tables[at] = flat[cuts[k] : cuts[k + 1]]
        for at, word in enumerate(words):
            if word in _CUT_CONTRACTIONS:
                told = np.frombuffer(tables[at], dtype=np.int32).copy()
                told[1] = 2
                tables[at] = told.tobytes()
        return tables

    def _chunk_counts(self, chunk: str) -> bytes:
        words = WORDS.findall(chunk)
        if len(words) == 1:
            return self.word_tables(words)[0]
        return self._joined(words)

    def _joined(self, words: list[str]) -> bytes:
        counts = array("i")
        for word in words:
            base, own = counts[-1] if counts else 0, array("i", self._memo[word])
            counts.extend([base + n for n in own] if base else own)
        return counts.tobytes()

    def learn(self, found: set[str]) -> None:
        new = {chunk: WORDS.findall(chunk) for chunk in self._memo.new(found)}
        words = self._memo.new(set(chain.from_iterable(new.values())))
        self._memo.update(zip(words, self.word_tables(words)))
        for chunk, parts in new.items():
            if len(parts) > 1:
                self._memo[chunk] = self._joined(parts)

    def tables(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Tokens of the first 0, 1, ... characters of each text, as the library would give them."""
        special = self.vocabulary.special_pattern
        ordinary = [special.sub(" ", t) if special else t for t in texts]
        found = set(chain.from_iterable(map(chunks, ordinary)))
        self.learn(found)
        for text in texts:
            yield self._table(text)
        self._memo.age(found)
        self._fits.age()

    def table(self, text: str) -> np.ndarray:
        return next(self.tables([text]))

    def _ordinary(self, text: str) -> np.ndarray:
        """The table of a text in which special strings, if any, are ordinary text."""
        if not text:
            return np.zeros(0, dtype=np.int32)
        local = list(map(self._memo.__getitem__, chunks(text)))
        ends = np.cumsum(np.fromiter(map(len, local), dtype=np.int64, count=len(local)) >> 2)
        table = np.frombuffer(b"".join(local), dtype=np.int32).copy()
        totals = np.cumsum(table[ends - 1])
        table += np.repeat(np.concatenate(([0], totals[:-1])), np.diff(ends, prepend=0)).astype(np.int32)
        for run in _RUN.finditer(text):
            start, end = run.span()
            base = table[start - 1] if start else 0
            table[start:end] = base + np.frombuffer(self._memo[run[0]], dtype=np.int32)
        return table

    def _table(self, text: str) -> np.ndarray:
        pieces, base = [np.zeros(1, dtype=np.int32)], 0
        before = ""
        for k, part in enumerate(self.vocabulary.cut_specials(text)):
            if k % 2 == 0:
                counts, before = self._ordinary(part), part
                pieces.append(counts + base)
                continue
            # A special string that is cut is ordinary text and joins the word before it.
            tail = before[len(before.rstrip(SPACE)) :] or before[self._last_border(before) :]
            start = len(before) - len(tail)
            base_tail = base + (int(counts[start - 1]) if start else 0)
            grown = self._ordinary(tail + part[:-1])[len(tail) :] + base_tail
            base += (int(counts[-1]) if len(counts) else 0) + 1
            pieces += [grown, np.array([base])]
        return np.concatenate(pieces).astype(np.int32, copy=False)

    @staticmethod
    def _last_border(text: str) -> int:
        """Where the last white space begins that follows something else; 0 without any."""
        found = 0
        for run in re.finditer(f"[{SPACE}]+", text):
            found = run.start()
        return found


_counters: dict[str, PrefixCounter] = {}


def counter(path: str) -> PrefixCounter:
    """One per Python worker and vocabulary."""
    if path not in _counters:
        _counters[path] = PrefixCounter(path)
    return _counters[path]


def prefix_counts(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    budget: int | None = None,
    keep_table: bool = True,
) -> DataFrame:
    """doc_id, n_bytes, n_chars, n_tokens for every row of ``docs``, and on demand the rest.

    ``counts`` (with ``keep_table``) holds the tokens of the first 0, 1, ... n_chars characters;
    ``fit_chars`` (with ``budget``) the length of the longest prefix of at most ``budget`` tokens.
    Special strings in a text count as one token, as in the library. Null counts as empty: no
    bytes, no tokens, a table of one zero. Repeated rows and null ids are carried along as they
    are; other columns play no part. Memory is four bytes for each character of one text.
    """
    source = texts(docs, id_col, text_col)
    names = ["doc_id", "n_bytes", "n_chars", "n_tokens"]
    names += ["fit_chars"] * (budget is not None) + ["counts"] * keep_table
    kinds = {"counts": "array<int>", "doc_id": source.dtypes[0][1]}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables_of = counter(path).tables
        for batch in batches:
            for part in in_pieces(batch):
                found: dict[str, list] = {name: [] for name in names[1:]}
                whole = part.column("text").to_pylist()
                for text, table in zip(whole, tables_of(whole)):
                    found["n_bytes"].append(len(text.encode()))
                    found["n_chars"].append(len(text))
                    found["n_tokens"].append(int(table[-1]))
                    if budget is not None:
                        # Counts do not only rise, so the last place that fits is looked for.
                        within = np.flatnonzero(table <= budget)
                        found["fit_chars"].append(int(within[-1]) if len(within) else None)
                    if keep_table:
                        found["counts"].append(table)
                columns = [
                    pa.array(v, pa.list_(pa.int32()) if k == "counts" else pa.int64())
                    for k, v in found.items()
                ]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *columns], names)

    return source.mapInArrow(run, ", ".join(f"{n} {kinds.get(n, 'long')}" for n in names))


def tokens_in_prefix(chars: Column) -> Column:
    """Tokens of the first ``chars`` characters, from ``counts``; null beyond the text."""
    at = chars.cast("int")
    return F.when((at >= 0) & (at < F.size("counts")), F.get("counts", at))


def longest_within(budget: Column) -> Column:
    """Characters of the longest prefix of at most ``budget`` tokens, from ``counts``."""
    places = F.transform("counts", lambda n, at: F.when(n <= budget, at))
    return F.array_max(places)
