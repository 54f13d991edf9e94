"""Benchmark decontamination by template canonicalisation.

Numbers, units after a number, and names inside a sentence become typed placeholders, equal ones in
a row one placeholder, so that a question keeps its template when its parameters are changed.
Windows of eight such tokens are hash-joined between documents and benchmark items; items of fewer
tokens are one window of their own length. Windows of an item with too few literals are joined as
they are written. The windows found are chained in rising order, over places where words were put in
or left out. Windows in which a value of the item stands for several values of the document do not
count.

Before the join a fixed-size bit set of the benchmark's windows goes to every task, and only
windows that can be in the benchmark leave it. Its size does not grow with either side; it only
decides how many useless rows meet the join.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltlake.llm.chunks import Memo
from voltlake.llm.common import texts, written
from voltlake.llm.rank_bpe import in_pieces
from voltlake.llm.superminhash import mix64

WINDOW = 8
LITERALS = 4  # a window of placeholders only says nothing
COVERED = 0.75  # share of an item's tokens that is enough, however few windows are whole
RUN = 20  # tokens in a row that are enough, however long the item is
SHIFT = 0.01  # what a change of the offset costs a chain, in windows
BITS = 22
# Common units of measure, money and time.
UNITS = frozenset(
    """% percent km kilometers kilometres m meters metres cm mm miles mile feet foot inches inch kg
    kilograms g grams mg pounds lb lbs ounces tons l liters litres ml gallons mph kmh hours hour h
    minutes minute min seconds second s days day weeks week months month years year dollars dollar
    usd cents euros euro eur pounds yen degrees celsius fahrenheit watts kw kwh volts mb gb tb""".split()
)
_TOKEN = re.compile(r"\d+(?:[.,:/]\d+)*|[^\W\d_]+|%|[.!?\n]")
_LITERAL, _NUMBER, _UNIT, _CAPITAL, _STOP = range(5)
_U64 = np.uint64


def _token(word: str) -> int:
    """Hash and kind (the last three bits) of a token, without its surroundings."""
    if word[0].isdigit():
        kind = _NUMBER
    elif word in ".!?\n":
        kind = _STOP
    elif word.lower() in UNITS:
        kind = _UNIT
    else:
        kind = _CAPITAL if word[0].isupper() else _LITERAL
    return xxhash.xxh64_intdigest(word.lower().encode()) >> 4 << 3 | kind


class Canonicaliser:
    def __init__(self) -> None:
        self._memo = Memo(_token, 200_000)

    def tokens(self, many: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hashes of the tokens of texts, what each is replaced by (0: a literal), and its text."""
        words, counts = [], np.zeros(len(many), dtype=np.int64)
        for row, text in enumerate(many):
            found = _TOKEN.findall(text)
            counts[row] = len(found)
            words += found
        told = np.fromiter(map(self._memo.__getitem__, words), dtype=np.int64, count=len(words))
        self._memo.age(words)
        owner = np.repeat(np.arange(len(many)), counts)
        hashes, kinds = (told >> 3).astype(np.uint64), told & 7
        before = np.full(len(kinds), _STOP)
        before[1:] = np.where(owner[1:] == owner[:-1], kinds[:-1], _STOP)
        slot = np.zeros(len(kinds), dtype=np.int64)
        slot[kinds == _NUMBER] = _NUMBER
        slot[(kinds == _UNIT) & (before == _NUMBER)] = _UNIT
        slot[(kinds == _CAPITAL) & (before != _STOP)] = _CAPITAL
        kept = kinds != _STOP
        return hashes[kept], slot[kept], owner[kept]


def _window(count: int) -> int:
    """Tokens of a window of an item with so many: one changed word leaves a window whole from 14 on."""
    return WINDOW - 1 if 2 * WINDOW - 2 <= count <= 2 * WINDOW else min(WINDOW, count)


def _collapsed(hashes: np.ndarray, slot: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First token, kind and value (0: a literal) of each literal or run of equal placeholders."""
    begins = np.ones(len(slot), dtype=bool)
    begins[1:] = (slot[1:] != slot[:-1]) | (slot[1:] == 0) | (owner[1:] != owner[:-1])
    starts = np.flatnonzero(begins)
    kinds, values = slot[starts], hashes[starts]
    if len(starts) < len(slot):
        place = (np.arange(len(slot)) - starts[np.cumsum(begins) - 1]).astype(np.uint64)
        with np.errstate(over="ignore"):
            runs = np.add.reduceat(mix64(hashes + (place << _U64(60))), starts) >> _U64(4)
        values = np.where(np.diff(starts, append=len(slot)) > 1, runs, values)
    return starts, kinds, np.where(kinds > 0, values.astype(np.int64) << 3 | kinds, 0)


def _rolled(mixed: np.ndarray, size: int, kind: int) -> np.ndarray:
    """Hash of each window of mixed tokens; windows of different kinds or sizes never meet."""
    count, factor = max(0, len(mixed) - size + 1), 1
    total = np.full(count, 2 * size + kind, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size):
            factor = factor * 0x9E3779B97F4A7C15 % (1 << 64)
            total += mixed[k : k + count] * _U64(factor)
    return mix64(total)


def _literals(slot: np.ndarray, size: int) -> np.ndarray:
    """How many tokens of each window are literals."""
    before = np.concatenate(([0], np.cumsum(slot == 0)))
    return before[size:] - before[:-size]


_TEMPLATE, _RAW = range(2)
_COLUMNS = ["kind", "size", "window", "place", "at", "span", "slots", "tokens", "last", "templates", "windows"]
_SHAPE = (
    "kind int, size int, window long, place int, at int, span int, slots array<long>, tokens int, last int, "
    "templates int, windows int"
)
_DOC_SHAPE = "window long, doc_place int, doc_at int, doc_slots array<long>"


def _item_windows(hashes: np.ndarray, slot: np.ndarray) -> list[tuple]:
    """(kind, size, hashes, first tokens, places, tokens, slots) of the windows of an item."""
    starts, kinds, values = _collapsed(hashes, slot, np.zeros(len(slot)))
    ends = np.append(starts, len(hashes))
    found = []
    for kind, flags in ((_TEMPLATE, kinds), (_RAW, slot)):
        size = _window(len(flags))
        literals = _literals(flags, size)
        if kind == _TEMPLATE:
            wanted = literals >= min(LITERALS, size)
        else:
            wanted = (literals < min(LITERALS, size)) | (len(hashes) < WINDOW)
        kept = np.flatnonzero(wanted)
        if not len(kept):
            continue
        rolled = _rolled(_mixed(hashes, starts, kinds, kind), size, kind)
        slots = np.zeros((len(kept), WINDOW), dtype=np.int64)
        place, span = kept, np.full(len(kept), size)
        if kind == _TEMPLATE:
            slots[:, :size] = values[kept[:, None] + np.arange(size)]
            place, span = starts[kept], ends[kept + size] - starts[kept]
        found.append((kind, size, rolled[kept], place, kept, span, slots))
    return found


def _mixed(hashes: np.ndarray, starts: np.ndarray, kinds: np.ndarray, kind: int) -> np.ndarray:
    """What windows are rolled over: literals and placeholders, or the tokens as they are."""
    return mix64(np.where(kinds > 0, kinds.astype(np.uint64), hashes[starts]) if kind == _TEMPLATE else hashes)


def _document_windows(tokens: tuple, sizes: list[tuple[int, int]], bits: np.ndarray) -> list[tuple]:
    """(text, hash, first token, place, slots) of the windows of all texts of a piece that may be an item's.

    The texts are rolled over together; what the bit set lets through is looked at more closely.
    """
    hashes, slot, owner = tokens
    starts, kinds, values = _collapsed(hashes, slot, owner)
    run_owner = owner[starts]
    n = int(owner[-1]) + 1 if len(owner) else 0
    token_first, run_first = (np.searchsorted(of, np.arange(n)) for of in (owner, run_owner))
    found = []
    for kind, of in ((_TEMPLATE, run_owner), (_RAW, owner)):
        wanted = [size for k, size in sizes if k == kind and size <= len(of)]
        mixed = _mixed(hashes, starts, kinds, kind) if wanted else None
        for size in wanted:
            rolled = _rolled(mixed, size, kind)
            bit = (rolled >> _U64(64 - BITS)).astype(np.int64)
            kept = np.flatnonzero(bits[bit >> 3] >> (bit & 7) & 1)
            kept = kept[of[kept] == of[kept + size - 1]]  # within one text
            if kind == _TEMPLATE and len(kept):
                kept = kept[(kinds[kept[:, None] + np.arange(size)] == 0).sum(axis=1) >= min(LITERALS, size)]
            if not len(kept):
                continue
            text = of[kept]
            slots = np.zeros((len(kept), WINDOW), dtype=np.int64)
            place = kept - token_first[text]
            at = place
            if kind == _TEMPLATE:
                slots[:, :size] = values[kept[:, None] + np.arange(size)]
                place, at = starts[kept] - token_first[text], kept - run_first[text]
            found.append((text, rolled[kept], place, at, slots))
    return found


def _slots_array(slots: np.ndarray) -> pa.Array:
    ends = np.arange(0, slots.size + 1, WINDOW, dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(slots.ravel()))


def item_windows(source: DataFrame) -> DataFrame:
    """item_id and what `_SHAPE` says of each window: where it begins in tokens (place) and in runs (at),
    its tokens (span), and counts of the item's tokens, runs and windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        canonicaliser = Canonicaliser()
        for batch in batches:
            for part in in_pieces(batch):
                owner, parts = [], []
                for row, text in enumerate(part.column("text").to_pylist()):
                    hashes, slot, of = canonicaliser.tokens([text])
                    found = _item_windows(hashes, slot) if len(hashes) else []
                    if not found:
                        continue
                    last = len(_collapsed(hashes, slot, of)[0]) - 1
                    templates = sum(len(f[2]) for f in found if f[0] == _TEMPLATE)
                    windows = len(set().union(*(f[3].tolist() for f in found)))
                    for kind, size, rolled, place, at, span, slots in found:
                        count = len(rolled)
                        owner.append(np.full(count, row))
                        parts.append(
                            (np.full(count, kind), np.full(count, size), rolled.view(np.int64), place, at, span, slots)
                            + tuple(np.full(count, x) for x in (len(hashes), last, templates, windows))
                        )
                if not owner:
                    continue
                columns = []
                for name, *arrays in zip(_COLUMNS, *parts):
                    flat = np.concatenate(arrays)
                    if name == "slots":
                        columns.append(_slots_array(flat))
                    else:
                        columns.append(pa.array(flat if name == "window" else flat.astype(np.int32)))
                ids = part.column("doc_id").take(pa.array(np.concatenate(owner)))
                yield pa.RecordBatch.from_arrays([ids, *columns], ["item_id", *_COLUMNS])

    return source.mapInArrow(run, f"item_id {source.dtypes[0][1]}, {_SHAPE}")


def document_windows(source: DataFrame, sizes: list[tuple[int, int]], allowed) -> DataFrame:
    """doc_id and what `_DOC_SHAPE` says of each window that may be an item's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        canonicaliser = Canonicaliser()
        bits = np.frombuffer(allowed.value, dtype=np.uint8)
        for batch in batches:
            for part in in_pieces(batch, 1 << 20):
                found = _document_windows(canonicaliser.tokens(part.column("text").to_pylist()), sizes, bits)
                if not found:
                    continue
                text, rolled, place, at, slots = (np.concatenate(arrays) for arrays in zip(*found))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").take(pa.array(text)), pa.array(rolled.view(np.int64)),
                        pa.array(place.astype(np.int32)), pa.array(at.astype(np.int32)), _slots_array(slots),
                    ],
                    ["doc_id", "window", "doc_place", "doc_at", "doc_slots"],
                )

    return source.mapInArrow(run, f"doc_id {source.dtypes[0][1]}, {_DOC_SHAPE}")


def _chain(place: np.ndarray, there: np.ndarray, tokens: int) -> np.ndarray:
    """Indexes of the longest chain of windows that rises in the item and in the document.

    From one window to the next the offset moves by no more than the item's length; of equally long
    chains the one with the fewest moves is taken. The points come in the order of ``there``.
    """
    shift = there - place
    if (shift == shift[0]).all():
        return np.arange(len(place))
    best, back = np.ones(len(place)), np.full(len(place), -1)
    low = np.searchsorted(there, there - 2 * tokens)
    for i in range(1, len(place)):
        j = slice(low[i], i)
        moved = np.abs(shift[j] - shift[i])
        gain = np.where((place[j] < place[i]) & (there[j] < there[i]) & (moved <= tokens), best[j] - SHIFT * (moved > 0), 0)
        if len(gain) and gain.max() > 0:
            back[i] = low[i] + gain.argmax()
            best[i] = 1 + gain.max()
    chain, i = [], int(best.argmax())
    while i >= 0:
        chain.append(i)
        i = back[i]
    return np.array(chain[::-1])


def _judged(rows: dict, chosen: np.ndarray, share: float) -> tuple | None:
    """matched, slots and verbatim of a chain of windows, or nothing if it is too little."""
    tokens, last = int(rows["tokens"].max()), int(rows["last"][0])
    # Rows that repeat an id say the same window twice.
    chosen = chosen[np.sort(np.unique(rows["place"][chosen] * 2 + rows["kind"][chosen], return_index=True)[1])]
    mine, theirs = rows["slots"][chosen], rows["doc_slots"][chosen]
    run = rows["at"][chosen][:, None] + np.arange(WINDOW)
    # A run at the edge of the item may go on in the document.
    edge = (mine & 7 != _UNIT) & ((run == 0) | (run == last) | (run == 1) & (mine & 7 == _CAPITAL))
    checked = (mine != 0) & ~edge
    pairs = np.unique(np.stack([mine[checked], theirs[checked]], axis=1), axis=0)
    values, counts = np.unique(pairs[:, 0], return_counts=True)
    torn = (checked & np.isin(mine, values[counts > 1])).any(axis=1)
    chosen, mine, theirs = chosen[~torn], mine[~torn], theirs[~torn]
    if not len(chosen):
        return None
    place, span, kind = rows["place"][chosen], rows["span"][chosen], rows["kind"][chosen]
    covered = np.zeros(tokens, dtype=bool)
    longest = 0
    for which in (_TEMPLATE, _RAW):
        of = kind == which
        at, there, first, end = (x[of] for x in (rows["at"][chosen], rows["doc_at"][chosen], place, place + span))
        for a, b in zip(first, end):
            covered[a:b] = True
        broken = np.flatnonzero((np.diff(at) != 1) | (np.diff(there) != 1)) + 1
        if len(at):
            longest = max(longest, (end[np.append(broken - 1, len(at) - 1)] - first[np.append(0, broken)]).max())
    matched, templates = len(np.unique(place)), int((kind == _TEMPLATE).sum())
    enough = (
        matched >= share * rows["windows"][0]
        or templates > 0 and templates >= share * rows["templates"][0]
        or covered.sum() >= max(share, COVERED) * tokens
        or longest >= RUN
    )
    if not enough:
        return None
    pairs = np.unique(np.stack([mine[mine != 0], theirs[mine != 0]], axis=1), axis=0)
    return matched, len(pairs), bool((pairs[:, 0] == pairs[:, 1]).all())


def _could(rows: dict, most: int, share: float) -> bool:
    """Whether a chain of at most ``most`` of the windows can be enough. What they cover together, and
    each criterion by itself, is at least what any chain of them gives."""
    places, templates = np.unique(rows["place"]), np.unique(rows["place"][rows["kind"] == _TEMPLATE])
    tokens, widest = int(rows["tokens"].max()), int(rows["span"].max())
    edges = np.zeros(tokens + 1, dtype=np.int64)
    np.add.at(edges, rows["place"], 1)
    np.add.at(edges, np.minimum(rows["place"] + rows["span"], tokens), -1)
    covered = np.cumsum(edges[:-1]) > 0
    breaks = np.flatnonzero(~covered)
    longest = np.diff(np.concatenate(([-1], breaks, [tokens]))).max() - 1
    return bool(
        min(most, len(places)) >= share * rows["windows"][0]
        or 0 < min(most, len(templates)) >= share * rows["templates"][0]
        or min(most * widest, covered.sum()) >= max(share, COVERED) * tokens
        or min(most * widest, longest) >= RUN
    )


def _stretches(doc_place: np.ndarray, tokens: int) -> list[slice]:
    """Hits in the order of the document, cut where a gap is too wide for any chain."""
    cuts = np.flatnonzero(np.diff(doc_place) > 2 * tokens) + 1
    return [slice(a, b) for a, b in zip(np.append(0, cuts), np.append(cuts, len(doc_place)))]


def _best(table: pa.Table, share: float) -> tuple | None:
    """What is to be said of one item in one document, or nothing."""
    names = ["kind", "place", "at", "span", "tokens", "last", "templates", "windows", "doc_place", "doc_at"]
    rows = {n: table.column(n).to_numpy() for n in names}
    for name in ("slots", "doc_slots"):
        rows[name] = table.column(name).combine_chunks().flatten().to_numpy().reshape(-1, WINDOW)
    order = np.lexsort((rows["kind"], rows["place"], rows["doc_place"]))
    rows = {n: v[order] for n, v in rows.items()}
    for stretch in _stretches(rows["doc_place"], int(rows["tokens"][0])):
        here = {n: v[stretch] for n, v in rows.items()}
        most = len(here["place"])
        while len(here["place"]) and _could(here, most, share):
            point = np.stack([here["doc_place"], here["place"]], axis=1).astype(np.int64)
            points, of = np.unique(point, axis=0, return_inverse=True)
            chain = _chain(points[:, 1], points[:, 0], int(here["tokens"][0]))
            taken = np.isin(of.ravel(), chain)
            found = _judged(here, np.flatnonzero(taken), share)
            if found:
                return found
            # The next occurrence; no chain of it has more windows, but for what moves have cost this one.
            most = len(chain) + len(chain) // 50 + 1
            here = {n: v[~taken] for n, v in here.items()}
    return None


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    share: float = 0.5,
) -> DataFrame:
    """doc_id, item_id, matched, windows, slots, verbatim of each item found in a document.

    An item is found if ``share`` of its windows, or of those that are templates, stand in the
    document in rising order, words put in or left out between them or not; or if these windows hold
    three quarters of its tokens, or twenty tokens in a row. Windows with a value of the item that
    stands for several values of the document do not count. An item of 13 tokens or fewer needs eight
    in a row, or all. ``slots`` counts the distinct parameters, ``verbatim`` says that all have the
    item's own values; a name that runs on in the document beyond the item is another value. Windows
    of fewer than four literals (or all its tokens, if shorter) are only found as they are written.
    Texts are read whole; a null or empty text and a null id are never found. Rows that repeat an id
    are one document or item. Empty tables give no rows; other columns play no part.
    """
    spark = docs.sparkSession
    items = texts(benchmark, item_col, item_text_col).filter("doc_id IS NOT NULL")
    wanted = written(item_windows(items), "benchmark-windows")
    places = wanted.select(F.shiftrightunsigned("window", 64 - BITS).alias("bit")).distinct()
    bits = np.zeros(1 << BITS, dtype=bool)
    at = places.toPandas()["bit"].to_numpy(dtype=np.int64)  # 2 ** BITS at most
    bits[at] = True
    allowed = spark.sparkContext.broadcast(np.packbits(bits, bitorder="little").tobytes())
    sizes = [tuple(r) for r in wanted.select("kind", "size").distinct().collect()]  # 2 * WINDOW at most
    known = texts(docs, id_col, text_col).filter("doc_id IS NOT NULL")
    here = document_windows(known, sizes, allowed)
    types = f"doc_id {known.dtypes[0][1]}, item_id {items.dtypes[0][1]}"

    def judge(table: pa.Table) -> pa.Table:
        found = _best(table, share)
        ids = table.select(["doc_id", "item_id"]).slice(0, 1 if found else 0)
        matched, slots, verbatim = ([x] if found else [] for x in found or (0, 0, False))
        return (
            ids.append_column("matched", pa.array(matched, pa.int64()))
            .append_column("windows", table.column("windows").slice(0, len(ids)))
            .append_column("slots", pa.array(slots, pa.int32()))
            .append_column("verbatim", pa.array(verbatim, pa.bool_()))
        )

    return (
        here.join(wanted, "window")
        .groupBy("doc_id", "item_id")
        .applyInArrow(judge, f"{types}, matched long, windows int, slots int, verbatim boolean")
    )
