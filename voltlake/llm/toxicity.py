"""A linear toxicity classifier that is held to the same score when groups of people are swapped.

Each labelled text that mentions a group ("women", "immigrants") gets counterfactuals, the same
text with the mention replaced by other groups of its list. Training minimises

    logistic loss  +  l2 * |w|^2  +  fairness * mean (score(text) - score(counterfactual))^2

on the log-odds, so that the weight of an insult stays while the weight of a mention cannot grow
just because mentions and insults met in the sample. To the given lists of groups come sets learned from
the sample (``learned_groups``): words that labels do not tell apart and that fill the same contexts. A text is seen as the set of its words and
their beginnings, which also know the unseen forms of a known stem; features are kept if they
tell labels apart in the sample, and those of the group terms always.

The classifier is fitted on ``sample`` labelled rows at most; scoring covers every whole text.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltlake.llm.chunks import Memo
from voltlake.llm.common import texts, written
from voltlake.llm.rank_bpe import in_pieces

# Neutral words for groups of people. The members of a list can stand in for each
# other in a sentence.
GROUPS = (
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("immigrants", "refugees", "foreigners", "locals"),
    ("black", "white", "asian", "latino", "african", "european"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("blind", "deaf", "disabled", "elderly", "young"),
    ("frauen", "männer", "mädchen", "jungen"),
    ("muslime", "christen", "juden", "hindus"),
    ("einwanderer", "flüchtlinge", "ausländer", "einheimische"),
    ("femmes", "hommes", "filles", "garçons"),
    ("musulmans", "chrétiens", "juifs", "hindous"),
    ("immigrés", "réfugiés", "étrangers", "habitants"),
    ("mujeres", "hombres", "chicas", "chicos"),
    ("musulmanes", "cristianos", "judíos", "hindúes"),
    ("inmigrantes", "refugiados", "extranjeros", "vecinos"),
)
BEGINNINGS = (4, 5, 6)
_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


def features_of(word: str) -> list[int]:
    """Hashes of the word and its beginnings; a beginning is marked, to be told from a word."""
    told = [word, *(word[:n] + "*" for n in BEGINNINGS if len(word) >= n)]
    return [xxhash.xxh64_intdigest(f) for f in told]


def all_features(words: set[str]) -> np.ndarray:
    return np.unique(np.array([f for w in words for f in features_of(w)], dtype=np.uint64))


def counterfactuals(words: set[str], groups: Sequence[Sequence[str]] = GROUPS) -> Iterator[tuple[str, str]]:
    """The swaps a text gets: each mention of a group, with every other of its list that the text does not name."""
    for group in groups:
        named = words.intersection(group)
        yield from ((term, other) for term in sorted(named) for other in group if other not in named)


def learned_groups(
    sample: DataFrame,
    terms: int = 100,
    at_least: int = 20,
    neutral: float = 2.0,
    alike: float = 0.6,
    size: int = 4,
    known: Iterable[str] = (),
) -> list[tuple[str, ...]]:
    """Sets of words that can stand in for each other in the texts (``text``, ``label``) of a bounded sample.

    A term is one of the ``terms`` most frequent words that are in ``at_least`` texts, whose shares in both classes
    differ by less than ``neutral`` standard errors, and that are not ``known``. Its contexts are the terms left and right
    of it. From the most frequent term on, each takes the ``size`` - 1 terms still free whose contexts are most ``alike``
    (cosine of square roots).
    """
    words = sample.select("label", F.expr(r"regexp_extract_all(lower(text), '\\p{L}+', 0)").alias("words"))
    sizes = {r[0]: r[1] for r in sample.groupBy("label").count().collect()}
    none, some = sizes.get(0, 0), sizes.get(1, 0)
    if not none or not some:
        return []
    share = F.col("seen") / (none + some)
    error = F.sqrt(share * (1 - share) * (1 / none + 1 / some))
    apart = F.abs(F.col("toxic") / some - (F.col("seen") - F.col("toxic")) / none)
    seen = (
        words.select("label", F.explode(F.array_distinct("words")).alias("word"))
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("seen"), F.sum("label").alias("toxic"))
        .filter((F.col("seen") >= at_least) & (apart <= neutral * error))
        .filter(~F.col("word").isin(list(known)))
        .orderBy(F.desc("seen"), "word")
        .limit(terms)
    )
    chosen = [r.word for r in seen.collect()]
    place = {word: k for k, word in enumerate(chosen)}
    pairs = words.select(F.explode(F.expr("arrays_zip(words, slice(words, 2, size(words))) AS p")).alias("p"))
    met = (
        pairs.select(F.col("p.words").alias("left"), F.col("p.1").alias("right"))
        .filter(F.col("left").isin(chosen) & F.col("right").isin(chosen))
        .groupBy("left", "right")
        .count()
    )
    table = np.zeros((len(chosen), 2 * len(chosen)))
    for left, right, count in met.collect():  # terms x terms rows at most
        table[place[left], place[right]] = count
        table[place[right], len(chosen) + place[left]] = count
    table = np.sqrt(table)
    near = table / np.maximum(np.linalg.norm(table, axis=1, keepdims=True), 1e-300)
    near = near @ near.T
    free, found = dict.fromkeys(range(len(chosen))), []
    for k in range(len(chosen)):
        if k in free:
            del free[k]
            fitting = sorted((o for o in free if near[k, o] >= alike), key=lambda o: (-near[k, o], o))[: size - 1]
            for other in fitting:
                del free[other]
            if fitting:
                found.append((chosen[k], *(chosen[o] for o in fitting)))
    return found


@dataclass(frozen=True)
class ToxicityModel:
    weights: dict[int, float]  # by the hash of a feature
    bias: float
    swaps: int = 0  # counterfactuals of the sample
    swap_change: float = 0.0  # by how much they change the log-odds, in the mean

    def log_odds(self, words: set[str], kept: Memo) -> float:
        named = set()
        for word in words:
            named.update(kept[word])
        return self.bias + sum(self.weights[f] for f in sorted(named))

    def remembered(self) -> Memo:
        """The features of words that have a weight."""
        known = self.weights
        return Memo(lambda word: [f for f in features_of(word) if f in known], 300_000)


def fit_rows(
    examples: Iterable[tuple[str, int]],
    groups: Sequence[Sequence[str]] = GROUPS,
    fairness: float = 10.0,
    l2: float = 1e-6,
    at_least: int = 4,
    clear: float = 3.5,
    rounds: int = 1000,
) -> ToxicityModel:
    """Fits on (text, label) pairs; labels are 0 and 1.

    A feature is kept if it is in ``at_least`` texts and its shares in both classes differ by
    ``clear`` standard errors.
    """
    # Of each text no more than its features is kept. Swaps are kept by what they change, and counted.
    told, labels = [], []
    terms = {term for group in groups for term in group}
    parts = {term: frozenset(features_of(term)) for term in terms}
    changes: Counter[tuple[frozenset[int], frozenset[int]]] = Counter()
    for text, label in examples:
        words = words_of(text)
        told.append(all_features(words))
        labels.append(label)
        if words & terms:
            holders = Counter(f for word in words for f in features_of(word))
            for term, other in counterfactuals(words, groups):
                gone = frozenset(f for f in parts[term] - parts[other] if holders[f] == 1)
                come = frozenset(f for f in parts[other] if f not in holders)
                changes[gone, come] += 1
    labels = np.array(labels, dtype=np.float64)
    if not len(labels) or labels.min() == labels.max():
        # Nothing to tell apart: the one label there is, or none.
        return ToxicityModel({}, 6.0 if len(labels) and labels[0] else -6.0)
    rows = np.repeat(np.arange(len(told), dtype=np.int32), [len(t) for t in told])
    known, place, seen = np.unique(np.concatenate(told), return_inverse=True, return_counts=True)
    del told
    seen_1 = np.bincount(place, labels[rows], minlength=len(known))
    sizes = (len(labels) - labels.sum(), labels.sum())
    share = seen / len(labels)
    error = np.sqrt(share * (1 - share) * (1 / sizes[0] + 1 / sizes[1]))
    apart = np.abs(seen_1 / sizes[1] - (seen - seen_1) / sizes[0])
    chosen = (seen >= at_least) & (apart >= clear * error) & (share < 1)
    identity = all_features(terms)
    kept = np.union1d(known[chosen], identity).tolist()
    number = {f: k for k, f in enumerate(kept)}
    new_place = np.array([number.get(f, -1) for f in known.tolist()], dtype=np.int64)[place]
    rows, columns = rows[new_place >= 0].astype(np.int64), new_place[new_place >= 0]
    del place, new_place
    swapped: list[tuple[int, int, float]] = []
    for pair, (gone, come) in enumerate(changes):
        swapped += [(pair, number[f], 1.0) for f in gone] + [(pair, number[f], -1.0) for f in come]
    pair, part, sign = (np.array(c) for c in zip(*swapped)) if swapped else (np.zeros(0, int),) * 3
    pairs, swaps = len(changes), sum(changes.values())
    often = np.array(list(changes.values()), dtype=np.float64) / max(swaps, 1)
    n, size = len(labels), len(kept)
    # Both classes weigh the same.
    weight = np.where(labels > 0, n / (2 * sizes[1]), n / (2 * sizes[0]))
    # The steepest curvature there is, by power iteration, sets the step.
    probe, steep = np.ones(size + 1), 1.0
    for _ in range(12):
        probe /= np.linalg.norm(probe)
        odds = (np.bincount(rows, probe[columns], minlength=n) + probe[-1]) * weight / (4 * n)
        bent = np.append(np.bincount(columns, odds[rows], minlength=size), odds.sum())
        bent[:-1] += 2 * l2 * probe[:-1]
        if pairs:
            apart = np.bincount(pair, sign * probe[part], minlength=pairs)
            bent[:-1] += 2 * fairness * np.bincount(part, sign * (often * apart)[pair], minlength=size)
        steep, probe = 1.3 * np.linalg.norm(bent), bent
    w, b = np.zeros(size), 0.0
    ahead_w, ahead_b, pace = w, b, 1.0
    for _ in range(rounds):
        odds = np.bincount(rows, ahead_w[columns], minlength=n) + ahead_b
        error = (1 / (1 + np.exp(-np.clip(odds, -40, 40))) - labels) * weight / n
        slope = np.bincount(columns, error[rows], minlength=size) + 2 * l2 * ahead_w
        if pairs:
            apart = np.bincount(pair, sign * ahead_w[part], minlength=pairs)
            slope += 2 * fairness * np.bincount(part, sign * (often * apart)[pair], minlength=size)
        new_w, new_b = ahead_w - slope / steep, ahead_b - error.sum() / steep
        new_pace = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        ahead_w = new_w + (pace - 1) / new_pace * (new_w - w)
        ahead_b = new_b + (pace - 1) / new_pace * (new_b - b)
        w, b, pace = new_w, new_b, new_pace
    odds = np.bincount(rows, w[columns], minlength=n) + b
    changed = float(often @ np.abs(np.bincount(pair, sign * w[part], minlength=pairs))) if pairs else 0.0
    return ToxicityModel({f: float(v) for f, v in zip(kept, w)}, float(b - _border(odds, labels)), swaps, changed)


def _border(odds: np.ndarray, labels: np.ndarray) -> float:
    """The log-odds that part the two classes best, in the middle of where they do."""
    order = np.argsort(odds, kind="stable")
    ones = labels[order]
    # Cutting before place k: the share of 1 below it and the share of 0 above it are wrong.
    below = np.concatenate(([0.0], np.cumsum(ones) / ones.sum()))
    above = np.concatenate(([1.0], 1 - np.cumsum(1 - ones) / (1 - ones).sum()))
    wrong = np.round(below + above, 12)
    best = np.flatnonzero(wrong == wrong.min())
    ends = np.concatenate(([odds.min() - 1], odds[order], [odds.max() + 1]))
    widest = best[np.argmax(ends[best + 1] - ends[best])]
    return float((ends[widest] + ends[widest + 1]) / 2)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column,
    sample: int = 5000,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    groups: Sequence[Sequence[str]] = GROUPS,
    terms: int = 100,
    **options,
) -> ToxicityModel:
    """Fits on ``sample`` rows at most: those labelled 0 or 1 where ``learn`` (of the labels'
    columns) holds, with the smallest hashed ids. A document labelled both ways counts as 1.
    To ``groups`` come the sets that ``learned_groups`` finds among the sample's ``terms`` words."""
    labelled = (
        labels.filter(learn & F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("__id"))
        .agg(F.max(label_col).cast("int").alias("__label"))
    )
    chosen = labelled.orderBy(F.xxhash64("__id"), "__id").limit(sample)
    # ``sample`` rows of an id and a label: small enough to go to every task.
    rows = docs.join(F.broadcast(chosen), F.col(id_col) == F.col("__id")).select(
        F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.col("__label").alias("label")
    )
    rows = written(rows, "toxicity-sample")
    learned = learned_groups(rows, terms, known={term for group in groups for term in group})
    return fit_rows(((r[0], r[1]) for r in rows.toLocalIterator()), [*groups, *learned], **options)


def _log_odds(model: ToxicityModel, kept: Memo, batch: list[str]) -> np.ndarray:
    odds = []
    for text in batch:
        words = words_of(text)
        odds.append(model.log_odds(words, kept))
        kept.age(words)
    return np.clip(np.array(odds, dtype=np.float64), -40, 40)


def without_toxic(docs: DataFrame, model: ToxicityModel, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, in all their columns, whose whole text is not predicted to be toxic.
    Each row is judged by itself; a null text counts as empty."""
    told = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = told.value
        kept = model.remembered()
        for batch in batches:
            for part in in_pieces(batch):
                texts = [t or "" for t in part.column(text_col).to_pylist()]
                yield part.filter(pa.array(_log_odds(model, kept, texts) < 0))

    return docs.mapInArrow(run, docs.schema)


def score(
    docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, score (0 to 1) and predicted (score of 0.5 or more) of every row of ``docs``.

    Only the whole text counts; null, empty and wordless texts get what the model says of a text
    without features. Repeated rows get equal scores, null ids are carried along, an empty table
    gives no rows, and other columns play no part.
    """
    source = texts(docs, id_col, text_col)
    told = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the sample

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = told.value
        kept = model.remembered()
        for batch in batches:
            for part in in_pieces(batch):
                scores = 1 / (1 + np.exp(-_log_odds(model, kept, part.column("text").to_pylist())))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))],
                    ["doc_id", "score", "predicted"],
                )

    return source.mapInArrow(run, f"doc_id {source.dtypes[0][1]}, score double, predicted int")
