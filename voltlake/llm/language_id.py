"""Language identification in two steps: the family first, then the language within it.

Families are told apart by one linear model each; the languages of the chosen family by linear
support vector machines for each pair of them, whose votes (and, between equal votes, margins)
decide. All models read the same features, the hashed byte 1- to 4-grams of the whole text, each
weighted by its share of the text. They are fitted on a bounded sample of labelled rows
(``sample`` documents of each language), whole and in passages, so that short texts are known too.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltlake.llm.common import texts, written
from voltlake.llm.features import byte_grams
from voltlake.llm.rank_bpe import in_pieces

# Well-known families of languages, by language code.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "bg", "sr", "hr", "sl", "mk"),
    "uralic": ("fi", "et", "hu"),
    "turkic": ("tr", "az", "kk", "uz"),
    "indo-aryan": ("hi", "ur", "bn", "mr", "gu", "pa", "ne"),
    "semitic": ("ar", "he", "am", "mt"),
}
BITS = 18
UNKNOWN = "und"


def family_of(lang: str, families: Mapping[str, tuple[str, ...]] = FAMILIES) -> str:
    """The family of a language; one that is not listed is a family of its own."""
    return next((name for name, members in families.items() if lang in members), lang)


@dataclass(frozen=True)
class LanguageModel:
    families: list[str]
    members: list[list[str]]  # languages of each family
    pairs: list[tuple[str, str]]  # languages each machine tells apart
    weights: np.ndarray  # (features, families + pairs)
    bias: np.ndarray

    def margins(self, batch: list[str]) -> np.ndarray:
        grams, starts = byte_grams(batch, BITS)
        summed = np.zeros((len(batch), self.weights.shape[1]))
        totals = np.maximum(np.diff(starts), 1)[:, None]
        for column in range(self.weights.shape[1]):
            own = self.weights[:, column]
            at_place = own[grams[:, 0]]
            for n in range(1, grams.shape[1]):
                at_place += own[grams[:, n]]
            running = np.concatenate(([0.0], np.cumsum(at_place, dtype=np.float64)))
            summed[:, column] = running[starts[1:]] - running[starts[:-1]]
        return summed / totals + self.bias

    def predict(self, batch: list[str]) -> tuple[list[str], list[float]]:
        """A language and a score from 0 to 1 for each text."""
        margins = self.margins(batch)
        chosen = margins[:, : len(self.families)].argmax(axis=1)
        place = {pair: len(self.families) + k for k, pair in enumerate(self.pairs)}
        langs, scores = [], []
        for row, family in zip(margins, chosen):
            members, ahead = self.members[family], 4.0
            best = members[0]
            if len(self.families) > 1:
                ordered = np.sort(row[: len(self.families)])
                ahead = ordered[-1] - ordered[-2]
            if len(members) > 1:
                votes = dict.fromkeys(members, 0.0)
                sure = dict.fromkeys(members, np.inf)
                for first, second in combinations(members, 2):
                    margin = row[place[first, second]]
                    won, lost = (first, second) if margin >= 0 else (second, first)
                    votes[won] += 1 + min(abs(margin), 100) / 1e4
                    sure[won] = min(sure[won], abs(margin))
                best = max(members, key=lambda m: votes[m])
                ahead = min(ahead, sure[best])
            langs.append(best)
            scores.append(float(1 / (1 + np.exp(-2.0 * min(ahead, 50.0)))))
        return langs, scores


def _linear_svm(shares, wanted: np.ndarray, rounds: int = 60, strength: float = 1e-4) -> tuple:
    """Squared hinge loss with an L2 penalty, by accelerated gradient steps."""
    rows, features, values, size = shares
    n = len(wanted)
    weight = n / (2.0 * np.where(wanted > 0, (wanted > 0).sum(), (wanted < 0).sum()))
    w, b = np.zeros(size), 0.0
    seen_w, seen_b, pace = w, b, 1.0
    norms = np.bincount(rows, values**2, minlength=n) + 1.0
    step = 1.0 / (2.0 * (weight * norms).mean() + strength)
    for _ in range(rounds):
        margin = np.bincount(rows, values * seen_w[features], minlength=n) + seen_b
        miss = np.maximum(0.0, 1.0 - wanted * margin) * weight
        pull = -2.0 * wanted * miss / n
        new_w = seen_w - step * (np.bincount(features, values * pull[rows], minlength=size) + strength * seen_w)
        new_b = seen_b - step * pull.sum()
        new_pace = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        seen_w = new_w + (pace - 1) / new_pace * (new_w - w)
        seen_b = new_b + (pace - 1) / new_pace * (new_b - b)
        w, b, pace = new_w, new_b, new_pace
    return w, b


def _passages(text: str, size: int = 60) -> list[str]:
    """The whole text, and four passages of it if it is longer than that."""
    found = [text]
    if len(text) > 2 * size:
        for k in range(4):
            start = (len(text) - size) * k // 3
            found.append(text[start : start + size >> (k % 2)] if k % 2 else text[start : start + size])
    return found


def fit_rows(
    examples: Iterable[tuple[str, str]], families: Mapping[str, tuple[str, ...]] = FAMILIES
) -> LanguageModel:
    """Fits all machines on (text, language) pairs, which must hold one language at least."""
    cut = [(p, lang) for text, lang in sorted(examples) for p in _passages(text) if p.strip()]
    # One text after the other, so that no more than its distinct grams are kept of each.
    kept = [np.unique(byte_grams([t], BITS)[0], return_counts=True) for t, _ in cut]
    sizes = np.array([len(f) for f, _ in kept])
    rows = np.repeat(np.arange(len(cut), dtype=np.int32), sizes)
    features = np.concatenate([f for f, _ in kept]).astype(np.int32)
    values = np.concatenate([c / c.sum() for _, c in kept]).astype(np.float32) * 4
    del kept
    # Scaled so that a text's feature vector has a length of about one.
    length = np.sqrt(np.bincount(rows, values**2, minlength=len(cut)))
    scale = 1.0 / max(float(np.median(length)), 1e-9)
    langs = np.array([lang for _, lang in cut], dtype=object)
    known = sorted(set(langs))
    family = {lang: family_of(lang, families) for lang in known}
    of_row = np.array([family[lang] for lang in langs], dtype=object)
    names = sorted(set(family.values()))
    members = [[lang for lang in known if family[lang] == name] for name in names]
    pairs = [pair for group in members for pair in combinations(group, 2)]

    def machine(selected: np.ndarray, positive: np.ndarray):
        number = np.cumsum(selected) - 1
        inside = selected[rows]
        part = number[rows[inside]], features[inside], values[inside] * scale, 1 << BITS
        return _linear_svm(part, np.where(positive[selected], 1.0, -1.0))

    everything = np.ones(len(cut), dtype=bool)
    found = [
        machine(everything, of_row == name) if len(names) > 1 else (np.zeros(1 << BITS), 0.0)
        for name in names
    ]
    for first, second in pairs:
        found.append(machine((langs == first) | (langs == second), langs == first))
    weights = np.stack([w * scale for w, _ in found], axis=1).astype(np.float32)
    return LanguageModel(names, members, pairs, np.asfortranarray(weights), np.array([b for _, b in found]))


def fit(
    docs: DataFrame,
    learn: Column,
    sample: int = 300,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    families: Mapping[str, tuple[str, ...]] = FAMILIES,
) -> LanguageModel | None:
    """Fits on ``sample`` documents of each language at most, those with the smallest hashed ids
    among the rows where ``learn`` holds and text and language are not null; None without any.

    Ids are ranked without their texts, which are fetched for the chosen ones alone. Rows that repeat id and
    text are learned from once.
    """
    labelled = docs.filter(learn).select(
        F.xxhash64(id_col).alias("place"),
        F.col(text_col).alias("text"),
        F.col(lang_col).alias("lang"),
    )
    labelled = labelled.filter("text IS NOT NULL AND lang IS NOT NULL AND text RLIKE '\\\\p{L}'")
    labelled = labelled.withColumn("mark", F.xxhash64("text"))
    key = ["lang", "place", "mark"]
    first = Window.partitionBy("lang").orderBy("place", "mark")
    ranked = labelled.select(*key).withColumn("number", F.row_number().over(first))
    chosen = written(ranked.filter(F.col("number") <= sample).select(*key).distinct(), "language-sample")
    fetched = labelled.join(chosen, key, "left_semi").dropDuplicates(key)
    examples = [(r.text, r.lang) for r in fetched.select("text", "lang").toLocalIterator()]
    return fit_rows(examples, families) if examples else None


def identify(
    docs: DataFrame, model: LanguageModel | None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, lang_pred and score (0 to 1) for every row of ``docs``, from its whole text alone.

    A null text, or one without any letter, is ``und`` with score 0, and so is every text if
    there was nothing to learn from. Repeated rows get equal results, null ids are carried along,
    an empty table gives no rows, and other columns play no part.
    """
    source = texts(docs, id_col, text_col)
    told = docs.sparkSession.sparkContext.broadcast(model)  # its size is fixed by BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = told.value
        for batch in batches:
            for part in in_pieces(batch, 2 << 20):
                whole = part.column("text").to_pylist()
                places = [k for k, t in enumerate(whole) if model and any(map(str.isalpha, t))]
                langs, scores = [UNKNOWN] * len(whole), [0.0] * len(whole)
                if places:
                    found = model.predict([whole[k] for k in places])
                    for k, lang, score in zip(places, *found):
                        langs[k], scores[k] = lang, score
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(langs), pa.array(scores)],
                    ["doc_id", "lang_pred", "score"],
                )

    return source.mapInArrow(run, f"doc_id {source.dtypes[0][1]}, lang_pred string, score double")
