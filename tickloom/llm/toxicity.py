"""Toxicity by a weighted lexicon.

A text is folded (lower case, look-alike letters of other scripts, digits and signs written for letters) and matched
against words and word beginnings by an Aho-Corasick automaton. A word counts with its heaviest entry, unless it lies in
an exception phrase. The sum of weights, alone and by length, goes through a logistic curve to a score from 0 to 1.

Weights are log-odds of an entry between labelled toxic and clean texts, less two standard errors; the curve is fitted
on labelled rows that the weights have not seen. Both use a sample of the labelled rows of bounded size.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

from tickloom.llm.common import id_and_text, unused

THRESHOLD = 0.3
SAMPLE = 20_000  # labelled rows that the lexicon and the curve are fitted on, about
STEMS = (4, 5, 6)  # letters of the word beginnings that are tried besides whole words
LEAST_TOXIC = 3  # toxic texts that an entry must be in
LEAST_WEIGHT = 1.0

# ---- fixed values -----------------------------------------------------------------------------------------------
SEEDS = (
    "idiot", "moron", "stupid", "loser", "scum", "trash", "pathetic", "worthless", "disgusting", "clown", "imbecile",
    "dumb", "retard", "filth", "vermin", "bastard", "bitch", "asshole", "jerk", "pig", "degenerate", "parasite",
)
SEED_WEIGHT = 2.0
EXCEPTIONS = (
    "trash can", "trash bin", "trash bag", "clown fish", "guinea pig", "pig iron", "class clown", "circus clown",
    "dumb waiter", "dumb terminal", "knee jerk", "jerk chicken", "host parasite",
)
_ALIKE = {
    "а": "a", "в": "b", "е": "e", "ё": "e", "і": "i", "ї": "i", "ј": "j", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p",
    "с": "c", "т": "t", "у": "y", "х": "x", "ѕ": "s", "ԁ": "d", "α": "a", "β": "b", "ε": "e", "ι": "i", "κ": "k", "ν": "v",
    "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ł": "l", "ø": "o",
}
_WRITTEN_FOR = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "|": "l"}
_BREAKS = "\t\n\v\f\r\"#%&'()*+,-./:;<=>?[\\]^_`{}~\x85\xa0«»“”„‘’‚‹›–—…·¡¿•"
# ------------------------------------------------------------------------------------------------------------------

_FOLD = str.maketrans(_ALIKE | _WRITTEN_FOR | dict.fromkeys(_BREAKS, " "))


def fold(text: str) -> str:
    """Folded words with a space around each. Letters come without accents and marks, and without characters that are
    not seen; compatibility forms (full-width, mathematical, roman numerals) come as plain letters."""
    if text.isascii():
        lowered = text.lower()
    else:
        lowered = _UNSEEN.sub("", unicodedata.normalize("NFKD", text).lower())
    # an exclamation mark after a word ends it; inside one it stands for a letter
    return " " + " ".join(word.rstrip("!|").translate(_FOLD).strip() for word in lowered.split()) + " "


_UNSEEN = regex.compile(r"[\p{Mn}\p{Me}\p{Cf}]+")


def entries_of(folded: str) -> set[str]:
    """What may become an entry: whole words (a space on both sides) and word beginnings (a space before)."""
    words = set(folded.split())
    found = {f" {word} " for word in words}
    for length in STEMS:
        found.update([" " + word[:length] for word in words if len(word) > length])
    return found


@dataclass(frozen=True)
class Model:
    """Entries with their weights, and the curve over (1, log of the sum, log of the sum by length)."""

    entries: tuple[tuple[str, float], ...]
    curve: tuple[float, float, float]
    exceptions: tuple[str, ...] = EXCEPTIONS
    _built: list = field(default_factory=list, compare=False, hash=False, repr=False)

    def __getstate__(self):
        return (self.entries, self.curve, self.exceptions)

    def __setstate__(self, state):
        for name, value in zip(("entries", "curve", "exceptions", "_built"), (*state, [])):
            object.__setattr__(self, name, value)

    def _automaton(self):
        if not self._built:
            import ahocorasick

            automaton = ahocorasick.Automaton()
            for entry, weight in self.entries:
                automaton.add_word(entry, (len(entry), weight))
            for phrase in self.exceptions:
                automaton.add_word(f" {phrase} ", (len(phrase) + 2, None))
            automaton.make_automaton()
            self._built.append(automaton)
        return self._built[0]

    def match(self, text: str) -> tuple[float, int]:
        """The sum of weights and the number of words."""
        folded = fold(text)
        found: dict[int, float] = {}
        excepted: list[tuple[int, int]] = []
        for end, (length, weight) in self._automaton().iter(folded):
            start = end - length + 1
            if weight is None:
                excepted.append((start, end))
            elif weight > found.get(start, 0.0):
                found[start] = weight
        total, reach, spans = 0.0, -1, iter(sorted(excepted))
        start, end = next(spans, (len(folded), 0))
        for at in sorted(found) if excepted else found:
            while start <= at:  # one sweep: the farthest end of the phrases that begin up to here
                reach = max(reach, end)
                start, end = next(spans, (len(folded), 0))
            if at >= reach:
                total += found[at]
        return total, len(folded.split())

    def score(self, text: str) -> float:
        return float(curve_of(np.array([features(*self.match(text))]), np.array(self.curve))[0])


def features(total: float, words: int) -> tuple[float, float, float]:
    return 1.0, float(np.log1p(total)), float(np.log1p(1000.0 * total / (words + 50)))


def curve_of(rows: np.ndarray, coefficients: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(rows @ coefficients, -30, 30)))


def fit_curve(rows: np.ndarray, toxic: np.ndarray, ridge: float = 0.1) -> tuple[float, ...]:
    """Logistic regression by Newton steps with a small penalty on all but the constant."""
    coefficients = np.zeros(rows.shape[1])
    penalty = ridge * np.diag([0.001] + [1.0] * (rows.shape[1] - 1))
    for _ in range(50):
        p = curve_of(rows, coefficients)
        slope = rows.T @ (toxic - p) - penalty @ coefficients
        step = np.linalg.solve(rows.T @ (rows * (p * (1 - p))[:, None]) + penalty, slope)
        coefficients = coefficients + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return tuple(coefficients.tolist())


def weights(counts: Iterable[tuple[str, int, int]], toxic: int, clean: int) -> tuple[tuple[str, float], ...]:
    """Log-odds less two standard errors, of entries that stay above the least weight; seeds keep a weight anyway."""
    found = {f" {word} ": SEED_WEIGHT for word in SEEDS}
    for entry, in_toxic, in_clean in counts:
        a, b = in_toxic + 0.5, in_clean + 0.5
        weight = np.log(a / (toxic + 1)) - np.log(b / (clean + 1)) - 2 * np.sqrt(1 / a + 1 / b)
        if in_toxic >= LEAST_TOXIC and weight >= LEAST_WEIGHT:
            found[entry] = float(weight)
        elif entry in found and in_clean > in_toxic:
            del found[entry]
    return tuple(sorted(found.items(), key=lambda x: (-x[1], x[0])))


DEFAULT_CURVE = (-3.0, 1.0, 0.5)  # where too few labels are there to fit one


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt from."""
    remainder = F.crc32(doc_id.cast("string").cast("binary")) % 4
    return F.coalesce(remainder == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from labelled rows that are not held out; about ``sample`` of them, chosen by a hash of their doc_id.

    Labels other than 0 and 1 are no labels; of several labels of a doc_id the toxic one counts, and all texts of a
    doc_id are labelled alike. Three quarters of the sample make the weights: entries are counted in the tasks, summed in
    a shuffle, and those over the least weight come back, all of them: their number is bounded by the sample. The last
    quarter makes the curve. Texts count whole, whatever their length, empty ones with no words; with too few labels the
    seeds and a stated curve are the model.
    """
    usable = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    usable = usable.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    spread = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 20))
    share = min(1.0, sample / max(1, usable.count()))
    chosen = usable.where(spread < int(share * (1 << 20))).withColumn("part", F.pmod(F.shiftright(spread, 3), F.lit(4)))
    # at most about ``sample`` small rows
    labelled = id_and_text(docs).join(F.broadcast(chosen), "doc_id")

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums: tuple[Counter, Counter] = (Counter(), Counter())
            for text, toxic in zip(batch.column("text"), batch.column("toxic").to_pylist()):
                sums[toxic].update(entries_of(fold(text.as_py())))
            # an entry that no toxic text of a batch holds is still counted, since others may hold it
            names = list(sums[0].keys() | sums[1].keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), *(pa.array([sums[t][n] for n in names], pa.int64()) for t in (1, 0))],
                ["entry", "in_toxic", "in_clean"],
            )

    first = labelled.where("part > 0").select("text", "toxic")
    sizes = {row.toxic: row["count"] for row in chosen.where("part > 0").groupBy("toxic").count().collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    summed = (
        first.mapInArrow(count, "entry string, in_toxic long, in_clean long")
        .groupBy("entry")
        .agg(F.sum("in_toxic").alias("in_toxic"), F.sum("in_clean").alias("in_clean"))
    )
    odds = F.log((F.col("in_toxic") + 0.5) / (toxic + 1)) - F.log((F.col("in_clean") + 0.5) / (clean + 1))
    error = F.sqrt(1 / (F.col("in_toxic") + 0.5) + 1 / (F.col("in_clean") + 0.5))
    heavy = odds - 2 * error >= LEAST_WEIGHT - 1e-9  # ``weights`` decides, this only spares the driver the rest
    worth = (F.col("in_toxic") >= LEAST_TOXIC) & heavy | F.col("entry").isin([f" {word} " for word in SEEDS])
    model = Model(weights([tuple(row) for row in summed.where(worth).collect()], toxic, clean), DEFAULT_CURVE)

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.match(text.as_py()) for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([total for total, _ in found], pa.float64()),
                    pa.array([words for _, words in found], pa.int64()),
                    batch.column("toxic"),
                ],
                ["total", "words", "toxic"],
            )

    rest = labelled.where("part = 0").select("text", "toxic")
    rows = rest.mapInArrow(measure, "total double, words long, toxic int").collect()  # a quarter of the sample
    y = np.array([row.toxic for row in rows], np.float64)
    if len(y) < 20 or y.min() == y.max():
        return model
    x = np.array([features(row.total, row.words) for row in rows])
    return Model(model.entries, fit_curve(x, y))


def score(docs: DataFrame, model: Model, columns: Sequence[str] = ("doc_id",), name: str = "score") -> DataFrame:
    """``columns`` of every row and its score under ``name``. Narrow. A null text is an empty one, which has a score too."""
    text = unused(docs, "scored_text")
    kept = docs.select(*columns, F.col("text").alias(text))
    schema = kept.drop(text).schema.add(name, "double")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [model.score(x.as_py() or "") for x in batch.column(text)]
            others = [other for other in batch.schema.names if other != text]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(other) for other in others), pa.array(scores, pa.float64())], [*others, name]
            )

    return kept.mapInArrow(run, schema)


def detect(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, sample: int = SAMPLE) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted (1 from ``threshold`` on).

    Equal texts have equal scores, rows that repeat repeat. A null text is an empty one; empty texts, and such without
    words, have the score of a sum of zero. Texts are scored whole, in time that grows with their length. No rows give
    no rows; without labels the seeds alone decide.
    """
    scored = score(docs, fit(docs, labels, sample))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, sample: int = SAMPLE) -> DataFrame:
    """Rows of ``docs``, with all their columns, whose score is below the threshold."""
    name = unused(docs, "score")
    scored = score(docs, fit(docs, labels, sample), docs.columns, name)
    return scored.where(F.col(name) < threshold).select(*docs.columns)
