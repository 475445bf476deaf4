"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on ordinary text and one on what toxic
text has in excess of it. A window is a word between its blanks (cut at
`WINDOW` bytes); its distance is how many bytes shorter the toxic dictionary makes
it, as a share of its bytes. Phrases are windows of `SPAN` bytes over the whole text, each
half over the next, under dictionaries trained on the ordinary and the toxic texts as they are: they
see ordinary words in toxic order, words without blanks, and words too rare for the cut. The largest
distances of a text and how many pass thresholds are calibrated to a score on labelled rows that the dictionaries have not seen.

Fitting reads a bounded sample of labelled rows (`SAMPLE`, `SAMPLE_CHARS`). Scoring
reads whole texts.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Callable, Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobloom.llm.common import settle, ship

#: Labelled rows read to fit, at most: ordinary and toxic, in the order of a hash of the id; and the longest text among them.
SAMPLE = (4000, 2000)
SAMPLE_CHARS = 20_000
THRESHOLD = 0.7
WINDOW = 48
LEVEL, DICTIONARY = 9, (32_768, 16_384)
#: Phrases are compressed at a lower level: on the two halves of the fitting rows it loses nothing and takes two thirds of the time.
PHRASE_LEVEL = 3
#: Windows kept with their distance in a worker, about.
STORE = 500_000
#: Excess of toxic text: a window with that many different windows before it, and so many times the ordinary share of them.
CONTEXTS, EXCESS = (3, 0.004), 16
NEAR = (0.4, 0.3)
#: Bytes of a phrase window and from one to the next, size of each phrase dictionary, and the distance of a near phrase.
SPAN, STEP, PHRASES, NEAR_PHRASE = 80, 40, 8192, 0.1
_PUNCTUATION = bytes(x for x in b'.,;:!?"|()')
#: Both dictionaries end with HEAD. A window is compressed as HEAD + window + TAIL: one match then pays for the frame,
#: and the window ends before the last bytes, in which the library seeks no match.
HEAD, TAIL = bytes([*range(1, 9), 11, 12, *range(14, 28)]), b"[]{}~^_@#%"


def windows(text: str) -> list[bytes]:
    """The words of a text in lower case with a blank on either side, without punctuation; long ones in pieces."""
    out = []
    for word in text.encode("utf-8", "surrogatepass").lower().translate(None, _PUNCTUATION).split():
        if len(word) > WINDOW:
            out += [b" " + word[i : i + WINDOW] + b" " for i in range(0, len(word), WINDOW)]
        else:
            out.append(b" " + word + b" ")
    return out


def stream(text: str) -> bytes:
    """The words of a text as `windows` has them, joined; long ones whole."""
    return b" " + b"  ".join(text.encode("utf-8", "surrogatepass").lower().translate(None, _PUNCTUATION).split()) + b" "


def _contexts(texts: Iterable[list[bytes]], only: set[bytes] | None = None) -> Counter:
    """In how many surroundings (different windows before it) each window is seen; copies of a text add none."""
    before = defaultdict(set)
    for row in texts:
        for last, word in zip([b""] + row, row, strict=False):
            if only is None or word in only:
                before[word].add(last)
    return Counter({w: len(x) for w, x in before.items()})


def _trained(size: int, samples: list[bytes]) -> bytes:
    """A dictionary trained on `samples`; where they are too few to train on, the samples themselves."""
    samples = [x for x in samples if len(x) >= 8]
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(dict.fromkeys(samples))[-size:]


def train(ordinary: list[list[bytes]], toxic: list[list[bytes]]) -> tuple[bytes, bytes]:
    """The ordinary and the toxic dictionary from texts as lists of windows."""
    least = max(CONTEXTS[0], CONTEXTS[1] * len(toxic))
    seen = {w: n for w, n in _contexts(toxic).items() if n >= least}
    common = _contexts(ordinary, set(seen))
    over = {w for w, n in seen.items() if (n + 0.5) / (len(toxic) + 1) > EXCESS * (common[w] + 0.5) / (len(ordinary) + 1)}
    plain = _trained(DICTIONARY[0], [b"".join(row) for row in ordinary])
    return plain, _trained(DICTIONARY[1], [b"".join(w for w in row if w in over) for row in toxic])


def train_phrases(ordinary: Iterable[str], toxic: Iterable[str]) -> tuple[bytes, bytes]:
    """The ordinary and the toxic dictionary of whole texts, of one size."""
    return _trained(PHRASES, list(map(stream, ordinary))), _trained(PHRASES, list(map(stream, toxic)))


class Distance:
    """Distances of windows and phrases for two pairs of dictionaries; distances of windows met before are kept, up to a bound."""

    def __init__(self, plain: bytes, toxic: bytes, phrases: tuple[bytes, bytes]):
        self.plain, self.toxic = self._compressor(plain), self._compressor(toxic)
        self.plain_phrase, self.toxic_phrase = (self._compressor(x, SPAN, PHRASE_LEVEL) for x in phrases)
        self.store: dict[bytes, float] = {}

    @staticmethod
    def _compressor(content: bytes, most: int = WINDOW, level: int = LEVEL) -> Callable[[bytes], bytes]:
        made = zstandard.ZstdCompressionParameters.from_level(
            level, dict_size=len(content), source_size=most, min_match=4, write_checksum=False, write_content_size=False,
            write_dict_id=False, format=zstandard.FORMAT_ZSTD1_MAGICLESS)
        held = zstandard.ZstdCompressionDict(content + HEAD, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        held.precompute_compress(compression_params=made)
        return zstandard.ZstdCompressor(dict_data=held, compression_params=made).compress

    def phrase_features(self, text: str) -> list[float]:
        """The largest distance of a phrase, the mean of the three largest and of all, and how many are near, plainly and as a share."""
        whole = stream(text)
        pieces = [HEAD + whole[i : i + SPAN] + TAIL for i in range(0, max(1, len(whole) - STEP), STEP)]
        all_of = np.sort([len(self.plain_phrase(x)) - len(self.toxic_phrase(x)) for x in pieces])[::-1] / SPAN
        near = (all_of >= NEAR_PHRASE).sum()
        return [all_of[0], all_of[:3].mean(), all_of.mean(), np.log1p(near), np.log1p(100 * near / len(all_of))]

    def features(self, text: str) -> list[float]:
        """The three largest distances (the third as their mean), and how many are near, plainly and as a share; then those of phrases."""
        if len(self.store) > STORE:
            self.store.clear()
        store, words = self.store, windows(text)
        if not words:
            return [0.0] * 11
        found = list(map(store.get, words))
        if None in found:
            for k, value in enumerate(found):
                if value is None:
                    word = words[k]
                    value = store.get(word)
                    if value is None:
                        whole = HEAD + word + TAIL
                        value = store[word] = (len(self.plain(whole)) - len(self.toxic(whole))) / len(word)
                    found[k] = value
        all_of = np.array(found)
        top = np.zeros(3)
        largest = np.sort(np.partition(all_of, -min(3, len(all_of)))[-3:])[::-1]
        top[: len(largest)] = largest
        near, less = ((all_of >= x).sum() for x in NEAR)
        return [top[0], top[1], top[: len(largest)].mean(), np.log1p(near), np.log1p(less), np.log1p(100 * near / len(all_of)), *self.phrase_features(text)]


@dataclass(frozen=True)
class Model:
    """Dictionaries, and the calibration: means, spreads and weights of the features, the weight of 1 last."""

    plain: bytes
    toxic: bytes
    phrases: tuple[bytes, bytes]
    means: tuple[float, ...]
    spreads: tuple[float, ...]
    weights: tuple[float, ...]

    def scorer(self) -> Callable[[str], float]:
        distance = Distance(self.plain, self.toxic, self.phrases)
        means, spreads, weights = map(np.array, (self.means, self.spreads, self.weights))

        def score(text: str) -> float:
            z = float(((np.array(distance.features(text)) - means) / spreads) @ weights[:-1] + weights[-1])
            return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))

        return score


def _calibrate(rows: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ridge logistic regression by Newton steps on standardised features."""
    means, spreads = rows.mean(axis=0), rows.std(axis=0) + 1e-9
    x = np.column_stack([(rows - means) / spreads, np.ones(len(rows))])
    ridge = np.diag([1.0] * rows.shape[1] + [1e-6])
    weights = np.zeros(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (labels - p) - ridge @ weights
        weights = weights + np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, slope)
    return means, spreads, weights


def fit_texts(rows: list[tuple[int | None, str, int]]) -> Model | float:
    """A model from (id, text, label); where a class is missing, the share of toxic rows as the score of every text.

    Rows are dealt to two halves by their id. The dictionaries of one half give the
    features of the other, on which the calibration is fitted; the model's
    dictionaries are trained on both.
    """
    known: dict[bytes, bytes] = {}
    cut = [(zlib.crc32(f"half {i}".encode()) % 2, [known.setdefault(w, w) for w in windows(t)], t, y) for i, t, y in rows]
    halves = [[x for x in cut if x[0] == h] for h in (0, 1)]
    if any(not any(x[3] == y for x in half) for half in halves for y in (0, 1)):
        return sum(y for _, _, _, y in cut) / max(1, len(cut))

    def trained(some: list) -> tuple[bytes, bytes, tuple[bytes, bytes]]:
        words, raw = ([[x[k] for x in some if bool(x[3]) == toxic] for toxic in (False, True)] for k in (1, 2))
        return *train(*words), train_phrases(*raw)

    features, labels = [], []
    for one, other in (halves, halves[::-1]):
        distance = Distance(*trained(one))
        features += [distance.features(x[2]) for x in other]
        labels += [x[3] for x in other]
    means, spreads, weights = _calibrate(np.array(features), np.array(labels, float))
    return Model(*trained(cut), tuple(means), tuple(spreads), tuple(weights))


def held_out(doc_id: Column) -> Column:
    """Rows never learnt from: crc32 of the id as text leaves 1 when divided by 3; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model | float:
    """Fit on labelled rows that are not held out: at most `SAMPLE` of each class with at most `SAMPLE_CHARS` characters.

    The ids are drawn first, in the order of a hash, so that only the texts they name reach the driver: `sum(SAMPLE)` rows at
    most. Where ids repeat, so that there are more, the first of them in that order count.
    """
    spark = docs.sparkSession
    ship(spark)
    marked = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label")).where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("doc_id")))
    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).where(F.length("text") <= SAMPLE_CHARS)
    sized = settle(spark, read.select("doc_id").join(marked, "doc_id"), "labelled")
    drawn = []
    for label, most in enumerate(SAMPLE):
        ids = sized.where(F.col("label") == label).groupBy("doc_id").agg(F.lit(label).alias("label"))
        drawn += ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).collect()
    if not drawn:
        return 0.0
    named = F.broadcast(spark.createDataFrame([tuple(r) for r in drawn], "doc_id long, label int"))
    texts = read.join(named, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", "label", "text").limit(sum(SAMPLE))
    return fit_texts([tuple(r) for r in texts.select("doc_id", "text", "label").collect()])


def score(text: Column, model: Model | float) -> Column:
    """Score of a text column from 0 to 1; null and empty texts get the score of a text without windows."""
    if not isinstance(model, Model):
        return F.lit(float(model))
    kept: list[Callable[[str], float]] = []

    @F.arrow_udf("double")
    def run(texts: pa.Array) -> pa.Array:
        if not kept:
            kept.append(model.scorer())
        return pa.array([kept[0](x or "") for x in texts.to_pylist()], pa.float64())

    return run(text)


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted: a row per document, repeated rows and null ids too; no rows from no documents.

    Labels are read only to fit, and only those of rows that are not held out. Equal
    texts get equal scores. Without labels of both classes every score is the share of toxic labels (0 without any).
    """
    value = score(F.col(text_col).cast("string"), fit(docs, labels, id_col, text_col))
    scored = docs.select(F.col(id_col).cast("long").alias("doc_id"), value.alias("score"))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
