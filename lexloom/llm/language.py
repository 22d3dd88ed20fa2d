"""Language identification with a string kernel.

Two texts are compared by the character n-grams of several lengths that both contain (a blended
spectrum kernel on presence), divided by the geometric mean of how many each contains. A few labelled
texts serve as landmarks: the kernel between them gives the Nyström map, in which kernel ridge
regression is plain ridge regression, one column for each language against the rest. A text is
scored by its kernel values with the landmarks, a batch of texts at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

LENGTHS = (1, 2, 3, 4)  # of the n-grams
#: Bounds of the fitted sample: languages learned (the most frequent ones), labelled texts in all, landmarks
#: among them, and the longest text that may be one of them. Scoring has no such bounds.
LANGUAGES = 64
SAMPLE_ROWS = 1024
LANDMARKS = 96
SAMPLE_CHARS = 4096
RIDGE = 1e-3  # for each row of the sample
FOLDS = 5
UNKNOWN = "und"

CHUNK = 1 << 20  # characters of a long text at once
BATCH = 256  # texts scored by one matrix product
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SPREAD = np.uint64(0xD6E8FEB86659FD93)
_PLAIN = np.array([c if chr(c).isalpha() else 32 for c in range(0x300)], np.uint32)  # other signs are spaces


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def _chunk_grams(text: str) -> np.ndarray:
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.where(codes < len(_PLAIN), _PLAIN[np.minimum(codes, len(_PLAIN) - 1)], codes)
    mixed = (codes.astype(np.uint64) + np.uint64(1)) * _SPREAD
    mixed ^= mixed >> np.uint64(29)
    rolling, found = np.zeros(len(mixed) + 1, np.uint64), []
    for n in range(1, max(LENGTHS) + 1):
        if len(mixed) < n:
            break
        rolling = rolling[:-1] * _BASE + mixed[n - 1 :]
        if n in LENGTHS:
            found.append(rolling * _SPREAD + np.uint64(n))
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.uint64)


def grams(text: str) -> np.ndarray:
    """The distinct n-grams of a whole text as sorted 64-bit hashes (equal hashes count as one n-gram).

    Letters are lower-cased; anything else below U+0300 is a space.
    """
    overlap = max(LENGTHS) - 1
    found = _chunk_grams(text[: CHUNK + overlap])
    for low in range(CHUNK, len(text), CHUNK):
        found = np.union1d(found, _chunk_grams(text[low : low + CHUNK + overlap]))
    return found


class Model(NamedTuple):
    """What scoring needs: the landmarks' n-grams, which landmarks have them, and the fitted weights."""

    languages: list[str]
    known: np.ndarray  # sorted n-grams of all landmarks
    holds: np.ndarray  # (n-gram, landmark): 1 where the landmark has the n-gram
    sizes: np.ndarray  # n-grams of each landmark
    weights: np.ndarray  # (landmark, language)
    bias: np.ndarray

    def kernel(self, sets: list[np.ndarray]) -> np.ndarray:
        """(text, landmark): shared n-grams over the root of both counts; 0 for a text without any."""
        shared = np.zeros((len(sets), len(self.sizes)), np.float64)
        for row, own in enumerate(sets):
            at = np.searchsorted(self.known, own)
            at[at == len(self.known)] = 0
            shared[row] = self.holds[at[self.known[at] == own]].sum(axis=0, dtype=np.int64)
        counts = np.array([max(len(s), 1) for s in sets], np.float64)
        return shared / np.sqrt(counts[:, None] * self.sizes[None, :])

    def decide(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(place of the language, score from 0 to 1) of every text."""
        values = self.kernel([grams(t) for t in texts]) @ self.weights + self.bias
        best = values.argmax(axis=1)
        return best, np.clip((values[np.arange(len(best)), best] + 1) / 2, 0, 1)


def fit(rows: list[tuple[str, str]], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """The model of labelled texts (language, text); the first ones of every language are the landmarks."""
    languages = sorted({lang for lang, _ in rows})
    sets = [grams(text) for _, text in rows]
    of = np.array([languages.index(lang) for lang, _ in rows])
    each = max(1, landmarks // len(languages))
    chosen = np.concatenate([np.flatnonzero(of == c)[:each] for c in range(len(languages))])
    own = [sets[i] for i in chosen]
    known = np.unique(np.concatenate(own))
    holds = np.zeros((len(known), len(own)), np.uint8)
    for column, found in enumerate(own):
        holds[np.searchsorted(known, found), column] = 1
    bare = Model(languages, known, holds, np.array([max(len(s), 1) for s in own], np.float64), np.zeros(0), np.zeros(0))
    # Nyström: features are kernel values times the inverse root of the landmarks' own kernel.
    values, vectors = np.linalg.eigh(bare.kernel(own))
    strong = values > 1e-9 * values.max()
    to_features = vectors[:, strong] / np.sqrt(values[strong])
    features = bare.kernel(sets) @ to_features
    targets = np.where(of[:, None] == np.arange(len(languages)), 1.0, -1.0)
    centre, middle = features.mean(axis=0), targets.mean(axis=0)
    spread = features - centre
    gram = spread.T @ spread + ridge * len(rows) * np.eye(spread.shape[1])
    solved = np.linalg.solve(gram, spread.T @ (targets - middle))
    return bare._replace(weights=to_features @ solved, bias=middle - centre @ solved)


def _fold(doc_id: str) -> Column:
    return F.crc32(F.col(doc_id).cast("string")) % FOLDS


def labelled_sample(docs: DataFrame, languages: int = LANGUAGES, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> list[tuple[str, str]]:
    """At most ``rows`` labelled texts (language, text) outside the held-out fold, as many of each language.

    Chosen by a hash of the text, so that reruns agree and equal texts count once; never longer than
    ``chars``. Rows are thinned by the hash before any language's rows meet.
    """
    mark = F.pmod(F.xxhash64("text"), F.lit(1 << 32))
    fit_for = (F.col("lang").isNotNull()) & (F.char_length("text") <= chars) & F.rlike("text", F.lit(r"\p{L}")) & (_fold("doc_id") != 0)
    labelled = docs.select("doc_id", "text", "lang").filter(fit_for).select("lang", "text", mark.alias("mark"))
    counts = labelled.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(languages).collect()
    if not counts:
        return []
    each = max(1, rows // len(counts))
    limit = lambda n: F.lit(min(1 << 32, (4 * each << 32) // n + 1)).cast("bigint")
    limits = F.create_map(*[x for r in counts for x in (F.lit(r["lang"]), limit(r["count"]))])
    thinned = labelled.filter(F.col("mark") < limits[F.col("lang")]).groupBy("lang", "mark").agg(F.min("text").alias("text"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("mark"))
    chosen = thinned.withColumn("_place", place).filter(F.col("_place") <= each).orderBy("lang", "_place").collect()
    return [(r["lang"], r["text"]) for r in chosen]


def identify(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``held_out``, ``lang_pred`` and ``score`` (0 to 1) from a model fitted on their own labels.

    Only rows with a language whose crc32 of doc_id does not divide by five are learned from; the
    prediction reads the text alone, the whole of it. A NULL text, a text without a letter, and every
    text when nothing could be learned is ``und`` with score 0. A NULL doc_id is neither held out nor
    learned from. Repeated rows are kept, columns called like an added one are replaced, and an empty
    table stays empty.
    """
    given = docs.withColumn("text", F.col(text)) if text != "text" else docs
    sample = labelled_sample(given)
    model = fit(sample) if sample else None
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most LANDMARKS texts of SAMPLE_CHARS characters
    names = ("held_out", "lang_pred", "score")
    rest = [c for c in docs.columns if c.lower() not in names]
    fields = [f for f in docs.schema.fields if f.name in rest]
    added = [T.StructField("held_out", T.BooleanType()), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH):
                batch = whole.slice(at, BATCH)
                texts = batch.column(batch.num_columns - 1).to_pylist()
                lang, score = [UNKNOWN] * len(texts), [0.0] * len(texts)
                sure = [i for i, t in enumerate(texts) if model is not None and t and has_letter(t)]
                if sure:
                    best, value = model.decide([texts[i] for i in sure])
                    for i, b, v in zip(sure, best.tolist(), value.tolist(), strict=True):
                        lang[i], score[i] = model.languages[b], v
                columns = [batch.column(c) for c in range(batch.num_columns - 1)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=out.names)

    held = F.coalesce(_fold("doc_id") == 0, F.lit(False)).alias("held_out")
    out = T.StructType(fields + added)
    asked = docs.select(*[F.col(f"`{c}`") for c in rest], held, F.col(f"`{text}`").alias("_given"))
    return asked.mapInArrow(predict, out)
