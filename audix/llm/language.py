"""Language identification with a string kernel.

A text is the set of its n-grams of 1 to 4 bytes (lower-cased UTF-8; the blended
spectrum, presence only), hashed to DIMENSIONS; the kernel of two texts is the
size of the common set over the geometric mean of the two sizes. Landmarks are
a bounded sample of labelled texts; the Nystroem map takes a text's kernel
values against them through the inverse square root of the landmarks' kernel
matrix, and one ridge regression per language separates it from the rest.

Training reads at most LANDMARKS + TRAIN_ROWS labelled rows (the rows with the
smallest hashes of doc_id per language, a documented bound); their kernel
matrices are small and solved on the driver. Scoring is the batched product
presence (texts x dimensions) times weights (dimensions x languages), the
weights being the landmarks' sets times the solved coefficients, so a text costs
the same whatever the sample.

Defined cases: null texts and texts without a letter are ``und`` with score 0;
null languages are not learned; without any labelled text every document is
``und``; ties go to the language first in alphabetical order; repeated rows are
scored each; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from audix.llm.batches import forget, text_slices
from audix.llm.shared import packed, ship, small, stored

DIMENSIONS = 8192
GRAMS = (1, 2, 3, 4)
LANDMARKS = 256
TRAIN_ROWS = 2000
RIDGE = 1e-2
UNKNOWN = "und"
RESULTS = ["lang_pred", "score"]
BATCH = 512
# Every label has so many training rows at least, if it has the documents, and
# so many landmarks on average.
LABEL_ROWS, LABEL_LANDMARKS = 20, 2
# Parts in which the first rows of a label are found before they meet.
SALTS = 64


def presence(data: np.ndarray, offsets: np.ndarray, dimensions: int = DIMENSIONS) -> np.ndarray:
    """(texts, dimensions) uint8 matrix of the n-grams present in each text."""
    n = len(offsets) - 1
    out = np.zeros((n, dimensions), np.uint8)
    flat = out.reshape(-1)
    owner = np.repeat(np.arange(n, dtype=np.int64) * dimensions, np.diff(offsets))
    room = np.repeat(offsets[1:], np.diff(offsets)) - np.arange(len(data))
    code = np.zeros(len(data), np.uint32)
    for k in GRAMS:
        size = len(data) - k + 1
        if size <= 0:
            break
        code = (code[:size] << np.uint32(8)) | data[k - 1:]
        h = (code ^ np.uint32(k * 0x3C6EF372)) * np.uint32(0x9E3779B1)
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x85EBCA77)
        place = owner[:size] + (h >> np.uint32(32 - dimensions.bit_length() + 1))
        flat[place if k == 1 else place[room[:size] >= k]] = 1
    return out


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray      # (dimensions, languages)

    def scores(self, marks: np.ndarray) -> np.ndarray:
        """One value per text and language, by one matrix product."""
        norm = np.sqrt(np.maximum(marks.sum(axis=1, dtype=np.float32), 1))
        return (marks.astype(np.float32) @ self.weights) / norm[:, None]


def fit(marks: np.ndarray, languages: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """Nystroem features of all presence rows against evenly dealt landmarks,
    then one ridge regression per language with targets 1 and 0."""
    names = sorted(set(languages))
    landmarks = max(landmarks, LABEL_LANDMARKS * len(names))
    marks = marks.astype(np.float64)
    marks /= np.sqrt(np.maximum(marks.sum(axis=1), 1))[:, None]
    chosen = np.unique(np.linspace(0, len(marks) - 1, min(landmarks, len(marks))).astype(int))
    anchor = marks[chosen]
    values, vectors = np.linalg.eigh(anchor @ anchor.T)
    use = values > 1e-8 * max(values.max(), 1e-12)
    root = vectors[:, use] / np.sqrt(values[use])
    features = (marks @ anchor.T) @ root
    targets = (np.array(languages)[:, None] == np.array(names)[None, :]).astype(float)
    solved = np.linalg.solve(features.T @ features + ridge * np.eye(features.shape[1]), features.T @ targets)
    return Model(names, (anchor.T @ (root @ solved)).astype(np.float32))


def _present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for s in text_slices(batches):
        for a in range(0, len(s), BATCH):
            part = s.offsets[a:a + BATCH + 1]
            bits = np.packbits(presence(s.data[part[0]:part[-1]], part - part[0]), axis=1)
            yield pa.RecordBatch.from_arrays(
                [s.rows.column(i).slice(a, len(bits)) for i in (0, 1)]
                + [pa.array([b.tobytes() for b in bits], pa.binary())], ["doc_id", "lang", "marks"])


def training_sample(labelled: DataFrame, rows: int = LANDMARKS + TRAIN_ROWS) -> list:
    """(doc_id, lang, marks) of at most ``rows`` documents, dealt evenly over
    the languages in the order of a hash of doc_id, so that the sample is the
    same each time; or of LABEL_ROWS a language, where that is more. No language
    is left out. Whole texts count; a row is DIMENSIONS bits."""
    ids = (labelled.select(F.col("doc_id").cast("long").alias("doc_id"), "lang").where("doc_id is not null").distinct())
    names = ids.select("lang").distinct().count()
    if not names:
        return []
    order = F.xxhash64(F.col("doc_id").cast("string"))
    each = max(rows // names, LABEL_ROWS)
    chosen = ids.withColumn("salt", F.pmod(F.xxhash64("doc_id", F.lit("salt")), F.lit(SALTS)))
    for part in (["lang", "salt"], ["lang"]):
        at = F.row_number().over(Window.partitionBy(*part).orderBy(order, "doc_id"))
        chosen = chosen.withColumn("at", at).where(F.col("at") <= each)
    chosen = small(stored(chosen.select("doc_id", "lang"), "sample"), 64)
    lettered = labelled.where(F.col("text").rlike(r"\p{L}"))
    marks = (lettered.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", F.lower("text").alias("text"))
             .join(chosen, ["doc_id", "lang"], "left_semi")
             .mapInArrow(_present, "doc_id long, lang string, marks binary"))
    return marks.groupBy("doc_id", "lang").agg(F.min("marks").alias("marks")).orderBy(order, "doc_id", "lang").collect()


def _score(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for s in text_slices(batches):
            best, top = np.zeros(len(s), np.int64), np.zeros(len(s), np.float32)
            for a in range(0, len(s), BATCH):
                b = min(a + BATCH, len(s))
                part = s.offsets[a:b + 1]
                values = model.scores(presence(s.data[part[0]:part[-1]], part - part[0]))
                best[a:b] = values.argmax(axis=1)
                top[a:b] = values[np.arange(b - a), best[a:b]]
            lettered = s.rows.column(s.rows.schema.get_field_index("lettered")).to_numpy(zero_copy_only=False)
            names = np.array(model.languages + [UNKNOWN], dtype=object)
            guess = names[np.where(lettered, best, len(model.languages))]
            score = np.where(lettered, np.clip(top, 0, 1), 0).astype(np.float64)
            yield pa.RecordBatch.from_arrays(
                [s.rows.column(0), pa.array(guess, pa.string()), pa.array(score)], ["row", *RESULTS])
    return run


def held_out(doc_id: str = "doc_id") -> Column:
    """Documents kept from training: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def identify(docs: DataFrame, labelled: DataFrame) -> DataFrame:
    """All columns of ``docs`` but text, then lang_pred and score. ``labelled``
    (doc_id, text, lang) trains; only its text and language are learned from."""
    ship(docs.sparkSession)
    letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    sample = training_sample(labelled.where(F.col("lang").isNotNull()))
    rows = packed(docs, RESULTS).select("row", F.lower("text").alias("text"), letter.alias("lettered"))
    if not sample:
        return rows.select("row.*", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    marks = np.unpackbits(np.frombuffer(b"".join(r.marks for r in sample), np.uint8)).reshape(len(sample), -1)
    model = fit(marks, [r.lang for r in sample])
    schema = f"row {rows.schema['row'].dataType.simpleString()}, lang_pred string, score double"
    return rows.mapInArrow(_score(model), schema).select("row.*", *RESULTS)
