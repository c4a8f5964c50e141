"""Language identification with a string kernel.

The kernel of two texts is the mean, over n-gram lengths 1 to 3, of the cosine between their sets of n-grams: what counts is presence, over the whole
text, in lower case, with everything but letters as one kind of gap. Landmark texts give a Nyström map, and one ridge regression per
language against the rest is fitted on it. As the kernel is linear in the presence vectors, landmarks and weights are multiplied out once, and a batch of
texts is scored by one matrix product per n-gram length. N-grams are hashed to 65,536 places for each length.

Fitting takes a bounded sample: up to ``SAMPLE`` labelled rows per language, those of smallest hash; ``LANDMARKS`` of them are landmarks. Every row is
scored on its whole text. A text that is null or has no letter is ``und`` with score 0, and so is every text if there is nothing to learn from. The score is
half of one plus the winning regression's value, cut to 0 to 1; up to a half every regression says no. A text most of whose distinct letters are in no landmark
gets a half at most. Ties go to the first language by name. Repeated rows get
equal answers, very long texts are read whole, an empty table gives no rows. The added columns replace input columns of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliospark.llm.common import keeps_columns

SAMPLE = 600  # labelled rows per language
LANDMARKS = 160  # in all
RIDGE = 1e-2
ORDERS = (1, 2, 3)
PLACES = 1 << 16
BATCH = 64
UNKNOWN = "und"
REJECT_BELOW = float(np.nextafter(0.5, 1))  # score under which a corpus drops a document: no regression says yes

_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000))
    return _LETTERS[0]


def presence(texts: list[str | None]) -> tuple[list[np.ndarray], np.ndarray]:
    """Per n-gram length a boolean (texts x places) matrix, and which texts have a letter."""
    flags = [np.zeros((len(texts), PLACES), dtype=bool) for _ in ORDERS]
    some = np.zeros(len(texts), dtype=bool)
    for row, text in enumerate(texts):
        codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        letter = _letters()[codes]
        some[row] = letter.any()
        if not some[row]:
            continue
        codes = np.where(letter, codes, 32)
        keep = np.ones(len(codes), dtype=bool)  # one gap for a run of them
        keep[1:] = letter[1:] | letter[:-1]
        codes = np.concatenate([[32], codes[keep], [32]]).astype(np.uint32)
        key = np.zeros(len(codes), dtype=np.uint32)
        for k, n in enumerate(ORDERS):
            key = key[:len(codes) - n + 1] * np.uint32(0x01000193) + codes[n - 1:]
            flags[k][row, (key * np.uint32(0x9E3779B1)) >> np.uint32(16)] = True
    return flags, some


def _gram(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Kernel matrix of two sets of texts."""
    out = np.zeros((len(a[0]), len(b[0])))
    for x, y in zip(a, b):
        nx, ny = np.maximum(x.sum(1), 1), np.maximum(y.sum(1), 1)
        shared = np.flatnonzero(y.any(0))  # no other place can be in common
        out += (x[:, shared].astype(np.float32) @ y[:, shared].astype(np.float32).T) / np.sqrt(nx[:, None] * ny[None, :])
    return out / len(a)


class Model:
    """``weights``: per n-gram length, places x languages."""

    def __init__(self, languages: list[str], weights: list[np.ndarray]):
        self.languages, self.weights = languages, weights

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        names, scores = [], np.zeros(len(texts))
        seen = self.weights[0].any(1) if self.languages else None  # the letters of the landmarks
        for at in range(0, len(texts), BATCH):
            flags, some = presence(texts[at:at + BATCH])
            if not self.languages:
                names += [UNKNOWN] * len(some)
                continue
            value = sum((x.astype(np.float32) @ w) / np.sqrt(np.maximum(x.sum(1), 1))[:, None] for x, w in zip(flags, self.weights))
            # Letters that no landmark has say nothing: what is left is the gap and chance agreements of places.
            own = flags[0]
            strange = 2 * (own & seen).sum(1) < own.sum(1)
            value = np.where(strange[:, None], np.minimum(value, 0), value)
            best = value.argmax(1)
            names += [self.languages[b] if s else UNKNOWN for b, s in zip(best, some)]
            scores[at:at + len(some)] = np.where(some, np.clip((value.max(1) + 1) / 2, 0, 1), 0)
        return names, scores


def fit_rows(texts: list[str], languages: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """Nyström kernel ridge regression, one against the rest."""
    names = sorted(set(languages))
    if not names:
        return Model([], [])
    label = np.array([names.index(x) for x in languages])
    turn = np.zeros(len(label), dtype=int)  # landmarks take the languages in turn
    for c in range(len(names)):
        turn[label == c] = np.arange((label == c).sum())
    marks = np.lexsort((label, turn))[:landmarks]
    own, _ = presence([texts[i] for i in marks])
    base = _gram(own, own)
    kernel = np.concatenate([_gram(presence(texts[at:at + BATCH])[0], own) for at in range(0, len(texts), BATCH)])
    values, vectors = np.linalg.eigh(base)
    good = values > 1e-6 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])
    phi = kernel @ root
    target = np.where(label[:, None] == np.arange(len(names))[None, :], 1.0, -1.0)
    weight = 1.0 / np.bincount(label, minlength=len(names))[label]  # each language counts alike
    gram = (phi * weight[:, None]).T @ phi
    solved = np.linalg.solve(gram + ridge * np.trace(gram) / len(gram) * np.eye(len(gram)), (phi * weight[:, None]).T @ target)
    of_marks = root @ solved  # landmarks x languages
    weights = [(x.T.astype(np.float32) @ (of_marks / np.sqrt(np.maximum(x.sum(1), 1))[:, None] / len(ORDERS)).astype(np.float32)) for x in own]
    return Model(names, weights)


def held_out(doc_id: str = "doc_id") -> Column:
    """A third of the documents, by id, is never learned from."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(3)) == 1, F.lit(False))


def fit(docs: DataFrame, sample: int = SAMPLE, landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """Learn from rows that are not held out and have both text and language."""
    order = F.xxhash64("doc_id", "text")
    usable = docs.where(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per language
    # A hash cut leaves about twice the sample, so that only few texts are sorted; the smallest hashes pass whatever the cut.
    cut = F.lit(None).cast("bigint")
    for name, n in counts.items():
        share = min(1.0, (2 * sample + 20) / n)
        cut = F.when(F.col("lang") == name, F.lit(min(2**63 - 1, int(-(2**63) + share * 2**64)))).otherwise(cut)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("_h", "doc_id"))
    rows = (usable.select("doc_id", "text", "lang", order.alias("_h")).where(F.col("_h") <= cut)
            .withColumn("_r", rank).where(F.col("_r") <= sample).orderBy("lang", "_r").select("text", "lang").collect())
    return fit_rows([r["text"] for r in rows], [r["lang"] for r in rows], landmarks, ridge)


@keeps_columns
def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The documents with ``lang_pred`` and ``score``."""
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.weights))

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = Model(*shared.value)
        for batch in batches:
            names, scores = known.predict(batch.tolist())
            yield pd.DataFrame({"lang_pred": names, "score": scores})

    docs = docs.drop("lang_pred", "score")
    found = docs.withColumn("_found", predict(F.col(f"`{text}`")))
    return found.withColumns({"lang_pred": F.col("_found.lang_pred"), "score": F.col("_found.score")}).drop("_found")


@keeps_columns
def accepted(docs: DataFrame, model: Model, text: str = "text", below: float = REJECT_BELOW) -> DataFrame:
    """The documents whose language is recognised, with their columns as they were."""
    aside = {c: f"_input_{c}" for c in ("lang_pred", "score") if c in docs.columns}
    found = identify(docs.withColumnsRenamed(aside), model, aside.get(text, text))
    kept = found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= below)).drop("lang_pred", "score")
    return kept.withColumnsRenamed({v: k for k, v in aside.items()}).select(*[F.col(f"`{c}`") for c in docs.columns])
