"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1 (``DIM`` components, drawn from
a hash of the letter, so the same on every machine).  An n-gram's vector binds
its letters' vectors, each permuted (rotated) by its place, by multiplying
them.  A text's profile bundles, that is adds, the vectors of all its n-grams;
a language's prototype bundles all its training texts.  A text gets the
language whose prototype has the largest cosine with its profile.

Texts are lower-cased; runs of other characters than letters count as one
space.  Training sums one vector per language in each task and adds those up;
only the prototypes (languages x DIM numbers) reach the driver.

Defined cases: a null text, or one without a letter, is ``und`` with score 0;
so is every text if nothing could be learned; ties go to the language first in
order; very long texts are read whole, slice by slice; rows with a null doc_id
are not held out and not learned from; an empty table gives an empty result;
further columns are kept by ``predict``.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ranklight.llm.common import prepare, table
from ranklight.llm.registry import register

DIM = 1024
ORDER = 3
UNKNOWN = "und"
#: Characters profiled at once, and rows: they bound the memory of a task.
BLOCK_CHARS = 1 << 18
BLOCK_ROWS = 128


class Encoder:
    """Texts to profiles."""

    def __init__(self, dim: int = DIM, order: int = ORDER):
        self.dim, self.order = dim, order
        self.vectors: dict[int, np.ndarray] = {}
        letters = np.zeros(0x110000, bool)
        for c in range(0x110000):
            if chr(c).isalpha():
                letters[c] = True
        self.letters = letters
        self.place = np.zeros(0x110000, np.int64)

    def letter(self, code: int) -> np.ndarray:
        """The vector of a letter (0: the space)."""
        if code not in self.vectors:
            bits = np.frombuffer(hashlib.shake_128(b"letter %d" % code).digest(self.dim // 8), np.uint8)
            self.vectors[code] = np.unpackbits(bits).astype(np.float32) * 2 - 1
        return self.vectors[code]

    def symbols(self, text: str, before: np.ndarray) -> np.ndarray:
        """Code points of the letters, 0 for each run of others.  ``before``:
        the last symbols of the slice before this one."""
        codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = np.where(self.letters[codes], codes, 0)
        codes = np.concatenate([before, codes.astype(np.int64)])
        keep = np.ones(len(codes), bool)
        keep[1:] = (codes[1:] != 0) | (codes[:-1] != 0)
        return codes[keep]

    def _slices(self, texts):
        """(row, symbols) of at most BLOCK_CHARS characters, overlapping so
        that every n-gram is in exactly one."""
        n = self.order
        for row, text in enumerate(texts):
            if not text:
                continue
            tail = np.zeros(1, np.int64)
            for at in range(0, len(text), BLOCK_CHARS):
                s = self.symbols(text[at:at + BLOCK_CHARS], tail)
                if at + BLOCK_CHARS >= len(text) and s[-1] != 0:
                    s = np.append(s, 0)
                yield row, s
                tail = s[-(n - 1):]

    def profiles(self, texts: list) -> np.ndarray:
        """(texts, dim) sums of n-gram vectors; zero where there is no letter."""
        return self.bundles(texts, np.arange(len(texts)), len(texts))

    def bundles(self, texts: list, label: np.ndarray, n_labels: int) -> np.ndarray:
        """(labels, dim) sums of the n-gram vectors of each label's texts."""
        out = np.zeros((n_labels, self.dim), np.float64)
        rows, parts, size = [], [], 0
        for row, s in self._slices(texts):
            rows.append(label[row])
            parts.append(s)
            size += len(s)
            if size >= BLOCK_CHARS or len(parts) >= BLOCK_ROWS:
                self._add(out, rows, parts)
                rows, parts, size = [], [], 0
        if parts:
            self._add(out, rows, parts)
        return out

    def _add(self, out: np.ndarray, rows: list, parts: list) -> None:
        n = self.order
        symbols = np.concatenate(parts)
        seen = np.zeros(0x110000, bool)
        seen[symbols] = True
        alphabet = np.flatnonzero(seen)
        k = len(alphabet)
        self.place[alphabet] = np.arange(k)
        local = self.place[symbols]
        lengths = np.array([len(p) for p in parts])
        key = np.zeros(len(local) - n + 1, np.int64) if len(local) >= n else np.zeros(0, np.int64)
        for i in range(n):
            key = key * k + local[i:i + len(key)]
        # n-grams that begin in one text and end in the next do not count,
        # nor do those without a letter.
        owner = np.repeat(np.arange(len(parts)), lengths)
        inside = owner[:len(key)] == owner[n - 1:n - 1 + len(key)]
        key, owner = key[inside], owner[:len(inside)][inside]
        if not len(key):
            return
        if k ** n <= 1 << 22:
            present = np.zeros(k ** n, bool)
            present[key] = True
            grams = np.flatnonzero(present)
            index = np.zeros(k ** n, np.int64)
            index[grams] = np.arange(len(grams))
            col = index[key]
        else:
            grams, col = np.unique(key, return_inverse=True)
        # Texts of one label are counted together; its sums stay whole numbers that floats hold.
        rows, same = np.unique(rows, return_inverse=True)
        counts = np.bincount(same[owner] * len(grams) + col, minlength=len(rows) * len(grams))
        counts = counts.reshape(len(rows), len(grams)).astype(np.float32)
        base = np.stack([self.letter(int(c)) for c in alphabet])
        rolled = [np.roll(base, n - 1 - i, axis=1) for i in range(n)]
        digits = [(grams // k ** (n - 1 - i)) % k for i in range(n)]
        for a in range(0, len(grams), 4096):  # bounds the matrix of bound vectors
            bound = rolled[0][digits[0][a:a + 4096]]
            for i in range(1, n):
                bound = bound * rolled[i][digits[i][a:a + 4096]]
            out[rows] += counts[:, a:a + 4096] @ bound


_ENCODERS: dict[tuple, Encoder] = {}


def _encoder(dim: int, order: int) -> Encoder:
    if (dim, order) not in _ENCODERS:
        _ENCODERS[(dim, order)] = Encoder(dim, order)
    return _ENCODERS[(dim, order)]


@dataclass
class Model:
    """Languages in order, their prototypes as unit vectors."""

    languages: list[str]
    prototypes: np.ndarray
    dim: int = DIM
    order: int = ORDER
    texts: dict = field(default_factory=dict)


def _train(dim: int, order: int):
    def run(batches):
        enc = _encoder(dim, order)
        sums: dict[str, list] = {}
        for batch in batches:
            texts, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for at in range(0, len(texts), BLOCK_ROWS):
                names, label, n = np.unique(np.array(langs[at:at + BLOCK_ROWS], object), return_inverse=True, return_counts=True)
                block = enc.bundles(texts[at:at + BLOCK_ROWS], label, len(names))
                for i, lang in enumerate(names):
                    total = sums.setdefault(lang, [np.zeros(dim), 0])
                    total[0] += block[i]
                    total[1] += int(n[i])
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.string()), pa.array([v.tolist() for v, _ in sums.values()], pa.list_(pa.float64())),
             pa.array([n for _, n in sums.values()], pa.int64())], names=["lang", "v", "n"])
    return run


def train(documents: DataFrame, dim: int = DIM, order: int = ORDER) -> Model:
    """Prototypes of all non-null ``lang`` values from all rows given."""
    prepare(documents, "text", "lang")
    d = documents.where("text is not null and lang is not null").select("text", F.col("lang").cast("string"))
    parts = d.mapInArrow(_train(dim, order), "lang string, v array<double>, n long")
    sums = (parts.select("lang", "n", F.posexplode("v").alias("i", "x")).groupBy("lang", "i")
            .agg(F.sum("x").alias("x"), F.sum("n").alias("n")).groupBy("lang")
            .agg(F.array_sort(F.collect_list(F.struct("i", "x"))).alias("v"), F.max("n").alias("n")))
    rows = sorted(sums.collect(), key=lambda r: r.lang)  # one row per language
    protos = np.array([[x.x for x in r.v] for r in rows]).reshape(len(rows), dim)
    norms = np.linalg.norm(protos, axis=1)
    keep = norms > 0
    return Model([r.lang for r, k in zip(rows, keep, strict=True) if k], protos[keep] / norms[keep][:, None], dim, order,
                 {r.lang: r.n for r in rows})


def prediction(model: Model, text: Column) -> Column:
    """struct(lang_pred string, score double) of a text column."""
    langs, protos, dim, order = model.languages, model.prototypes, model.dim, model.order

    @F.pandas_udf("lang_pred string, score double")
    def predict_batch(texts: pd.Series) -> pd.DataFrame:
        enc = _encoder(dim, order)
        preds, scores = [], []
        all_texts = texts.tolist()
        for at in range(0, len(all_texts), BLOCK_ROWS):
            block = enc.profiles(all_texts[at:at + BLOCK_ROWS])
            norms = np.sqrt((block * block).sum(axis=1))
            known = (norms > 0) & bool(langs)
            cos = block @ protos.T / np.maximum(norms, 1e-300)[:, None] if langs else np.zeros((len(block), 1))
            best = cos.argmax(axis=1)
            preds += [langs[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)]
            scores += [min(1.0, max(0.0, float(c[b]))) if k else 0.0 for c, b, k in zip(cos, best, known, strict=True)]
        return pd.DataFrame({"lang_pred": preds, "score": scores})

    # Else a filter on the result would move below the projection and run it twice.
    return predict_batch.asNondeterministic()(text)


def predict(documents: DataFrame, model: Model) -> DataFrame:
    """``documents`` with ``lang_pred`` and ``score`` (replacing columns of
    these names)."""
    d = documents.drop("lang_pred", "score").withColumn("_llm_p", prediction(model, F.col("text")))
    return d.select(*[c for c in d.columns if c != "_llm_p"], "_llm_p.lang_pred", "_llm_p.score")


def held_out(doc_id: Column) -> Column:
    """Every fourth document by a checksum of its id; never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def train_split(documents: DataFrame) -> Model:
    return train(documents.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))))


@register("op3_language_profiles")
def op3_language_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, learned from those not held out."""
    docs = table(spark, sf_dir, "documents")
    d = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return predict(d, train_split(docs)).select("doc_id", "held_out", "lang_pred", "score")
