"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. The vector of an n-gram is its letters' vectors,
each rotated by its place, multiplied; a text is the sum of its n-grams' vectors; a language's
prototype is the sum of its texts' unit vectors. A text gets the language whose prototype has the
largest cosine with it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Sent, held_out, slices

SHIFT = 21  # bits of a code point
SPACE = 32
TOGETHER = 1024  # n-grams whose vectors are unpacked at once


class Space:
    """The vectors: `dim` long, of n-grams of `n` letters, from `seed`.

    Up to `stored` n-gram vectors are kept by a process; further ones are made when met.
    """

    def __init__(self, dim: int = 1024, n: int = 3, seed: int = 11, stored: int = 16384):
        self.dim, self.n, self.seed, self.stored = dim, n, seed, stored
        self._clear()

    def _clear(self) -> None:
        self.letters: dict[int, np.ndarray] = {}
        self.rows: dict[int, int] = {}
        self.grams = np.empty((0, self.dim), np.int8)  # +1 and -1
        self.is_letter: np.ndarray | None = None

    def __getstate__(self) -> dict:
        return {k: getattr(self, k) for k in ("dim", "n", "seed", "stored")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._clear()

    def letter(self, point: int) -> np.ndarray:
        if point not in self.letters:
            bits = np.random.default_rng([self.seed, point]).integers(0, 2, self.dim)
            self.letters[point] = (2 * bits - 1).astype(np.float32)
        return self.letters[point]

    def gram(self, code: int) -> np.ndarray:
        out = np.ones(self.dim, np.float32)
        for place in range(self.n):
            out *= np.roll(self.letter(code >> SHIFT * place & (1 << SHIFT) - 1), place)
        return out

    def codes(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """The distinct n-grams of a text and their counts; what is no letter is one space."""
        if self.is_letter is None:
            self.is_letter = np.array([chr(p).isalpha() for p in range(0x110000)])
        points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        letter = self.is_letter[points]
        if not letter.any():
            return np.empty(0, np.int64), np.empty(0, np.int64)
        points = np.where(letter, points, SPACE)
        keep = letter.copy()
        keep[1:] |= letter[:-1]  # of a run without letters the first place only
        points = np.concatenate(([SPACE], points[keep], [SPACE]))
        count = max(1, len(points) - self.n + 1)
        code = np.zeros(count, np.int64)
        for place in range(self.n):
            code = code << SHIFT | points[place : place + count]
        return np.unique(code, return_counts=True)

    def vector(self, text: str) -> np.ndarray | None:
        """The sum of a text's n-gram vectors, None if it has no letter."""
        return self.summed(*self.codes(text))

    def summed(self, codes: np.ndarray, counts: np.ndarray) -> np.ndarray | None:
        """The sum of the vectors of so many n-grams, None if there are none."""
        if not len(codes):
            return None
        at = np.fromiter((self.rows.get(c, -1) for c in codes.tolist()), np.int64, len(codes))
        new = codes[at < 0][: self.stored - len(self.rows)]
        if len(new):
            if len(self.rows) + len(new) > len(self.grams):
                grown = np.empty((min(self.stored, 2 * (len(self.rows) + len(new))), self.dim), np.int8)
                grown[: len(self.rows)] = self.grams[: len(self.rows)]
                self.grams = grown
            for c in new.tolist():
                self.grams[len(self.rows)] = self.gram(c)
                self.rows[c] = len(self.rows)
            at = np.fromiter((self.rows.get(c, -1) for c in codes.tolist()), np.int64, len(codes))
        known = at >= 0
        out = np.zeros(self.dim, np.float32)
        own, times = at[known], counts[known].astype(np.float32)
        for start in range(0, len(own), TOGETHER):
            out += times[start : start + TOGETHER] @ self.grams[own[start : start + TOGETHER]].astype(np.float32)
        for c, n in zip(codes[~known].tolist(), counts[~known].tolist(), strict=True):
            out += n * self.gram(c)
        return out


def learn(docs: DataFrame, space: Space, per_language: int = 4000) -> dict[str, np.ndarray]:
    """Prototypes by language from about `per_language` rows of each, taken by a hash of doc_id.

    Rows whose doc_id belongs to the held-out quarter, or without lang, are left out.
    """
    rows = docs.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull()).select(
        F.col("doc_id").cast("string").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
        F.col("text").cast("string").alias("text"),
    )
    counts = rows.groupBy("lang").count()
    share = F.least(F.lit(1.0), per_language / F.col("count"))
    chance = F.pmod(F.xxhash64(F.lit("lang"), "doc_id"), F.lit(1 << 20)) / (1 << 20)
    # One row a language: their number does not grow with the corpus.
    sampled = rows.join(F.broadcast(counts.select("lang", share.alias("share"))), "lang").where(chance < F.col("share"))
    sent = Sent(docs.sparkSession, space)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in slices(batches):
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                vector = sent.value.vector(text or "")
                if vector is not None:
                    unit = vector.astype(np.float64) / max(np.linalg.norm(vector), 1e-9)
                    total[lang] = total.get(lang, 0) + unit
        if total:
            arrays = [pa.array([*total]), pa.array([v.tolist() for v in total.values()], pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(arrays, ["lang", "vector"])

    parts = sampled.select("lang", "text").mapInArrow(sums, "lang string, vector array<double>")
    added = parts.select("lang", F.posexplode("vector").alias("place", "x")).groupBy("lang", "place").agg(F.sum("x").alias("x"))
    vectors = added.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("place", "x"))).alias("v")).collect()
    return {r["lang"]: np.array([p["x"] for p in r["v"]]) for r in sorted(vectors)}


def identify(docs: DataFrame, space: Space, prototypes: dict[str, np.ndarray]) -> DataFrame:
    """All rows of `docs` with `_llm_lang`, `_llm_score` and `_llm_grams`, the number of distinct n-grams.

    A text that is null or has no letter gets `und` and score 0, as does every text if there is no
    prototype. The score is the cosine with the prototype (0 if negative). Ties go to the first language by
    name. Whole texts are read; rows are independent of one another, so repeated rows, empty
    tables and other columns need no care.
    """
    names = sorted(prototypes)
    matrix = np.array([prototypes[n] / max(np.linalg.norm(prototypes[n]), 1e-9) for n in names], np.float32)
    sent = Sent(docs.sparkSession, (space, names, matrix))
    at = docs.columns.index("text")
    schema = type(docs.schema)(list(docs.schema.fields))
    schema = schema.add("_llm_lang", "string").add("_llm_score", "double").add("_llm_grams", "long")

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space, names, matrix = sent.value
        for batch in slices(batches):
            found, scores, grams = [], [], []
            for text in batch.column(at).to_pylist():
                codes, counts = space.codes(text or "")
                grams.append(len(codes))
                vector = space.summed(codes, counts) if names else None
                norm = 0.0 if vector is None else float(np.linalg.norm(vector))
                if not norm:
                    found.append("und"), scores.append(0.0)
                    continue
                cosines = matrix @ vector / norm
                best = int(cosines.argmax())
                found.append(names[best]), scores.append(min(1.0, max(0.0, float(cosines[best]))))
            yield batch.append_column("_llm_lang", pa.array(found, pa.string())).append_column(
                "_llm_score", pa.array(scores, pa.float64())
            ).append_column("_llm_grams", pa.array(grams, pa.int64()))

    return docs.mapInArrow(make, schema)
