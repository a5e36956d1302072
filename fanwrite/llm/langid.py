"""Language identification with hyperdimensional profiles.

Every letter, of whatever script, has a random vector of +1 and -1 of its own, drawn
from its code point when it is first met.  The vector of a letter triple
binds its letters: the first one's vector rotated twice, the second one's
rotated once and the third one's are multiplied element by element.  A text's
profile bundles (adds) the vectors of all its triples; a language's prototype
bundles the unit profiles of labelled texts.  A text is given the language
whose prototype has the largest cosine with its profile.

Texts are read as lower-case letters; each run of other characters is one
space, also before the first and after the last letter.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DIMENSIONS = 1024
SEED = 20260101
SAMPLE = 3000  # labelled documents a language, in expectation
UNDETERMINED = "und"
CHUNK = 4096  # triples whose vectors are held at once
LETTERS = 16_384  # letters whose vectors are kept for the next texts; at least three a triple of a chunk
CODE_BITS = 21


@functools.cache
def lowered() -> np.ndarray:
    """The lower-case letter of every code point; 0 for those that are no letters."""
    out = np.zeros(0x110000, np.int64)
    for c in range(0x110000):
        if (letter := chr(c)).isalpha():
            out[c] = ord(letter.lower()[0])
    return out


def letter_vector(code: int) -> np.ndarray:
    """The vector of a letter, or of the space (0)."""
    return np.random.default_rng([SEED, code]).choice(np.array([-1, 1], np.int8), DIMENSIONS)


class Letters:
    """The vectors of the letters met so far, as they enter a triple in first, second,
    third place.  When ``LETTERS`` are held, they are drawn anew as they come."""

    def __init__(self) -> None:
        self.rows = np.full(0x110000, -1, np.int32)
        self.vectors = np.zeros((3, LETTERS, DIMENSIONS), np.int8)
        self.n = 0

    def bound(self, triples_: np.ndarray) -> np.ndarray:
        """The vectors of triples."""
        places = [triples_ >> 2 * CODE_BITS, triples_ >> CODE_BITS & (1 << CODE_BITS) - 1, triples_ & (1 << CODE_BITS) - 1]
        rows = [self.rows[codes] for codes in places]
        if min(r.min() for r in rows) < 0:
            self._draw(np.unique(np.concatenate(places)))
            rows = [self.rows[codes] for codes in places]
        out = self.vectors[0][rows[0]]
        out *= self.vectors[1][rows[1]]
        out *= self.vectors[2][rows[2]]
        return out

    def _draw(self, codes: np.ndarray) -> None:
        if self.n + int((self.rows[codes] < 0).sum()) > LETTERS:
            self.rows.fill(-1)
            self.n = 0
        for c in codes[self.rows[codes] < 0].tolist():
            vector = letter_vector(c)
            for place, turn in enumerate((2, 1, 0)):
                self.vectors[place, self.n] = np.roll(vector, turn)
            self.rows[c] = self.n
            self.n += 1


letters = functools.cache(Letters)


def triples(text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
    """Distinct triples of a text as numbers, and their counts; None if it has no letter."""
    if not text:
        return None
    codes = lowered()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    if not codes.any():
        return None
    codes = np.concatenate(([0], codes, [0]))
    codes = codes[np.concatenate(([True], (codes[1:] != 0) | (codes[:-1] != 0)))]
    return np.unique((codes[:-2] << CODE_BITS | codes[1:-1]) << CODE_BITS | codes[2:], return_counts=True)


def profiles(texts: pd.Series) -> Iterator[np.ndarray | None]:
    """The unit profile of each text, None for those without a letter."""
    for text in texts:
        if (found := triples(text)) is None:
            yield None
            continue
        codes, counts = found
        out = np.zeros(DIMENSIONS, np.float64)
        for i in range(0, len(codes), CHUNK):
            bound = letters().bound(codes[i : i + CHUNK])
            out += counts[i : i + CHUNK].astype(np.float32) @ bound.astype(np.float32)
        norm = np.linalg.norm(out)
        yield out / norm if norm else out


class Prototypes(NamedTuple):
    languages: list[str]
    vectors: np.ndarray  # a unit row for each language


def held_out(key: Column) -> Column:
    """Whether crc32 of the key's text is divisible by 5; false for a null key."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def learn(df: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE) -> Prototypes:
    """Prototypes from the rows that are not held out and have a key, a text and a label.

    About ``sample`` rows of each label are used: those whose hash of key and
    text falls below the label's share, the same ones at every run.  Rows are
    counted in one aggregation; each task adds up its rows' profiles, so what
    is shuffled and collected is one vector a label (language codes: few).
    """
    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    rows = rows.where(F.col("key").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("key")))
    labelled = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not labelled:
        return Prototypes([], np.zeros((0, DIMENSIONS)))
    shares = F.create_map(*(F.lit(x) for lang_, n in labelled.items() for x in (lang_, min(1.0, sample / n))))
    draw = F.pmod(F.xxhash64("key", "text"), F.lit(1 << 20)) / float(1 << 20)

    def bundle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for name, vector in zip(batch["lang"], profiles(batch["text"]), strict=True):
                if vector is not None:
                    sums[name] = sums.get(name, 0) + vector
        if sums:
            yield pd.DataFrame({"lang": list(sums), "vector": list(sums.values())})

    drawn = rows.where(draw < F.element_at(shares, F.col("lang"))).select("lang", "text")
    parts = drawn.mapInPandas(bundle, "lang string, vector array<double>")
    added = parts.select("lang", F.posexplode("vector").alias("i", "x")).groupBy("lang", "i").agg(F.sum("x").alias("x"))
    sums: dict[str, np.ndarray] = {}
    for r in added.collect():
        sums.setdefault(r["lang"], np.zeros(DIMENSIONS))[r["i"]] = r["x"]
    names = sorted(n for n, v in sums.items() if np.linalg.norm(v))
    return Prototypes(names, np.array([sums[n] / np.linalg.norm(sums[n]) for n in names]).reshape(len(names), DIMENSIONS))


def judgement(spark: SparkSession, text: Column, prototypes: Prototypes) -> Column:
    """A struct of ``lang_pred`` and ``score`` for a text, as in ``predict``."""
    shared = spark.sparkContext.broadcast(prototypes)

    def run(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names, vectors = shared.value
        for batch in texts:
            out = []
            for profile in profiles(batch):
                if profile is None or not names:
                    out.append((UNDETERMINED, 0.0))
                    continue
                cosines = vectors @ profile
                best = int(cosines.argmax())
                out.append((names[best], float(min(1.0, max(0.0, cosines[best])))))
            yield pd.DataFrame(out, columns=["lang_pred", "score"])

    return F.pandas_udf(run, "lang_pred string, score double")(text)


def predict(df: DataFrame, prototypes: Prototypes, text: str = "text") -> DataFrame:
    """``df`` with ``lang_pred string`` and ``score double`` (cosine, at least 0).

    A null text, one without letters, and any text when nothing was learned
    get ``und`` and 0.  Equal cosines go to the first language by name.  Only
    the text enters.  All rows and columns stay (columns of the two names are
    replaced); an empty table gives an empty result.
    """
    judged = judgement(df.sparkSession, F.col(text), prototypes)
    kept = [c for c in df.columns if c not in ("lang_pred", "score", "_judged")]
    return df.select(*kept, judged.alias("_judged")).select(*kept, "_judged.lang_pred", "_judged.score")


def identify(df: DataFrame) -> DataFrame:
    """``documents`` judged by prototypes learned from its own labelled rows."""
    rows = predict(df.select("doc_id", "text"), learn(df))
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
