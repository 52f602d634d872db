"""Language identification in two steps: the family first, then one-versus-one linear
support vector machines among the languages of that family.

Features are hashed byte n-grams of the lower-cased whole text, as shares of all n-grams.
Training uses a bounded sample of labelled rows; prediction reads every text in windows,
so that memory does not grow with a text.

Planes part the learnt languages only, however unlike all of them a text is.  Whether it
is typical is told by itself: the mean logarithm of its n-grams' shares in the language
found, which does not fall with length, against that of the labelled rows.

Defined results: a text that is null or has no letter is ``und`` with score 0; so is
every text when there is nothing to learn from.  Rows without a key or label are never
learnt from.  Repeated rows are predicted alike.  Columns named like a result are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UNDETERMINED = "und"
#: Families by ISO 639-1 code; a language that is not listed is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is fo af fy lb yi",
    "romance": "fr es it pt ro ca gl oc",
    "slavic": "ru uk be pl cs sk sl hr sr bs mk bg",
    "baltic": "lt lv",
    "uralic": "fi et hu",
    "turkic": "tr az kk ky uz tk tt",
    "semitic": "ar he mt am",
    "indic": "hi bn ur mr gu pa ne si",
    "malayic": "id ms jv su",
}
ORDERS = (1, 2, 3)
WINDOW = 1 << 18
#: Share of an n-gram that the labelled rows of a language do not have.
RARE = 1e-5


@dataclass(frozen=True)
class Training:
    """``max_rows`` bounds the labelled rows of the sample, shared evenly by languages.

    Every language has ``min_rows`` of them, as far as it has so many, so that the bound
    grows with the languages.  More than ``max_labels`` labels are an error.
    """

    max_rows: int = 800
    min_rows: int = 20
    max_labels: int = 200
    buckets: int = 2048
    penalty: float = 1e-4
    steps: int = 200
    slope: float = 3.0
    #: A text is typical down to ``reach`` times the distance from the median of the rows
    #: that are labelled right to their quantile ``lowest``.
    lowest: float = 0.01
    reach: float = 4.0


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    family_of: list[int]
    pairs: list[tuple[int, int]]
    families: int
    weights: np.ndarray  # buckets x (families + pairs)
    bias: np.ndarray
    slope: float
    usual: np.ndarray  # buckets x languages: logarithms of n-gram shares
    least: np.ndarray  # by language: the mean of these that a typical text has


def _plain() -> np.ndarray:
    """Bytes to letters: whatever of ASCII is no letter becomes a space."""
    out = np.arange(256, dtype=np.uint8)
    for b in range(128):
        if not chr(b).isalpha():
            out[b] = 32
    return out


PLAIN = _plain()


def _windows(texts: pa.Array, buckets: int):
    """Yields (row, bucket) arrays of the n-grams of all texts, a window at a time."""
    lower = pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), ""))
    offsets = np.frombuffer(lower.buffers()[1], np.int64)[lower.offset : lower.offset + len(lower) + 1]
    data = np.frombuffer(lower.buffers()[2] or b"", np.uint8)
    reach, bits = max(ORDERS) - 1, buckets.bit_length() - 1
    for first in range(int(offsets[0]), int(offsets[-1]), WINDOW):
        last = min(first + WINDOW, int(offsets[-1]))
        at = np.arange(first, min(last + reach, int(offsets[-1])))
        row = np.searchsorted(offsets, at, "right") - 1
        b = PLAIN[data[at[0] : at[-1] + 1]]
        own = at < last
        # the byte before, if it belongs to the same text
        before = np.r_[PLAIN[data[at[0] - 1]] if at[0] else np.uint8(0), b[:-1]]
        before[at == offsets[row]] = 0
        kept = (b != 32) | (before != 32)  # runs of spaces count once
        b, row, own = b[kept].astype(np.uint32), row[kept], own[kept]
        for n in ORDERS:
            size = len(b) - n + 1
            if size <= 0:
                continue
            code = np.full(size, n, np.uint32)
            for d in range(n):
                code = code * np.uint32(256) + b[d : d + size]
            code = (code * np.uint32(2654435761)) >> np.uint32(32 - bits)
            valid = own[:size] & (row[:size] == row[n - 1 : n - 1 + size])
            yield row[:size][valid], code[valid]


def shares(texts: pa.Array, buckets: int) -> np.ndarray:
    """One row of n-gram shares for each text."""
    out = np.zeros((len(texts), buckets), np.float32)
    for row, code in _windows(texts, buckets):
        np.add.at(out, (row, code), 1)
    return out / np.maximum(out.sum(axis=1, keepdims=True), 1)


def margins(texts: pa.Array, model: LanguageModel) -> np.ndarray:
    """Signed distances of each text from every separating plane, without its share vector."""
    out = np.zeros((len(texts), model.weights.shape[1]))
    total = np.zeros(len(texts))
    for row, code in _windows(texts, len(model.weights)):
        total += np.bincount(row, minlength=len(texts))
        for k in range(out.shape[1]):
            out[:, k] += np.bincount(row, model.weights[code, k], len(texts))
    return out / np.maximum(total, 1)[:, None] + model.bias


def linear_svm(gram: np.ndarray, y: np.ndarray, penalty: float, steps: int) -> np.ndarray:
    """Squared hinge loss with an L2 penalty, by accelerated gradient steps.

    The plane is a sum of the rows; the steps run over the rows' weights in that sum, so
    they cost the square of the number of rows and not of the features.
    """
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum()))
    probe, norm = np.ones(len(y)), 1.0
    for _ in range(20):
        probe = weight * (gram @ probe)
        norm = np.linalg.norm(probe) + 1e-12
        probe /= norm
    a, ahead, momentum = np.zeros(len(y)), np.zeros(len(y)), 1.0
    for _ in range(steps):
        gap = np.maximum(0, 1 - y * (gram @ ahead))
        new = ahead - (penalty * ahead - 2 * weight * gap * y) / (2 * norm + penalty)
        faster = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        ahead, a, momentum = new + (momentum - 1) / faster * (new - a), new, faster
    return a


def fit(x: np.ndarray, labels: list[str], training: Training = Training()) -> LanguageModel:
    """Fits all planes on share vectors and their labels."""
    languages = sorted(set(labels))
    named = {code: name for name, codes in FAMILIES.items() for code in codes.split()}
    names = [named.get(code, code) for code in languages]
    families = sorted(set(names))
    family_of = [families.index(n) for n in names]
    pairs = [(a, b) for a, b in combinations(range(len(languages)), 2) if family_of[a] == family_of[b]]
    if not languages:
        none = np.zeros((training.buckets, 0))
        return LanguageModel([], [], [], 0, none, np.zeros(0), training.slope, none, np.zeros(0))
    y = np.array([languages.index(c) for c in labels], dtype=int)
    of = np.array(family_of, dtype=int)[y]
    centre, scale = x.mean(axis=0), x.std() * np.sqrt(x.shape[1]) + 1e-12
    z = (x - centre) / scale
    gram = (z @ z.T).astype(np.float64) + 1  # plus one: a constant feature, for the bias

    def plane(rows, signs):
        a = linear_svm(gram[np.ix_(rows, rows)], signs, training.penalty, training.steps)
        w = z[rows].T @ a / scale
        return w, a.sum() - w @ centre

    everything, planes = np.arange(len(y)), []
    for f in range(len(families)):
        alone = len(families) == 1
        planes.append((np.zeros(x.shape[1]), 1.0) if alone else plane(everything, np.where(of == f, 1, -1)))
    for a, b in pairs:
        rows = np.flatnonzero((y == a) | (y == b))
        planes.append(plane(rows, np.where(y[rows] == a, 1, -1)))
    weights, bias = np.array([w for w, _ in planes]).T, np.array([b for _, b in planes])
    usual, least = np.zeros((x.shape[1], len(languages))), np.full(len(languages), -np.inf)
    model = LanguageModel(languages, family_of, pairs, len(families), weights, bias, training.slope, usual, least)
    right = decide(x @ weights + bias, model)[0] == y
    for k in range(len(languages)):
        of_k = x[y == k].astype(np.float64)
        whole, n = of_k.sum(axis=0), len(of_k)
        usual[:, k] = np.log(whole / n + RARE)
        if n > 1 and right[y == k].any():
            # each row against the other ones
            found = (of_k * np.log((whole - of_k).clip(0) / (n - 1) + RARE)).sum(axis=1)[right[y == k]]
            middle = np.median(found)
            least[k] = middle - training.reach * (middle - np.quantile(found, training.lowest))
    return model


def decide(m: np.ndarray, model: LanguageModel) -> tuple[np.ndarray, np.ndarray]:
    """Language index and score of each row of margins."""

    def probability(margin):
        return 1 / (1 + np.exp(-np.clip(model.slope * margin, -50, 50)))

    n = len(m)
    family = np.argmax(m[:, : model.families], axis=1)
    top2 = np.sort(m[:, : model.families], axis=1)[:, -2:]
    sure = probability((top2[:, -1] - top2[:, 0]) / 2) if model.families > 1 else np.ones(n)
    of = np.array(model.family_of)
    votes = np.where(of[None, :] == family[:, None], 0.0, -np.inf)
    for k, (a, b) in enumerate(model.pairs):
        margin = m[:, model.families + k]
        # a won duel counts one; the margin, below one half, only parts equal votes
        votes[:, a] += (margin > 0) + np.tanh(margin) / 4 / len(of)
        votes[:, b] += (margin <= 0) - np.tanh(margin) / 4 / len(of)
    language = np.argmax(votes, axis=1)
    for k, (a, b) in enumerate(model.pairs):
        margin = m[:, model.families + k]
        duel = np.where(language == a, probability(margin), np.where(language == b, probability(-margin), 1.0))
        sure = np.minimum(sure, duel)
    return language, sure


def learn(
    docs: DataFrame, key: str, text: str, label: str, learnable: Column, training: Training = Training()
) -> LanguageModel:
    """Fits on a bounded sample of the learnable labelled rows, the same ones each time.

    Per language the rows of the smallest key hashes are taken.  Whole texts are counted
    on the executors; only bounded share vectors reach the driver.
    """
    rows = docs.select(key, text, F.col(label).alias("_label")).filter(
        learnable & F.col(label).isNotNull() & F.col(text).rlike(r"\p{L}")
    )
    # one label too many is enough to tell that there are too many
    counts = {r["_label"]: r["n"] for r in rows.groupBy("_label").agg(F.count("*").alias("n")).orderBy(
        F.desc("n"), "_label").limit(training.max_labels + 1).collect()}
    if not counts:
        return fit(np.zeros((0, training.buckets), np.float32), [], training)
    if len(counts) > training.max_labels:
        raise ValueError(f"more than {training.max_labels} labels in {label!r}; see Training.max_labels")
    each = max(1, training.min_rows, training.max_rows // len(counts))
    draw = F.pmod(F.xxhash64(key), F.lit(1 << 20))
    chance = F.create_map(*[F.lit(v) for k, n in counts.items() for v in (k, min(1.0, 2 * (each + 20) / n))])
    drawn = rows.filter(draw < F.try_element_at(chance, F.col("_label")) * (1 << 20))
    order = Window.partitionBy("_label").orderBy(F.xxhash64(key), key, text)
    sample = drawn.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= each)

    def count(batches):
        for batch in batches:
            for i in range(0, len(batch), 64):
                part = batch.slice(i, 64)
                x = shares(part.column(0), training.buckets)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r.tobytes() for r in x], pa.binary()), part.column(1)], ["x", "label"]
                )

    got = sample.select(text, "_label").mapInArrow(count, "x binary, label string").orderBy("label", "x").toArrow()
    x = np.frombuffer(b"".join(got["x"].to_pylist()), np.float32).reshape(-1, training.buckets)
    return fit(x, got["label"].to_pylist(), training)


def identify(docs: DataFrame, model: LanguageModel, text: str = "text", typical: bool = False) -> DataFrame:
    """Adds ``lang_pred`` and ``score``, predicted from the text alone.

    If asked for, also ``typical``: whether the text is like those of its language at all.
    """
    if typical:
        # ``decide`` does not look at the further columns
        weights, bias = np.hstack([model.weights, model.usual]), np.r_[model.bias, np.zeros(len(model.languages))]
        model = replace(model, weights=weights, bias=bias)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<language: string, score: double, typical: boolean>")
    def predict(texts: pa.Array) -> pa.Array:
        known = shared.value
        if not known.languages:
            names, sure, like = [UNDETERMINED] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), bool)
        else:
            m = margins(texts, known)
            index, sure = decide(m, known)
            like = np.ones(len(texts), bool)
            if typical:
                own = m[np.arange(len(texts)), m.shape[1] - len(known.languages) + index]
                like = own >= known.least[index]
            names = pa.array(known.languages, pa.string()).take(pa.array(index))
        return pa.StructArray.from_arrays(
            [pa.array(names, pa.string()), pa.array(np.round(sure, 6)), pa.array(like)],
            ["language", "score", "typical"],
        )

    letters = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    like = {"typical": letters & F.col("_found.typical")} if typical else {}
    return docs.drop("lang_pred", "score", *like).withColumn("_found", predict(F.col(text))).withColumns(
        {
            **like,
            "lang_pred": F.when(letters, F.col("_found.language")).otherwise(F.lit(UNDETERMINED)),
            "score": F.when(letters, F.col("_found.score")).otherwise(F.lit(0.0)),
        }
    ).drop("_found")


def third(key: str) -> Column:
    """crc32 of the key as text, modulo 3: 1 is held out from learning."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % 3
