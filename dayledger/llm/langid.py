"""Operator 9: language identification, family first, then between related languages.

A text's features are hashed counts of one to three neighbouring characters (letters in lower
case, all else a gap), square-rooted and scaled to length one. Linear support vector machines, one
against the rest, predict the family; within a family a machine for each pair of languages votes.
Languages that ``FAMILIES`` does not know form a family each.

The machines are fitted on the driver on a sample of bounded size (``PER_LANGUAGE`` different
training rows of each language, by a hash of key and text, ``SAMPLE`` in all; with more than
``LANGUAGES`` labels, of those with the most different rows); every row is then scored where it lies.
Prediction sees the text only. Null, empty and letterless texts are ``und`` with score 0, as is
everything when there are no labelled rows. Rows with a null key are scored, but not learned from.
Very long texts are read whole. Ties go to the label that sorts first; repeated rows are learned from
once and scored each. An empty table gives an empty result. Columns named like the result are replaced.
"""

from __future__ import annotations

from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import map_blocks, table, to_driver

UNDETERMINED = "und"
#: Features of a text.
WIDTH = 1024
#: Rows that the machines learn from, for each language and together (4 KB each on the driver).
PER_LANGUAGE, SAMPLE = 800, 16_000
#: Languages that labels may name.
LANGUAGES = 400
# Families of languages, by ISO 639-1 code.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "fy", "is", "lb", "nb", "nl", "nn", "no", "sv", "yi"),
    "romance": ("ca", "es", "fr", "gl", "it", "la", "oc", "pt", "ro"),
    "slavic": ("be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "uralic": ("et", "fi", "hu"),
    "turkic": ("az", "kk", "ky", "tr", "uz"),
    "indic": ("bn", "gu", "hi", "mr", "ne", "pa", "ur"),
    "semitic": ("am", "ar", "he", "mt"),
    "baltic": ("lt", "lv"),
}


# ---------------------------------------------------------------- features


@cache
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def features(text: str | None, width: int = WIDTH) -> np.ndarray | None:
    """Of length one; None for a text without a letter."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), np.uint32)
    is_letter = _letters()[codes]
    if not is_letter.any():
        return None
    c = np.where(is_letter, codes, 32).astype(np.uint64)
    c = np.concatenate([[32], c, [32]]).astype(np.uint64)
    is_letter = np.concatenate([[False], is_letter, [False]])
    one, two, three = (np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
    pair = c[:-1] * one + c[1:] * two
    grams = (c * one, pair, pair[:-1] + c[2:] * three + one)
    kept = (is_letter, is_letter[:-1] | is_letter[1:], is_letter[1:-1])
    out = np.zeros(width)
    for gram, keep in zip(grams, kept, strict=True):
        slot = (gram[keep] >> np.uint64(40)) % np.uint64(width)
        out += np.bincount(slot.astype(np.int64), minlength=width)
    out = np.sqrt(out)
    return out / np.linalg.norm(out)


# ---------------------------------------------------------------- machines


def _machine(x: np.ndarray, y: np.ndarray, weight: float = 1e-4, rounds: int = 300) -> np.ndarray:
    """Linear support vector machine with squared hinge loss; both classes count the same.

    Accelerated gradient descent; the last entry is the bias.
    """
    x = np.hstack([x, np.ones((len(x), 1))])
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum()))
    w = v = np.zeros(x.shape[1])
    step = 1 / (4 + weight)
    for k in range(rounds):
        gap = np.maximum(0, 1 - y * (x @ v))
        new = v - step * (weight * v - 2 * (x.T @ (share * gap * y)))
        v = new + k / (k + 3) * (new - w)
        w = new
    return w


class Model:
    def __init__(self, x: np.ndarray, langs: list[str]) -> None:
        names = sorted(set(langs))
        family_of = {code: family for family, codes in FAMILIES.items() for code in codes}
        self.langs = names
        group = [family_of.get(name, name) for name in names]
        self.families = sorted(set(group))
        self.members = [[k for k, g in enumerate(group) if g == f] for f in self.families]
        label = np.array([names.index(name) for name in langs], np.int64)
        family = np.array([self.families.index(g) for g in group], np.int64)[label] if names else label
        self.family_machines = np.array(
            [_machine(x, np.where(family == k, 1.0, -1.0)) for k in range(len(self.families))]
        ).reshape(len(self.families), x.shape[1] + 1)
        self.pairs = {}
        for members in self.members:
            for a, b in combinations(members, 2):
                rows = (label == a) | (label == b)
                self.pairs[a, b] = _machine(x[rows], np.where(label[rows] == a, 1.0, -1.0))

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        n = len(x)
        if not self.langs or not n:
            return [UNDETERMINED] * n, np.zeros(n)
        x = np.hstack([x, np.ones((n, 1))])
        best, sure = np.zeros(n, np.int64), np.ones(n)
        if len(self.families) > 1:
            margins = x @ self.family_machines.T
            best = margins.argmax(axis=1)
            top = np.partition(margins, -2, axis=1)
            sure = _sigmoid(top[:, -1] - top[:, -2])
        out = np.empty(n, np.int64)
        for k, members in enumerate(self.members):
            rows = np.flatnonzero(best == k)
            if len(members) == 1 or not len(rows):
                out[rows] = members[0]
                continue
            # Votes, then the sum of what speaks for a language, decide.
            votes, speaks = np.zeros((len(rows), len(members))), np.zeros((len(rows), len(members)))
            for i, j in combinations(range(len(members)), 2):
                p = _sigmoid(2 * (x[rows] @ self.pairs[members[i], members[j]]))
                votes[:, i] += p >= 0.5
                votes[:, j] += p < 0.5
                speaks[:, i] += p
                speaks[:, j] += 1 - p
            speaks /= len(members) - 1
            first = (votes + speaks / len(members)).argmax(axis=1)
            out[rows] = np.array(members)[first]
            sure[rows] *= speaks[np.arange(len(rows)), first]
        return [self.langs[k] for k in out], sure


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


# ---------------------------------------------------------------- on tables


def _vectors(df: DataFrame, text: str, lang: str) -> DataFrame:
    def run(block: pa.RecordBatch) -> pa.RecordBatch:
        found = [features(t) for t in block.column(text).to_pylist()]
        keep = [k for k, f in enumerate(found) if f is not None]
        return pa.record_batch(
            {
                "lang": block.column(lang).take(pa.array(keep, pa.int64())),
                "vector": pa.array([found[k].astype("<f4").tobytes() for k in keep], pa.binary()),
            }
        )

    return map_blocks(df.select(lang, text), run, "lang string, vector binary", text)


def fit(
    labelled: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    per_language: int = PER_LANGUAGE,
) -> Model:
    """From rows whose language is not null: all different ones of a language, or ``per_language`` of
    them by a hash of key and text; of the ``LANGUAGES`` that have the most different rows.
    """
    labelled = labelled.where(F.col(lang).isNotNull() & F.col(key).isNotNull()).select(
        F.col(lang).alias("lang"), F.col(text).alias("text"),
        F.xxhash64(F.col(key).cast("string"), text).alias("row"),
    )
    # Rows that share a key are told apart by their texts, and equal rows count once: however often
    # a row repeats, it is neither all that is drawn nor all that is missed.
    different = labelled.select("lang", "row").distinct().groupBy("lang")
    sizes = (
        different.agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES)
    ).collect()
    per_language = max(1, min(per_language, SAMPLE // max(1, len(sizes))))
    # Shares of a hash's range that hold a little more than the bound; the bound then cuts.
    place = F.pmod("row", F.lit(1 << 30))
    shares = {
        r["lang"]: min(1 << 30, int((1 << 30) * 1.2 * (per_language + 20) / r["n"])) for r in sizes
    }
    share = F.coalesce(F.try_element_at(_literal_map(shares), F.col("lang")), F.lit(0))
    drawn = labelled.where(place < share).dropDuplicates(["lang", "row"])
    rows = to_driver(_vectors(drawn, "text", "lang"), 2 * (per_language + 20) * len(sizes) + 100)
    taken: dict[str, list[bytes]] = {}
    for row in sorted(rows, key=lambda r: (r["lang"], bytes(r["vector"]))):
        taken.setdefault(row["lang"], []).append(bytes(row["vector"]))
    # Evenly spaced in the order of the vectors, so that the order of tasks does not matter.
    cut = {}
    for name, v in taken.items():
        n = min(len(v), per_language)
        cut[name] = [v[k * len(v) // n] for k in range(n)]
    raw = b"".join(b"".join(v) for v in cut.values())
    x = np.frombuffer(raw, "<f4").reshape(-1, WIDTH).astype(np.float64)
    return Model(x, [name for name, v in cut.items() for _ in v])


def _literal_map(values: dict[str, int]) -> Column:
    pairs = [F.lit(v) for pair in values.items() for v in pair]
    return F.create_map(*pairs) if pairs else F.create_map().cast("map<string,int>")


def predict(
    df: DataFrame, model: Model, text: str = "text", into: tuple[str, str] = ("lang_pred", "score")
) -> DataFrame:
    """Adds the language and the score, replacing columns of those names."""
    df = df.drop(*into)
    sent = df.sparkSession.sparkContext.broadcast(model)  # WIDTH + 1 numbers for each machine

    def run(block: pa.RecordBatch) -> pa.RecordBatch:
        found = [features(t) for t in block.column(text).to_pylist()]
        keep = [k for k, f in enumerate(found) if f is not None]
        x = np.array([found[k] for k in keep]).reshape(len(keep), WIDTH)
        names, sure = sent.value.predict(x)
        langs, scores = [UNDETERMINED] * len(found), np.zeros(len(found))
        for k, name, score in zip(keep, names, sure, strict=True):
            langs[k], scores[k] = name, score
        out = block.append_column(into[0], pa.array(langs, pa.string()))
        return out.append_column(into[1], pa.array(scores))

    schema = df.select("*", F.lit("").alias(into[0]), F.lit(0.0).alias(into[1])).schema
    return map_blocks(df, run, schema, text)


def held_out(key: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 3 == 1, F.lit(False))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.where(~held_out()))
    marked = docs.select("doc_id", held_out().alias("held_out"), "text")
    return predict(marked, model).select("doc_id", "held_out", "lang_pred", "score")
