"""Language identification in two steps: the family first, then the language among its relatives.

Texts become counts of letter groups of one to three characters, hashed to a fixed width. A linear support vector
machine for each family against the rest picks the family; inside it, one machine for each pair of languages votes.
The machines are fitted on a bounded sample of labelled rows: about ``SAMPLE`` rows over all languages, the same share
of each language's hashes at every run. Labels are counted over all rows. Prediction uses the text only, the whole of it.

A null text, or one without a letter, is ``und`` with score 0; so is everything if no row has a label to learn from.
Rows with equal or null ids stay apart, and an empty table gives no rows.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlake.llm.common import map_batches, texts_of

# Bound of the sample: labelled rows over all languages.
SAMPLE = 6000
# Languages with fewer labelled rows than this are not learned.
LEAST_ROWS = 5
WIDTH = 1 << 11
EPOCHS = 12
REGULAR = 1e-4
UNDETERMINED = "und"

# Families of languages; a language that is not listed is a family of its own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "af", "sv", "da", "no", "nb", "nn", "is"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl"),
    "slavic": ("ru", "uk", "be", "bg", "pl", "cs", "sk", "sl", "hr", "sr", "bs", "mk"),
    "uralic": ("fi", "et", "hu"),
    "turkic": ("tr", "az", "kk", "uz"),
    "indic": ("hi", "ur", "bn", "mr", "gu", "pa", "ne"),
    "semitic": ("ar", "he", "fa"),
}


def family_of(language: str) -> str:
    return next((f for f, members in FAMILIES.items() if language in members), language)


@lru_cache(maxsize=1)
def letter_table() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def letter_groups(text: str) -> np.ndarray | None:
    """Hashed counts of letter groups, square-rooted and of unit length; None without a letter."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", errors="replace"), "<u4").astype(np.uint64)
    letters = letter_table()[codes]
    if not letters.any():
        return None
    codes = np.where(letters, codes, np.uint64(32))
    # Runs of other characters count as one border of a word.
    keep = letters | np.append(True, letters[:-1])
    codes = np.concatenate([[np.uint64(32)], codes[keep], [np.uint64(32)]]).astype(np.uint64)
    one = codes * np.uint64(0x9E3779B97F4A7C15)
    two = (one[:-1] ^ (codes[1:] * np.uint64(0xC2B2AE3D27D4EB4F))) * np.uint64(0x165667B19E3779F9)
    three = (two[:-1] ^ (codes[2:] * np.uint64(0x27D4EB2F165667C5))) * np.uint64(0x9E3779B97F4A7C15)
    places = (np.concatenate([one, two, three]) >> np.uint64(64 - WIDTH.bit_length() + 1)).astype(np.int64)
    counts = np.sqrt(np.bincount(places, minlength=WIDTH).astype(np.float32))
    return counts / np.linalg.norm(counts)


def fitted_machine(rows: np.ndarray, positive: np.ndarray, seed: int) -> np.ndarray:
    """Linear support vector machine (weights and offset) by averaged subgradient steps; classes weigh alike."""
    sides = np.where(positive, 1.0, -1.0).astype(np.float32)
    share = positive.mean()
    weight = np.where(positive, 0.5 / max(share, 1e-9), 0.5 / max(1 - share, 1e-9)).astype(np.float32)
    wide = np.hstack([rows, np.ones((len(rows), 1), np.float32)])
    w, total = np.zeros(wide.shape[1], np.float32), np.zeros(wide.shape[1], np.float64)
    rng, step, taken = np.random.default_rng(seed), 0, 0
    for epoch in range(EPOCHS):
        order = rng.permutation(len(rows))
        for k in range(0, len(order), 32):
            some = order[k : k + 32]
            step += 1
            rate = 8.0 / (1 + 8.0 * REGULAR * step)
            short = sides[some] * (wide[some] @ w) < 1
            w *= 1 - rate * REGULAR
            pull = (sides[some] * weight[some] * short) @ wide[some]
            w += (rate / len(some)) * pull
            if epoch >= EPOCHS // 2:
                total += w
                taken += 1
    return (total / max(taken, 1)).astype(np.float32)


@dataclass
class LanguageModel:
    """Machines of the families and of the pairs of languages inside each."""

    members: dict[str, list[str]]
    family_machines: dict[str, np.ndarray]
    pair_machines: dict[tuple[str, str], np.ndarray]

    def predict(self, text: str) -> tuple[str, float]:
        row = letter_groups(text) if self.members else None
        if row is None:
            return UNDETERMINED, 0.0
        row = np.append(row, np.float32(1))
        sure = lambda margin: 1 / (1 + np.exp(-4.0 * np.clip(margin, -20, 20)))
        margins = {f: float(m @ row) for f, m in self.family_machines.items()}
        family = max(margins, key=margins.__getitem__) if margins else next(iter(self.members))
        score = sure(margins[family]) if margins else 1.0
        wins = {language: [0, 0.0, np.inf] for language in self.members[family]}
        for (a, b), machine in self.pair_machines.items():
            if a in wins and b in wins:
                margin = float(machine @ row)
                for language, side in ((a, margin), (b, -margin)):
                    wins[language][0] += side > 0
                    wins[language][1] += side
                    wins[language][2] = min(wins[language][2], side)
        best = max(sorted(wins), key=lambda language: wins[language][:2])
        if len(wins) > 1:
            score *= sure(wins[best][2])
        return best, float(score)


def held_out(id_column: Column) -> Column:
    """The rows that are kept for measuring: a quarter, by the checksum of the id."""
    return F.coalesce(F.crc32(id_column.cast("string")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, learnable: Column, sample: int = SAMPLE) -> LanguageModel:
    """Fit on rows where ``learnable`` holds and ``lang`` is not null."""
    labelled = docs.where(learnable & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().where(f"count >= {LEAST_ROWS}").collect()}
    languages = sorted(counts)
    if not languages:
        return LanguageModel({}, {}, {})
    each = max(sample // len(languages), 1)
    cutoff = F.lit(None)
    for language in languages:
        share = min(1.0, each / counts[language])
        cutoff = F.when(F.col("lang") == language, int(share * (1 << 30))).otherwise(cutoff)
    chosen = labelled.where(F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(1 << 30)) < cutoff)

    def features(batch: pa.RecordBatch) -> dict:
        rows = [letter_groups(t) for t in texts_of(batch.column(1))]
        data = [None if r is None else r.astype(np.float16).tobytes() for r in rows]
        return {"lang": batch.column(0), "data": pa.array(data, pa.binary())}

    got = map_batches(chosen.select("lang", "text"), features, "lang string, data binary").where("data is not null")
    pairs = sorted((r["lang"], bytes(r["data"])) for r in got.collect())  # about ``sample`` rows of fixed width
    if not pairs:
        return LanguageModel({}, {}, {})
    names = np.array([p[0] for p in pairs])
    rows = np.frombuffer(b"".join(p[1] for p in pairs), np.float16).reshape(len(pairs), WIDTH).astype(np.float32)
    members: dict[str, list[str]] = {}
    for language in sorted(set(names.tolist())):
        members.setdefault(family_of(language), []).append(language)
    families = np.array([family_of(n) for n in names.tolist()])
    family_machines = {
        f: fitted_machine(rows, families == f, 11 + i) for i, f in enumerate(members) if len(members) > 1
    }
    pair_machines = {}
    for group in members.values():
        for a, b in itertools.combinations(group, 2):
            some = (names == a) | (names == b)
            pair_machines[a, b] = fitted_machine(rows[some], names[some] == a, 101)
    return LanguageModel(members, family_machines, pair_machines)


def with_language(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``; the other columns pass through as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    columns = [c for c in docs.columns if c not in ("lang_pred", "score")]
    at = columns.index("text")

    def run(batch: pa.RecordBatch) -> dict:
        got = [shared.value.predict(t) for t in texts_of(batch.column(at))]
        return dict(zip(columns, batch.columns, strict=True)) | {
            "lang_pred": pa.array([g[0] for g in got], pa.string()),
            "score": pa.array([g[1] for g in got], pa.float64()),
        }

    chosen = docs.select(*columns)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema)
    return map_batches(chosen, run, f"{schema}, lang_pred string, score double")
