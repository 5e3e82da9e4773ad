"""Small fixtures of documents with every awkward case, and brute-force versions of the operators."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, ids string, n string, part string"


def awkward_texts() -> list[str | None]:
    rng = random.Random(3)
    syllables = ["the", "ing", "an", "re", "ha", "tion", "é", "ñ", "ß", "漢", "\U0001f600", "'ll", "<|endoftext|>", "▁", "<s>"]
    mixed = ["".join(rng.choice([*syllables, " ", "  ", "\n", "\t", "\u00a0", "!", "7"]) for _ in range(rng.randint(0, 60))) for _ in range(60)]
    long = " ".join(rng.choice(["some", "long", "text", "of", "words", "und", "Wörter"]) + str(rng.randint(0, 99)) for _ in range(20_000))
    return [None, "", " ", "\n\n", "a", "aaaaaaaaaaaaaaaaaaaaaaaa", "x" * 30_000, long, long, "two words", *mixed]


def documents(spark, texts=None, ids=None):
    """Documents with columns beside the known ones whose names clash with those the operators make."""
    texts = awkward_texts() if texts is None else texts
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, "en", "s", len(t or ""), "x", "y", "z") for i, t in zip(ids, texts, strict=True)]
    return spark.createDataFrame(rows, DOCS)


def shingles(text: str | None, words: int = 5) -> frozenset:
    found = WORD.findall((text or "").translate(LOWER))
    if len(found) < words:
        return frozenset([tuple(found)] if found else [])
    return frozenset(zip(*(found[k:] for k in range(words)), strict=False))


def components(ids: list, linked) -> dict:
    """Smallest reachable id of each, where ``linked(a, b)`` says so."""
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, a in enumerate(ids):
        for b in ids[:k]:
            if linked(a, b):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {i: root(i) for i in ids}
