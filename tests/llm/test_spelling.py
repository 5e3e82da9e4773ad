"""Spelling variants against all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest
from helpers import LOWER, awkward_texts, documents

from wardlake.llm import queries, spelling
from wardlake.llm.common import table


def plain_words(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", (text or "").translate(LOWER)):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def plain(counts):
    near = {w: [] for w in counts}
    words = sorted(counts, key=len)
    for i, a in enumerate(words):
        for b in words[i + 1 :]:
            if len(b) > len(a) + 1:
                break
            if one_edit(a, b):
                near[a].append(b)
                near[b].append(a)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        form[w] = best if best is not None and counts[best] >= 10 * counts[w] else None
    out = {}
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, counts[w], len(near[w]), counts.get(form[w]))
    return out


def as_rows(df):
    got = df.collect()
    assert len(got) == len({r.word for r in got})
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in got}


def some_counts():
    rng = random.Random(9)
    counts = {}
    for _ in range(60):
        word = "".join(rng.choice("abeinstéÿ") for _ in range(rng.randint(7, 12)))
        counts[word] = rng.choice([2, 30, 500, 20_000])
        for _ in range(rng.randint(0, 12)):
            at, letter = rng.randrange(len(word)), rng.choice("abeinstz")
            word = rng.choice([word[:at] + word[at + 1 :], word[:at] + letter + word[at:], word[:at] + letter + word[at + 1 :], word])
            counts.setdefault(word, rng.choice([2, 3, 30, 300, 400]))
    counts = {w: n for w, n in counts.items() if len(w) >= 7}
    return counts | {"aaaaaaa": 5, "aaaaaaaa": 50, "aaaaaaaaa": 500, "baaaaaa": 50, "caaaaaa": 50, "x" * 5000: 2, "x" * 4999 + "y": 30, "x" * 5001: 2}


@pytest.mark.parametrize("tile", [4096, 5])
def test_groups_equal_all_pairs(spark, tile):
    counts = some_counts()
    df = spark.createDataFrame([(w, n, "x", "y") for w, n in counts.items()], "word string, n bigint, form string, block string")
    assert as_rows(spelling.spelling_groups(df, tile=tile)) == plain(counts)


def test_words_beyond_latin(spark):
    counts = {"русские": 5, "русский": 50, "русскиий": 2, "漢字漢字漢字漢": 3, "漢字漢字漢字": 40}
    df = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    assert as_rows(spelling.spelling_groups(df)) == plain(counts)


def test_words_of_odd_texts(spark):
    texts = [*awkward_texts(), "ÀÉcrire ÀÉcrire straße×÷ straße×÷ Straße×÷", "Wonderful wonderful wonderfull wonderful"]
    ids = [None if k % 9 == 0 else k for k in range(len(texts))]
    docs = documents(spark, texts * 2, ids * 2)
    counts = plain_words(list(zip(ids, texts, strict=True)) * 2)
    found = spelling.word_counts(spelling.damaged_words(docs))
    assert {r.word: r.n for r in found.collect()} == counts
    assert as_rows(spelling.spelling_groups(found)) == plain(counts)
    assert spelling.spelling_groups(found.limit(0)).count() == 0


def test_given_documents(spark, small):
    rows = [tuple(r) for r in table(spark, small, "documents").select("doc_id", "text").collect()]
    assert as_rows(queries.op13_spelling(spark, small)) == plain(plain_words(rows))
