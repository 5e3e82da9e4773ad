"""The pipeline against brute-force versions of its stages, each on what the one before kept."""

import corpus_pipeline
import numpy as np
from helpers import components, documents, shingles

from wardlake.llm import line_cleaning
from wardlake.llm.queries import BYTE_VOCABULARY


def test_stages_one_after_another(spark, small):
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{small}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language", "quality", "near duplicates", "packing"]
    stages = [f for _, f in corpus_pipeline.STAGES]

    first = spark.createDataFrame(stages[0](spark, docs, small).collect(), docs.schema)
    letters = {r.doc_id for r in docs.collect() if any(c.isalpha() for c in r.text or "")}
    assert {r.doc_id for r in first.collect()} <= letters and first.columns == docs.columns
    assert first.count() >= 0.98 * len(letters)

    second = spark.createDataFrame(stages[1](spark, first, small).collect(), docs.schema)
    judged = {r.doc_id: r for r in line_cleaning.with_line_cleaning(first).collect()}
    assert {r.doc_id: r.text for r in second.collect()} == {i: r.clean_text for i, r in judged.items() if r.kept}
    assert all(r.n_chars == len(r.text) for r in second.collect()) and second.columns == docs.columns

    third = spark.createDataFrame(stages[2](spark, second, small).collect(), docs.schema)
    sets = {r.doc_id: shingles(r.text) for r in second.collect()}
    near = lambda a, b: bool(sets[a]) and bool(sets[b]) and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    groups = components(sorted(sets), near)
    assert {r.doc_id for r in third.collect()} == set(groups.values()) and third.columns == docs.columns
    assert len(set(groups.values())) < len(groups)

    library = Tokenizer.from_file(BYTE_VOCABULARY)
    rebuilt: dict[int, list] = {}
    for p in sorted(stages[3](spark, third, small).collect(), key=lambda p: (p.doc_id, p.start)):
        rebuilt.setdefault(p.doc_id, []).extend(np.frombuffer(p.ids, "<u2").tolist())
    assert rebuilt == {r.doc_id: [*library.encode(r.text, add_special_tokens=False).ids, 0] for r in third.collect()}


def test_stages_of_nothing_and_awkward_rows(spark, small):
    docs = documents(spark).select("doc_id", "text", "lang", "source", "n_chars")
    nothing, some = docs.where("false"), docs.unionByName(docs)
    for _, stage in corpus_pipeline.STAGES:
        nothing, some = stage(spark, nothing, small), stage(spark, some, small)
        assert nothing.count() == 0
    assert some.count() >= 0


def test_repeated_rows_leave_one_document(spark, small):
    texts = ["one two three four five six seven", "one two three four five six seven", "another text of six words here"]
    docs = documents(spark, [*texts, "no id"], [1, 2, 3, None]).select("doc_id", "text", "lang", "source", "n_chars")
    got = corpus_pipeline.without_near_copies(spark, docs.unionByName(docs), small).collect()
    rows = sorted(((r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in got), key=str)
    none = (None, "no id", "en", "s", 5)
    assert rows == [(1, texts[0], "en", "s", len(texts[0])), (3, texts[2], "en", "s", len(texts[2])), none, none]
