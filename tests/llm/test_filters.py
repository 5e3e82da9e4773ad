"""Page rules and trust, revisits, language and line rules."""

import re

import pytest
from helpers import WORD, awkward_texts, documents
from pyspark.sql import functions as F

from wardlake.llm import language, line_cleaning, link_trust, queries, revisits
from wardlake.registry.compare import differences

PAGES = "page_id bigint, url string, html string, host string, rule string, trust string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], PAGES)


def plain_rule(url, rules):
    if url is None or "://" not in url:
        return "", "", None, None
    after = url[url.index("://") + 3 :]
    host = re.match(r"[^/?#]*", after)[0]
    path = re.match(r"[^?#]*", after[len(host) :])[0]
    host = "".join(c.lower() if c.isascii() else c for c in host)
    fits = []
    for says, text in rules:
        name, begin = text.split("/", 1)
        if (host == name or host.endswith("." + name)) and path.startswith("/" + begin):
            fits.append((len(text), says == "block", text, says))
    best = max(fits, default=(0, False, None, None))
    return host, path, best[2], best[3]


def test_rules(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://A.Org/x?y#z", "http://org", "http://org/", "http://x.example.org/es/1", "a://example.org/en/12#f"]
    urls += ["http://my.com/fr/1", "http://my.com/de/", "http://my.com?/de/", "http://xorg/", "http://b.org/a://c.com/de/", "http://my.com/de\n/", "http://É.org/a"]
    rows = [(k, u, None) for k, u in enumerate(urls)]
    got = link_trust.judged_pages(pages(spark, rows + rows), queries.RULES).collect()
    assert len(got) == 2 * len(rows)
    for row in got:
        host, path, rule, verdict = plain_rule(urls[row.page_id], queries.RULES)
        assert (row.host, row.path, row.rule) == (host, path, rule)
        assert row.verdict == (verdict or ("block" if row.distrust > row.trust else "allow"))


def test_trust_spreads_along_links(spark):
    link = lambda *hosts: "".join(f'<a href="http://{h}/x">' for h in hosts)
    rows = [
        (1, "http://good.org/", link("friend.net", "GOOD.org", "friend.net") + '<img src=//pics.net/a.png>'),
        (2, "http://bad.com/de/1", link("victim.net")),
        (3, "http://farm.net/", link("bad.com", "friend.net")),
        (4, "http://outer.net/", link("farm.net")),
        (5, "http://friend.net/", None),
        (6, "http://victim.net/", "<p>no links"),
        (7, "http://lonely.net/", ""),
    ]
    got = {r.page_id: r for r in link_trust.judged_pages(pages(spark, rows), queries.RULES).collect()}
    assert {k: r.verdict for k, r in got.items()} == {1: "allow", 2: "block", 3: "block", 4: "block", 5: "allow", 6: "allow", 7: "allow"}
    unit, d = link_trust.UNIT, link_trust.DAMPING
    assert got[5].trust == int(unit * d * 2 / 3) and got[3].distrust == int(unit * d)
    assert got[4].distrust == int(int(unit * d) * d) and got[6].distrust == 0
    assert link_trust.judged_pages(pages(spark, rows).where("false"), queries.RULES).count() == 0


def test_spread_settles_on_a_cycle(spark):
    seeds = spark.createDataFrame([("a", 1000, 0)], "host string, trust bigint, distrust bigint")
    links = spark.createDataFrame([("a", "b", 1), ("b", "a", 1)], "src string, dst string, links bigint")
    got = {r.host: r.trust for r in link_trust.spread(seeds, links, damping=0.5).collect()}
    assert abs(got["a"] - 1333) <= 2 and abs(got["b"] - 666) <= 2


def test_distrust_reaches_along_a_deep_chain(spark):
    """Each host of a chain links to the next, the last is blocked: passing ends only where less than a unit is left."""
    link = '<a href="http://h{}.net/">'
    rows = [(i, f"http://h{i}.net/", link.format(i + 1)) for i in range(60)] + [(60, "http://h60.net/", '<a href="http://bad.com/">')]
    rows.append((61, "http://bad.com/de/x", None))
    got = {r.page_id: r for r in link_trust.judged_pages(pages(spark, rows), queries.RULES).collect()}
    left = link_trust.UNIT
    for i in range(60, -1, -1):
        left = int(left * link_trust.DAMPING)
        assert (got[i].distrust, got[i].verdict) == (left, "block")
    with pytest.raises(ValueError):
        link_trust.spread(None, None, damping=1.0)


CAPTURES = "record_id bigint, url string, captured_at bigint, kind string, headers map<string,string>, digest string, key string, at string"


def captures(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], CAPTURES)


@pytest.mark.parametrize("slices", [1, 3, 50])
def test_revisits(spark, slices):
    rows = [
        (1, "http://www.a.org/p/", 10, "response", {"ETag": '"v1"', "Content-Length": "9", "Date": "d1"}, "s1"),
        (2, "https://A.org/p#x", 20, "revisit", {"etag": 'W/"v1"', "DATE": "d2", "content-length": "0", "Set-Cookie": "c"}, None),
        (3, "http://a.org/p", 30, "response", {"etag": '"v2"'}, None),
        (4, "http://a.org/p?utm_source=f", 30, "revisit", {"etag": '"v2"'}, None),
        (5, "http://a.org/p", 40, "revisit", {"etag": '"v2"', "vary": None}, "s9"),
        (6, "http://a.org/p", 50, "revisit", None, None),
        (7, "http://a.org/p?q=1", 60, "revisit", {"etag": '"v2"'}, None),
        (8, None, 60, "revisit", {"etag": '"v2"'}, None),
        (9, "http://a.org/p", None, "revisit", {}, None),
        (10, "http://a.org/p", 70, "request", {}, None),
        (11, "http://a.org/p", 30, "response", {"etag": '"v3"'}, None),
        (12, "http://a.org/p", 80, "revisit", {"etag": '"v3"'}, None),
        (12, "http://a.org/p", 80, "revisit", {"etag": '"v3"'}, None),
    ]
    got = revisits.resolve_revisits(captures(spark, rows), slices).collect()
    found = {r.record_id: (r.response_id, r.outcome) for r in got}
    assert len(got) == 9
    assert found == {
        2: (1, "matched"), 4: (1, "changed"), 5: (11, "changed"), 6: (11, "unverified"), 7: (None, "no_response"),
        8: (None, "no_response"), 9: (None, "no_response"), 12: (11, "matched"),
    }
    merged = next(r.headers for r in got if r.record_id == 2)
    assert merged == {"etag": 'W/"v1"', "date": "d2", "content-length": "9"}
    assert next(r.headers for r in got if r.record_id == 5) is None
    assert revisits.resolve_revisits(captures(spark, rows).where("false"), slices).count() == 0


def test_revisit_query_equals_sql(spark, small):
    assert not differences(queries.op2_revisits(spark, small), queries.oracle_sql()["op2_revisits"], small)[1]


def test_line_query_equals_sql(spark, small):
    assert not differences(queries.op7_line_cleaning(spark, small), queries.oracle_sql()["op7_line_cleaning"], small)[1]


def base_counts(text):
    words = WORD.findall(text or "")
    windows = list(zip(words, words[1:], words[2:], strict=False))
    seen = {}
    for w in windows:
        seen[w] = seen.get(w, 0) + 1
    covered = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(3)}
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def test_base_counts(spark):
    texts = [*awkward_texts(), "a b c a b c a b c", "x y z\nx y z\n\nq", "1 2 3 4 1 2 3 5 2 3 4"]
    for row in line_cleaning.with_line_cleaning(documents(spark, texts)).collect():
        got = (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words)
        assert got == base_counts(texts[row.doc_id])
        n, repeated = got[0], got[4]
        assert row.base_failed == (n < 50 or 100 * repeated > 50 * n)
    assert line_cleaning.with_line_cleaning(documents(spark, texts).where("false")).count() == 0


def test_lines_go_before_documents(spark):
    good = "\n".join(" ".join(f"w{k}x{j}" for j in range(9)) + "." for k in range(12))
    noise = "Home | News | About | Contact\nAll rights reserved.\nword### word$$$ word%%%.\nWOW!! NOW!! BUY!!\nno mark at all"
    first = good.split("\n")[0]
    menu = "\n".join(f"One{k} | Two{k} | Three{k} | Four{k} | Five{k} | Six{k} |" for k in range(40))
    texts = [good, f"{noise}\n{good}\n{first}", f"{good}\n{menu}", None]
    rows = {r.doc_id: r for r in line_cleaning.with_line_cleaning(documents(spark, texts)).collect()}
    assert rows[0].kept and rows[0].clean_text == good and rows[0].lost_share == 0
    assert rows[1].kept and rows[1].clean_text == good
    assert rows[1].lines_failed == {"navigation": 1, "punctuation": 3, "boilerplate": 2}
    assert not rows[2].kept and not rows[2].base_failed
    assert not rows[3].kept and rows[3].lost_share is None


def test_sentence_marks_of_other_scripts(spark):
    lines = [
        "यह एक साधारण वाक्य है जो दण्ड पर समाप्त होता है {}।", "এটি একটি সাধারণ বাক্য যা দাঁড়ি দিয়ে শেষ হয় {}।", "یہ ایک عام جملہ ہے جو وقفے پر ختم ہوتا ہے {}۔",
        "هل هذه جملة عادية تنتهي بعلامة استفهام {}؟", "これ は 普通 の 文 です {}。", "นี่ คือ ประโยค ธรรมดา ที่ ไม่มี เครื่องหมาย {}", "ይህ ተራ ዓረፍተ ነገር ነው {}።",
    ]
    texts = ["\n".join(line.format(k) for k in range(12)) for line in lines] + ["\n".join(f"no mark in this line at all {k}" for k in range(12))]
    rows = {r.doc_id: r for r in line_cleaning.with_line_cleaning(documents(spark, texts)).collect()}
    assert [rows[i].lost_share for i in range(len(texts))] == [0.0] * len(lines) + [1.0]


def test_quality_verdict_follows_the_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    judged = line_cleaning.with_line_cleaning(docs).where("not base_failed").join(labels, "doc_id")
    share = {r.quality: r.kept for r in judged.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert share[1] > 0.98 and share[0] < 0.3


def test_language_on_held_out_documents(spark):
    got = queries.op4_language(spark, "/root/testdata/sf0.01")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    held = got.where("held_out").join(docs, "doc_id")
    assert held.where("lang = lang_pred").count() >= 0.98 * held.count() > 100
    assert got.where("score < 0 or score > 1").isEmpty()


def test_language_of_nothing(spark):
    docs = documents(spark)
    model = language.fit(docs, F.lit(True))
    rows = language.with_language(docs, model).collect()
    assert len(rows) == len(awkward_texts()) and rows[0].asDict().keys() >= {"ids", "n", "lang_pred", "score"}
    for row in rows:
        letters = any(c.isalpha() for c in row.text or "")
        assert row.lang_pred == ("en" if letters else "und") and (letters or row.score == 0)
    nothing = language.fit(docs.withColumn("lang", F.lit(None).cast("string")), F.lit(True))
    assert {r.lang_pred for r in language.with_language(docs, nothing).collect()} == {"und"}
    assert language.with_language(docs.where("false"), model).count() == 0


def test_related_languages_meet_in_a_second_step(spark):
    texts = {"en": "the house and the garden of this man with that", "de": "das haus und der garten von diesem mann mit dem", "fr": "la maison et le jardin de cet homme avec les", "es": "la casa y el jardin de este hombre con los"}
    rows = [(k, f"{t} {k}", lang) for k in range(40) for lang, t in texts.items()]
    model = language.fit(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"), F.lit(True))
    assert set(model.family_machines) == {"germanic", "romance"}
    assert set(model.pair_machines) == {("de", "en"), ("es", "fr")}
    assert all(model.predict(t)[0] == lang for lang, t in texts.items())
