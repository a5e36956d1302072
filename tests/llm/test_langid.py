"""Language ID: accuracy on held-out documents, and edge rows."""

import random
from collections import Counter
from zlib import crc32

import numpy as np
import pytest

from fanwrite.llm import langid
from fanwrite.llm.catalog import op5_langid


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    lang = {r[0]: r[1] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    rows = op5_langid(spark, sf).collect()
    assert len(rows) == len(lang)
    assert all(r["held_out"] == (crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held_out"] and lang[r["doc_id"]]]
    assert len(held) > 100 and sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) / len(held) > 0.97


def test_the_prediction_rests_on_the_text_only(make_docs):
    rows = [(i, "the house and the garden of them", "en") for i in range(40)] + [(100 + i, "der garten und das haus von ihnen", "de") for i in range(40)]
    docs = make_docs(rows)
    learned = langid.learn(docs)
    assert learned.languages == ["de", "en"]
    asked = make_docs([(None, "the garden", "de"), (900, "das haus", None), (901, "THE GARDEN!", "xx")])
    got = [r["lang_pred"] for r in langid.predict(asked, learned).orderBy("doc_id").collect()]
    assert got == ["en", "de", "en"]


def test_edge_rows(make_docs, no_docs):
    docs = make_docs([(1, None, "en"), (2, "", "en"), (3, "123 !?", "en"), (6, "wörter " * 50_000, None), (7, "hello there", "en"), (7, "hello there", "en")])
    got = sorted((r["doc_id"], r["lang_pred"]) for r in langid.identify(docs).collect())
    assert got == [(1, "und"), (2, "und"), (3, "und"), (6, "en"), (7, "en"), (7, "en")]
    unlabelled = make_docs([(1, "hello", None), (None, "x", "en")])
    assert [tuple(r)[1:] for r in langid.identify(unlabelled).collect()] == [(crc32(b"1") % 5 == 0, "und", 0.0), (False, "und", 0.0)]
    assert langid.identify(no_docs).count() == 0


def test_the_stage_leaves_columns_of_its_names_alone(spark, make_docs):
    import corpus_pipeline

    extra = ("score", "_lang", "_judged", "_judged_")
    docs = make_docs([(1, "the house and the garden", "en"), (2, "the garden", None), (3, "123", "en")]).selectExpr("*", *(f"'mine' AS {c}" for c in extra))
    got = corpus_pipeline.language_id(spark, docs, "")
    assert got.columns == docs.columns
    assert sorted((r["doc_id"], r["lang"], r["lang_pred"], *(r[c] for c in extra)) for r in got.collect()) == [(i, "en", "x", *["mine"] * 4) for i in (1, 2)]


def plain_profile(text):
    """Triples of lower-case letters, runs of others as one space, bound and bundled one by one."""
    letters = " ".join("".join(c.lower()[0] if c.isalpha() else " " for c in text or "").split(" ")).split()
    if not letters:
        return None
    padded = [0, *(x for word in letters for x in [*map(ord, word), 0])]
    out = np.zeros(langid.DIMENSIONS)
    for (a, b, c), n in Counter(zip(padded, padded[1:], padded[2:])).items():
        out += float(n) * np.roll(langid.letter_vector(a), 2) * np.roll(langid.letter_vector(b), 1) * langid.letter_vector(c)
    return out / np.linalg.norm(out)


def plain(rows):
    """All rows (key, text, lang) judged by prototypes of all labelled ones that are not held out."""
    found = [plain_profile(t) for _, t, _ in rows]
    sums = {}
    for (key, _, lang), profile in zip(rows, found):
        if lang is not None and profile is not None and key is not None and crc32(str(key).encode()) % 5:
            sums[lang] = sums.get(lang, 0) + profile
    names = sorted(sums)
    out = []
    for profile in found:
        cosines = [float(sums[n] @ profile / np.linalg.norm(sums[n])) for n in names] if profile is not None else []
        best = max(range(len(cosines)), key=lambda k: (cosines[k], -k), default=None)
        out.append(("und", 0.0) if best is None else (names[best], max(0.0, cosines[best])))
    return out


def test_whole_table_equals_plain_profiles(spark, sf_small):
    table = spark.read.parquet(f"{sf_small}/documents.parquet")
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in table.collect()]
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in op5_langid(spark, sf_small).collect()}
    for (key, _, _), (name, score) in zip(rows, plain(rows)):
        assert got[key][0] == name and got[key][1] == pytest.approx(score, abs=1e-5)


def test_ties_go_to_the_first_language(make_docs):
    docs = make_docs([(i, "same words", "bb" if i % 2 else "aa") for i in range(1, 9)])
    assert {r["lang_pred"] for r in langid.identify(docs).collect()} == {"aa"}


SCRIPTS = {"Cyrillic": (0x430, 32), "Arabic": (0x620, 42), "Greek": (0x3B1, 24), "Han": (0x4E00, 200), "Ethiopic": (0x1200, 80), "Latin": (0x61, 26)}


def test_languages_of_other_scripts_are_told_apart(spark):
    """Two made-up languages a script: the same letters, other habits of putting them together."""
    rnd = random.Random(1)

    def language(first, size):
        habits = {c: rnd.sample(range(size), 5) for c in range(size)}

        def word():
            c, out = rnd.randrange(size), []
            for _ in range(rnd.randint(2, 7)):
                c = rnd.choice(habits[c])
                out.append(chr(first + c))
            return "".join(out)

        return lambda n: " ".join(word() for _ in range(n))

    rows = []
    for name, (first, size) in SCRIPTS.items():
        for k in "ab":
            speak = language(first, size)
            rows += [(f"{name}-{k}", speak(40)) for _ in range(60)]
    docs = spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(rows)], "doc_id bigint, text string, lang string")
    got = {r["doc_id"]: r["lang_pred"] for r in langid.identify(docs).where("held_out").collect()}
    right = Counter(rows[i][0].split("-")[0] for i, name in got.items() if rows[i][0] == name)
    asked = Counter(rows[i][0].split("-")[0] for i in got)
    assert all(right[s] >= 0.9 * asked[s] > 0 for s in SCRIPTS), (right, asked)


def test_every_letter_has_its_own_vector_however_many_there_are(monkeypatch):
    vectors = [langid.letter_vector(c) for c in (0x431, 0x631, 0xC31, 0x1231, 0x61, 0)]
    assert all(abs(int(a.astype(int) @ b)) < 200 for i, a in enumerate(vectors) for b in vectors[:i])
    text = "".join(map(chr, range(0x4E00, 0x4E00 + 3000)))
    whole = next(langid.profiles([text]))
    monkeypatch.setattr(langid, "LETTERS", 700)
    monkeypatch.setattr(langid, "CHUNK", 200)
    monkeypatch.setattr(langid, "letters", lambda held=langid.Letters(): held)
    assert np.allclose(next(langid.profiles([text])), whole)
