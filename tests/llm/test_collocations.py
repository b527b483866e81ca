"""Collocations against a brute-force count, also where fingerprints collide."""

import re
from collections import Counter, defaultdict

import pytest

from vigilog.llm.collocations import Fingerprints, collocations, cut, normal

UP = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def brute(rows, least, top=2000, most=4):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(UP)):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, most + 1):
                f.update((lang, tuple(w[i : i + k])) for i in range(len(w) - k + 1))
    found = {k: v for k, v in f.items() if len(k[1]) > 1 and v >= least}
    inside = {
        (lang, p[i : i + s])
        for (lang, p), v in found.items()
        for s in range(2, len(p))
        for i in range(len(p) - s + 1)
        if 100 * v >= 80 * found[lang, p[i : i + s]]
    }
    by_lang = defaultdict(list)
    for (lang, p), a in found.items():
        if (lang, p) not in inside:
            score, k = min((2000000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k) for k in range(1, len(p)))
            by_lang[lang].append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted(
        (lang, place, p.decode(), -a, left, right, n[lang], -score)
        for lang, own in by_lang.items()
        for place, (score, a, p, left, right) in enumerate(sorted(own)[:top], 1)
    )


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


def test_counts_by_text_even_where_fingerprints_collide(documents):
    rows = [tuple(r) for r in documents.select("lang", "text").collect()]
    expected = brute(rows, least=5)
    assert len(expected) > 100
    assert rows_of(collocations(documents, least=5)) == expected
    # Fingerprints of 12 bits and small slices: nearly every fingerprint stands for several phrases.
    assert rows_of(collocations(documents, least=5, slice_bytes=20_000, bits=12)) == expected


def test_odd_rows(spark):
    rows = [
        (None, "New York, new  york\tNEW york!"), ("und", "new york"), ("en", None), ("en", ""), ("en", " .,;\n\t"),
        ("en", "a a a a a"), ("en", "a a a a a"), ("en", "É é É é"), ("fr", "l'eau l'eau\x0bl'eau l'eau"),
        ("en", "x\xa0y z x\xa0y z"), ("en", "word " * 30_000), ("de", "b c d. b c d. b c d"), ("", "q r q r"),
    ]
    ddl = "lang string, text string, n bigint, phrase string, slice string"
    df = spark.createDataFrame([(*r, 1, "clash", "clash") for r in rows], ddl)
    for least, top in ((2, 2000), (2, 1), (1, 2000)):
        assert rows_of(collocations(df, least=least, top=top)) == brute(rows, least, top)
    # One piece is never cut; a text of many pieces is, between them.
    assert rows_of(collocations(df, least=2, slice_bytes=16)) == brute(rows, 2)
    assert collocations(df.limit(0)).collect() == []


def test_sums_do_not_overflow(spark):
    from vigilog.llm.collocations import scored

    big = 2**61
    rows = [("en", 1, "a", big), ("en", 1, "b", big + 1), ("en", 2, "a b", big), ("en", 3, "a b c", big - 1),
            ("en", 1, "c", big), ("en", 2, "b c", 2**62)]
    found = {r.phrase: r.score for r in scored(spark.createDataFrame(rows, "lang string, n int, phrase string, f bigint")).collect()}
    assert found == {
        "b c": 2000000 * 2**62 // (2 * big + 1),
        "a b c": 2000000 * (big - 1) // (big + 2**62),
    }


def test_normal_texts_and_cuts():
    assert normal(b" A\tb  C. \n d ;") == b"a b c\nd"
    assert normal(b"") == normal(b" .,") == b""
    assert list(cut(b"aa bb\ncc\ndd", 6)) == [b"aa bb", b"cc\ndd"]
    assert b"\n".join(cut(b"x y z w\na b\nc", 3)) == b"x y z w\na b\nc"


def test_fingerprints_are_equal_for_equal_phrases_wherever_they_stand():
    state = Fingerprints()
    seen = {}
    for body in (b"a bb a bb c\nbb c a bb", b"zz a bb c\nc a bb"):
        state.read("en", body)
        for n in range(1, 5):
            at, prints = state.grams(n)
            texts = state.phrases(at, n).to_pylist()
            assert all("\n" not in t and t.count(" ") == n - 1 for t in texts)
            for text, print_ in zip(texts, prints.tolist(), strict=True):
                assert seen.setdefault(text, print_) == print_
    assert len(set(seen.values())) == len(seen)
