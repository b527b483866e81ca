"""The registered queries of the subpackage against SQL or a brute-force version."""

import base64
import hashlib
import re
import zlib
from collections import defaultdict

import corpus_pipeline
import pytest
from conftest import SF_DIR
from oracle_check import compare, connect

from vigilog.llm.oracle import ORACLE
from vigilog.llm.queries import QUERIES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet").toPandas().sort_values("doc_id")


@pytest.mark.parametrize("name", ORACLE)
def test_equals_its_sql(spark, con, name):
    assert compare(QUERIES[name](spark, SF_DIR), con, ORACLE[name]) is None


def test_there_is_one_query_for_each_operator():
    numbers = [int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES]
    assert sorted(numbers) == list(range(1, 14))


def test_op1_finds_exactly_the_documents_with_an_item(spark, docs):
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").toPandas()
    whole = {
        (d, i)
        for d, t in zip(docs.doc_id, docs.text, strict=True)
        for i, x in zip(items.item_id, items.text, strict=True)
        if x in t
    }
    found = QUERIES["op1_decontaminate"](spark, SF_DIR).toPandas()
    assert whole and whole <= set(zip(found.doc_id, found.item_id, strict=True))
    for r in found.itertuples():
        if (r.doc_id, r.item_id) in whole:
            text, item = docs.set_index("doc_id").text[r.doc_id], items.set_index("item_id").text[r.item_id]
            assert r.edits == 0 and r.covered == len(item) and text[r.start : r.end] == item


def test_op2_equals_a_loop_over_the_documents(spark, docs):
    found = QUERIES["op2_fingerprint"](spark, SF_DIR).toPandas().set_index("doc_id")
    texts = list(docs.text)
    assert sorted(found.index) == list(docs.doc_id)
    for n, doc_id in enumerate(docs.doc_id):
        text, after, row = texts[n], texts[(n + 1) % len(texts)], found.loc[doc_id]
        cut = len(text) // 4
        edited = text[: len(text) - cut] + after[:cut]
        assert row.n_chars == len(text)
        assert row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        if len(text) > 400:
            grams, changed = ({t[k : k + 12] for k in range(len(t) - 11)} for t in (text, edited))
            true = len(grams & changed) / len(grams | changed)
            assert abs(row.near_edited - true) < 4 * (true * (1 - true) * 8 / len(grams | changed)) ** 0.5 + 0.02
    by_text = defaultdict(set)
    for text, doc_id in zip(docs.text, docs.doc_id, strict=True):
        by_text[text].add(found.fingerprint[doc_id])
    assert all(len(p) == 1 for p in by_text.values())


def test_op4_finds_every_notice_in_the_texts(spark, docs):
    notices = {
        "Released under the MIT License": "MIT",
        "Licensed under the Apache License, Version 2.0": "Apache-2.0",
        "This work is licensed under the GNU General Public License, version 3": "GPL-3.0",
        "Licensed under CC BY-NC 4.0": "CC-BY-NC-4.0",
    }
    expected = sorted(
        (d, lic, m.start(), m.end())
        for d, t in zip(docs.doc_id, docs.text, strict=True)
        for words, lic in notices.items()
        for m in re.finditer(re.escape(words), t)
    )
    found = QUERIES["op4_license_scan"](spark, SF_DIR).toPandas()
    found = found[found.license != "All-Rights-Reserved"]  # the next test has these
    assert expected == sorted(zip(found.doc_id, found.license, found.start, found.end, strict=True))


def test_op4_finds_every_reserved_right(spark, docs):
    found = QUERIES["op4_license_scan"](spark, SF_DIR).toPandas()
    own = found[found.license == "All-Rights-Reserved"]
    expected = [(d, m.start(), m.end()) for d, t in zip(docs.doc_id, docs.text, strict=True) for m in re.finditer("All rights reserved", t)]
    assert expected and expected == sorted(zip(own.doc_id, own.start, own.end, strict=True))


def test_op5_pieces_are_the_tokenizers_ids_and_fit_without_gaps(spark, docs):
    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found = QUERIES["op5_packing"](spark, SF_DIR).toPandas()
    rows = {d: g.sort_values("piece") for d, g in found.groupby("doc_id")}
    for doc_id, text in zip(docs.doc_id, docs.text, strict=True):
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 0], "<u4")
        own = rows[doc_id]
        assert list(own.piece) == list(range(len(own))) and own.length.sum() == len(ids)
        assert (own.length[1:] == 2048).all() and (len(own) == 1 or len(ids) > 2048)
        for r in own.itertuples():
            assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
    for _, g in found.sort_values("offset").groupby("sequence_id"):
        assert list(g.offset) == [0, *g.length.cumsum()[:-1]] and g.length.sum() <= 2048
    assert found.sequence_id.nunique() <= -(-found.length.sum() // 2048) + 1


def test_op7_ranks_held_out_documents(spark):
    found = QUERIES["op7_quality"](spark, SF_DIR).toPandas().set_index("doc_id")
    assert found.score.between(0, 1).all() and ((found.score >= 0.3) == (found.predicted == 1)).all()
    assert all((zlib.crc32(str(d).encode()) % 5 == 0) == h for d, h in found.held_out.items())
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").toPandas()
    scored = QUERIES["op7_quality"](spark, "/root/testdata/sf0.01").toPandas().merge(labels, on="doc_id")
    held = scored[scored.held_out]
    assert (held.predicted == held.quality).mean() > 0.95


def test_op8_is_the_article(spark):
    import html

    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet").toPandas().set_index("page_id")
    found = QUERIES["op8_html_main"](spark, SF_DIR).toPandas().set_index("page_id")
    assert sorted(found.index) == sorted(pages.index)
    for page_id, page in pages.html.items():
        inner = re.search(r"<article>(.*?)(</article>|\Z)", page, re.DOTALL)[1]
        inner = re.sub(r"<[^>]*(>|\Z)", lambda m: " " if re.match(r"</?(p|h1|br)\b", m[0]) else "", inner)
        expected = re.sub(r"\s+", " ", html.unescape(inner)).strip()
        assert (found.text[page_id], found.n_chars[page_id]) == (expected, len(expected))


def sets_of(texts, words):
    out = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", t.translate(LOWER))
        out.append({tuple(w[k : k + words]) for k in range(max(1, len(w) - words + 1))} if w else set())
    return out


def brute_groups(ids, texts, words, percent):
    """Smallest reachable id of each text, comparing all pairs."""
    sets = sets_of(texts, words)
    group = list(range(len(sets)))
    for a in range(len(sets)):
        for b in range(a):
            low, high = sorted((len(sets[a]), len(sets[b])))
            if low and 100 * low >= percent * high and group[a] != group[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (low + high - both):
                    old, new = group[a], group[b]
                    group = [new if g == old else g for g in group]
    least = defaultdict(list)
    for g, i in zip(group, ids, strict=True):
        least[g].append(i)
    return {i: (len(s), min(least[g])) for i, s, g in zip(ids, sets, group, strict=True)}


def test_op10_equals_all_pairs(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").toPandas()
    expected = brute_groups(list(docs.doc_id), list(docs.text), 3, 85)
    found = QUERIES["op10_near_dedup"](spark, "/root/testdata/sf0.01").toPandas()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found.itertuples()} == expected
    assert ((found.doc_id == found.component_id) == found.kept).all()
    assert sum(i != c for i, (_, c) in expected.items()) > 20


def test_pipeline_stages_take_effect(spark, docs):
    sf_dir = SF_DIR
    own = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "line_dedup", "near_dedup", "decontaminate", "packing"]
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = own
        own = stage(spark, own, sf_dir)
        assert own.dtypes == before.dtypes
        own.write.parquet(path := f"{spark.conf.get('spark.checkpoint.dir')}/test-{name}")
        own = spark.read.parquet(path)
        kept[name] = (before.toPandas().set_index("doc_id"), own.toPandas().set_index("doc_id"))
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").toPandas().set_index("doc_id").quality
    rejected = set(kept["quality"][0].index) - set(kept["quality"][1].index)
    assert rejected and all(labels.get(d, 0) == 0 for d in rejected)
    before, after = kept["line_dedup"]
    assert set(before.index) == set(after.index)
    of = defaultdict(set)
    for d, t in before.text.items():
        for line in t.split("\n"):
            of[line.strip(" \t\n\x0b\f\r").translate(LOWER)].add(d)
    for d, t in before.text.items():
        lines = [x for x in t.split("\n") if not (k := x.strip(" \t\n\x0b\f\r").translate(LOWER)) or len(of[k]) < 10]
        assert after.text[d] == "\n".join(lines) and after.n_chars[d] == len(after.text[d])
    before, after = kept["near_dedup"]
    groups = brute_groups(list(before.index), list(before.text), 5, 80)
    assert set(after.index) == {i for i, (_, c) in groups.items() if i == c}
    before, after = kept["decontaminate"]
    items = list(spark.read.parquet(f"{sf_dir}/benchmark.parquet").toPandas().text)
    leaking = {d for d, t in before.text.items() if any(x in t for x in items)}
    assert leaking and leaking.isdisjoint(after.index) and set(after.index) <= set(before.index)
    packed = corpus_pipeline.STAGES[-1][1](spark, own, sf_dir).toPandas()
    assert set(packed.doc_id) == set(after.index)


def test_fingerprints_are_base64_of_sorted_hashes(spark):
    found = QUERIES["op2_fingerprint"](spark, SF_DIR).limit(3).collect()
    for r in found:
        assert len(base64.b64decode(r.fingerprint.removesuffix("~"))) % 4 == 0
