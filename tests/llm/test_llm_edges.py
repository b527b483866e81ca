"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import time

import pytest
from pyspark.sql import functions as F

from vigilog.llm import chat, fingerprint, packing, quality
from vigilog.llm.components import components
from vigilog.llm.decontaminate import find_leaks, unsearched
from vigilog.llm.html_main import extract_main
from vigilog.llm.license_scan import scan_licenses
from vigilog.llm.line_dedup import dedup_lines
from vigilog.llm.near_dedup import candidate_tasks, drop_near_duplicates, near_duplicates
from vigilog.llm.url_filter import Rule, judge, link_edges

DDL = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LONG = "word " * 60_000
MIT = "Released under the MIT License."
ROWS = [
    (1, None, None, None, None), (2, "", "en", "s", 0), (3, "One two three four five six", "en", "s", 1),
    (3, "One two three four five six", "en", "s", 1), (None, "One two three four five six", None, "s", None),
    (None, None, None, None, None), (5, LONG, "en", "s", 5), (6, MIT, "en", "s", 6), (7, " \t\n", "en", "s", 3),
    (8, "x", "en", "s", 1), (8, "x y", "en", "s", 1),
]


@pytest.fixture(scope="module")
def docs(spark):
    extra = {c: F.lit("clash") for c in ("n_lines", "score", "block", "rank", "text_a", "copy", "root", "fingerprint")}
    return spark.createDataFrame(ROWS, DDL).withColumns(extra)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


LABELS = "doc_id bigint, quality int, toxic int"
ITEMS = "item_id bigint, text string"


def run_all(spark, docs):
    labels = spark.createDataFrame([(3, 1, 0), (6, 0, 0), (None, 1, 0), (5, None, None)], LABELS)
    items = spark.createDataFrame([(1, "One two three four five six"), (2, None), (None, ""), (4, "ab")], ITEMS)
    model = quality.fit(docs, labels)
    return {
        "leaks": find_leaks(docs, items), "prints": fingerprint.edited_fingerprints(docs),
        "lines": dedup_lines(docs, 2), "licenses": scan_licenses(docs), "packed": packing.pack(docs),
        "scored": quality.score(docs, model), "near": near_duplicates(docs), "kept": drop_near_duplicates(docs),
    }


def test_line_dedup_is_linear_in_the_lines_of_a_document(spark):
    frequent = [f"Line {n}" for n in range(16_000)]
    rows = [(d, "\n".join([f"own {d}", *frequent, "", " LINE 7 "]) if d % 2 else f"own {d}\n" + "\n".join(frequent)) for d in range(12)]
    docs = spark.createDataFrame([*rows, (99, None)], "doc_id bigint, text string")
    begin = time.monotonic()
    out = {r.doc_id: r for r in dedup_lines(docs, 10).collect()}
    assert time.monotonic() - begin < 60
    assert all(out[d].text == (f"own {d}\n" if d % 2 else f"own {d}") for d in range(12))
    assert all((out[d].n_lines, out[d].n_dropped) == ((16_003, 16_001) if d % 2 else (16_001, 16_000)) for d in range(12))
    assert (out[99].text, out[99].n_lines, out[99].n_dropped) == ("", 1, 0)


def test_short_items_are_returned_as_unsearched(spark):
    items = spark.createDataFrame([(1, "nine  code"), (2, "ten co  de x"), (3, None), (None, "")], ITEMS)
    assert {r.item_id for r in unsearched(items).collect()} == {1, 3, None}


def test_every_operator_on_odd_rows(spark, docs):
    out = {k: v.collect() for k, v in run_all(spark, docs).items()}
    assert len(out["leaks"]) == 3 and {r.item_id for r in out["leaks"]} == {1}
    assert len(out["prints"]) == len(ROWS)
    assert {r.doc_id for r in out["licenses"]} == {6}
    assert len(out["scored"]) == len(ROWS) and all(0 <= r.score <= 1 for r in out["scored"])
    assert sum(r.length for r in out["packed"] if r.doc_id == 1) == 1
    assert len({(r.sequence_id, r.offset) for r in out["packed"]}) == len(out["packed"])
    lines = [(r.doc_id, r.text, r.n_lines, r.n_dropped) for r in out["lines"]]
    assert lines.count((3, "", 1, 1)) == 2 and lines.count((None, "", 1, 1)) == 1
    assert lines.count((1, "", 1, 0)) == lines.count((None, "", 1, 0)) == lines.count((2, "", 1, 0)) == 1
    near = [(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in out["near"]]
    assert near.count((3, 2, 3, True)) == 2 and near.count((None, 2, 3, False)) == 1
    assert near.count((1, 0, 1, True)) == 1 and near.count((None, 0, None, True)) == 1
    kept = sorted(str((r.doc_id, r.text)) for r in out["kept"])
    expected = {r[:2] for r in ROWS} - {(None, ROWS[4][1])}
    assert kept == sorted(str(r) for r in expected)
    assert {"lang", "source", "n_chars", "n_lines", "score", "copy", "root"} <= set(out["kept"][0].asDict())


def test_every_operator_on_an_empty_table(spark, empty):
    assert all(v.count() == 0 for v in run_all(spark, empty).values())


def test_a_lone_document_is_its_own_next(spark):
    (row,) = fingerprint.edited_fingerprints(spark.createDataFrame([(4, "abcdefgh")], "doc_id bigint, text string")).collect()
    assert row.near_next == 1.0 and row.n_chars == 8


def test_fingerprints_merge_by_group(spark):
    rows = [(n % 2, n, "abc def ghi jkl mno pqr " * 3 + str(n) * 40) for n in range(20)]
    prints = fingerprint.fingerprints(spark.createDataFrame(rows, "g int, n int, text string"))
    merged = {r.g: r.fingerprint for r in fingerprint.merge(prints, ["g"]).collect()}
    for g, found in merged.items():
        own = [fingerprint.sketch(t) for h, _, t in rows if h == g]
        assert found == fingerprint.to_text(fingerprint.union(own))
    part = prints.select(fingerprint.containment(F.col("fingerprint"), F.lit(merged[0])).alias("c"), "g").filter("g = 0")
    assert all(r.c > 0.9 for r in part.collect())


def test_a_line_counts_once_a_document(spark):
    rows = [(n, "Same\n same \nown" + str(n)) for n in range(3)] + [(9, "twice\ntwice"), (10, "SAME")]
    found = {r.doc_id: r for r in dedup_lines(spark.createDataFrame(rows, "doc_id int, text string"), 4).collect()}
    assert found[0].text == "own0" and found[0].n_dropped == 2 and found[10].text == ""
    assert found[9].text == "twice\ntwice"


def test_chat_orders_ties_and_closes_conversations(spark):
    rows = [
        (1, 1, "assistant", "a"), (1, 0, "user", "<|im_end|>"), (1, 1, "assistant", "a"), (1, 2, "user", None),
        (2, 0, "user", "only"), (None, 0, "assistant", ""), (None, None, None, None),
    ]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    made = chat.examples(turns)
    full = {(r.conv_id, r.example): r for r in made.collect()}
    assert [full[1, n].target for n in range(3)] == [1, 2, None] and full[2, 0].target is None
    for r in full.values():
        assert r.chars == len(r.text)
        if r.target is not None:
            turn = chat.parse(r.text)[r.target]
            assert turn == ("assistant", chat.unescape(r.text[r.loss_start : r.loss_end])) and len(chat.parse(r.text)) == r.target + 1
    back = {r.conv_id: r for r in chat.read_back(made).collect()}
    assert (back[1].n_turns, back[1].loss_chars, back[2].loss_chars, back[None].n_turns) == (4, 2, 0, 2)
    assert chat.read_back(chat.examples(turns.limit(0))).count() == 0


def test_chat_examples_hold_all_turns_before_them(spark):
    rows = [(1, n, "assistant" if n % 3 else "user", f"t{n} <|im_end|>" * 30) for n in range(40)]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    made = chat.examples(turns)
    found = made.collect()
    assert [r.target for r in found] == [*[n for n in range(40) if n % 3], None]
    for r in found:
        until = 40 if r.target is None else r.target + 1
        assert chat.parse(r.text) == [(role, text) for _, _, role, text in rows[:until]] and r.chars == len(r.text)
    (back,) = chat.read_back(made).collect()
    assert back.formatted_chars == sum(len(r.text) for r in found) and back.n_turns == 40


def test_url_decisions_pass_along_chains_and_allow_precedes(spark):
    rows = [
        ("http://a.net/x", "https://b.net/y"), ("http://b.net/y#f", "http://spam.net/bad/1"),
        ("http://c.net/", "http://spam.net/bad/2"), ("http://c.net/", "http://good.net/ok"),
        (None, "http://a.net/x"), ("http://a.net/x", None), ("http://d.net/", "http://d.net/"),
    ]
    edges = spark.createDataFrame(rows, "src string, dst string")
    urls = ["http://a.net/x", "ftp://B.net/y", "http://c.net/#z", "http://spam.net/bad/2", "http://d.net/", None, "nothing", "http://x.spam.net/bad/9?q"]
    frame = spark.createDataFrame([(u, "old") for u in urls], "url string, rule string")
    rules = [Rule("block", "spam.net", "/bad/"), Rule("allow", "good.net", "/")]
    found = {r.url: r for r in judge(frame, edges, rules).collect()}
    assert [found[u].verdict for u in urls] == ["block", "block", "allow", "block", "allow", "allow", "allow", "block"]
    assert found[urls[3]].rule == "spam.net/bad/" and found["nothing"].host == "" and found["ftp://B.net/y"].host == "b.net"
    assert judge(frame.limit(0), edges.limit(0), rules).count() == 0


def test_links_are_read_from_pages(spark):
    pages = [
        ("http://a.com/d/x", "<link rel='canonical' href='/y'>"), ("http://b.com/q", '<link href="z?p=1" rel="canonical">'),
        ("http://c.com", "<meta http-equiv=refresh content='0; url=//d.com/w'>"), ("http://e.com/", "<link rel=stylesheet href=x>"),
        (None, "<link rel=canonical href=/y>"), ("http://f.com/", None),
    ]
    found = link_edges(spark.createDataFrame(pages, "url string, html string")).collect()
    assert sorted(found) == [("http://a.com/d/x", "http://a.com/y"), ("http://b.com/q", "http://b.com/z?p=1"), ("http://c.com", "http://d.com/w")]


def test_links_are_decoded_resolved_by_scheme_and_read_from_markup_only(spark):
    link = "<link rel=canonical href='{}'>".format
    pages = [
        ("http://a.com/1", link("http://b.com/p?a=1&amp;b=2")), ("http://a.com/2", link("http://b.com/p?a=1&#38;b=2&#x26;c")),
        ("http://a.com/3", link("/go?u=http://x.org/")), ("http://a.com/4", link("HTTP://b.com/&amp;lt;&nosuch;&#xE9;&#0;&#55296;")),
        ("http://a.com/5", "<meta http-equiv=refresh content='0; url=http&colon;//b.com/?x&amp;y'>"),
        ("http://a.com/6", f"<!-- {link('/no')} --><SCRIPT>'{link('/no')}'</script >{link('/yes')}<!-- {link('/no')}"),
        ("http://a.com/7", f"<!-->{link('/yes')}<script-x>{link('/too')}<style>{link('/no')}"),
    ]
    edges = link_edges(spark.createDataFrame(pages, "url string, html string"))
    assert sorted((r.src[-1], r.dst) for r in edges.collect()) == [
        ("1", "http://b.com/p?a=1&b=2"), ("2", "http://b.com/p?a=1&b=2&c"), ("3", "http://a.com/go?u=http://x.org/"),
        ("4", "HTTP://b.com/&lt;&nosuch;é&#0;&#55296;"), ("5", "http://b.com/?x&y"), ("6", "http://a.com/yes"),
        ("7", "http://a.com/too"), ("7", "http://a.com/yes"),
    ]
    urls = spark.createDataFrame([("http://a.com/1",), ("http://a.com/3",)], "url string")
    rules = [Rule("block", "b.com", "/p"), Rule("block", "x.org", "/")]
    found = {r.url[-1]: r.verdict for r in judge(urls, edges.filter("src rlike '[13]$'"), rules).collect()}
    assert found == {"1": "block", "3": "allow"}


def test_the_sql_follows_links_like_the_operator(spark, tmp_path):
    import duckdb

    from vigilog.llm.oracle import URL_FILTER
    from vigilog.llm.queries import QUERIES

    link = "<link rel=canonical href='{}'>".format
    pages = [
        ("http://a.net/1", link("http://x.com/de/p?a=1&amp;b=2")), ("http://a.net/2", link("/go?u=http://x.com/de/")),
        ("http://a.net/3", f"<!-- {link('http://x.com/de/')} --><SCRIPT>{link('http://x.com/de/')}</script >"),
        ("http://a.net/4", link("http&colon;//x.com/d&#101;/")), ("http://a.net/5", link("http://x.com/&#x64;e/")),
        ("http://a.net/6", "<meta http-equiv=refresh content='0; url=//x.com/de/'>"), ("http://a.net/7", link("/8")),
        ("http://a.net/8", link("http://x.com/fr/")), ("http://a.net/9", f"<!-->{link('http://x.com/de/')}"),
        ("http://a.net/10", link("http://x.com/&#55296;&nosuch;&#0;de/")), (None, link("/8")), ("", None), ("http://a.net/11", None),
        ("http://a.net/1", link("http://x.com/de/p?a=1&amp;b=2")), ("http://A.net/" + "long/" * 100_000, link("../x")),
    ]
    rows = spark.createDataFrame([(n, *p) for n, p in enumerate(pages)], "page_id bigint, url string, html string")
    rows.coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    found = QUERIES["op6_url_filter"](spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    expected = {r[0]: tuple(r[1:]) for r in con.execute(f"SELECT page_id, host, path, rule, verdict FROM ({URL_FILTER})").fetchall()}
    assert {r.page_id: tuple(r)[1:] for r in found.collect()} == expected
    assert [n for n in sorted(expected) if expected[n][3] == "block"] == [0, 3, 4, 5, 8, 13]


def test_chat_with_clashing_columns_and_a_very_long_text(spark):
    rows = [(1, 0, "user", LONG), (1, 1, "assistant", LONG + "<|"), (1, 1, "assistant", LONG + "<|")]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    clashing = turns.withColumns({c: F.lit("clash") for c in ("example", "target", "chars", "loss_start", "n_turns")})
    plain, other = (chat.read_back(chat.examples(t)).collect() for t in (turns, clashing))
    assert plain == other and (plain[0].n_turns, plain[0].loss_chars) == (3, 2 * len(LONG) + 4)


def test_neighbours_across_blocks_and_tasks(spark, monkeypatch):
    monkeypatch.setattr(fingerprint, "BLOCK_ROWS", 10)
    rows = [(n * n - 50, f"text of number {n} " * (n % 7 + 1)) for n in range(1300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)
    for most in (100_000, 64):
        monkeypatch.setattr(fingerprint, "MOST_BLOCKS", most)
        found = {r.doc_id: r for r in fingerprint.edited_fingerprints(docs).collect()}
        assert len(found) == 1300
        for (doc_id, text), (_, after) in zip(rows, [*rows[1:], rows[0]], strict=True):
            cut = len(text) // 4
            edited = fingerprint.sketch(text[: len(text) - cut] + after[:cut])
            assert found[doc_id].edited_fingerprint == fingerprint.to_text(edited)


@pytest.fixture(scope="module")
def stage_tables(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stages")
    labels = [(n, n % 2, 0) for n in range(100, 140)]
    spark.createDataFrame([*labels, (None, 1, None)], LABELS).coalesce(1).write.parquet(f"{folder}/labels.parquet")
    items = [(1, "Which of these ten questions has been answered wrongly by the whole class? " * 3), (2, None)]
    spark.createDataFrame(items, ITEMS).coalesce(1).write.parquet(f"{folder}/benchmark.parquet")
    return str(folder), items[0][1]


def test_pipeline_stages_on_odd_rows(spark, docs, stage_tables):
    """Columns that are called like those of an operator keep their values, and rows their number."""
    import corpus_pipeline

    folder, passage = stage_tables
    own = docs.drop("text_a").withColumn("piece", F.lit("clash"))
    labelled = [(n, ("good words " if n % 2 else "junk ### ") * 20, "en", "s", n) for n in range(100, 140)]
    leak = [(200, passage, "en", "s", 1), (200, passage, "en", "s", 1), (None, passage, None, None, None)]
    more = spark.createDataFrame([*labelled, *leak], DDL)
    for name in own.columns[5:]:
        more = more.withColumn(name, F.lit("clash"))
    rows = own.unionByName(more)
    out = {name: stage(spark, rows, folder) for name, stage in corpus_pipeline.STAGES}
    for name in list(out)[:-1]:
        assert out[name].columns == rows.columns
        assert {r[0] for r in out[name].select(own.columns[-1]).distinct().collect()} == {"clash"}
    texts = {name: [(r.doc_id, r.text) for r in out[name].collect()] for name in list(out)[:-1]}
    assert len(texts["line_dedup"]) == rows.count() and texts["line_dedup"].count((200, passage)) == 2
    left = texts["decontaminate"]
    assert len(left) == rows.count() - 3 and all(t != passage for _, t in left) and left.count((None, None)) == 1
    kept = texts["near_dedup"]
    assert sum(t == passage for _, t in kept) == 1 and sum(t is None for _, t in kept) == 2
    assert sum(t == LONG for _, t in kept) == 1 and sum((t or "").startswith("One two") for _, t in kept) == 1
    assert all(n % 2 for n, _ in texts["quality"] if n and 100 <= n < 140)
    pieces = out["packing"].groupBy("doc_id").agg(F.sum("length").alias("n")).collect()
    assert {r.doc_id for r in pieces} == {r.doc_id for r in rows.select("doc_id").distinct().collect()}


def test_pipeline_stages_on_an_empty_table(spark, empty, stage_tables):
    import corpus_pipeline

    assert all(stage(spark, empty, stage_tables[0]).count() == 0 for _, stage in corpus_pipeline.STAGES)


def test_url_queries_run_no_python(spark):
    from helpers import plan_of

    from vigilog.llm.queries import QUERIES

    plan = plan_of(QUERIES["op6_url_filter"](spark, "/root/testdata/sf0.001"), "simple")
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))


def test_components_of_a_long_path_and_a_star(spark):
    rows = [(n, n + 1) for n in range(100)] + [(500, n) for n in range(501, 560)] + [(7, 7), (900, 900), (None, 3)]
    found = {r.node: r.component for r in components(spark.createDataFrame(rows, "src bigint, dst bigint")).collect()}
    assert all(found[n] == 0 for n in range(101)) and all(found[n] == 500 for n in range(500, 560)) and found[900] == 900
    assert None not in found and components(spark.createDataFrame([], "src bigint, dst bigint")).count() == 0


def test_large_candidate_groups_meet_in_pairs_of_chunks(spark):
    rows = [({"a": n, "b": 0}, 10, {"a": 0, "b": 0}) for n in range(60)]
    groups = spark.createDataFrame(rows, "node struct<a:bigint,b:bigint>, n bigint, component struct<a:bigint,b:bigint>")
    tasks = candidate_tasks(groups, most=200).collect()
    by_task, together = {}, set()
    for r in tasks:
        by_task.setdefault(r.task, set()).add(r.node.a)
    for nodes in by_task.values():
        assert len(nodes) < 60
        together |= {(a, b) for a in nodes for b in nodes}
    assert len(together) == 3600


def test_near_duplicates_across_chunks(spark, monkeypatch):
    from vigilog.llm import near_dedup

    base = [f"w{n}" for n in range(100)]
    rows = [(n, " ".join([*base[:n], f"x{n}", *base[n + 1 :]])) for n in range(30)] + [(99, "other words " + " ".join(map(str, range(50))))]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    monkeypatch.setattr(near_dedup.candidate_tasks, "__defaults__", (500,))
    found = {r.doc_id: r.component_id for r in near_duplicates(frame, 3, 85).collect()}
    assert all(found[n] == 0 for n in range(30)) and found[99] == 99


def test_pages_alike_and_alone(spark):
    a, b = "<div>Menu</div><p>Only one</p><div>End</div>", "<div>Menu</div><p>Only two</p><div>End</div>"
    rows = [
        (1, "http://a.com/x/1", a), (2, "http://a.com/x/2", b), (2, "http://a.com/x/2", b), (3, None, None),
        (None, "u", ""), (4, "http://b.com/", "<p>alone " + "w " * 50_000),
    ]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("n_chars", F.lit("old"))
    found = sorted((str(r.page_id), r.text[:8], r.n_chars) for r in extract_main(pages).collect())
    assert found == [("1", "Only one", 8), ("2", "Only two", 8), ("2", "Only two", 8), ("3", "", 0), ("4", "alone w ", 100_005), ("None", "", 0)]
    assert extract_main(pages.limit(0)).count() == 0


def test_copies_across_blocks_are_differenced_with_the_pages_around(spark):
    def page(words):
        return f"<div>Menu</div><p>Only {words}</p><div>End</div>"

    rows = [(n, f"http://a.com/{n:04}", page("one" if n < 500 else "copy" if n < 2500 else "last")) for n in range(3000)]
    found = extract_main(spark.createDataFrame(rows, "page_id bigint, url string, html string")).toPandas()
    assert len(found) == 3000 and set(found.text) == {"Only one", "Only copy", "Only last"}


def test_an_article_of_comments_is_no_main_text():
    from vigilog.llm.html_lines import OTHER, page_lines

    assert page_lines("<article class='comment'><p>hi</article><article id=story>x</article>") == [("hi", OTHER), ("x", "main")]


def test_tokens_are_those_of_the_tokenizers_library():
    import public_tokenizers
    from tokenizers import Tokenizer

    own = packing.load_tokenizer()
    other = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for text in ("", " ", "a  b\n\n c\t", "It's we'll THEY'RE 12,000½", "日本語 émoji 🎉🎉  \r\n", "don't'd ''s", " x y", LONG[:1000]):
        assert own.encode_ordinary(text) == other.encode(text, add_special_tokens=False).ids


def test_added_tokens_are_split_off_like_in_the_tokenizers_library(spark):
    import json
    import zlib

    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    with open(path) as file:
        assert {t["content"]: t["id"] for t in json.load(file)["added_tokens"]} == packing.ADDED_TOKENS
    end = "<|endoftext|>"
    texts = [f"a {end} b", end, end * 3, f"  {end}\n\n {end}  ", f"x{end}'s 12{end}34", f"<|{end}|>", "<|endoftext|", LONG[:20_000] + end + LONG[:3000]]
    other = Tokenizer.from_file(path)
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = packing.pack(rows, with_ids=True).toPandas()
    assert found.ids.map(lambda ids: zlib.crc32(np.array(ids, "<u4").tobytes())).equals(found.ids_crc32)
    for n, text in enumerate(texts):
        pieces = found[found.doc_id == n].sort_values("piece")
        ids = [int(i) for part in pieces.ids for i in part]
        assert ids == [*other.encode(text, add_special_tokens=False).ids, packing.END_ID]
        assert list(pieces.start) == [0, *pieces.length.cumsum()[:-1]]


def test_line_stage_keeps_columns_called_like_the_counts(spark, tmp_path):
    import corpus_pipeline

    rows = [(n, "shared\nown " + str(n), "en", "s", 0) for n in range(12)]
    docs = spark.createDataFrame(rows, DDL).withColumns({c: F.lit("clash") for c in ("n_lines", "n_dropped")})
    found = corpus_pipeline.line_stage(spark, docs, str(tmp_path))
    assert found.columns == docs.columns
    kept = {(r.doc_id, r.text, r.n_chars, r.n_lines, r.n_dropped) for r in found.collect()}
    assert kept == {(n, f"own {n}", len(f"own {n}"), "clash", "clash") for n in range(12)}


def test_the_training_sample_ends_in_hash_order(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(quality, "train", lambda samples: seen.append(len(samples)))
    texts = [(n, "word " * (5 if n % 2 else 400) + str(n), n % 2) for n in range(40) if not quality_held(n)]
    docs = spark.createDataFrame([t[:2] for t in texts], "doc_id bigint, text string")
    labels = spark.createDataFrame([(n, q, 0) for n, _, q in texts], LABELS)
    quality.fit(docs, labels)
    monkeypatch.setattr(quality, "TRAIN_ENTRIES", 1)
    quality.fit(docs, labels)
    assert seen == [len(texts), 1]


def quality_held(doc_id):
    import zlib

    return zlib.crc32(str(doc_id).encode()) % 5 == 0
