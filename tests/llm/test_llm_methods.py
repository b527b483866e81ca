"""The methods themselves: hashing, planning, signatures, alignment, parsing."""

import random
import time
import tracemalloc
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from vigilog.llm import decontaminate as D
from vigilog.llm import fingerprint as FP
from vigilog.llm import near_dedup as N
from vigilog.llm.chat import escape, escape_role, parse, unescape, unescape_role
from vigilog.llm.html_lines import MAIN, OPEN, OTHER, common, page_lines
from vigilog.llm.html_main import main_text
from vigilog.llm.license_scan import Scanner, patience, rising
from vigilog.llm.packing import cut, place, plan
from vigilog.llm.perfect_hash import PerfectHash
from vigilog.llm.quality import features, train


@pytest.mark.parametrize("n", [0, 1, 2, 17, 5000])
def test_perfect_hash_is_minimal_and_survives_bytes(n):
    keys = np.unique(np.random.default_rng(n).integers(0, 2**63, n, dtype=np.uint64))
    found = PerfectHash.from_bytes(PerfectHash.build(keys).to_bytes())
    assert sorted(found.index(keys)) == list(range(len(keys)))
    strangers = np.arange(1, 100, dtype=np.uint64)
    assert ((found.index(strangers) >= -1) & (found.index(strangers) < max(1, len(keys)))).all()


def test_cut_makes_only_the_first_piece_shorter():
    assert cut(2048, 2048) == [(0, 2048)] and cut(5, 2048) == [(0, 5)]
    assert cut(4100, 2048) == [(0, 4), (4, 2048), (2052, 2048)]
    assert cut(4096, 2048) == [(0, 2048), (2048, 2048)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=200))
def test_plan_packs_like_best_fit_decreasing(sizes):
    capacity = 64
    runs = plan(Counter(sizes), capacity)
    length = np.array(sorted(sizes), np.int64)
    rank = np.concatenate([np.arange(n) for _, n in sorted(Counter(sizes).items())] or [np.zeros(0, int)])
    sequence, offset = place(runs, length, rank)
    filled = {}
    for s, o, n in sorted(zip(sequence, offset, length, strict=True)):
        assert filled.get(s, 0) == o
        filled[s] = o + n
    assert all(x <= capacity for x in filled.values())
    gaps = []
    for n in sorted(sizes, reverse=True):
        fit = [g for g in gaps if g >= n]
        if fit:
            gaps.remove(min(fit))
        gaps.append((min(fit) if fit else capacity) - n)
    assert len(filled) <= len(gaps)


def test_superminhash_estimates_with_less_variance_than_independent_slots():
    rng = np.random.default_rng(0)
    found = []
    for _ in range(300):
        base = rng.integers(1, 2**63, 40, dtype=np.uint64)
        found.append((lambda s: (s[0] == s[1]).mean())(N.signatures([np.unique(base[:30]), np.unique(base[10:])], 80)))
    assert abs(np.mean(found) - 0.5) < 0.01 and np.std(found) < (0.25 / 80) ** 0.5 * 0.95
    assert np.isinf(N.signatures([np.zeros(0, np.uint64)], 8)).all()


def test_signature_of_a_set_does_not_depend_on_its_company():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(1, 2**63, n, dtype=np.uint64)) for n in (1, 3, 50, 700, 0)]
    together = N.signatures(sets, 40)
    for s, row in zip(sets, together, strict=True):
        assert (N.signatures([s], 40)[0] == row).all()


def test_bands_miss_less_than_promised():
    for percent in (80, 85):
        assert (1 - (percent / 100) ** N.ROWS) ** N.bands_for(percent) <= N.MISS


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sets(st.integers(0, 12), min_size=1, max_size=9), min_size=1, max_size=14), st.sampled_from([50, 80, 85]))
def test_linked_equals_all_pairs(sets, percent):
    arrays = [np.array(sorted(s), np.uint64) for s in sets]
    root = N.linked(arrays, percent)
    group = list(range(len(sets)))
    for a in range(len(sets)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if 100 * both >= percent * len(sets[a] | sets[b]):
                old, new = group[a], group[b]
                group = [new if g == old else g for g in group]
    assert all((root[a] == root[b]) == (group[a] == group[b]) for a in range(len(sets)) for b in range(a))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sets(st.integers(0, 12), min_size=1, max_size=9), min_size=2, max_size=14), st.sampled_from([50, 80]), st.integers(0, 99))
def test_linked_across_sides_names_the_smallest_member(sets, percent, seed):
    side = np.random.default_rng(seed).integers(0, 2, len(sets))
    root = N.linked([np.array(sorted(s), np.uint64) for s in sets], percent, side)
    group = list(range(len(sets)))
    for a in range(len(sets)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if side[a] != side[b] and 100 * both >= percent * len(sets[a] | sets[b]):
                one, other = sorted((group[a], group[b]))
                group = [one if g == other else g for g in group]
    assert list(root) == group


def test_many_copies_of_a_template_are_linked_in_seconds():
    rng = np.random.default_rng(4)
    template = rng.integers(0, 2**62, 20).astype(np.uint64)
    n = 30_000
    own = rng.integers(0, 2**62, (n, 1)).astype(np.uint64)
    sets = [np.unique(np.concatenate([np.delete(template, k % 20), own[k]])) for k in range(n)]
    begin = time.monotonic()
    root = N.linked(sets, 80)
    assert (root == 0).all() and time.monotonic() - begin < 60


def test_short_texts_are_one_shingle_and_never_part_of_longer_ones():
    a, b, c, d = N.shingle_sets(["One two", "one TWO\n", "one two three", " "], 3)
    assert len(a) == 1 and (a == b).all() and a[0] != c[0] and len(d) == 0


def naive_leaks(text, item, window, rate):
    t, i = D.normal_codes(text), D.normal_codes(item)
    n = min(len(i), window)
    e = D.budget(n, rate)
    out = []
    for w in range(len(i) - n + 1):
        row = np.zeros(len(t) + 1, int)
        for k in range(n):
            step = np.minimum(row[:-1] + (t != i[w + k]), row[1:] + 1)
            row = np.minimum.accumulate(np.concatenate([[k + 1], step]) - np.arange(len(t) + 1)) + np.arange(len(t) + 1)
        if row.min() <= e:
            out.append((w, int(row.min())))
    return out


def test_leaks_equal_full_alignment():
    rnd = random.Random(5)
    parts = "th er on tion the of and ing ble an re ou sh ly".split()

    def prose(n):
        return " ".join("".join(rnd.choice(parts) for _ in range(rnd.randint(1, 3))) for _ in range(n))

    def spoil(text, n):
        out = list(text)
        for _ in range(n):
            p = rnd.randrange(len(out))
            out[p : p + 1] = rnd.choice([["x"], [], [out[p], "y"]])
        return "".join(out)

    seen = Counter()
    for _ in range(8):
        items = [prose(rnd.randint(3, 30)) for _ in range(3)] + ["abc", ""]
        texts = [prose(rnd.randint(0, 12)) + " " + spoil(rnd.choice(items[:3]), rnd.choice([0, 2, 4, 9])) + prose(4) for _ in range(4)]
        index = D.build_index(list(enumerate(items)))
        found = {(t, index.ids[i]): (edits, covered) for t, i, _, _, edits, covered in D.leaks_in([*texts, ""], index, 80, 0.0625)}
        for t, text in enumerate(texts):
            for i, item in enumerate(items[:3]):
                naive = naive_leaks(text, item, 80, 0.0625)
                assert bool(naive) == ((t, i) in found)
                if naive:
                    assert min(e for _, e in naive) == found[t, i][0]
                    seen[found[t, i][0] > 0] += 1
    assert seen[True] and seen[False]


def test_leaks_do_not_depend_on_layout():
    item = " ".join(f"word{n}x" for n in range(60))
    lines = [item[k : k + 50] for k in range(0, len(item), 50)]
    wrapped = "".join(x.replace(" ", "\n" + " " * 12 + "\t ", 1) for x in lines)
    text = "before: " + wrapped + " after"
    ((_, _, start, end, edits, covered),) = D.leaks_in([text], D.build_index([(1, item)]), 80, 0.0625)
    assert (text[start:end], edits, covered) == (wrapped, 0, len(item))
    ((*_, covered),) = D.leaks_in([item], D.build_index([(1, wrapped)]), 80, 0.0625)
    assert covered == len(wrapped)


def test_leaks_have_the_whole_budget_of_their_rate():
    rnd = random.Random(3)
    item = "".join(rnd.choices("abcdefghij klmnop", k=200))
    edited = "".join("#" if n % 13 == 6 else c for n, c in enumerate(item))  # 15 edits
    found = list(D.leaks_in([edited], D.build_index([(1, item)], 200, 0.1), 200, 0.1))
    naive = naive_leaks(edited, item, 200, 0.1)
    assert [f[4] for f in found] == [min(e for _, e in naive)] and found[0][4] > 7
    assert D.budget(200, 0.1) == 20 and D.budget(17, 0.0625) == 1
    short = "abcdefghijklmnopq"
    assert [f[4] for f in D.leaks_in([short.replace("i", "#")], D.build_index([(1, short)]), 80, 0.0625)] == [1]
    with pytest.raises(ValueError):
        D.build_index([(1, item)], 200, 0.5)


def test_repeated_grams_take_bounded_memory():
    n = 8000
    index = D.build_index([(1, "a" * n)])
    tracemalloc.start()
    found = list(D.leaks_in(["b" * 50 + "a" * n], index, 80, 0.0625))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [(f[4], f[5]) for f in found] == [(0, n)]
    assert peak < 200e6


def test_counts_by_strip_do_not_depend_on_the_slices(monkeypatch):
    rnd = random.Random(8)
    items = ["".join(rnd.choices("ab", k=rnd.randint(10, 120))) for _ in range(5)]
    texts = ["".join(rnd.choices("ab", k=rnd.randint(0, 200))) + items[n][5:] for n in range(4)]
    index = D.build_index(list(enumerate(items)))
    whole = list(D.leaks_in(texts, index, 80, 0.0625))
    monkeypatch.setattr(D, "HITS", 7)
    assert whole and list(D.leaks_in(texts, index, 80, 0.0625)) == whole


def test_window_hashes_depend_on_the_window_alone():
    codes = FP.codes_of("abcabcabcabcabc")
    found = FP.window_hashes(codes, 12)
    assert len(found) == 4 and found[0] == found[3] and found[0] != found[1]
    assert len(FP.window_hashes(codes[:5], 12)) == 1 and len(FP.window_hashes(codes[:0], 12)) == 0


def test_sketches_merge_and_estimate_containment():
    rnd = random.Random(2)
    parts = ["".join(rnd.choices("abcdefgh ", k=4000)) for _ in range(30)]
    whole, part = FP.sketch("".join(parts)), FP.sketch(parts[3])
    assert FP.part_in(part, whole) > 0.97 and FP.part_in(whole, part) < 0.06
    assert FP.likeness(FP.union([FP.sketch(p) for p in parts]), whole) > 0.98
    for text in ("", "a", "short text", parts[0]):
        found = FP.sketch(text)
        assert (FP.from_text(FP.to_text(found)) == found).all() and (len(found) > 0) == (text != "")


def longest(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=12), st.lists(st.integers(0, 3), max_size=12), st.sampled_from([8, 1 << 24]))
def test_common_is_a_longest_common_subsequence(a, b, most):
    pairs = common(a, b, most)
    assert len(pairs) == longest(a, b) and all(a[i] == b[j] for i, j in pairs)
    assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:], strict=False))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("abcdefg"), max_size=14), st.lists(st.sampled_from("abcdefg"), max_size=14))
def test_patience_pairs_are_a_common_subsequence(a, b):
    pairs = patience(a, b)
    assert all(a[i] == b[j] for i, j in pairs) and len(pairs) <= longest(a, b)
    assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:], strict=False))
    if len(set(a)) == len(a) and len(set(b)) == len(b):  # all words are anchors
        assert len(pairs) == longest(a, b)


def test_rising_is_longest():
    assert rising([(0, 3), (1, 1), (2, 2), (3, 5), (4, 4)]) in ([(1, 1), (2, 2), (4, 4)], [(1, 1), (2, 2), (3, 5)])
    assert rising([]) == []


def test_scanner_finds_every_mention_and_no_other_version():
    text = (
        "Released under the MIT License. Released under, the very MIT license! İ Licensed under CC BY-NC 4.0. "
        "This work is licensed under the GNU General Public License, version 2. "
        "This work is licensed under the GNU General Public License, version 3."
    )
    found = Scanner().scan(text)
    assert [f.license for f in found] == ["MIT", "MIT", "CC-BY-NC-4.0", "GPL-2.0", "GPL-3.0"]
    assert text[found[2].start : found[2].end] == "Licensed under CC BY-NC 4.0"
    assert [text[f.start : f.end][-9:] for f in found[3:]] == ["version 2", "version 3"]
    assert Scanner().scan("") == [] and Scanner().scan("the of and " * 50) == []


@pytest.mark.parametrize(
    "text, license, found",
    [
        ("Licensed under the MIT license", "MIT", "Licensed under the MIT license"),
        ("// SPDX-License-Identifier: Apache-2.0", "Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
        ("# SPDX-License-Identifier: GPL-2.0-or-later\n", "GPL-2.0", "SPDX-License-Identifier: GPL-2.0-or-later"),
        ("SPDX-License-Identifier: MIT-0", "MIT-0", "SPDX-License-Identifier: MIT-0"),
        ("SPDX-License-Identifier: CC-BY-NC-SA-4.0", "CC-BY-NC-SA-4.0", "SPDX-License-Identifier: CC-BY-NC-SA-4.0"),
        ("It is GNU AGPL v3.", "AGPL-3.0", "GNU AGPL v3"),
        ("licensed under GPLv2 or later", "GPL-2.0", "GPLv2"),
        ("distributed under the terms of the Mozilla Public License 2.0", "MPL-2.0", "distributed under the terms of the Mozilla Public License 2.0"),
        ("the GNU Lesser General Public License version 2.1", "LGPL-2.1", "GNU Lesser General Public License version 2.1"),
    ],
)
def test_scanner_finds_notices_of_one_line(text, license, found):
    (find,) = Scanner().scan(text)
    assert (find.license, text[find.start : find.end], find.coverage) == (license, found, 1.0)


def test_scanner_leaves_mentions_alone():
    for text in ("Er kam mit der license", "available under the sky", "MIT is a school, GNU an animal, GPL 3 a film", "SPDX is a format"):
        assert Scanner().scan(text) == []


def test_scanner_tells_licences_of_a_family_apart():
    from vigilog.llm.license_templates import TEMPLATES

    scanner = Scanner()
    for t in TEMPLATES:  # each text is its own licence, among other words too
        found = scanner.scan(f"some words before it. {t.text} and more after")
        assert t.license in [f.license for f in found] and {f.license for f in found} <= {t.license, "All-Rights-Reserved"}, t.license
    names = {
        "(c) 2020 X. All rights reserved.": ["All-Rights-Reserved"], "all human rights are reserved": [],
        "Licensed under CC BY-NC-SA 4.0. Licensed under CC BY-NC 4.0.": ["CC-BY-NC-SA-4.0", "CC-BY-NC-4.0"],
        "Licensed under CC BY-NC-ND 4.0": ["CC-BY-NC-ND-4.0"],
    }
    assert {text: [f.license for f in scanner.scan(text)] for text in names} == names


def test_scanner_equals_aligning_every_passage():
    rnd = random.Random(4)
    scanner = Scanner(least=0.8)
    template, own, _, span = scanner.templates[3]
    one = Scanner([template], 0.8)
    for _ in range(60):
        words = []
        for _ in range(rnd.randint(0, 3)):
            words += rnd.choices(["the", "under", "foo", "cc", "bar"], k=rnd.randint(0, 8))
            words += [w for w in own if rnd.random() > 0.1]
        exists = any(
            len(p := patience(words[s : s + span], own)) >= 0.8 * len(own)
            and {own[j] for _, j in p} >= set(template.needed)
            for s in range(len(words))
        )
        assert bool(one.scan(" ".join(words))) == exists


def test_page_lines_follow_the_markup():
    page = (
        "<body><div class='ad-slot'>x</div>y<p class=ad>bad<p>good<article><header>h</header>"
        "<h1>A &amp; B</h1><p>one\n two<br>three<nav>n</nav></article><form>f</form><p>tail &lt"
    )
    assert page_lines(page) == [
        ("x", OTHER), ("y", OPEN), ("bad", OTHER), ("good", OPEN), ("h", OTHER), ("A & B", MAIN),
        ("one two", MAIN), ("three", MAIN), ("n", OTHER), ("f", OTHER), ("tail <", OPEN),
    ]
    assert page_lines("") == page_lines("<p") == page_lines("<script>if (a<b) '</p>'") == []


def test_main_text_keeps_shared_lines_of_an_article_only():
    assert main_text([("menu", OPEN), ("own", OPEN)], {0}) == "own"
    assert main_text([("menu", OPEN), ("text", MAIN)], {0, 1}) == "text"


@settings(max_examples=200, deadline=None)
@given(st.text("<|\\>n\nimstart_end a", max_size=40), st.text("<|\\\n a", max_size=10))
def test_template_is_reversible(text, role):
    assert unescape(escape(text)) == text and unescape_role(escape_role(role)) == role
    assert "<|" not in escape(text)
    made = f"<|im_start|>{escape_role(role)}\n{escape(text)}<|im_end|>\n"
    assert parse(made * 2) == [(role, text)] * 2


def test_features_depend_on_the_text_alone():
    texts = ["a bb  a a", "", "\n", "Wörter mit Zeichen"]
    of, found = features(texts)
    for n, text in enumerate(texts):
        assert sorted(found[of == n]) == sorted(features([text])[1])
    assert 1 not in of and 2 not in of


def test_training_needs_both_classes():
    one = (np.array([1, 2]), np.array([0.5, 0.5]))
    assert train([]).scores(["a"])[0] == 0.5
    assert train([(1, *one)]).scores(["a"])[0] > 0.99 and train([(0, *one)]).scores([""])[0] < 0.01
