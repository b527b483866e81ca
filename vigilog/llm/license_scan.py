"""Licence scan by patience alignment of texts with licence templates.

Words are runs of letters and digits, lower-cased (``2.0`` is one word). A passage of ``span``
words (one and a half times the template and a few more) is aligned with a template like this:
equal words at both ends are matched; then words that occur once in each are anchors, of which the
longest increasing subsequence is kept; and the gaps between anchors are aligned in the same way,
where further words are unique. Coverage is the share of the template's words that are matched.
A passage is a find if coverage reaches ``least`` and all the template's needed words are matched;
it ends before the first word that the template excludes.

Passages are chosen without loss: alignment can't match a word more often than both sides have it,
so only passages whose capped word counts reach ``least`` are aligned, best and earliest first.
A find takes its words; passages that overlap it are dropped, and the rest go on.

Texts are read once, in full and without a shuffle.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilog.llm.common import map_texts
from vigilog.llm.license_templates import TEMPLATES, Template

LEAST = 0.85
_WORD = re.compile(r"[^\W_]+(?:\.\d+)*")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def patience(a: Sequence[str], b: Sequence[str]) -> list[tuple[int, int]]:
    """Pairs of places of matched words of ``a`` and ``b``, rising in both."""
    pairs: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, i_end, j, j_end = todo.pop()
        while i < i_end and j < j_end and a[i] == b[j]:
            pairs.append((i, j))
            i, j = i + 1, j + 1
        while i < i_end and j < j_end and a[i_end - 1] == b[j_end - 1]:
            i_end, j_end = i_end - 1, j_end - 1
            pairs.append((i_end, j_end))
        if i == i_end or j == j_end:
            continue
        once_a, once_b = Counter(a[i:i_end]), Counter(b[j:j_end])
        place = {b[k]: k for k in range(j, j_end) if once_b[b[k]] == 1}
        shared = [(k, place[a[k]]) for k in range(i, i_end) if once_a[a[k]] == 1 and a[k] in place]
        anchors = rising(shared)
        bounds = [(i - 1, j - 1), *anchors, (i_end, j_end)]
        pairs += anchors
        if anchors:
            todo += [(p + 1, r, q + 1, s) for (p, q), (r, s) in zip(bounds, bounds[1:], strict=False)]
    return sorted(pairs)


def rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest subsequence that rises in the second number too (piles of patience sorting)."""
    tops: list[int] = []
    last: list[int] = []  # in each pile, the pair on top
    back: list[int] = []
    for n, (_, j) in enumerate(pairs):
        pile = bisect_left(tops, j)
        back.append(last[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(j)
            last.append(n)
        else:
            tops[pile], last[pile] = j, n
    out, n = [], last[-1] if last else -1
    while n >= 0:
        out.append(pairs[n])
        n = back[n]
    return out[::-1]


@dataclass
class Find:
    license: str
    kind: str
    start: int  # in code points of the text
    end: int
    coverage: float


class Scanner:
    def __init__(self, templates: Sequence[Template] = TEMPLATES, least: float = LEAST):
        self.least = least
        self.templates = []
        for t in templates:
            words = words_of(t.text)
            span = len(words) if t.exact else len(words) * 3 // 2 + 4
            self.templates.append((t, words, Counter(words), span))
        self.known = {w for _, words, _, _ in self.templates for w in words}
        # Templates by their needed word that fewest others need, so a text asks for few of them.
        needs = Counter(w for t in templates for w in set(t.needed))
        self.by_word: dict[str, list[int]] = {}
        for n, t in enumerate(templates):
            self.by_word.setdefault(min(t.needed, key=lambda w: (needs[w], w)), []).append(n)

    def passages(self, words: list[str], counts: Counter, size: int, span: int) -> list[tuple[int, int]]:
        """(capped count, start) of passages that could reach the coverage, best first.

        A passage starts at a word of the template; one that starts elsewhere holds no more of it.
        """
        need = self.least * size
        at = [n for n, w in enumerate(words) if w in counts]
        held: Counter = Counter()
        total = end = 0
        out = []
        for start in at:
            while end < len(at) and at[end] < start + span:
                word = words[at[end]]
                held[word] += 1
                total += held[word] <= counts[word]
                end += 1
            if total >= need:
                out.append((total, start))
            word = words[start]
            total -= held[word] <= counts[word]
            held[word] -= 1
        return sorted(out, key=lambda x: (-x[0], x[1]))

    def scan(self, text: str) -> list[Find]:
        """Finds in a text in order of their start; of overlapping ones that with most words."""
        words = words_of(text)
        present = Counter(w for w in words if w in self.known)
        finds: list[tuple[int, int, float, Template]] = []
        for at in sorted(n for w in present if w in self.by_word for n in self.by_word[w]):
            template, own, counts, span = self.templates[at]
            if len(words) < self.least * len(own) or any(w not in present for w in template.needed):
                continue
            most = sum(min(n, present[w]) for w, n in counts.items())
            if most < self.least * len(own):
                continue
            taken: list[tuple[int, int]] = []
            for _, start in self.passages(words, counts, len(own), span):
                passage = words[start : start + span]
                if any(start < e and s < start + len(passage) for s, e in taken):
                    # What stands before a find can still hold another one.
                    stop = min((s for s, e in taken if s >= start), default=start)
                    if stop == start or any(s <= start < e for s, e in taken):
                        continue
                    passage = words[start:stop]
                # A word of another licence ends the passage.
                passage = passage[: next((n for n, w in enumerate(passage) if w in template.excluded), None)]
                if len(passage) < self.least * len(own):
                    continue
                pairs = patience(passage, own)
                matched = {own[j] for _, j in pairs}
                if len(pairs) >= self.least * len(own) and matched.issuperset(template.needed):
                    first, last = start + pairs[0][0], start + pairs[-1][0] + 1
                    taken.append((first, last))
                    finds.append((first, last, len(pairs) / len(own), template))
        if not finds:
            return []
        spans = [m.span() for m in _WORD.finditer(text)] if len(text) == len(text.lower()) else _spans(text)
        out: list[tuple[int, int, Find]] = []
        for first, last, coverage, t in sorted(finds, key=lambda f: (f[0] - f[1], f[0], -f[2], f[3].license)):
            if all(last <= s or e <= first for s, e, _ in out):
                found = Find(t.license, t.kind, spans[first][0], spans[last - 1][1], coverage)
                out.append((first, last, found))
        return [f for _, _, f in sorted(out, key=lambda x: x[0])]


def _spans(text: str) -> list[tuple[int, int]]:
    """Word spans where lower-casing changes the length: characters that grow are one place."""
    low = [c.lower() for c in text]
    place = [n for n, c in enumerate(low) for _ in c] + [len(text)]
    return [(place[s], place[e - 1] + 1) for s, e in (m.span() for m in _WORD.finditer("".join(low)))]


def scan_licenses(docs: DataFrame, templates: Sequence[Template] = TEMPLATES, least: float = LEAST) -> DataFrame:
    """A row for each find: doc_id, license, kind, start, end (code points), coverage.

    Texts without a find give no row; null and empty texts have none. Repeated rows give repeated
    results, null ids pass through. An empty table gives an empty result. Other columns of
    ``docs`` are not read.
    """

    def make() -> Callable[[list[str]], dict[str, object]]:
        scanner = Scanner(templates, least)
        return lambda texts: {"finds": [[vars(f) for f in scanner.scan(t)] for t in texts]}

    kind = "finds array<struct<license:string,kind:string,start:bigint,end:bigint,coverage:double>>"
    found = map_texts(docs.select("doc_id", "text"), make, kind)
    return found.select("doc_id", F.explode("finds").alias("find")).select("doc_id", "find.*")
