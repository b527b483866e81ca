"""Text lines of a page, each with what its markup says about it; and their alignment."""

from __future__ import annotations

import html
import re

# What the markup around a line says: it is the page's main text, it is not, or nothing.
MAIN, OTHER, OPEN = "main", "other", "open"

# Elements and attribute words by what they hold (HTML standard and common use).
VOID = frozenset("area base br col embed hr img input link meta source track wbr param".split())
RAW = frozenset("script style title textarea iframe noembed noframes xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li "
    "main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
MAIN_TAGS = frozenset("article main".split())
OTHER_TAGS = frozenset(
    "aside button canvas datalist dialog fieldset footer form head header iframe menu nav "
    "noscript object script select style svg template textarea title".split()
)
OTHER_ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation "
    "search toolbar".split()
)
OTHER_WORDS = frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent "
    "cookie cookies disqus footer login masthead menu modal nav navbar navigation newsletter "
    "notice notices popup promo related replies reply share sharing sidebar signup social "
    "sponsor sponsored subscribe toolbar".split()
)
OTHER_NAMES = frozenset("header page-header site-header top-header".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|</?[a-zA-Z][^>]*(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_SPACE = re.compile(r"\s+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)


def _says_other(tag: str, rest: str) -> bool:
    """Whether an element holds something else than main text."""
    if tag in OTHER_TAGS:
        return True
    if not rest or tag in ("html", "body"):
        return False
    for name, *values in _ATTRIBUTE.findall(rest):
        name, value = name.lower(), next((v for v in values if v), "").lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        if name == "role" and value in OTHER_ROLES:
            return True
        if name == "style" and _HIDDEN.search(value):
            return True
        if name in ("class", "id"):
            for word in value.split():
                if word in OTHER_NAMES or not OTHER_WORDS.isdisjoint(re.split(r"[-_]+", word)):
                    return True
    return False


def page_lines(page: str) -> list[tuple[str, str]]:
    """(text, MAIN / OTHER / OPEN) of each non-empty line, in page order.

    A line is the text between two boundaries of block elements, with character references
    decoded, runs of white space as one space and none at its ends. Comments, scripts and styles
    give no lines. Markup that is cut off at the end of the page ends there.
    """
    lines: list[tuple[str, str]] = []
    stack: list[tuple[str, str]] = []  # open elements and what holds inside
    held: list[str] = []
    state = OPEN

    def flush() -> None:
        if held:
            text = _SPACE.sub(" ", html.unescape("".join(held))).strip()
            held.clear()
            if text:
                lines.append((text, state))

    at = 0
    while at < len(page):
        token = _TOKEN.search(page, at)
        if token is None:
            held.append(page[at:])
            break
        if token.start() > at:
            held.append(page[at : token.start()])
        at = token.end()
        if token["tag"] is None:
            continue
        tag = token["tag"].lower()
        if tag in BLOCK:
            flush()
        if token["end"]:
            depth = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == tag), -1)
            if depth >= 0:
                del stack[depth:]
                new = stack[-1][1] if stack else OPEN
                if new != state:
                    flush()
                state = new
            continue
        if tag in RAW:
            close = re.compile(f"</{tag}", re.IGNORECASE).search(page, at)
            at = close.start() if close else len(page)
            continue
        if tag in VOID:
            continue
        if tag in BLOCK:
            # A block ends an open paragraph, an item the item before it.
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == "p" or (stack[k][0] == tag == "li"):
                    del stack[k:]
                    state = stack[-1][1] if stack else OPEN
                    break
                if stack[k][0] in BLOCK:
                    break
        if state != OTHER and _says_other(tag, token["rest"]):
            flush()
            inner = OTHER
        elif state == OPEN and tag in MAIN_TAGS:
            inner = MAIN
        else:
            inner = state
        stack.append((tag, inner))
        state = inner
    flush()
    return lines


def _bits(a: list, b: list) -> list[int]:
    """Row by row over ``a``, the bit vector over ``b`` whose zeros count the common subsequence."""
    places: dict = {}
    for n, x in enumerate(b):
        places[x] = places.get(x, 0) | 1 << n
    full = (1 << len(b)) - 1
    row, rows = full, []
    for x in a:
        hit = row & places.get(x, 0)
        row = ((row + hit) | (row - hit)) & full
        rows.append(row)
    return rows


def common(a: list, b: list, most: int = 1 << 24) -> list[tuple[int, int]]:
    """A longest common subsequence of two lists, as pairs of places.

    Two short lists are traced back directly; longer ones are halved at the place where the two
    halves' lengths add up to the most, so memory stays below ``most`` bits.
    """
    if not a or not b:
        return []
    if len(a) * len(b) <= most or len(a) == 1:
        rows, pairs = _bits(a, b), []
        i, j = len(a) - 1, len(b) - 1
        while i >= 0 and j >= 0:
            before = rows[i - 1] if i else (1 << len(b)) - 1
            if rows[i] >> j & 1:
                j -= 1
            elif not before >> j & 1:
                i -= 1
            else:
                pairs.append((i, j))
                i, j = i - 1, j - 1
        return pairs[::-1]
    middle = len(a) // 2
    ahead = _lengths(a[:middle], b)
    behind = _lengths(a[middle:][::-1], b[::-1])[::-1]
    cut = max(range(len(b) + 1), key=lambda k: ahead[k] + behind[k])
    left = common(a[:middle], b[:cut], most)
    return left + [(i + middle, j + cut) for i, j in common(a[middle:], b[cut:], most)]


def _lengths(a: list, b: list) -> list[int]:
    """Length of the longest common subsequence of ``a`` and each prefix of ``b``."""
    places: dict = {}
    for n, x in enumerate(b):
        places[x] = places.get(x, 0) | 1 << n
    row = full = (1 << len(b)) - 1
    for x in a:
        hit = row & places.get(x, 0)
        row = ((row + hit) | (row - hit)) & full
    out = [0]
    for n in range(len(b)):
        out.append(out[-1] + (not row >> n & 1))
    return out
