"""URL filtering by rules, carried over to aliases along redirects and canonical links.

Everything here is DataFrame operations; no Python runs on the executors.

Definitions. The host of a url is what stands between the first ``://`` and the next ``/``, ``?``,
``#`` or the end, with A-Z lower-cased; the path follows up to ``?``, ``#`` or the end. A null url
or one without ``://`` has an empty host and path. A rule (host, path) fits its host and all of
its subdomains if the url's path starts with the rule's path; of several that fit, the one with
the longest text wins, then the longer host, then allow.

Urls are equivalent if a chain of edges joins them. Two spellings that differ only in scheme or
fragment are one node. A url that no rule fits takes the decision of its equivalents: allow if
any of them has an allow rule (explicit allow precedes), else block if any has a block rule,
else allow.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilog.llm.common import lower_ascii
from vigilog.llm.components import components
from vigilog.session import materialize

ALLOW, BLOCK = "allow", "block"

#: An HTML tag of a canonical link or of a page that sends its reader on, and the target in it.
LINK_TAG = r"(?i)<(?:link\b[^>]*\brel\s*=\s*[\"']?canonical\b[^>]*|meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*)>"
TARGET = r"(?i)\b(?:href\s*=\s*[\"']?\s*|url\s*=\s*['\"]?\s*)([^\"'\s>]+)"


#: Comments, and elements whose content is text and not markup: no link stands in them.
NO_MARKUP = (
    r"(?is)<!--(?:-?>|.*?(?:--!?>|\z))"
    r"|<(script|style|textarea|title|xmp|iframe|noembed|noframes)(?=[\s/>]).*?(?:</\1(?=[\s/>])|\z)"
)
ABSOLUTE = r"(?i)\A[a-z][a-z0-9+.\-]*://"

#: A character reference, or text up to the next; numbers above 0x10FFFF have more digits.
REFERENCES = r"&(?:#0*[0-9]{1,7}|#[xX]0*[0-9a-fA-F]{1,6}|[a-zA-Z]+);|&|[^&]+"
#: Named references to ASCII characters that urls hold.
NAMED = {
    "amp": "&", "AMP": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "sol": "/", "colon": ":", "quest": "?",
    "equals": "=", "num": "#", "commat": "@", "percnt": "%", "period": ".", "plus": "+", "lowbar": "_", "comma": ",",
    "semi": ";", "excl": "!", "dollar": "$", "ast": "*", "lpar": "(", "rpar": ")", "lsqb": "[", "rsqb": "]",
}


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty without one."""
    at = F.instr(F.coalesce(url, F.lit("")), "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    return lower_ascii(F.regexp_extract(_rest(url), r"\A[^/?#]*", 0))


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"\A[^/?#]*([^?#]*)", 1)


def node_of(url: Column) -> Column:
    """Name of a url's node: host, path and query, without scheme and fragment."""
    rest = F.regexp_extract(_rest(url), r"\A[^/?#]*([^#]*)", 1)
    return F.concat(host_of(url), rest)


def fitting_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The winning rule as struct (rule, verdict), else null. ``rules`` is configuration."""
    order = sorted(rules, key=lambda r: (-len(r.text), -len(r.host), r.verdict != ALLOW))
    fits = [
        F.when(
            ((host == r.host) | host.endswith(f".{r.host}")) & path.startswith(r.path),
            F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict")),
        )
        for r in order
    ]
    nothing = F.lit(None).cast("struct<rule:string,verdict:string>")
    return F.coalesce(*fits, nothing)


def decoded(text: Column) -> Column:
    """``text`` with its numeric and ``NAMED`` character references decoded, once."""

    def piece(part: Column) -> Column:
        name = F.regexp_extract(part, r"\A&([a-zA-Z]+);\z", 1)
        digits = F.regexp_extract(part, r"\A&#([0-9]+);\z", 1)
        code = F.when(digits != "", F.conv(digits, 10, 16)).otherwise(
            F.regexp_extract(part, r"\A&#[xX]0*([0-9a-fA-F]+);\z", 1)
        )
        number = F.conv(code, 16, 10).cast("int")
        real = (number > 0) & (number <= 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
        plain = F.when(real, F.decode(F.unhex(F.lpad(code, 8, "0")), "UTF-32")).otherwise(part)
        return F.coalesce(names[name], plain)

    names = F.create_map(*[F.lit(x) for pair in NAMED.items() for x in pair])
    parts = F.regexp_extract_all(text, F.lit(REFERENCES), 0)
    return F.when(F.contains(text, F.lit("&")), F.array_join(F.transform(parts, piece), "")).otherwise(text)


def link_edges(pages: DataFrame) -> DataFrame:
    """(src, dst) urls from canonical links and refresh redirects in the pages' html.

    Character references in a target are decoded. A target that starts with no scheme is resolved
    against its page: ``//host/x``, ``/x`` or relative to the page's folder. Tags in comments,
    scripts and the like are no links. Pages with a null url or html give no edge.
    """
    markup = F.regexp_replace("html", NO_MARKUP, " ")
    found = pages.select(
        "url", F.explode(F.regexp_extract_all(markup, F.lit(LINK_TAG), 0)).alias("tag")
    ).select("url", decoded(F.regexp_extract("tag", TARGET, 1)).alias("target"))
    base = F.concat(F.regexp_extract("url", r"\A(.*?)://", 1), F.lit("://"))
    folder = F.regexp_replace(path_of(F.col("url")), r"[^/]*\z", "")
    target = F.col("target")
    absolute = (
        F.when(target.rlike(ABSOLUTE), target)
        .when(target.startswith("//"), F.concat(F.regexp_extract("url", r"\A(.*?)://", 1), F.lit(":"), target))
        .when(target.startswith("/"), F.concat(base, host_of(F.col("url")), target))
        .otherwise(F.concat(base, host_of(F.col("url")), F.when(folder == "", "/").otherwise(folder), target))
    )
    return found.filter("target <> '' and instr(url, '://') > 0").select(
        F.col("url").alias("src"), absolute.alias("dst")
    )


def judge(urls: DataFrame, edges: DataFrame, rules: list[Rule]) -> DataFrame:
    """Add host, path, rule and verdict to ``urls`` (a column ``url``, any others).

    ``edges`` (src, dst) are redirects and canonical links between urls. Null urls have empty
    host and path and the verdict allow; an empty url is one without ``://``. Urls of any length are
    judged whole. Repeated rows each get their verdict; empty inputs give an empty result. Columns of
    ``urls`` named like a result column are replaced.
    """
    ends = edges.select(node_of(F.col("src")).alias("src"), node_of(F.col("dst")).alias("dst"))
    ends = materialize(ends.filter("src <> '' and dst <> '' and src <> dst").distinct(), "links")
    own = urls.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    own = own.withColumn("__rule", fitting_rule(F.col("host"), F.col("path"), rules))
    if ends.isEmpty():
        own = own.withColumn("__taken", F.lit(None).cast("string"))
    else:
        own = own.withColumn("__node", node_of(F.col("url")))
        aliases = components(ends, "aliases")
        # Every alias is judged by its own text, whether or not a page has it.
        text = F.col("node")
        host = F.regexp_extract(text, r"\A[^/?#]*", 0)
        path = F.regexp_extract(text, r"\A[^/?#]*([^?#]*)", 1)
        ruled = aliases.withColumn("verdict", fitting_rule(host, path, rules)["verdict"])
        decided = (
            ruled.filter("verdict is not null")
            .groupBy("component")
            .agg(F.min("verdict").alias("__taken"))  # 'allow' sorts before 'block'
        )
        taken = aliases.join(decided, "component").select(
            F.col("node").alias("__node"), "__taken"
        )
        own = own.join(taken, "__node", "left")
    return own.withColumns(
        {
            "rule": F.col("__rule.rule"),
            "verdict": F.coalesce("__rule.verdict", "__taken", F.lit(ALLOW)),
        }
    ).drop("__rule", "__taken", "__node")
