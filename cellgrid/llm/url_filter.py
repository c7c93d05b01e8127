"""URL filtering by pattern rules that are indexed under their rarest literal token.

A rule is a host suffix with a path prefix (``example.net/en/``) or a free pattern (``*utm_source=*``; ``*`` matches
anything, ``^`` a character that is no letter, digit or one of ``_-.%``).  Both kinds become one regular expression
and a set of literal tokens that every matching URL must contain.  Token frequencies are counted over all URLs, each
rule is filed under its rarest token, and a URL fetches only the rules filed under its own tokens by an equi-join;
only these run their expression.  Rules without a token are filed under the empty token, which every URL has if such
rules exist.

Everything is a DataFrame expression.  A URL is judged once however often it occurs; a rule is filed under one token,
so a (URL, rule) pair appears at most once.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: fixed values: the domain rules and free patterns of the production list
DOMAIN_RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
PATTERN_RULES = (("block", "*utm_source=*"), ("block", "*/ads/*"), ("block", "*sessionid=*"), ("block", "*/track^*"),
                 ("block", "*/es/*"), ("allow", "*/es/*page=2*"), ("allow", "*.html"))
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TOKEN = "[a-z0-9]+"


@dataclass(frozen=True)
class Rule:
    action: str  # allow or block
    text: str
    kind: str  # domain or pattern
    regex: str
    tokens: tuple[str, ...]


def _ascii_lower(text: str) -> str:
    return text.translate(str.maketrans(_UPPER, _LOWER))


def _java_quote(text: str) -> str:
    return "".join(c if re.match(r"[A-Za-z0-9 ]", c) or ord(c) > 127 else "\\" + c for c in text)


def domain_rule(action: str, text: str) -> Rule:
    """Fits the host and its subdomains, if the path starts with the rule's; matched against host + ``?`` + path, as neither holds a ``?``."""
    host, slash, path = text.partition("/")
    host, path = _ascii_lower(host), slash + path
    regex = rf"^([^?]*\.)?{_java_quote(host)}\?{_java_quote(path)}"
    # the last token of the path may go on in the URL unless a delimiter ends it
    ended = re.sub(r"[A-Za-z0-9]+$", "", path)
    return Rule(action, text, "domain", regex, tuple(sorted({*re.findall(_TOKEN, host), *re.findall(_TOKEN, _ascii_lower(ended))})))


def pattern_rule(action: str, text: str) -> Rule:
    """``*`` any run, ``^`` a separator or the end; anchored at both ends, matched against the whole URL, A-Z lower-cased."""
    low = _ascii_lower(text)
    parts = re.split(r"([*^])", low)
    regex = "^" + "".join({"*": ".*", "^": r"(?:[^a-z0-9_.%-]|$)"}.get(p, _java_quote(p)) for p in parts) + "$"
    tokens = set()
    for m in re.finditer(_TOKEN, low):  # a token next to a star may be longer in the URL
        if low[m.start() - 1:m.start()] != "*" and low[m.end():m.end() + 1] != "*":
            tokens.add(m[0])
    return Rule(action, text, "pattern", f"(?s){regex}", tuple(sorted(tokens)))


def production_rules() -> list[Rule]:
    return [domain_rule(*r) for r in DOMAIN_RULES] + [pattern_rule(*r) for r in PATTERN_RULES]


def rule_table(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    """The rules as literals in the plan, so that Spark knows how small they are.  Long lists belong in a table."""
    rows = [F.struct(F.lit(i).alias("rule_no"), F.lit(r.action).alias("action"), F.lit(r.text).alias("rule"),
                     F.lit(r.kind).alias("kind"), F.lit(r.regex).alias("regex"),
                     F.array(*[F.lit(t) for t in r.tokens or ("",)]).alias("tokens")) for i, r in enumerate(rules)]
    return spark.range(1).select(F.inline(F.array(*rows)))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host after the first ``://`` up to / ? # or the end, A-Z lower-cased; path then up to ? # or the end."""
    ok = F.coalesce(F.instr(url, "://") > 0, F.lit(False))
    rest = F.substring(url, F.instr(url, "://") + 3, F.length(url))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.when(ok, host).otherwise(""), F.when(ok, path).otherwise("")


def judge(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """One row per page: id, host, path, rule (the longest fitting domain rule), verdict (allow or block).

    The longest fitting domain rule decides (ties: the smaller text).  Else the longest matching free pattern does
    (ties: allow before block, then the smaller text), else ``default``.  A null URL, or one without ``://``, has an empty
    host and path and fits no domain rule; free patterns still see a URL without ``://``.  Repeated pages are judged
    alike, one row each.  Other columns are not read.
    """
    p = pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").alias("url"))
    host, path = host_and_path(F.col("url"))
    urls = p.filter(F.col("url").isNotNull()).select("url").distinct().withColumns({"host": host, "path": path})
    low = F.translate("url", _UPPER, _LOWER)
    tokens = F.array_append(F.array_distinct(F.regexp_extract_all(low, F.lit(f"({_TOKEN})"), 1)), "")
    literal = rules.select("rule_no", F.explode("tokens").alias("token"))
    seen = (urls.select(F.explode(tokens).alias("token"), "url", "host", "path")
            .join(literal.select("token").distinct(), "token", "left_semi"))
    frequency = seen.groupBy("token").agg(F.count("*").alias("n"))
    index = (literal.join(frequency, "token", "left").fillna({"n": 0})
             .groupBy("rule_no").agg(F.min(F.struct("n", "token")).alias("rarest")).select("rule_no", F.col("rarest.token").alias("token")))
    filed = index.join(rules.drop("tokens"), "rule_no")
    subject = F.when(F.col("kind") == "domain", F.concat("host", F.lit("?"), "path")).otherwise(F.translate("url", _UPPER, _LOWER))
    fits = seen.join(filed, "token").filter(F.rlike(subject, F.col("regex")))
    # order: domain rules first, longest first, then allow, then text
    rank = F.struct((F.col("kind") != "domain").alias("free"), (-F.length("rule")).alias("short"),
                    F.when(F.col("kind") == "domain", F.lit("")).otherwise(F.col("action")).alias("a"), "rule", "action")
    best = fits.groupBy("url").agg(F.min(rank).alias("best"))
    host, path = host_and_path(F.col("url"))
    return p.join(best, "url", "left").select(
        "page_id", host.alias("host"), path.alias("path"),
        F.when(~F.col("best.free"), F.col("best.rule")).alias("rule"),
        F.coalesce(F.col("best.action"), F.lit(default)).alias("verdict"))


def _oracle() -> str:
    """Every rule against every page."""
    def quoted(x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    values = []
    for i, r in enumerate(production_rules()):
        host, slash, path = r.text.partition("/")
        parts = (_ascii_lower(host), slash + path) if r.kind == "domain" else ("", "")
        values.append(f"({i}, {quoted(r.action)}, {quoted(r.text)}, {quoted(r.kind)}, {quoted(parts[0])}, {quoted(parts[1])}, {quoted(r.regex if r.kind == 'pattern' else '')})")
    low = f"translate(url, '{_UPPER}', '{_LOWER}')"
    return f"""
WITH rule(no, action, rule, kind, rhost, rpath, regex) AS (VALUES {', '.join(values)}),
split AS (SELECT *, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) END AS rest, row_number() OVER () AS r FROM pages),
page AS (SELECT r, page_id, url, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_LOWER}'), '') AS host,
                coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM split),
fit AS (SELECT r, rule.* FROM page, rule WHERE url IS NOT NULL AND CASE WHEN kind = 'domain'
          THEN (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
          ELSE regexp_matches({low}, regex) END),
best AS (SELECT r, first(rule ORDER BY kind = 'pattern', -length(rule), CASE WHEN kind = 'domain' THEN '' ELSE action END, rule) AS rule,
                first(action ORDER BY kind = 'pattern', -length(rule), CASE WHEN kind = 'domain' THEN '' ELSE action END, rule) AS action,
                first(kind ORDER BY kind = 'pattern', -length(rule), CASE WHEN kind = 'domain' THEN '' ELSE action END, rule) AS kind
         FROM fit GROUP BY r)
SELECT page_id, host, path, CASE WHEN best.kind = 'domain' THEN best.rule END AS rule, coalesce(best.action, 'allow') AS verdict
FROM page LEFT JOIN best USING (r)
"""


ORACLE_SQL = _oracle()
