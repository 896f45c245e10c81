"""URL filters: pattern rules found through their rarest literal token.

A pattern is matched against host + path of a URL. ``||`` at its start anchors it at the host or any
parent domain, ``*`` stands for any run of characters, ``^`` for a separator (any character but letters
and digits, or an end). A pattern's tokens are the runs of letters and digits that it bounds on both
sides, so a URL that fits holds them as whole tokens. Rules are filed under the token that is rarest in
the URLs at hand; a URL's tokens fetch candidate rules, and only those run their regular expression.
Patterns without a bounded token are tried on every URL.

Of the fitting site rules the longest wins (ties: block first, then the pattern's order); if none fits,
the URL is blocked if any page rule fits it. Host: after the first ``://`` up to ``/``, ``?``, ``#`` or
the end, A-Z lower-cased; path: then up to ``?``, ``#`` or the end. A null URL, or one without ``://``,
has neither and is allowed. Repeated rows are judged alike; an empty table gives an empty result.

Rules go to the tasks in slices of ``SLICE`` rules, each broadcast on its own; with more rules than that
a URL's best rule so far is carried from slice to slice, so there is no limit on rules.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLICE = 100_000
_TOKEN = re.compile("[A-Za-z0-9]+")
_LOWER = {c: c + 32 for c in range(65, 91)}


@dataclass(frozen=True)
class Rule:
    pattern: str
    verdict: str
    name: str
    site: bool = True  # site rules: the longest wins; page rules: any fitting one blocks

    @property
    def length(self) -> int:
        return len(self.name)


def site_rule(text: str, verdict: str) -> Rule:
    """``host/path``: the host with all its subdomains, and paths that start with the path."""
    return Rule("||" + text, verdict, text)


#: The rules of the registered query (fixed values).
SITES = [
    site_rule("com/", "allow"),
    site_rule("example.com/en/", "block"),
    site_rule("www.example.com/en/", "allow"),
    site_rule("net/es/", "block"),
    site_rule("net/fr/", "block"),
]
#: Pages that a training corpus leaves out wherever they are (fixed values).
PAGES = [
    Rule(pattern, "block", pattern, site=False)
    for pattern in (
        "^cheap-pills^", "^casino^", "^poker^", "^porn^", "^xxx^", "^adult^", "^viagra^", "^payday-loans^", "^torrent^",
        "^warez^", "^login^", "^signup^", "^cart^", "^checkout^", "^adserver^", "^doubleclick^",
        "||ads.*", "^wp-admin^", "^unsubscribe^",
    )
]


def expression(pattern: str) -> str:
    """The regular expression of a pattern, for `re.search`."""
    head, rest = ("^(?:[^/]*\\.)?", pattern[2:]) if pattern.startswith("||") else ("", pattern)
    parts = {"*": ".*", "^": "(?:[^A-Za-z0-9]|^|$)"}
    return head + "".join(parts.get(c, re.escape(c)) for c in rest)


def tokens_of(pattern: str) -> list[str]:
    """Tokens that every fitting URL holds whole."""
    anchored = pattern.startswith("||")
    rest = pattern[2:] if anchored else pattern
    found = []
    for match in _TOKEN.finditer(rest):
        a, b = match.span()
        left = rest[a - 1] != "*" if a else anchored
        right = b < len(rest) and rest[b] != "*"
        if left and right:
            found.append(match[0])
    return found


def split_url(url: str | None) -> tuple[str, str]:
    if url is None or "://" not in url:
        return "", ""
    rest = re.split("[?#]", url.split("://", 1)[1], maxsplit=1)[0]
    host, slash, path = rest.partition("/")
    return host.translate(_LOWER), slash + path


class Index:
    """Rules by their rarest token."""

    def __init__(self, rules: list[Rule], frequency: dict[str, int]):
        self.rules = [(r.site, r.length, r.verdict, r.name, re.compile(expression(r.pattern), re.DOTALL)) for r in rules]
        self.by_token: dict[str, list[int]] = {}
        self.always: list[int] = []
        load = Counter()
        for i, rule in enumerate(rules):
            tokens = tokens_of(rule.pattern)
            if not tokens:
                self.always.append(i)
                continue
            rarest = min(tokens, key=lambda t: (frequency.get(t, 0), load[t], t))
            load[rarest] += 1
            self.by_token.setdefault(rarest, []).append(i)

    def candidates(self, text: str) -> list[int]:
        found = [i for t in set(_TOKEN.findall(text)) for i in self.by_token.get(t, ())]
        return sorted(found + self.always)

    def judge(self, text: str, best: tuple | None = None, blocked: bool = False) -> tuple[tuple | None, bool]:
        """The best site rule (length, block first, name), and whether a page rule fits."""
        for i in self.candidates(text):
            site, length, verdict, name, regex = self.rules[i]
            if site:
                rank = (length, verdict == "block", name)
                if (best is None or rank > best) and regex.search(text):
                    best = rank
            elif not blocked and regex.search(text):
                blocked = True
        return best, blocked


def frequencies(urls: DataFrame, url: str, rules: list[Rule]) -> dict[str, int]:
    """In how many rows the rules' tokens occur; at most one number per rule token."""
    wanted = sorted({t for r in rules for t in tokens_of(r.pattern)})
    if not wanted:
        return {}
    spark = urls.sparkSession
    tokens = urls.select(F.explode(F.array_distinct(F.regexp_extract_all(F.col(url), F.lit("([A-Za-z0-9]+)")))).alias("token"))
    held = tokens.join(spark.createDataFrame([(t,) for t in wanted], "token string"), "token", "left_semi")
    return {r[0]: r[1] for r in held.groupBy("token").count().collect()}


def judged(pages: DataFrame, rules: list[Rule] | None = None, url: str = "url") -> DataFrame:
    """``pages`` with host, path, rule (of the winning site rule, else null) and verdict."""
    rules = SITES + PAGES if rules is None else rules
    added = ["host", "path", "rule", "verdict", "_length", "_block", "_page"]
    pages = pages.select([c for c in pages.columns if c not in added])
    names = pages.columns
    spark = pages.sparkSession
    seen = frequencies(pages, url, rules)
    state = [
        T.StructField("_length", T.IntegerType()), T.StructField("_block", T.BooleanType()),
        T.StructField("rule", T.StringType()), T.StructField("_page", T.BooleanType()),
    ]
    out = pages.select(*names, *[F.lit(None).cast(f.dataType).alias(f.name) for f in state])
    for a in range(0, max(1, len(rules)), SLICE):
        out = _slice(out, names, url, spark.sparkContext.broadcast((rules[a : a + SLICE], seen)), state)
    split = F.regexp_extract(F.col(url), "(?s)^.*?://([^/?#]*)([^?#]*)", 1)
    host = F.coalesce(F.translate(split, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))
    path = F.coalesce(F.regexp_extract(F.col(url), "(?s)^.*?://([^/?#]*)([^?#]*)", 2), F.lit(""))
    blocked = F.when(F.col("rule").isNotNull(), F.col("_block")).otherwise(F.col("_page"))
    return out.select(
        *names, host.alias("host"), path.alias("path"), "rule", F.when(blocked, "block").otherwise("allow").alias("verdict")
    )


def _slice(rows: DataFrame, names: list[str], url: str, shared, state: list[T.StructField]) -> DataFrame:
    at = names.index(url)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(*shared.value)
        for batch in batches:
            before = zip(*(batch.column(len(names) + i).to_pylist() for i in range(4)))
            out = []
            for text, (length, block, name, page) in zip(batch.column(at).to_pylist(), before):
                host, path = split_url(text)
                best = None if name is None else (length, block, name)
                best, fits = index.judge(host + path, best, bool(page)) if host or path else (None, False)
                out.append((*(best or (None, None, None)), fits))
            columns = list(zip(*out)) if out else [[]] * 4
            kinds = (pa.int32(), pa.bool_(), pa.string(), pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(len(names))] + [pa.array(c, k) for c, k in zip(columns, kinds)],
                names=[*names, *(f.name for f in state)],
            )

    schema = T.StructType([rows.schema[c] for c in names] + state)
    return rows.mapInArrow(run, schema)
