"""URL filtering: pattern rules indexed by their rarest literal token.

A rule is a host suffix and a path prefix with ``*`` wildcards, compiled to a regular expression. Its
literal tokens are the runs of letters and digits that any matching URL must hold as whole tokens; the
rule is indexed under the one that is rarest among the URLs at hand. A URL's tokens fetch the candidate
rules and only their expressions are run. The longest fitting rule decides; without one the default
verdict holds. Rules without any whole token are candidates for every URL.

The rule index is broadcast: at most ``MAX_RULES`` rules, checked; token counts are gathered only for
tokens that occur in rules.

Defined results: a null URL or one without ``://`` has empty host and path and gets the default;
hosts match on label borders; equally long rules: the first in text order; repeated rows each keep
theirs; no rules or no rows work; extra columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._text import table, thrifty

MAX_RULES = 200_000
TOKEN = re.compile("[0-9a-z]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def expressions(self) -> tuple[re.Pattern, re.Pattern]:
        host, path = (".*".join(map(re.escape, x.split("*"))) for x in (self.host, self.path))
        return re.compile(rf"(?:.*\.)?{host}", re.DOTALL), re.compile(path, re.DOTALL)

    def tokens(self) -> set[str]:
        """Tokens that every matching URL holds whole: a host's at its ends are, a path's last may go on."""
        out = {x[0] for x in TOKEN.finditer(self.host) if not touches(self.host, x)}
        path = self.path.translate(FOLD)
        return out | {x[0] for x in TOKEN.finditer(path) if x.end() < len(path) and not touches(path, x)}


def touches(text: str, token: re.Match) -> bool:
    return text[token.end() : token.end() + 1] == "*" or text[max(0, token.start() - 1) : token.start()] == "*"


RULES = (Rule("org", "/", "allow"), Rule("example.org", "/es/", "block"), Rule("example.org", "/en/1", "block"), Rule("com", "/fr/", "allow"), Rule("com", "/de/", "block"))


def parts(url: str | None) -> tuple[str, str]:
    _, sep, rest = (url or "").partition("://")
    if not sep:
        return "", ""
    m = re.match(r"([^/?#]*)([^?#]*)", rest)
    return m[1].translate(FOLD), m[2]


def url_tokens(host: str, path: str) -> set[str]:
    return {*TOKEN.findall(host), *TOKEN.findall(path.translate(FOLD))}


class Index:
    def __init__(self, rules: list[Rule], counts: dict[str, int]):
        self.by_token: dict[str, list[tuple[Rule, tuple[re.Pattern, re.Pattern]]]] = {}
        for r in rules:
            token = min(r.tokens(), key=lambda t: (counts.get(t, 0), t), default="")
            self.by_token.setdefault(token, []).append((r, r.expressions()))

    def candidates(self, host: str, path: str):
        for token in ("", *url_tokens(host, path)):
            yield from self.by_token.get(token, ())

    def judge(self, host: str, path: str) -> Rule | None:
        found = [r for r, (on_host, on_path) in self.candidates(host, path) if on_host.fullmatch(host) and on_path.match(path)]
        return min(found, key=lambda r: (-len(r.name), r.name, r.verdict), default=None) if host else None


def token_counts(pages: DataFrame, url_col: str, wanted: set[str]) -> dict[str, int]:
    """How many URLs hold each token that stands in some rule."""
    known = pages.sparkSession.sparkContext.broadcast(frozenset(wanted))

    def run(batches):
        for batch in batches:
            n: dict[str, int] = {}
            for url in batch.column(0).to_pylist():
                for t in url_tokens(*parts(url)) & known.value:
                    n[t] = n.get(t, 0) + 1
            yield pa.RecordBatch.from_pydict({"token": pa.array(list(n), pa.string()), "n": pa.array(list(n.values()), pa.int64())})

    return {r["token"]: r["n"] for r in pages.select(url_col).mapInArrow(thrifty(run), "token string, n long").groupBy("token").agg(F.sum("n").alias("n")).toLocalIterator()}


def filter_urls(pages: DataFrame, rules=RULES, default: str = "allow", id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """id, host, path, rule (its host and path, else null), verdict; one row for each page."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"at most {MAX_RULES} rules can be broadcast")
    rules, kind = list(rules), pages.schema[id_col].dataType.simpleString()
    counts = token_counts(pages, url_col, set().union(*(r.tokens() for r in rules)))
    held = pages.sparkSession.sparkContext.broadcast((rules, counts))
    built: dict[int, Index] = {}

    def run(batches):
        index = built.get(0) or built.setdefault(0, Index(*held.value))
        for batch in batches:
            rows = []
            for url in batch.column("url").to_pylist():
                host, path = parts(url)
                r = index.judge(host, path)
                rows.append((host, path, r and r.name, r.verdict if r else default))
            yield pa.RecordBatch.from_arrays([batch.column("id"), *(pa.array([x[k] for x in rows], pa.string()) for k in range(4))], ["id", "host", "path", "rule", "verdict"])

    out = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url")).mapInArrow(thrifty(run), f"id {kind}, host string, path string, rule string, verdict string")
    return out.withColumnRenamed("id", id_col)


def query(spark, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"))
