"""URL rules indexed by their rarest literal token.

A rule is an action for a host with its subdomains and a path prefix.  Each rule becomes
a regular expression; its literal tokens (the alphanumeric runs of host and path) are
counted over the urls of the table, and the rule is filed under the one that the fewest
urls have.  The tokens of a url fetch its candidate rules, and only those expressions
run.  The longest rule that fits decides.

Scale: one pass counts the rules' tokens (one row per token, combined on the map side);
the second is a map over the urls with no shuffle.  The rules are a parameter of the
query, held by every task; a hot host costs nothing, since no rows are grouped by it.

Edge cases: a null url or one without ``://`` has empty host and path and no rule; a rule
without any literal token is a candidate for every url; of rules with the same length
the first one in the list decides; repeated rows are judged alike.  Only the two named
columns are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOKEN = "[A-Za-z0-9]+"
JUDGED = "page_id long, host string, path string, rule string, verdict string"


@dataclass(frozen=True)
class Rule:
    action: str  # "allow" or "block"
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path

    @property
    def patterns(self) -> tuple[re.Pattern, re.Pattern]:
        """For the whole host and for the beginning of the path."""
        return re.compile(rf"(?s:.*\.)?{re.escape(self.host)}"), re.compile(re.escape(self.path))

    @property
    def tokens(self) -> list[str]:
        # A prefix may end inside a token of the url: the last token of the path is
        # literal only where something that is no token follows it.
        whole = re.findall(TOKEN, self.host)
        return whole + re.findall(TOKEN + "(?=[^A-Za-z0-9])", self.path)


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(lower, F.lit("")), F.coalesce(path, F.lit(""))


def rare_tokens(pages: DataFrame, rules: list[Rule]) -> dict[str, list[int]]:
    """Rules by the token that stands in the fewest urls (columns host, path)."""
    known = sorted({t for r in rules for t in r.tokens})
    tokens = F.array_distinct(F.regexp_extract_all(F.concat_ws(" ", "host", "path"), F.lit(TOKEN), F.lit(0)))
    counted = pages.select(F.explode(tokens).alias("t")).where(F.col("t").isin(known)).groupBy("t").count()
    seen = {r["t"]: r["count"] for r in counted.collect()}  # one row per token of the rules
    index: dict[str, list[int]] = {}
    for i, r in enumerate(rules):
        index.setdefault(min(r.tokens, key=lambda t: (seen.get(t, 0), t), default=""), []).append(i)
    return index


def judge(pages: DataFrame, rules: list[Rule], *, default: str = "allow", id_col: str = "page_id",
          url_col: str = "url") -> DataFrame:
    """One row per row of ``pages`` (schema ``JUDGED``); rule is the text of the deciding
    rule or null."""
    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"))
    rows = rows.select("page_id", *[c.alias(n) for c, n in zip(host_and_path(F.col("url")), ("host", "path"))])
    index = rare_tokens(rows, rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, compiled = re.compile(TOKEN), [r.patterns for r in rules]
        always = index.get("", [])
        for b in batches:
            names, verdicts = [], []
            for host, path in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                best = None
                candidates = {*always, *(i for t in set(tokens.findall(f"{host} {path}")) for i in index.get(t, ()))}
                for i in sorted(candidates):
                    if compiled[i][0].fullmatch(host) and compiled[i][1].match(path) and (best is None or len(rules[i].text) > len(rules[best].text)):
                        best = i
                names.append(None if best is None else rules[best].text)
                verdicts.append(default if best is None else rules[best].action)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(names, pa.string()), pa.array(verdicts, pa.string())],
                                             names=["page_id", "host", "path", "rule", "verdict"])

    return rows.mapInArrow(run, JUDGED)
