"""URL rules by longest match in a trie of reversed host labels, then path segments.

The trie is sent to all tasks if the rules are at most MAX_RULES and their texts at most MAX_CHARS.
More rules are joined on the host instead: each different address meets the rules of its host and of
the domains above it.
"""

from __future__ import annotations

from typing import NamedTuple

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweave.llm.common import map_rows

MAX_RULES, MAX_CHARS = 500_000, 50_000_000
ALLOW, BLOCK = "allow", "block"

RULE_SCHEMA = "host STRING, path STRING, verdict STRING"
RULES = [("org", "/", ALLOW), ("example.org", "/es/", BLOCK), ("example.org", "/en/1", BLOCK),
         ("com", "/fr/", ALLOW), ("com", "/de/", BLOCK)]

_ADDRESS = regex.compile(r"(?s)^.*?://([^/?#]*)([^?#]*)")


class _Path:
    """Segments that rules have in full, and the beginnings of the next one at which rules end."""

    def __init__(self) -> None:
        self.next: dict[str, _Path] = {}
        self.ends: dict[str, tuple[str, str]] = {}
        self.whole: tuple[str, str] | None = None


class _Host:
    def __init__(self) -> None:
        self.next: dict[str, _Host] = {}
        self.paths: _Path | None = None


class Match(NamedTuple):
    length: int
    host: int
    rule: str
    verdict: str


class Trie:
    """Rules (host, path, verdict). Of rules with the same host and path, one that blocks wins."""

    def __init__(self, rules: list[tuple[str, str, str]]):
        self.root = _Host()
        for host, path, verdict in sorted(rules, key=lambda r: r[2]):
            node = self.root
            for label in reversed(host.split(".")) if host else ():
                node = node.next.setdefault(label, _Host())
            if node.paths is None:
                node.paths = _Path()
            place, found = node.paths, (host + path, verdict)
            if not path:
                place.whole = found
                continue
            *full, rest = path.split("/")
            for segment in full:
                place = place.next.setdefault(segment, _Path())
            place.ends[rest] = found

    def match(self, host: str, path: str) -> tuple[str, str] | None:
        """The longest rule that fits: its text and verdict. Of equal length, the longer host."""
        best = Match(-1, -1, "", "")
        node, labels = self.root, host.split(".") if host else []
        segments = path.split("/")
        for depth in range(len(labels) + 1):
            if node.paths is not None:
                best = max(best, *self._fits(node.paths, segments, depth), key=lambda m: m[:2])
            if depth == len(labels) or labels[-1 - depth] not in node.next:
                break
            node = node.next[labels[-1 - depth]]
        return None if best.length < 0 else (best.rule, best.verdict)

    @staticmethod
    def _fits(place: _Path, segments: list[str], depth: int) -> list[Match]:
        found = [] if place.whole is None else [place.whole]
        for number, segment in enumerate(segments):
            # The segment begins with the rule's last one, which may end within it.
            if number and place.ends:
                found += [place.ends[segment[:n]] for n in {len(e) for e in place.ends}
                          if segment[:n] in place.ends]
            if segment not in place.next:
                break
            place = place.next[segment]
        return [Match(len(rule), depth, rule, verdict) for rule, verdict in found] or [
            Match(-1, -1, "", "")]


def address(url: str | None) -> tuple[str, str]:
    """Host and path of a url; both empty for null and where there is no `://`."""
    found = _ADDRESS.match(url or "")
    if found is None:
        return "", ""
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in found[1])
    return host, found[2]


def parse_rules(rules: DataFrame) -> DataFrame:
    """Rules with nulls as empty texts, the host in lower case, without repetitions."""
    return rules.select(*[F.coalesce(rules[n], F.lit("")).alias(n) for n in ("host", "path")],
                        rules["verdict"]).withColumn(
        "host", F.translate("host", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    ).groupBy("host", "path").agg(F.max("verdict").alias("verdict"))


def judge(pages: DataFrame, rules: DataFrame, default: str = ALLOW, max_rules: int = MAX_RULES,
          keep: list[str] | None = None) -> DataFrame:
    """Every row of `pages` with `host`, `path`, `rule` (its text, or null) and `verdict`.

    A rule (host, path, verdict) fits its host and all domains below it if the url's path starts with
    the rule's. An empty host fits all. The longest rule wins, of equally long ones that with the
    longer host; without a rule, `default`. A null url or one without `://` has an empty host and
    path. Input columns named like an added one are replaced by it; `keep` names the input columns
    to return. Empty tables give no rows, or the default.
    """
    rules = parse_rules(rules)
    count, chars = rules.agg(F.count("*"), F.sum(F.length("host") + F.length("path"))).first()
    if count > max_rules or (chars or 0) > MAX_CHARS:
        return _by_join(pages, rules, default, keep)
    trie = pages.sparkSession.sparkContext.broadcast(Trie([tuple(r) for r in rules.collect()]))

    def outcome(batch: pa.RecordBatch) -> list[pa.Array]:
        places = [address(u.as_py()) for u in batch.column("url")]
        found = [trie.value.match(*p) or (None, default) for p in places]
        return [pa.array(column, pa.string())
                for column in ([p[0] for p in places], [p[1] for p in places],
                               [f[0] for f in found], [f[1] for f in found])]

    return map_rows(pages, {"url": pages["url"]}, _ADDED, outcome, keep)


_ADDED = "host STRING, path STRING, rule STRING, verdict STRING"


def _by_join(pages: DataFrame, rules: DataFrame, default: str, keep: list[str] | None) -> DataFrame:
    def outcome(batch: pa.RecordBatch) -> list[pa.Array]:
        places = [address(u.as_py()) for u in batch.column("url")]
        return [pa.array([p[i] for p in places], pa.string()) for i in (0, 1)]

    placed = map_rows(pages, {"url": pages["url"]}, "host STRING, path STRING", outcome, keep)
    labels = F.split("host", r"\.")
    above = F.transform(F.sequence(F.lit(1), F.size(labels)),
                        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    met = (placed.select("host", "path").distinct()
           .withColumn("of", F.explode(F.array_distinct(F.concat(above, F.array(F.lit(""))))))
           .join(rules.select(F.col("host").alias("of"), F.col("path").alias("begin"),
                              F.col("verdict").alias("found")), "of")
           .where(F.col("path").startswith(F.col("begin"))))
    best = met.groupBy("host", "path").agg(F.max(F.struct(
        (F.length("of") + F.length("begin")).alias("length"), F.length("of").alias("host_length"),
        F.concat("of", "begin").alias("rule"), F.col("found").alias("verdict"))).alias("best"))
    others = [c for c in placed.columns if c.lower() not in ("rule", "verdict", "best")]
    return placed.join(best, ["host", "path"], "left").select(
        *[c for c in others if c not in ("host", "path")], "host", "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"))


def default_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(RULES, RULE_SCHEMA)


def report(pages: DataFrame) -> DataFrame:
    """page_id and the verdict on the url of every row of `pages`, by the rules above."""
    return judge(pages.select("page_id", "url"), default_rules(pages.sparkSession),
                 keep=["page_id"])


# The same with DuckDB: of the rules that fit, the longest.
ORACLE_SQL = f"""
WITH rules(host, path, verdict) AS (VALUES {", ".join(map(str, RULES))}),
cut AS (
  SELECT page_id, url, row_number() OVER () AS row,
    CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
placed AS (
  SELECT page_id, row,
    translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
              'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut),
fitting AS (
  SELECT p.row, r.host || r.path AS rule, r.verdict,
    row_number() OVER (PARTITION BY p.row
      ORDER BY length(r.host || r.path) DESC, length(r.host) DESC) AS place
  FROM placed p JOIN rules r
    ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path))
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM placed p LEFT JOIN fitting f ON p.row = f.row AND f.place = 1
"""
