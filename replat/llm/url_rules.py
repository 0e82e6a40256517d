"""URL filters: pattern rules found through their rarest literal token (operator 8)."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replat.llm.common import ascii_lower

TOKEN = "[a-z0-9]+"
HOST = re.compile(r"://([^/?#]*)([^?#]*)")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@dataclass(frozen=True)
class Rule:
    """``pattern`` decides; every url it fits holds each of ``tokens`` as a whole run of a-z and 0-9.

    A place rule is tried on host + path (``place``: its text, the longest wins); any other on the whole
    url in lower case, and any block among those that fit beats the default.
    """

    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    place: str | None = None


def place_rule(verdict: str, place: str) -> Rule:
    """``host/path``: the host itself and its subdomains, where the path starts with the rule's."""
    host, _, path = place.partition("/")
    host = host.translate(LOWER)
    # the last run of the path may go on in a url, so it is no whole token there
    whole = re.findall(TOKEN, host) + re.findall(TOKEN + "(?=[^a-z0-9])", f"/{path}".translate(LOWER))
    return Rule(verdict, rf"(?:[^/]*\.)?{re.escape(host)}/{re.escape(path)}", tuple(dict.fromkeys(whole)), place)


def word_rule(*words: str) -> Rule:
    """Block urls in which the words stand next to each other, one separator between them."""
    inner = "[^a-z0-9]".join(words)
    return Rule("block", f"(^|[^a-z0-9]){inner}([^a-z0-9]|$)", words)


def ending_rule(ending: str) -> Rule:
    """Block urls whose path ends in a file name ending."""
    return Rule("block", rf"[.]{ending}([?#]|$)", (ending,))


PLACES = (
    place_rule("allow", "com/"),
    place_rule("block", "example.com/en/"),
    place_rule("allow", "www.example.com/en/"),
    place_rule("block", "net/es/"),
    place_rule("block", "net/fr/"),
)
PATTERNS = (
    *map(word_rule, ("casino", "poker", "porn", "xxx", "viagra", "escort", "torrent", "adserver", "doubleclick")),
    word_rule("wp", "login", "php"),
    word_rule("cgi", "bin"),
    *map(ending_rule, ("exe", "apk", "dmg", "zip", "iso")),
)


def token_counts(urls: DataFrame, url: str, tokens: Iterable[str]) -> dict[str, int]:
    """In how many rows each of the rules' tokens occurs; as many numbers as there are tokens."""
    wanted = sorted(set(tokens))
    if not wanted:
        return {}
    held = F.array_intersect(F.regexp_extract_all(ascii_lower(F.col(url)), F.lit(f"({TOKEN})"), F.lit(1)), F.array(*map(F.lit, wanted)))
    rows = urls.select(F.explode(held).alias("token")).groupBy("token").count().collect()
    return dict.fromkeys(wanted, 0) | {r["token"]: r["count"] for r in rows}


def rule_index(rules: Iterable[Rule], counts: dict[str, int]) -> tuple[dict[str, list[Rule]], list[Rule]]:
    """Rules by their rarest token, and the rules without one, which every url is tried on."""
    by_token: dict[str, list[Rule]] = defaultdict(list)
    always = []
    for rule in rules:
        if rule.tokens:
            by_token[min(rule.tokens, key=lambda t: (counts.get(t, 0), t))].append(rule)
        else:
            always.append(rule)
    return dict(by_token), always


class Judge:
    def __init__(self, index: dict[str, list[Rule]], always: list[Rule]):
        def ready(rules: list[Rule]) -> list[tuple[Rule, re.Pattern]]:
            return [(r, re.compile(r.pattern)) for r in rules]

        self.index = {token: ready(rules) for token, rules in index.items()}
        self.always = ready(always)
        self.tokens = re.compile(TOKEN)

    def __call__(self, url: str | None) -> tuple[str, str, str | None, str]:
        parts = HOST.search(url or "")
        host, path = (parts[1].translate(LOWER), parts[2]) if parts else ("", "")
        low = (url or "").translate(LOWER)
        place, verdict = None, "allow"
        tried = list(self.always)
        for token in set(self.tokens.findall(low)) & self.index.keys():
            tried += self.index[token]
        for rule, pattern in tried:
            if rule.place is None:
                if place is None and pattern.search(low):
                    verdict = rule.verdict
            elif (place is None or len(rule.place) > len(place)) and pattern.match(host + path):
                place, verdict = rule.place, rule.verdict
        return host, path, place, verdict


def judged_urls(
    pages: DataFrame,
    places: Iterable[Rule] = PLACES,
    patterns: Iterable[Rule] = PATTERNS,
    key: str = "page_id",
    url: str = "url",
) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every row.

    The longest fitting place rule decides (of equal ones the first); without one a url is blocked if a
    pattern rule fits, else allowed. A null url, or one without ``://``, has an empty host and path;
    the pattern rules still see the text of the latter. Repeated rows and keys give repeated rows.
    """
    rules = [*places, *patterns]
    narrow = pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"))
    index, always = rule_index(rules, token_counts(narrow, "url", (t for r in rules for t in r.tokens)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(index, always)
        for batch in batches:
            found = [judge(u) for u in batch.column("url").to_pylist()]
            columns = [pa.array([f[i] for f in found], pa.string()) for i in range(4)]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), *columns], ["page_id", "host", "path", "rule", "verdict"])

    return narrow.mapInArrow(run, "page_id long, host string, path string, rule string, verdict string")


def place_fits(host: Column, path: Column, place: str) -> Column:
    """The same test as a column, for callers that need one rule only."""
    name, _, start = place.partition("/")
    return ((host == name) | host.endswith(f".{name}")) & path.startswith(f"/{start}")


def oracle() -> str:
    """DuckDB SQL for the default rules, which tries every rule on every url."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    whens = []
    for rule in sorted(PLACES, key=lambda r: -len(r.place)):
        host, _, path = rule.place.partition("/")
        whens.append(f"when (host = '{host}' or ends_with(host, '.{host}')) and starts_with(path, '/{path}') then '{rule.place}'")
    verdicts = " ".join(f"when rule = '{r.place}' then '{r.verdict}'" for r in PLACES)
    blocked = " or ".join(f"regexp_matches(low, '{r.pattern}')" for r in PATTERNS)
    return f"""
    with cut as (
      select page_id, url, translate(coalesce(url, ''), '{upper}', '{lower}') as low,
             case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest
      from pages),
    parts as (
      select page_id, low, translate(regexp_extract(rest, '^[^/?#]*'), '{upper}', '{lower}') as host,
             regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') as path
      from cut),
    ruled as (select *, case {' '.join(whens)} end as rule from parts)
    select page_id, host, path, rule,
           case {verdicts} when {blocked} then 'block' else 'allow' end as verdict
    from ruled"""
