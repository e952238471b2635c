"""URL allow and block rules, found through an index on each rule's rarest literal token."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerline.llm.common import ship

ALLOW, BLOCK = "allow", "block"
#: Rules are handed over with each task, so their number is bounded.
MAX_RULES = 200_000
_TOKEN = re.compile(r"[a-z0-9]+")
_SCHEMA = "host string, path string, rule string, verdict string"


class Rule(NamedTuple):
    """Fits ``host`` and its subdomains where the path starts with ``path``.

    An empty ``host`` fits every host. ``*`` in the path stands for any characters.
    """

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def fits_host(self, host: str) -> bool:
        return not self.host or host == self.host or host.endswith("." + self.host)

    def path_regex(self) -> str:
        """Matched from the start of the path."""
        return ".*".join(re.escape(part) for part in self.path.split("*"))

    def tokens(self) -> set[str]:
        """Literal tokens that every fitting URL holds whole.

        The path's last token may go on in the URL, as may tokens beside a
        ``*``; those are left out. Tokens are lower case, as hosts are.
        """
        open_ended = re.sub(r"[A-Za-z0-9]+(?=\*|$)|(?<=\*)[A-Za-z0-9]+", "", self.path)
        return set(_TOKEN.findall(self.host.lower())) | set(_TOKEN.findall(open_ended.lower()))


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    end = re.search(r"[/?#]", rest)
    host, tail = (rest[: end.start()], rest[end.start():]) if end else (rest, "")
    path = re.split(r"[?#]", tail, maxsplit=1)[0]
    return re.sub(r"[A-Z]+", lambda m: m[0].lower(), host), path


def url_tokens(host: str, path: str) -> set[str]:
    return set(_TOKEN.findall(f"{host} {path}".lower()))


def token_counts(urls: DataFrame, url_col: str, tokens: set[str]) -> dict[str, int]:
    """How many URLs hold each of the rules' tokens, over all rows."""
    wanted = F.array(*[F.lit(t) for t in sorted(tokens)])
    held = F.array_intersect(F.split(F.lower(F.col(url_col)), "[^a-z0-9]+"), wanted)
    counts = urls.select(F.explode(held).alias("token")).groupBy("token").count()
    return {row["token"]: row["count"] for row in counts.collect()}


def index_rules(
    rules: Sequence[Rule], counts: dict[str, int]
) -> tuple[dict[str, list[int]], list[int]]:
    """Rule numbers by rarest token, and those without a token."""
    index: dict[str, list[int]] = {}
    always: list[int] = []
    for number, rule in enumerate(rules):
        tokens = rule.tokens()
        if tokens:
            index.setdefault(min(tokens, key=lambda t: (counts.get(t, 0), t)), []).append(number)
        else:
            always.append(number)
    return index, always


def judge_urls(
    urls: DataFrame, rules: Sequence[Rule], id_col: str = "page_id", url_col: str = "url",
    default: str = ALLOW,
) -> DataFrame:
    """One row per input row: id, ``host``, ``path``, ``rule`` (or NULL) and ``verdict``.

    The longest rule (host and path together) wins, then the earlier one. URLs
    that no rule fits get ``default``. A NULL URL, or one without ``://``, has
    an empty host and path. Repeated rows are judged alike; no rows, no result.
    Work is one narrow pass; besides, one count of the rules' tokens.
    """
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; at most {MAX_RULES} can be handed to the tasks")
    ship(urls.sparkSession)
    tokens = set().union(*[rule.tokens() for rule in rules]) if rules else set()
    index, always = index_rules(rules, token_counts(urls, url_col, tokens) if tokens else {})
    rules = list(rules)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns: dict[int, re.Pattern] = {}

        def verdict(url):
            host, path = split_url(url)
            found = list(always)
            for token in url_tokens(host, path):
                found += index.get(token, ())
            best = None
            for number in sorted(found):
                rule = rules[number]
                if (best is not None and len(rule.name) <= len(best.name)) or not rule.fits_host(host):
                    continue
                if number not in patterns:
                    patterns[number] = re.compile(rule.path_regex(), re.DOTALL)
                if patterns[number].match(path):
                    best = rule
            if best is None:
                return host, path, None, default
            return host, path, best.name, best.verdict

        for batch in batches:
            rows = [verdict(url) for url in batch.column(1).to_pylist()]
            columns = [pa.array([row[i] for row in rows], pa.string()) for i in range(4)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names)

    kind = urls.schema[id_col].dataType.simpleString()
    names = [id_col, "host", "path", "rule", "verdict"]
    return urls.select(id_col, url_col).mapInArrow(judge, f"`{id_col}` {kind}, {_SCHEMA}")
