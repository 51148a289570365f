"""URL verdicts: host and path rules first, then a weighted vocabulary searched by an Aho-Corasick automaton.

One pass over the url column, no shuffle. The automaton finds every term of the vocabulary in one scan of the url; a hit counts only between
boundaries (no letter or digit next to it). One strict term, or several distinct soft terms, block a url. A vocabulary is two lists of
terms, or a table of terms and weights, of which the strict ones weigh 1 or more."""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.llm.common import rows_within_bytes

#: The vocabulary in use when none is given.
STRICT = ("casino", "porn", "xxx", "viagra", "phishing", "malware", "warez")
SOFT = ("bet", "bets", "win", "free", "cheap", "pills", "ads", "track", "adult", "loan", "loans", "poker", "bonus", "crypto", "click", "sex", "slots", "replica")
LOWER = {c: c + 32 for c in range(65, 91)}


class Rule(NamedTuple):
    verdict: str  # allow or block
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path

    @classmethod
    def parse(cls, verdict: str, text: str) -> Rule:
        """`example.com/en/`: a host, then a path that begins with a slash."""
        host, slash, path = text.partition("/")
        if verdict not in ("allow", "block") or not slash:
            raise ValueError(f"no rule: {verdict} {text}")
        return cls(verdict, host.translate(LOWER), slash + path)


RULES = tuple(Rule.parse(*x.split()) for x in ("allow com/", "block example.com/en/", "allow www.example.com/en/", "block net/es/", "block net/fr/"))


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path: what follows the first :// up to / ? # or the end, and then up to ? # or the end. Null, or no ://: both empty."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    host = re.match(r"[^/?#]*", rest)[0]
    return host.translate(LOWER), re.match(r"[^?#]*", rest[len(host) :])[0]


class Judge:
    def __init__(self, rules: tuple[Rule, ...], strict: tuple[str, ...], soft: tuple[str, ...], soft_needed: int):
        self.by_host: dict[str, list[Rule]] = {}
        for r in rules:
            self.by_host.setdefault(r.host, []).append(r)
        self.soft_needed, self.terms = soft_needed, ahocorasick.Automaton()
        for kind, words in ((0, soft), (1, strict)):  # a term in both lists is strict
            for w in words:
                if w:
                    self.terms.add_word(w.translate(LOWER), (kind, w.translate(LOWER)))
        self.any = len(self.terms) > 0
        if self.any:
            self.terms.make_automaton()

    def rule(self, host: str, path: str) -> Rule | None:
        """The longest rule whose host is this host or a parent domain and whose path starts the path; of equals, block."""
        best, rest = None, host
        while rest:
            for r in self.by_host.get(rest, ()):
                if path.startswith(r.path) and (best is None or (len(r.text), r.verdict) > (len(best.text), best.verdict)):
                    best = r
            rest = rest.partition(".")[2]
        return best

    def hits(self, url: str) -> tuple[int, int]:
        """Distinct strict and soft terms of a url that stand between boundaries."""
        low, found = url.translate(LOWER), (set(), set())
        if self.any:
            for end, (kind, w) in self.terms.iter(low):
                a, z = end - len(w), end + 1
                if (a < 0 or not low[a].isalnum()) and (z == len(low) or not low[z].isalnum()):
                    found[kind].add(w)
        return len(found[1]), len(found[0])

    def __call__(self, url: str | None) -> tuple[str, str, str | None, str, int, int]:
        host, path = split_url(url)
        rule, (strict, soft) = self.rule(host, path), self.hits(url or "")
        verdict = rule.verdict if rule else "block" if strict or soft >= self.soft_needed else "allow"
        return host, path, rule.text if rule else None, verdict, strict, soft


#: Bytes of a vocabulary table at most: it goes to every worker.
MOST_BYTES = 64 * 2**20


def vocabulary(terms: DataFrame, term_col: str = "term", weight_col: str = "weight") -> tuple[tuple[str, ...], tuple[str, ...]]:
    """(strict, soft) terms of a table: those of weight 1 or more, and those of a smaller weight above 0; null or empty terms and other weights don't count. The
    table's size is checked before it comes to the driver."""
    rows = terms.select(F.col(term_col).cast("string").alias("term"), F.col(weight_col).cast("double").alias("weight")).where("term <> '' and weight > 0")
    if not rows_within_bytes(rows, ["term"], MOST_BYTES, MOST_BYTES):
        raise ValueError(f"the vocabulary has more than {MOST_BYTES} bytes")
    found = rows.groupBy("term").agg(F.max("weight").alias("weight")).collect()
    return tuple(sorted(r["term"] for r in found if r["weight"] >= 1)), tuple(sorted(r["term"] for r in found if r["weight"] < 1))


def judge_urls(df: DataFrame, rules: tuple[Rule, ...] = RULES, strict: tuple[str, ...] = STRICT, soft: tuple[str, ...] = SOFT, soft_needed: int = 2, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row for each row of df: the id, host, path, rule (its text, or null), verdict (allow or block), n_strict and n_soft (distinct terms hit).

    The longest rule that fits decides; without one the vocabulary does. A null url, or one without ://, has an empty host and path, fits no rule and
    is judged by its terms (null: allow). Repeated rows and null ids are judged each. Empty tables and vocabularies are fine. Other columns are not read."""
    sent = df.sparkSession.sparkContext.broadcast((tuple(rules), tuple(strict), tuple(soft)))
    rows = df.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"))
    text = ["host", "path", "rule", "verdict"]
    schema = T.StructType([T.StructField(id_col, rows.schema["id"].dataType), *(T.StructField(x, T.StringType()) for x in text), *(T.StructField(x, T.LongType()) for x in ("n_strict", "n_soft"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(*sent.value, soft_needed)
        for b in batches:
            out = [judge(u) for u in b.column(1).to_pylist()]
            if out:
                yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(x, pa.int64() if k > 3 else pa.string()) for k, x in enumerate(zip(*out, strict=True)))], schema.names)

    return rows.mapInArrow(run, schema)
