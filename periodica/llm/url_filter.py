"""URL filter: host and path rules first, then a weighted vocabulary counted by Aho-Corasick.

All vocabulary terms are found in one pass over the URL. A hit counts only between boundaries (no
ASCII letter or digit directly before or after it), so ``bet`` does not fire inside ``alphabet``.
One strict term, or ``soft_limit`` distinct soft terms, reject a URL.

Edge cases: a NULL URL, or one without ``://``, has an empty host and path and fits no rule; the
vocabulary still reads what text there is, a NULL URL is allowed. Repeated rows are judged one by
one, an empty table gives an empty result, other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from periodica.llm.common import LOWER, UPPER

STRICT = ("casino", "escort", "gambling", "hentai", "porn", "viagra", "warez", "xxx")
SOFT = ("adult", "bet", "bonus", "cheap", "crack", "dating", "free", "jackpot", "keygen", "loan", "pills", "poker", "sex", "torrent")


@dataclass(frozen=True)
class UrlRules:
    """``rules`` are (verdict, host/path); the longest fitting rule decides before the vocabulary."""

    rules: tuple[tuple[str, str], ...] = ()
    strict: tuple[str, ...] = STRICT
    soft: tuple[str, ...] = SOFT
    soft_limit: int = 2


def url_host(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: tuple[tuple[str, str], ...]) -> Column:
    """The longest rule for the host or a parent domain whose path starts the URL's path."""
    chosen = F.lit(None).cast("string")
    for _, rule in sorted(rules, key=lambda r: len(r[1])):
        domain, _, rest = rule.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith("/" + rest)
        chosen = F.when(fits, F.lit(rule)).otherwise(chosen)
    return chosen


def _plain(c: str) -> bool:
    return c.isascii() and c.isalnum()


def _count_terms(config: UrlRules):
    """Batches of (key, url) -> (key, strict, soft): distinct bounded hits of both kinds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = ahocorasick.Automaton()
        for term in {*config.strict, *config.soft}:
            machine.add_word(term, term)
        machine.make_automaton()
        table = str.maketrans(UPPER, LOWER)
        strict, soft = frozenset(config.strict), frozenset(config.soft)
        for batch in batches:
            hard, mild = [], []
            for url in batch.column("url").to_pylist():
                text = (url or "").translate(table)
                found = set()
                for end, term in machine.iter(text):
                    start = end - len(term) + 1
                    if (start == 0 or not _plain(text[start - 1])) and (end + 1 == len(text) or not _plain(text[end + 1])):
                        found.add(term)
                hard.append(sorted(found & strict))
                mild.append(sorted(found & soft))
            kinds = pa.list_(pa.string())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(hard, kinds), pa.array(mild, kinds)],
                names=[*batch.schema.names, "strict_terms", "soft_terms"],
            )

    return run


def judge_urls(pages: DataFrame, config: UrlRules, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Per row: id, host, path, rule, verdict, and the distinct strict and soft terms found."""
    named = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"))
    schema = named.schema.simpleString()[7:-1] + ",strict_terms:array<string>,soft_terms:array<string>"
    counted = named.mapInArrow(_count_terms(config), schema)
    parts = counted.withColumns({"host": url_host(F.col("url")), "path": url_path(F.col("url"))})
    ruled = parts.withColumn("rule", fitting_rule(F.col("host"), F.col("path"), config.rules))
    said = F.lit(None).cast("string")
    for verdict, rule in config.rules:
        said = F.when(F.col("rule") == rule, F.lit(verdict)).otherwise(said)
    rejected = (F.size("strict_terms") >= 1) | (F.size("soft_terms") >= config.soft_limit)
    verdict = F.coalesce(said, F.when(rejected, "block").otherwise("allow"))
    return ruled.select(F.col("id").alias(id_col), "host", "path", "rule", verdict.alias("verdict"), "strict_terms", "soft_terms")
