"""URL filter: host and path rules first, then a weighted vocabulary searched with an Aho-Corasick automaton.

``url_filter`` judges every row. A rule (host, path prefix) fits its host and all subdomains; the longest fitting
rule decides. Where no rule fits, the whole url is searched for vocabulary terms. A hit counts only between
boundaries (no ASCII letter or digit on either side). One strict term blocks, and so do ``soft_min`` distinct soft terms
that weigh ``soft_weight`` together. A vocabulary is a table of (term, class, weight), such as ``read_vocabulary`` reads;
the built-in one has terms of the four languages of the test corpus, and any two of its soft terms weigh enough.

Defined results: a null url, or one without ``://``, has an empty host and path, no rule, and the verdict of its
hits (a null url has none: allow). Repeated and null page ids are rows like any other.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.llm.common import column

# The rules of the contract, (verdict, host, path).
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
# Terms by class, English first, then French, German and Spanish.
STRICT = (
    "adult", "porn", "xxx", "casino", "spam", "malware", "phishing", "warez", "escort", "hentai", "ransomware", "keylogger",
    "porno", "pornographie", "kasino", "glucksspiel", "pornografie", "hurenportal", "pornografia", "prostitutas",
)
SOFT = (
    "ads", "bet", "bets", "bonus", "cheap", "click", "farm", "free", "jackpot", "loan", "loans", "pill", "pills",
    "poker", "promo", "tracker", "track", "viagra", "win", "winner", "betting", "dating", "payday", "replica", "torrent",
    "gratuit", "paris-sportifs", "credit-rapide", "rencontres", "pilule", "cadeau",
    "kostenlos", "gratis", "wetten", "sofortkredit", "gewinnspiel", "partnersuche",
    "apuestas", "prestamos", "pastillas", "ganador", "citas", "sorteo",
)
# Soft terms that rarely stand in a harmless url weigh more than 1.
HEAVY = {"viagra": 2.0, "jackpot": 1.5, "payday": 1.5, "sofortkredit": 1.5, "credit-rapide": 1.5, "paris-sportifs": 1.5, "apuestas": 1.5}
VOCABULARY = (*((t, "strict", 1.0) for t in STRICT), *((t, "soft", HEAVY.get(t, 1.0)) for t in SOFT))
SOFT_MIN, SOFT_WEIGHT = 2, 2.0
MAX_TERMS = 1_000_000  # the automaton is built in every task
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty if it is null or has no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    raw = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(raw) + 1, F.length(rest)), "^[^?#]*", 0)
    return F.translate(raw, UPPER, LOWER), path


def checked(vocabulary: Iterable[tuple[str, str, float]]) -> tuple[tuple[str, str, float], ...]:
    """The vocabulary with A-Z lower-cased terms, each once: strict before soft, then the larger weight."""
    terms: dict[str, tuple[str, float]] = {}
    for term, kind, weight in vocabulary:
        if not term or kind not in ("strict", "soft") or not 0 <= weight < float("inf"):
            raise ValueError(f"a term, strict or soft, and a weight of at least 0: {(term, kind, weight)}")
        term = term.translate(_ASCII_LOWER)
        terms[term] = max(terms.get(term, ("", 0.0)), (kind, float(weight)))  # "strict" > "soft"
    return tuple((t, kind, weight) for t, (kind, weight) in terms.items())


def read_vocabulary(spark: SparkSession, path: str) -> list[tuple[str, str, float]]:
    """A vocabulary from a Parquet table (term string, class string, weight double, null: 1), at most ``MAX_TERMS`` rows."""
    rows = spark.read.parquet(path).select("term", "class", F.coalesce("weight", F.lit(1.0)).alias("weight")).limit(MAX_TERMS + 1).collect()
    if len(rows) > MAX_TERMS:
        raise ValueError(f"{path}: more than {MAX_TERMS} terms")
    return [(r["term"], r["class"], r["weight"]) for r in rows]


def _counter(vocabulary: Iterable[tuple[str, str, float]]):
    """url -> distinct strict terms, distinct soft terms, weight of the soft terms"""
    machine, weights = ahocorasick.Automaton(), {}
    for term, kind, weight in vocabulary:
        machine.add_word(term, (kind, term))
        weights[term] = weight
    if len(machine):
        machine.make_automaton()
    plain = set("abcdefghijklmnopqrstuvwxyz0123456789")

    def count(url: str | None) -> tuple[int, int, float]:
        found: dict[str, set[str]] = {"strict": set(), "soft": set()}
        if url and len(machine):
            low = url.translate(_ASCII_LOWER)
            for end, (kind, term) in machine.iter(low):
                before, after = end - len(term), end + 1
                if (before < 0 or low[before] not in plain) and (after >= len(low) or low[after] not in plain):
                    found[kind].add(term)
        return len(found["strict"]), len(found["soft"]), math.fsum(weights[t] for t in found["soft"])

    return count


_ASCII_LOWER = str.maketrans(UPPER, LOWER)


def url_filter(
    pages: DataFrame,
    rules=RULES,
    vocabulary: Iterable[tuple[str, str, float]] = VOCABULARY,
    soft_min: int = SOFT_MIN,
    soft_weight: float = SOFT_WEIGHT,
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """page_id, host, path, rule, verdict, strict_hits, soft_hits (distinct terms), soft_weight for every row of ``pages``."""
    vocabulary = checked(vocabulary)
    host, path = host_and_path(F.col("url"))
    base = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))
    parsed = base.select("page_id", "url", host.alias("host"), path.alias("path"))

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counter(vocabulary)
        for batch in batches:
            found = [count(u) for u in column(batch, "url")]
            kept = [batch.column(batch.schema.get_field_index(c)) for c in ("page_id", "host", "path")]
            extra = [pa.array([f[k] for f in found], t) for k, t in enumerate((pa.int32(), pa.int32(), pa.float64()))]
            yield pa.RecordBatch.from_arrays(kept + extra, ["page_id", "host", "path", "strict_hits", "soft_hits", "soft_weight"])

    kind = base.schema["page_id"].dataType.simpleString()
    judged = parsed.mapInArrow(hits, f"page_id {kind}, host string, path string, strict_hits int, soft_hits int, soft_weight double")
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):  # the longest is tested first
        fits = ((F.col("host") == rule_host) | F.col("host").endswith("." + rule_host)) & F.col("path").startswith(rule_path)
        rule = F.when(fits, F.lit(rule_host + rule_path)).otherwise(rule)
        verdict = F.when(fits, F.lit(what)).otherwise(verdict)
    several = (F.col("soft_hits") >= soft_min) & (F.col("soft_weight") >= soft_weight)
    found = F.when((F.col("strict_hits") >= 1) | several, "block").otherwise("allow")
    hit = ("strict_hits", "soft_hits", "soft_weight")
    return judged.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, found).alias("verdict"), *hit)


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter(spark.read.parquet(f"{sf_dir}/pages.parquet")).select("page_id", "host", "path", "rule", "verdict")


def _distinct_hits(terms: Iterable[str], weights: dict[str, float] | None = None) -> str:
    one = "CAST(regexp_matches(low, '(^|[^a-z0-9]){}($|[^a-z0-9])') AS INTEGER)"
    return " + ".join(one.format(t) + (f" * {weights.get(t, 1.0)}" if weights is not None else "") for t in terms)


def op6_sql() -> str:
    ordered = sorted(RULES, key=lambda r: -len(r[1]) - len(r[2]))
    fits = [f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')" for _, h, p in ordered]
    rule = " ".join(f"WHEN {f} THEN '{h}{p}'" for f, (_, h, p) in zip(fits, ordered, strict=True))
    verdict = " ".join(f"WHEN {f} THEN '{v}'" for f, (v, _, _) in zip(fits, ordered, strict=True))
    return f"""
WITH a AS (
  SELECT page_id, translate(coalesce(url, ''), '{UPPER}', '{LOWER}') AS low,
         CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
b AS (SELECT *, regexp_extract(rest, '^[^/?#]*') AS raw FROM a),
c AS (SELECT page_id, low, translate(raw, '{UPPER}', '{LOWER}') AS host,
             regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM b)
SELECT page_id, host, path, CASE {rule} END AS rule,
       CASE {verdict}
            WHEN {_distinct_hits(STRICT)} >= 1 THEN 'block'
            WHEN {_distinct_hits(SOFT)} >= {SOFT_MIN} AND {_distinct_hits(SOFT, HEAVY)} >= {SOFT_WEIGHT} THEN 'block' ELSE 'allow' END AS verdict
FROM c"""
