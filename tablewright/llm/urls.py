"""URL filter: host and path rules first, else logistic regression on hashed character n-grams.

The classifier is trained from a small labelled URL table with full-batch gradient descent: the n-grams of host and
path are hashed into a fixed number of columns, so its weights are bounded whatever the URLs.

A null URL or one without `://` has empty host and path, fits no rule and is left to the classifier; with nothing to
look at that allows it. Of several fitting rules the longest wins, of equally long ones the blocking one. Repeated rows
are judged each for itself.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import map_texts

RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))
#: Columns of the hashed feature space, lengths of the n-grams, and the most labelled URLs that training takes.
COLUMNS, LENGTHS, MOST_LABELLED = 1 << 15, (3, 4, 5), 20_000

#: Small labelled table: 1 marks URLs to block.
LABELLED = [(url, 1) for url in (
    "http://best-casino.test/play/77", "https://casino-royal.test/slots", "http://m.win-casino.test/en/12", "https://win-big.test/jackpot",
    "http://free-bets.test/odds", "https://bets-today.test/free/1", "http://freebet.test/bonus", "https://poker-win.test/en/5",
    "http://cheap-pills.test/buy", "https://pills-cheap.test/rx/3", "http://cheapmeds.test/viagra", "https://online-pills.test/en/1",
    "http://adult-cams.test/live", "https://adult-x.test/video/9", "http://xxx-adult.test/en/4", "https://hot-adult.test/",
    "http://m.adult-video.test/en/11", "https://www.adult-x-club.test/fr/2",
    "http://ads-track.test/click", "https://track-ads.test/pixel?id=1", "http://ads-server.test/banner", "https://ad-tracker.test/r/8",
    "http://spam-mail.test/offer", "https://link-farm.test/page/1", "http://spam-farm.test/en/2", "https://content-farm.test/de/3",
    "http://cheap-loans.test/apply", "https://free-casino.test/spins", "http://www.spam-links.test/7", "https://win-prize.test/claim",
)] + [(url, 0) for url in (
    "http://daily-news.test/world/2024", "https://www.thetimes.test/en/12", "http://blog.garden.test/roses", "https://docs.python.test/library/re",
    "http://m.recipes.test/en/soup", "https://university.test/physics", "http://history.test/rome/3", "https://www.weather.test/fr/88",
    "http://blog.thering.test/de/45", "https://museum.test/collection/7", "http://library.test/catalog", "https://m.station.test/es/19",
    "http://www.nation.test/en/301", "https://science.test/articles/55", "http://travel.test/spain", "https://blog.music.test/jazz",
    "http://city.test/council/minutes", "https://sports.test/league/4", "http://open-data.test/tables", "https://www.thought.test/en/90",
    "http://motion.test/en/7001.html", "https://edition.test/fr/12?page=2", "http://health.test/advice", "https://mail.test/help",
    "http://farm-life.test/animals", "https://track-and-field.test/results", "http://blog.thunder.test/en/3", "https://nature.test/birds/61",
)]


def host_of(url: Column) -> Column:
    known = url.contains("://")
    raw = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    lowered = F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(known, lowered).otherwise("")


def path_of(url: Column) -> Column:
    return F.when(url.contains("://"), F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)).otherwise("")


def rule_for(host: Column, path: Column, rules=RULES) -> Column:
    """struct(rule, verdict) of the longest fitting rule, or null."""
    chosen = F.lit(None).cast("struct<rule:string,verdict:string>")
    ranked = sorted(rules, key=lambda r: (len(r[1]), r[0] == "block"))
    for verdict, rule in ranked:
        domain, slash, rest = rule.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(slash + rest)
        chosen = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(chosen)
    return chosen


def _columns(tag: str, part: str) -> set[int]:
    """Hashed n-grams of one part of a URL; runs of digits count as one 0."""
    padded = f"^{re.sub(r'[0-9]+', '0', part)}$"
    return {zlib.crc32(f"{tag}{padded[i:i + n]}".encode()) % COLUMNS for n in LENGTHS for i in range(len(padded) - n + 1)}


def split(url: str | None) -> tuple[str, str]:
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    return (re.sub("[A-Z]+", lambda c: c[0].lower(), m[1]), m[2]) if m else ("", "")


def train(labelled: list[tuple[str | None, int]] = LABELLED, steps: int = 2000, rate: float = 8.0, penalty: float = 1e-3) -> np.ndarray:
    """Weights of the hashed columns of host and path and, last, the bias."""
    if len(labelled) > MOST_LABELLED:
        raise ValueError(f"{len(labelled)} labelled URLs; training takes at most {MOST_LABELLED}")
    features = [_columns("h", h) | _columns("p", p) for h, p in (split(u) for u, _ in labelled)]
    row = np.repeat(np.arange(len(features)), [len(f) for f in features])
    column = np.fromiter((c for f in features for c in sorted(f)), np.int64, len(row))
    size = np.maximum(1.0, np.sqrt(np.bincount(row, minlength=len(features))))
    y = np.array([label for _, label in labelled], float)
    w, bias = np.zeros(COLUMNS), 0.0
    for _ in range(steps):
        z = np.bincount(row, w[column], len(features)) / size + bias
        miss = 1 / (1 + np.exp(-z)) - y
        w -= rate * (np.bincount(column, (miss / size)[row], COLUMNS) / max(1, len(y)) + penalty * w)
        bias -= rate * miss.mean() if len(y) else 0.0
    return np.append(w, bias)


def score(weights: np.ndarray, host: str, path: str) -> float:
    """Probability that the URL is one to block."""
    columns = sorted(_columns("h", host) | _columns("p", path))
    z = weights[columns].sum() / max(1.0, np.sqrt(len(columns))) + weights[-1]
    return float(1 / (1 + np.exp(-z)))


def filtered(pages: DataFrame, labelled: list[tuple[str | None, int]] = LABELLED, rules=RULES, threshold: float = 0.5) -> DataFrame:
    """page_id, host, path, rule, verdict, and the classifier's score of every page."""
    weights = pages.sparkSession.sparkContext.broadcast(train(labelled))

    def judge(batch):
        scores = [score(weights.value, h, p) if h or p else 0.0
                  for h, p in zip(batch.column("host").to_pylist(), batch.column("path").to_pylist())]
        yield pa.RecordBatch.from_pydict({**{c: batch.column(c) for c in ("page_id", "host", "path", "rule", "verdict")}, "score": scores})

    url = F.col("url")
    parted = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"))
    ruled = parted.withColumn("r", rule_for(F.col("host"), F.col("path"), rules)).select(
        "page_id", "host", "path", "r.rule", "r.verdict", F.concat("host", "path").alias("text"))
    scored = map_texts(ruled, judge, "page_id long, host string, path string, rule string, verdict string, score double")
    return scored.withColumn("verdict", F.coalesce("verdict", F.when(F.col("score") >= threshold, "block").otherwise("allow")))
