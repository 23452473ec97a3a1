"""Quality rules as a short-circuit cascade.

A rule looks at measures of a text that are worked out when first asked for. Cost and rejections of every rule are
estimated on a bounded sample; the cascade then asks the rules in the order of rejections per cost and stops at the
first that rejects. The order changes only how much work a text takes, never the verdict.

Nulls and empty texts have no words and fail the length rule. Repeated rows get the same verdict each; an empty table
gives an empty result. Columns besides the text pass through `kept_only`, whatever their names.
"""

from __future__ import annotations

import time
from collections import Counter
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import map_texts, raw_texts

#: Rows on which cost and selectivity are estimated, and the most text in one: the sample reaches the driver.
SAMPLE_ROWS, SAMPLE_BYTES = 500, 64 << 10
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\v\f\r"
UPPER = bytes(range(65, 91))
LOWER = bytes(range(97, 123))


class Measures:
    """Figures of one text, each worked out once and only when asked for."""

    def __init__(self, text: bytes) -> None:
        self.text = text

    @cached_property
    def words(self) -> list[bytes]:
        return self.text.split()

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        tight = self.text.translate(None, SPACES)
        return len(tight) if tight.isascii() else len(tight.decode())

    @cached_property
    def n_symbols(self) -> int:
        return len(self.text) - len(self.text.translate(None, SYMBOLS))

    @cached_property
    def n_upper(self) -> int:
        return len(self.text) - len(self.text.translate(None, UPPER))

    @cached_property
    def n_lower(self) -> int:
        return len(self.text) - len(self.text.translate(None, LOWER))

    @cached_property
    def lines(self) -> list[bytes]:
        return [line for line in self.text.split(b"\n") if line.strip(SPACES)]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        words, n = self.words, self.n_words
        if n < 4:
            return 0
        known: dict[bytes, int] = {}
        ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, n)
        base = len(known) + 1
        if base < 2_000_000:
            windows = (ids[:-2] * base + ids[1:-1]) * base + ids[2:]
        else:
            pairs = np.unique(ids[:-1] * base + ids[1:], return_inverse=True)[1]
            windows = pairs[:-1] * base + ids[2:]
        order = np.argsort(windows, kind="stable")
        ranked = windows[order]
        same = ranked[1:] == ranked[:-1]
        twice = np.zeros(n - 2, bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        hit = np.zeros(n, bool)
        for k in range(3):
            hit[k:n - 2 + k] |= twice
        return int(hit.sum())


#: A rule says whether it rejects a text. All comparisons are of whole numbers.
RULES = {
    "short": lambda m: m.n_words < 50,
    "repeats": lambda m: 100 * m.n_repeat_words > 50 * m.n_words,
    "symbols": lambda m: 10 * m.n_symbols > m.n_words,
    "same_lines": lambda m: 100 * m.n_dup_lines > 40 * len(m.lines),
    "word_length": lambda m: m.word_chars < 2 * m.n_words or m.word_chars > 12 * m.n_words,
    "capitals": lambda m: m.n_upper > m.n_lower and m.n_upper > 10,
}


def rule_order(docs: DataFrame, text: str = "text", rules: dict = RULES, sample_rows: int = SAMPLE_ROWS) -> list[str]:
    """Rule names by rejections per cost, as estimated on `sample_rows` rows of at most SAMPLE_BYTES each."""
    sample = docs.select(F.col(text).alias("text")).where(F.octet_length("text") <= SAMPLE_BYTES).take(sample_rows)
    spent, rejected = Counter(), Counter()
    for row in sample:
        for name, rule in rules.items():
            began = time.perf_counter_ns()
            rejected[name] += bool(rule(Measures(row["text"].encode())))
            spent[name] += time.perf_counter_ns() - began
    return sorted(rules, key=lambda r: (-rejected[r] / max(spent[r], 1), list(rules).index(r)))


def cascade(measures: Measures, order: list[str], rules: dict = RULES) -> bool:
    """True when no rule rejects."""
    return not any(rules[name](measures) for name in order)


def kept_only(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows whose text no rule rejects, with all their columns."""
    order = rule_order(docs, text)

    @F.pandas_udf("boolean")
    def keeps(texts):
        return texts.map(lambda t: cascade(Measures((t or "").encode()), order))

    return docs.where(keeps(F.col(text)))


def judged(docs: DataFrame) -> DataFrame:
    """doc_id with the measures, whether a base rule fails, and the verdict of the cascade."""
    order = rule_order(docs)
    beyond = [r for r in order if r not in ("short", "repeats")]
    fields = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

    def judge(batch):
        rows: dict[str, list] = {f: [] for f in (*fields, "base_failed", "kept")}
        for raw in raw_texts(batch):
            m = Measures(raw)
            for f in fields:
                rows[f].append(getattr(m, f))
            failed = RULES["short"](m) or RULES["repeats"](m)
            rows["base_failed"].append(failed)
            rows["kept"].append(not failed and cascade(m, beyond))
        yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), **rows})

    schema = "doc_id long, " + ", ".join(f"{f} long" for f in fields) + ", base_failed boolean, kept boolean"
    return map_texts(docs.select("doc_id", "text"), judge, schema)


SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
l AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
g AS (
  SELECT doc_id, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
t AS (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p
      FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM g) WHERE n > 1),
r AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM t GROUP BY doc_id),
m AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) AS n_upper,
    length(text) - length(regexp_replace(text, '[a-z]', '', 'g')) AS n_lower,
    coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_lines, 0) AS n_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN l ON d.doc_id = l.doc_id LEFT JOIN r ON d.doc_id = r.doc_id),
v AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    10 * n_symbols > n_words OR 100 * n_dup_lines > 40 * n_lines OR word_chars < 2 * n_words
      OR word_chars > 12 * n_words OR (n_upper > n_lower AND n_upper > 10) AS more_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT more_failed AS kept
FROM v
"""
