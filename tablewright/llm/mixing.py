"""Mixing sources to target weights by iterative proportional fitting.

Documents fall into cells of source, language and topic. Token weights of the cells are raked in turn to the target
margins of the three until all hold; documents are then sampled with their cell's raked weight per token as probability.
The expected tokens of the sample are a given share of the corpus, whatever single cells are like: cells that would need
a probability above 1 are taken whole and the rest is raked to what is left. `reached` tells how near the margins come.

Targets, unless given, are the tempered shares of the corpus: tokens of a value to the power of `temper`, so hot
sources shrink and rare ones grow. Fixed rounds are run, each step of them written to the shared folder, so that a plan
holds one step: every cell moves by the factor of one value, and the table of cells has one row per combination that occurs.

Null sources, languages and topics are values of their own. Null and empty texts have no tokens; cells without tokens
keep weight 1. A decision depends only on doc_id, seed and cell: repeated rows stay or go together. An empty table
gives an empty sample.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import stored, utf8

TEMPER, ROUNDS, SEED = 0.8, 10, "mix-1"
#: Expected tokens of a sample as a share of the corpus's tokens.
SAMPLE = 0.5
MARGINS = ("source", "lang", "topic")
WORD = r"[^\x20\x09-\x0D]+"


def topic(text: Column) -> Column:
    """A coarse topic by marks of the text's make-up."""
    return (F.when(text.rlike("(?i)licen[cs]ed?"), "licence").when(text.contains(" | "), "table")
            .when(text.rlike("[0-9]{4}"), "figures").otherwise("prose"))


def _named(column: Column) -> Column:
    """Null as a value of its own."""
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit(""))


def placed(docs: DataFrame, topic_of: Column | None = None) -> DataFrame:
    """The documents with __source, __lang, __topic and __tokens."""
    text = utf8()
    return docs.select("*", _named(F.col("source")).alias("__source"), _named(F.col("lang")).alias("__lang"),
                       _named(topic(text) if topic_of is None else topic_of).alias("__topic"),
                       F.regexp_count(text, F.lit(WORD)).cast("long").alias("__tokens"))


def _scale(rows: DataFrame, total: float) -> float:
    """The factor at which min(most, factor * weight) sums to total; each Newton step from below is one aggregate."""
    rows = rows.where("weight > 0")
    scale = total / (rows.agg(F.sum("weight")).first()[0] or 1.0)
    while True:
        whole = F.col("weight") * scale >= F.col("most")
        capped, free = rows.agg(F.sum(F.when(whole, F.col("most"))), F.sum(F.when(~whole, F.col("weight")))).first()
        if not free or (following := (total - (capped or 0.0)) / free) <= scale * (1 + 1e-12):
            return scale
        scale = following


def margin_targets(cells: DataFrame, targets: dict[str, DataFrame] | None = None, temper: float = TEMPER,
                   sample: float | None = None) -> dict[str, DataFrame]:
    """Per margin a frame (value, target) of tokens. With a sample no value has to give more tokens than it has."""
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    counts, shares = {}, {}
    for margin in MARGINS:
        counts[margin] = cells.groupBy(margin).agg(F.sum("tokens").alias("most")).where("most > 0")
        if targets and margin in targets:
            wanted = targets[margin].select(_named(F.col("value")).alias(margin), F.col("share").cast("double").alias("weight"))
        else:
            wanted = counts[margin].select(margin, F.pow(F.col("most").cast("double"), F.lit(temper)).alias("weight"))
        shares[margin] = stored(wanted if sample is None else wanted.join(counts[margin], margin), "mix_target")
    if sample is None:
        whole = {m: shares[m].agg(F.sum("weight")).first()[0] or 1.0 for m in MARGINS}
        return {m: shares[m].select(m, (F.col("weight") / whole[m] * total).alias("target")) for m in MARGINS}
    within = [shares[m].where("weight > 0").agg(F.sum("most")).first()[0] or 0 for m in MARGINS]
    budget = float(min(sample * total, *within))
    return {m: shares[m].select(m, F.least(F.col("most").cast("double"), F.col("weight") * _scale(shares[m], budget)).alias("target"))
            for m in MARGINS}


def rake(cells: DataFrame, targets: dict[str, DataFrame] | None = None, temper: float = TEMPER, rounds: int = ROUNDS,
         sample: float | None = None) -> DataFrame:
    """source, lang, topic, tokens, weight: cell weights whose margins have the target shares.

    targets: per margin a frame (value, share); missing margins are tempered. Values without a target keep no weight.
    sample: weights are a sample's expected tokens, this share of the corpus. A cell that would exceed its own tokens is
    taken whole and the others of its margin are raked to what is left; a last common scale meets the budget.
    """
    wanted = margin_targets(cells, targets, temper, sample)
    weights = stored(cells.select(*MARGINS, "tokens", (F.col("tokens") * (sample or 1.0)).cast("double").alias("weight")), "mix_cells")
    for _ in range(rounds):
        for margin in MARGINS:
            if sample is None:
                factor = (weights.groupBy(margin).agg(F.sum("weight").alias("now")).join(wanted[margin], margin, "left")
                          .select(margin, F.when(F.col("now") > 0, F.coalesce("target", F.lit(0.0)) / F.col("now")).otherwise(0.0).alias("factor")))
                weights = stored(weights.join(factor, margin).select(
                    *MARGINS, "tokens", (F.col("weight") * F.col("factor")).alias("weight")), "mix_step")
                continue
            whole = F.col("weight") >= F.col("tokens")
            now = weights.groupBy(margin).agg(F.sum(F.when(whole, F.col("tokens")).otherwise(0)).alias("capped"),
                                              F.sum(F.when(whole, 0.0).otherwise(F.col("weight"))).alias("free"))
            aim, taken = F.coalesce("target", F.lit(0.0)), F.col("capped") + F.col("free")
            factor = now.join(wanted[margin], margin, "left").select(
                margin, F.when(taken <= 0, 0.0).when(aim < taken, aim / taken).otherwise(1.0).alias("shrink"),
                F.when((aim > taken) & (F.col("free") > 0), (aim - F.col("capped")) / F.col("free")).otherwise(1.0).alias("grow"))
            # Only one of the two differs from 1; cells taken whole can shrink but not grow.
            weights = stored(weights.join(factor, margin).select(*MARGINS, "tokens", F.least(
                F.col("tokens").cast("double"), F.col("weight") * F.col("shrink") * F.col("grow")).alias("weight")), "mix_step")
    if sample is not None:
        budget = wanted[MARGINS[0]].agg(F.sum("target")).first()[0] or 0.0
        scale = _scale(weights.withColumn("most", F.col("tokens")), budget)
        weights = weights.withColumn("weight", F.least(F.col("tokens").cast("double"), F.col("weight") * scale))
    return weights


def drawn(docs: DataFrame, targets: dict[str, DataFrame] | None = None, seed: str = SEED, temper: float = TEMPER,
          sample: float | None = SAMPLE) -> DataFrame:
    """All documents with __tokens, __weight (raked weight per token), __chance and __kept, the sampling decision.

    Without a sample the weights are not bounded and the cell with the highest weight per token is the one kept whole,
    which leaves the size of the sample to that cell.
    """
    rows = placed(docs)
    cells = stored(rows.groupBy(*[F.col(f"__{m}").alias(m) for m in MARGINS]).agg(F.sum("__tokens").alias("tokens")), "mix_counts")
    raked = rake(cells, targets, temper, sample=sample).withColumn("ratio", F.when(F.col("tokens") > 0, F.col("weight") / F.col("tokens")))
    highest = 1.0 if sample is not None else raked.agg(F.max("ratio")).first()[0] or 1.0
    per_cell = raked.select(*[F.col(m).alias(f"__{m}") for m in MARGINS], F.coalesce("ratio", F.lit(1.0)).alias("__weight"),
                            F.coalesce(F.col("ratio") / highest, F.lit(1.0)).alias("__chance"))
    name = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(f":{seed}"))
    draw = F.conv(F.substring(F.md5(name.cast("binary")), 1, 12), 16, 10).cast("double") / float(1 << 48)
    return rows.join(per_cell, [f"__{m}" for m in MARGINS]).withColumn("__kept", draw < F.col("__chance"))


def reached(rows: DataFrame, targets: dict[str, DataFrame] | None = None, temper: float = TEMPER, sample: float | None = SAMPLE) -> DataFrame:
    """margin, value, tokens, target, expected, sampled of `drawn` documents: how near the sample comes to its margins."""
    cells = stored(rows.groupBy(*[F.col(f"__{m}").alias(m) for m in MARGINS]).agg(
        F.sum("__tokens").alias("tokens"), F.sum(F.col("__tokens") * F.col("__chance")).alias("expected"),
        F.sum(F.when(F.col("__kept"), F.col("__tokens")).otherwise(0)).alias("sampled")), "mix_reached")
    wanted = margin_targets(cells, targets, temper, sample)
    each = [cells.groupBy(m).agg(*[F.sum(c).alias(c) for c in ("tokens", "expected", "sampled")]).join(wanted[m], m, "left")
            .select(F.lit(m).alias("margin"), F.nullif(F.col(m), F.lit("")).substr(2, 1 << 30).alias("value"), "tokens",
                    F.coalesce("target", F.lit(0.0)).alias("target"), "expected", "sampled") for m in MARGINS]
    return each[0].unionByName(each[1]).unionByName(each[2])


def mixed(docs: DataFrame, targets: dict[str, DataFrame] | None = None, seed: str = SEED, temper: float = TEMPER,
          sample: float | None = SAMPLE) -> DataFrame:
    """The sampled documents, with the columns they came with."""
    return drawn(docs, targets, seed, temper, sample).where("__kept").select(*docs.columns)


def judged(docs: DataFrame) -> DataFrame:
    """doc_id, topic, n_tokens, weight (rounded), kept; its SQL has unbounded weights, so no sample is given here."""
    plain = docs.select("doc_id", "source", "lang", "text")
    return drawn(plain, sample=None).select("doc_id", F.expr("substring(__topic, 2)").alias("topic"), F.col("__tokens").alias("n_tokens"),
                               F.round("__weight", 6).alias("weight"), F.col("__kept").alias("kept"))


def _sql() -> str:
    steps, last = [], "c"
    for k in range(ROUNDS):
        for m in MARGINS:
            steps.append(f"""r{k}{m} AS MATERIALIZED (
  SELECT source, lang, topic, tokens, w * coalesce(target, 0) / sum(w) OVER (PARTITION BY {last}.{m}) AS w
  FROM {last} JOIN t_{m} USING ({m}))""")
            last = f"r{k}{m}"
    targets = [f"""t_{m} AS MATERIALIZED (
  SELECT {m}, pow(t::DOUBLE, {TEMPER}) / sum(pow(t::DOUBLE, {TEMPER})) OVER () * sum(t) OVER ()::DOUBLE AS target
  FROM (SELECT {m}, sum(tokens) AS t FROM c GROUP BY {m}))""" for m in MARGINS]
    parts = ",\n".join([*targets, *steps])
    return rf"""
WITH d AS MATERIALIZED (
  SELECT doc_id, source, lang, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS tokens,
    CASE WHEN regexp_matches(text, '(?i)licen[cs]ed?') THEN 'licence' WHEN contains(text, ' | ') THEN 'table'
      WHEN regexp_matches(text, '[0-9]{{4}}') THEN 'figures' ELSE 'prose' END AS topic FROM documents),
c AS MATERIALIZED (SELECT source, lang, topic, sum(tokens)::BIGINT AS tokens, sum(tokens)::DOUBLE AS w FROM d GROUP BY ALL),
{parts},
f AS (SELECT source, lang, topic, w / tokens AS ratio FROM {last})
SELECT doc_id, topic, tokens::BIGINT AS n_tokens, round(ratio, 6) AS weight,
  ('0x' || substr(md5(doc_id::VARCHAR || ':{SEED}'), 1, 12))::BIGINT::DOUBLE / 281474976710656.0 < ratio / (SELECT max(ratio) FROM f) AS kept
FROM d JOIN f USING (source, lang, topic)
"""


SQL = _sql()
