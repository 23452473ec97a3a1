"""The registered corpus queries: each applies its operator to the whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from tablewright.llm import (contamination, interleave, lines, mixing, near, quality, repair, repeats, secrets, tokens, toxicity, urls,
                             whitening)
from tablewright.registry.common import Registry, load

registry = Registry()


@registry.add("op7_quality_rules", quality.SQL)
def op7_quality_rules(spark, sf):
    return quality.judged(load(spark, sf, "documents"))


@registry.add("op9_decontamination", contamination.SQL)
def op9_decontamination(spark, sf):
    return contamination.contaminated(load(spark, sf, "documents"), load(spark, sf, "benchmark")).drop("spans")


@registry.add("op3_secret_scans", secrets.SQL)
def op3_secret_scans(spark, sf):
    """A source is an owner; its documents in one language are a repository."""
    repository = F.concat_ws("/", "source", "lang")
    return secrets.digest(secrets.secrets(load(spark, sf, "documents"), F.col("source"), repository))


@registry.add("op2_url_filters")
def op2_url_filters(spark, sf):
    return urls.filtered(load(spark, sf, "pages"))


@registry.add("op4_line_dedup", lines.SQL)
def op4_line_dedup(spark, sf):
    return lines.deduplicate(load(spark, sf, "documents")).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@registry.add("op6_token_output")
def op6_token_output(spark, sf):
    return tokens.round_trip(load(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@registry.add("op10_ngram_join")
def op10_ngram_join(spark, sf):
    return near.joined(load(spark, sf, "documents"))


@registry.add("op5_repeated_strings")
def op5_repeated_strings(spark, sf):
    return repeats.without_repeats(load(spark, sf, "documents")).drop("kept")


@registry.add("op1_toxicity")
def op1_toxicity(spark, sf):
    return toxicity.scored(load(spark, sf, "documents"), load(spark, sf, "labels"))


@registry.add("op8_source_mixing", mixing.SQL)
def op8_source_mixing(spark, sf):
    return mixing.judged(load(spark, sf, "documents"))


@registry.add("op11_sharding", interleave.SQL)
def op11_sharding(spark, sf):
    return interleave.digest(load(spark, sf, "documents"))


@registry.add("op12_conversation_repair", repair.SQL)
def op12_conversation_repair(spark, sf):
    return repair.digest(load(spark, sf, "conversations"))


@registry.add("op13_whitening")
def op13_whitening(spark, sf):
    return whitening.digest(load(spark, sf, "embeddings"))
