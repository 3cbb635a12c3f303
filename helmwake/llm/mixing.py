"""Mixing of sources to target shares of the total size in tokens.

Every document gets a hash-random key. Within its source the documents are put in
the order of that key and their token counts are summed up as they go; whole
epochs are repeated as often as the budget allows, and the last epoch is cut where
the running sum reaches the rest of the budget. The sums are taken bucket by
bucket of the key's high bits, so the largest source spreads over 1,024 tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helmwake.llm.tokenizer import TOKENIZERS, with_ids
from helmwake.operators.prefix import distributed_prefix_sum
from helmwake.session import ensure_checkpoint_dir


def sized(documents: DataFrame, name: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> DataFrame:
    """(doc_id, source, n_tokens) of every document with a source and at least one token.

    A doc_id that comes in several rows is one document; the smallest (source,
    size) counts. The slim table is checkpointed: it is used twice, and encoding
    is the costly part.
    """
    ensure_checkpoint_dir(documents.sparkSession)
    t = with_ids(documents.select("doc_id", "source", "text"), "text", "ids", name, folder)
    t = t.where("doc_id IS NOT NULL AND source IS NOT NULL").select("doc_id", "source", F.size("ids").cast("bigint").alias("n_tokens"))
    # a filter on the size before the aggregation would encode every text a second time
    one = t.groupBy("doc_id").agg(F.min(F.struct("source", "n_tokens")).alias("s")).select("doc_id", "s.source", "s.n_tokens").where("n_tokens > 0")
    return one.checkpoint()


def budgets(docs: DataFrame, targets: DataFrame, total_tokens: int | None = None) -> DataFrame:
    """(source, target_share, max_repeats, tokens, budget): what each source has and what it must supply.

    Without ``total_tokens`` the total is the largest at which every source that
    has documents can still meet its share within its repeats. With it, a source
    that has too little supplies all it may, and its reached share falls short.
    """
    have = docs.groupBy("source").agg(F.sum("n_tokens").alias("tokens"))
    t = targets.dropDuplicates(["source"]).where("target_share > 0 AND max_repeats > 0").join(have, "source")
    t = t.select("source", "target_share", F.col("max_repeats").cast("bigint").alias("max_repeats"), "tokens")
    most = F.col("tokens") * F.col("max_repeats")
    total = F.lit(float(total_tokens)) if total_tokens is not None else t.agg(F.min(most / F.col("target_share")).alias("x")).scalar()
    return t.withColumn("budget", F.least(F.floor(total * F.col("target_share") + F.lit(1e-6)), most))


def mix_documents(documents: DataFrame, targets: DataFrame, total_tokens: int | None = None, seed: int = 0, name: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> DataFrame:
    """The mix: doc_id, source, n_tokens and copies (at least 1, at most the source's max_repeats).

    Documents without a source, of a source that isn't listed, and without any
    token are not in the mix. The document at the cut is taken when that brings
    the source nearer to its budget, so a source misses it by half a document at most.
    """
    d = sized(documents, name, folder)
    b = budgets(d, targets, total_tokens)
    keyed = d.withColumn("u", F.xxhash64("doc_id", F.lit(seed)))
    run = distributed_prefix_sum(keyed, ["source"], F.shiftright("u", 54), ["u", "doc_id"], "n_tokens", "upto")
    m = run.join(b, "source")
    full = F.least(F.floor(F.col("budget") / F.col("tokens")), F.col("max_repeats"))
    rest = F.col("budget") - full * F.col("tokens")
    extra = ((full < F.col("max_repeats")) & (2 * F.col("upto") - F.col("n_tokens") <= 2 * rest)).cast("bigint")
    m = m.withColumn("copies", full + F.when(rest > 0, extra).otherwise(F.lit(0)))
    return m.where("copies > 0").select("doc_id", "source", "n_tokens", "copies")


def shares(mix: DataFrame, targets: DataFrame) -> DataFrame:
    """The shares really reached, one row per target: source, target_share, documents, tokens, most_copies, reached_share."""
    got = mix.groupBy("source").agg(F.count("*").alias("documents"), F.sum(F.col("n_tokens") * F.col("copies")).alias("tokens"), F.max("copies").alias("most_copies"))
    t = targets.dropDuplicates(["source"]).select("source", "target_share", F.col("max_repeats").cast("bigint").alias("max_repeats")).join(got, "source", "left").na.fill(0, ["documents", "tokens", "most_copies"])
    whole = t.agg(F.sum("tokens").alias("x")).scalar()
    return t.withColumn("reached_share", F.coalesce(F.try_divide(F.col("tokens").cast("double"), whole), F.lit(0.0)))
