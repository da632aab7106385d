"""One query for each operator, over its whole table."""

from pyspark.sql import functions as F

from feedlake.llm import (
    bpe, digest, knn, langid, mixing, packing, periodic, pii, quality, recurrent, secrets, simhash, variants,
)
from feedlake.llm.frames import surrogate_key, table
from feedlake.plans.catalogue import query


@query("op1_byte_bpe")
def op1_byte_bpe(spark, sf_dir):
    """Every text as ids and back again, by digests."""
    tokenizer = bpe.Tokenizer(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = tokenizer.decode(tokenizer.encode(docs))
    return coded.select(
        "doc_id",
        bpe.n_ids("ids").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op7_mix_to_weights", f"""
WITH {mixing.PLAN_SQL}
SELECT doc_id, size, source_size, target,
  (floor(rate) + (chance < rate - floor(rate))::INT)::BIGINT * size AS taken
FROM sized JOIN mixed ON sized.source IS NOT DISTINCT FROM mixed.source""")
def op7_mix_to_weights(spark, sf_dir):
    """How many words of each document the mix takes."""
    plan = mixing.plan(table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target",
                       (F.col("copies") * F.col("size")).alias("taken"))


@query("op8_simhash_classes")
def op8_simhash_classes(spark, sf_dir):
    """Every document with its fingerprint and the class of near-copies it belongs to."""
    found = simhash.classes(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", simhash.as_hex("fingerprint").alias("fingerprint"), "component_id")


@query("op5_similarity_digest")
def op5_similarity_digest(spark, sf_dir):
    """Digest of every text, and how like it are its edited text and the next document."""
    return digest.compare_with_edits(table(spark, sf_dir, "documents"))


@query("op2_secret_ownership", secrets.scan_sql())
def op2_secret_ownership(spark, sf_dir):
    """Secrets of every text, each judged by how many owners share its value."""
    found = secrets.scan(table(spark, sf_dir, "documents"))
    counts = [c for c in found.columns if c.startswith("n_")]
    return found.select(F.col("repository").alias("doc_id"), *counts,
                        F.sha2("base", 256).alias("base_sha256"), "spans")


@query("op4_voronoi_knn")
def op4_voronoi_knn(spark, sf_dir):
    """The 20 best partners of every vector whose id is divisible by 20."""
    return knn.top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


@query("op10_quality_trees")
def op10_quality_trees(spark, sf_dir):
    """Quality of every text, learnt from labels outside of the held-out fifth."""
    return quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op6_language_id")
def op6_language_id(spark, sf_dir):
    """Language of every text, learnt from the documents that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return langid.detect(docs).select("doc_id", "held_out", "language.lang_pred", "language.score")


@query("op3_pii_surrogates")
def op3_pii_surrogates(spark, sf_dir):
    """Every document with personal data replaced by surrogates."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.replace(docs, surrogate_key(spark)).withColumn("n_chars", F.char_length("text").cast("long"))


@query("op9_recurrent_lm")
def op9_recurrent_lm(spark, sf_dir):
    """Every text scored by the recurrent model, beside its unigram base."""
    return recurrent.score(table(spark, sf_dir, "documents"))


@query("op11_exchange_packing")
def op11_exchange_packing(spark, sf_dir):
    """Every document's pieces and their places in as few sequences as exchanges lead to."""
    return packing.pack_documents(table(spark, sf_dir, "documents"))


@query("op12_trie_variants")
def op12_trie_variants(spark, sf_dir):
    """Frequent words, each with its number of neighbours, its likely right form and that form's root."""
    return variants.of_documents(table(spark, sf_dir, "documents"))


@query("op13_periodic_runs")
def op13_periodic_runs(spark, sf_dir):
    """Runs of every text, some with a tail repeated, and the text without the repetitions by digest."""
    found = periodic.scan(table(spark, sf_dir, "documents"), repeat_tails=True)
    return found.select("doc_id", "n_runs", "start", "length", "period", "exponent_milli",
                        F.sha2(periodic.runs_text("runs"), 256).alias("runs_sha256"),
                        F.sha2("collapsed", 256).alias("collapsed_sha256"))
