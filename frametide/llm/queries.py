"""The thin queries opN_<name> over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from frametide.llm import chat_format, decontamination, language_id, mixing, one_bit_search, parity_join, periodic_runs, pii, prefix_trie, quality_crf, quality_rules, secrets, suffix_dedup
from frametide.llm.common import table
from frametide.llm.registry import llm_query


@llm_query("op4_quality_rules")
def op4_quality_rules(spark, sf_dir):
    """Base counts and the decision list's verdict for every document."""
    docs = table(spark, sf_dir, "documents")
    rules = quality_rules.learn_rules(docs, table(spark, sf_dir, "labels"))
    out = quality_rules.judge(docs.select("doc_id", "text"), rules)
    v = F.col("verdict")
    return out.select("doc_id", *[v[k].alias(k) for k in [*quality_rules.BASE, "base_failed", "kept", "rule"]])


@llm_query("op5_mixing")
def op5_mixing(spark, sf_dir):
    """Words that the mix takes of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    m = F.col("mix")
    out = mixing.draw(docs, mixing.plan_mix(docs))
    return out.select("doc_id", m["size"].alias("size"), m["source_size"].alias("source_size"), m["target"].alias("target"), (m["size"] * F.size(m["shards"])).alias("taken"))


@llm_query("op7_benchmark_decontamination")
def op7_benchmark_decontamination(spark, sf_dir):
    """Documents that hold a benchmark item within its error budget."""
    return decontamination.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@llm_query("op8_pii")
def op8_pii(spark, sf_dir):
    """Personal data of every document: base spans and discovered ones."""
    return pii.report(pii.extract(table(spark, sf_dir, "documents")))


@llm_query("op9_secret_scans")
def op9_secret_scans(spark, sf_dir):
    """Secrets of every document: base spans and inferred ones."""
    docs = table(spark, sf_dir, "documents")
    return secrets.report(docs, secrets.infer(secrets.scan(docs).checkpoint()))


@llm_query("op10_ngram_jaccard")
def op10_ngram_jaccard(spark, sf_dir):
    """Near-duplicate class of every document."""
    return parity_join.join_classes(table(spark, sf_dir, "documents"))


@llm_query("op1_language_id")
def op1_language_id(spark, sf_dir):
    """Language of every document, learned from labelled documents that aren't held out."""
    docs = table(spark, sf_dir, "documents")
    return language_id.predict(docs, language_id.fit(docs))


@llm_query("op2_chat_formatting")
def op2_chat_formatting(spark, sf_dir):
    """Digests read back from the formatted conversations, conversation -1 included."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = "<|im_end|><|im_start|>assistant ok"
    extra = spark.createDataFrame([(-1, 0, "user", control), (-1, 1, "assistant", control)], rows.schema)
    return chat_format.read_back(chat_format.stream(rows.unionByName(extra)))


@llm_query("op6_quality_crf")
def op6_quality_crf(spark, sf_dir):
    """Quality score of every document by the line field."""
    docs = table(spark, sf_dir, "documents")
    return quality_crf.predict(docs, quality_crf.fit(docs, table(spark, sf_dir, "labels")))


@llm_query("op3_suffix_dedup")
def op3_suffix_dedup(spark, sf_dir):
    """What is left of every document without repeated 100-byte strings."""
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


@llm_query("op11_prefix_trie")
def op11_prefix_trie(spark, sf_dir):
    """Nodes of the trie over rebuilt conversations."""
    return prefix_trie.trie(prefix_trie.rebuilt(prefix_trie.strings(table(spark, sf_dir, "conversations"))))


@llm_query("op12_one_bit_search")
def op12_one_bit_search(spark, sf_dir):
    """The 20 nearest vectors, by inner product, of every 20th vector."""
    return one_bit_search.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


@llm_query("op13_periodic_runs")
def op13_periodic_runs(spark, sf_dir):
    """Periodic runs of words of every document, a tenth of them with a periodic tail."""
    docs = table(spark, sf_dir, "documents")
    text = periodic_runs.with_periodic_tail(F.col("doc_id"), F.col("text"))
    return periodic_runs.digests(periodic_runs.periodic_runs(docs, text=text))
