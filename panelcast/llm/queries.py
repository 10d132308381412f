"""Registry of the training-data queries: name -> (callable, DuckDB SQL or None)."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelcast.sources.tables import read_table


def tokenizer_file(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_packing(spark, sf_dir):
    from panelcast.llm.packing import pack
    return pack(read_table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"), 2048)


def op7_token_counts(spark, sf_dir):
    from panelcast.llm.token_counts import fresh_cache, token_counts
    return token_counts(read_table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"),
                        fresh_cache(spark), limit=512)


def op8_simhash(spark, sf_dir):
    from panelcast.llm.simhash import near_duplicates
    return near_duplicates(read_table(spark, sf_dir, "documents"), words=4, max_bits=4)


def op9_substring_dedup(spark, sf_dir):
    from panelcast.llm.substring_dedup import remove_repeats
    return (remove_repeats(read_table(spark, sf_dir, "documents"), window=35)
            .select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")))


def op2_spotsigs(spark, sf_dir):
    from panelcast.llm.spotsigs import edited_fingerprints
    return edited_fingerprints(read_table(spark, sf_dir, "documents"), chain=2)


def op3_license_scan(spark, sf_dir):
    from panelcast.llm.license_scan import scan
    return scan(read_table(spark, sf_dir, "documents"), threshold=(9, 10))


def op4_line_dedup(spark, sf_dir):
    from panelcast.llm.line_dedup import line_classes
    return line_classes(read_table(spark, sf_dir, "documents"), edits=2, min_chars=20, share=0.1)


def op5_decontamination(spark, sf_dir):
    from panelcast.llm.decontaminate import contamination
    return contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op6_url_filter(spark, sf_dir):
    from panelcast.llm.url_filter import url_verdicts
    return url_verdicts(read_table(spark, sf_dir, "pages"))


def op6_sql():
    from panelcast.llm.url_filter import verdict_sql
    return verdict_sql()


def op10_toxicity(spark, sf_dir):
    from panelcast.llm.toxicity import fit_on_tables, score_documents
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_on_tables(docs, read_table(spark, sf_dir, "labels"), train_docs=1000)
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    return score_documents(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op11_prefix_trie(spark, sf_dir):
    from panelcast.llm.prefix_trie import prefix_trie
    return prefix_trie(read_table(spark, sf_dir, "conversations"))


def op11_sql():
    from panelcast.llm.prefix_trie import trie_sql
    return trie_sql()


def op12_spelling(spark, sf_dir):
    from panelcast.llm.spelling import spelling_variants
    return spelling_variants(read_table(spark, sf_dir, "documents"))


def op12_sql():
    from panelcast.llm.spelling import spelling_sql
    return spelling_sql()


def op13_main_text(spark, sf_dir):
    from panelcast.llm.main_text import main_text
    return main_text(read_table(spark, sf_dir, "pages"))


REGISTRY = {
    "op1_packing": (op1_packing, None),
    "op2_spotsigs": (op2_spotsigs, None),
    "op3_license_scan": (op3_license_scan, None),
    "op4_line_dedup": (op4_line_dedup, None),
    "op5_decontamination": (op5_decontamination, None),
    "op6_url_filter": (op6_url_filter, op6_sql()),
    "op7_token_counts": (op7_token_counts, None),
    "op8_simhash": (op8_simhash, None),
    "op9_substring_dedup": (op9_substring_dedup, None),
    "op10_toxicity": (op10_toxicity, None),
    "op11_prefix_trie": (op11_prefix_trie, op11_sql()),
    "op12_spelling": (op12_spelling, op12_sql()),
    "op13_main_text": (op13_main_text, None),
}
