"""The registered queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .byte_tokens import byte_vocabulary_path
from .configuration_packing import pack_whole
from .decontamination import report as decontamination_report
from .line_dedup import KEYS, without_repeated_lines
from .merkle import manifest
from .packing import pack_documents
from .quality_rules import learn_rules, statistics, verdicts
from .secret_ledger import BASE_RULES, scan_versions
from .shared import fresh_path, table
from .simhash_dedup import near_duplicates
from .spelling import variants
from .substring_dedup import remove_repeats
from .token_output import read_tokens, write_tokens
from .tokens import vocabulary_path
from .toxicity import CUT, held_out, scores, train
from .url_filter import judged


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op2_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "token-ids")
    write_tokens(table(spark, sf_dir, "documents"), path, vocabulary_path(None))
    return read_tokens(spark, path)


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = without_repeated_lines(table(spark, sf_dir, "documents"), keys=KEYS)
    kept = F.sha2(F.coalesce("text", F.lit("")), 256)
    return left.select("row.doc_id", "n_lines", "n_removed", kept.alias("kept_sha256"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    judged = verdicts(statistics(docs), learn_rules(docs, table(spark, sf_dir, "labels")))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule"
    )


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = scores(docs, train(docs, table(spark, sf_dir, "labels")))
    return found.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))


def _spans_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def _count(kind: str) -> Column:
    return F.size(F.filter("findings", lambda x: x["kind"] == kind)).cast("long")


def op7_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_versions(table(spark, sf_dir, "documents"), fresh_path(spark, "secret-ledger"))
    base = F.filter("findings", lambda x: x["order"] < len(BASE_RULES))
    return found.select(
        "doc_id",
        *(_count(r.kind).alias(f"n_{r.kind}") for r in BASE_RULES),
        F.sha2(_spans_text(base), 256).alias("base_sha256"),
        _spans_text(F.col("findings")).alias("spans"),
    )


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), vocabulary_path(None))


def op9_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = near_duplicates(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(table(spark, sf_dir, "documents"))


def op12_configuration_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_whole(table(spark, sf_dir, "documents"), byte_vocabulary_path(None))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_substring_dedup, op2_token_output, op3_line_dedup, op4_quality_rules, op5_url_filter, op6_toxicity,
        op7_secret_ledger, op8_packing, op9_simhash_dedup, op10_decontamination,
        op11_spelling_variants, op12_configuration_packing, op13_merkle_manifest,
    )
    return {f.__name__: f for f in found}
