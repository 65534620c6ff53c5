"""The operators on the driver tables, with production parameters, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import line_dedup, merkle_manifest, url_filter
from strata.llm.chat_format import format_chats
from strata.llm.compression_quality import quality_scores
from strata.llm.decontamination import contaminated
from strata.llm.language_id import fit_text, identify
from strata.llm.merkle_manifest import as_hex, build, fold, leaf_digest, proof_digest, proofs
from strata.llm.mixing import mix_sources
from strata.llm.ngram_join import join_links
from strata.llm.periodic_runs import find_runs
from strata.llm.piece_chunks import decode_pieces, encode_pieces
from strata.llm.token_files import tokens_round_trip
from strata.llm.topk_search import search

#: Name of the tokenizer file of ``op8_token_files``; its path is looked up when the query runs.
TOKENIZER = "word_bpe_49k.json"
#: Name of the model file of ``op11_sentencepiece``.
PIECES = "piece_bpe_32k.model"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of ``documents`` under Jaccard 0.85 of 4-word shingles."""
    return join_links(table(spark, sf_dir, "documents"), n=4, num=85, den=100)


def op2_bm25_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best of all ``documents`` for each document whose id is divisible by 20, by all its words."""
    docs = table(spark, sf_dir, "documents")
    queries = docs.where(F.col("doc_id") % 20 == 0).select(F.col("doc_id").alias("query_id"), "text")
    return search(docs, queries, k=10)


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every url of ``pages``."""
    return url_filter.filter_pages(table(spark, sf_dir, "pages"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies of ``benchmark`` items in ``documents``, scored by alignment."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` without lines that five or more sources share."""
    return line_dedup.without_shared_lines(table(spark, sf_dir, "documents"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every page of ``pages``; the text model is fitted on ``documents``."""
    return identify(table(spark, sf_dir, "pages"), fit_text(table(spark, sf_dir, "documents")))


def op7_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every text of ``documents``, fitted on ``labels`` outside the held-out fold."""
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` written as token files; their index as read back."""
    return tokens_round_trip(table(spark, sf_dir, "documents"), tokenizer_path())


def op9_pivotal_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much of each of the ``documents`` a mix of 150 % of their words takes."""
    return mix_sources(table(spark, sf_dir, "documents"))


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recovered roles and rendered turns of ``conversations``."""
    return format_chats(table(spark, sf_dir, "conversations"))


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the pieces of every text of ``documents``, and of what they decode to."""
    model = tokenizer_path(PIECES)
    coded = encode_pieces(table(spark, sf_dir, "documents"), model)
    told = coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"), "ids")
    return decode_pieces(told, model).select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) in which every tenth text, by the hash of its id, repeats some of its words to its end.

    Of a text with ``n`` words, all from word ``a`` on become repeats of ``p``
    words from there; words are then joined by a space. Other texts stay.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.expr("h div 10")
    cut = docs.select("doc_id", "text", h.alias("h")).withColumn(
        "w", F.when(F.col("h") % 10 == 0, F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda x: x != "")))
    placed = cut.withColumn("n", F.size("w")).withColumn("a", (g % F.col("n")).cast("int"))
    placed = placed.withColumn("rest", F.col("n") - F.col("a"))
    placed = placed.withColumn("p", (1 + F.floor(F.col("rest") / (3 + g % 8))).cast("int"))
    again = F.flatten(F.array_repeat(F.slice("w", F.col("a") + 1, F.col("p")), F.ceil(F.col("rest") / F.col("p")).cast("int")))
    planted = F.array_join(F.concat(F.slice("w", F.lit(1), F.col("a")), F.slice(again, F.lit(1), F.col("rest"))), " ")
    return placed.select("doc_id", F.when((F.col("h") % 10 == 0) & (F.col("n") > 0), planted).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in every text of ``documents``, in some of which periods are planted."""
    found = find_runs(with_planted_periods(table(spark, sf_dir, "documents")))
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"], r["period"])))
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","),
                                                   r["period"].cast("string"), F.lit("\n")))
    rows = found.withColumn("best", best)
    return rows.select("doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), (-F.col("best.less")).alias("length"),
                       F.col("best.period").alias("period"), F.expr("1000 * -best.less div best.period").alias("exponent_milli"),
                       F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A proof for each of the ``documents``, and whether it holds after half of them lost their line breaks."""
    docs = table(spark, sf_dir, "documents")
    others = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    text = F.col("text")
    cut = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text)
    manifest = build(docs, leaf_digest(*others, text), keep={"tampered": F.unhex(leaf_digest(*others, cut))})
    rows = proofs(manifest).withColumn("root", F.lit(manifest.root.hex() if manifest.root else None).cast("string"))
    rows = rows.select(F.col("id").alias("doc_id"), as_hex(F.col("digest")).alias("leaf"), as_hex(F.col("top")).alias("subroot"), "root",
                       proof_digest(F.col("path")).alias("proof_sha256"), fold(as_hex(F.col("tampered")), F.col("path")).alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


QUERIES = {f.__name__: f for f in (
    op1_ngram_jaccard_join, op2_bm25_search, op3_url_filter, op4_decontamination, op5_line_dedup, op6_language_id,
    op7_compression_quality, op8_token_files, op9_pivotal_mixing, op10_chat_format, op11_sentencepiece, op12_periodic_runs,
    op13_merkle_manifest)}

ORACLE_SQL = {"op3_url_filter": url_filter.SQL, "op5_line_dedup": line_dedup.SQL, "op13_merkle_manifest": merkle_manifest.SQL}
