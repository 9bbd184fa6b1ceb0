"""The registered queries of the operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.llm import (
    best_fit_packing,
    decontamination,
    embedding_dedup,
    html_extraction,
    kneser_ney,
    language_id,
    line_dedup,
    periodic_runs,
    phrases,
    repeated_bytes,
    simhash_dedup,
    token_orc,
    toxicity,
)
from gaugeworks.llm.common import Work, documents, ship


#: Vocabulary of the token files, and the id that ends a document in them.
VOCABULARY, END_ID = "word_bpe_49k.json", 2


def op1_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    work = Work(spark, "tokens")
    token_orc.write(
        documents(spark, sf_dir), f"{work.path}/orc", public_tokenizers.path(VOCABULARY), END_ID
    )
    rows = work.stage(token_orc.index(spark, f"{work.path}/orc"), "index")
    return token_orc.with_starts(rows)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = toxicity.severity(docs, model)
    chances = [F.col("p_at_least")[k].alias(f"p_at_least_{k + 1}") for k in range(toxicity.GRADES)]
    return scored.select("doc_id", "expected_severity", *chances, "grade", "toxic")


def trusted_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents labelled as good and not toxic."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return labels.where("quality = 1 and toxic = 0").select("doc_id")


def op3_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = kneser_ney.perplexities(documents(spark, sf_dir), trusted_ids(spark, sf_dir))
    return judged.drop("_k1", "_k2")


def op4_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = repeated_bytes.remove_repeats(documents(spark, sf_dir), length=400)
    gone = repeated_bytes.n_removed()
    return kept.select(
        "doc_id",
        (F.octet_length("kept").cast("long") + gone).alias("n_bytes"),
        gone.alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
        F.octet_length("kept").cast("long").alias("n_kept"),
        F.char_length(F.col("kept").cast("string")).cast("long").alias("n_chars"),
        (gone > 0).alias("repeats"),
    )


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.drop_lines(documents(spark, sf_dir).select("doc_id", "text"), min_docs=10)
    digest = F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256")
    return kept.select("doc_id", "n_lines", "n_dropped", digest)


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return embedding_dedup.near_duplicates(vectors, threshold=0.98)


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per contaminated pair of document and benchmark item."""
    found = decontamination.contaminated(
        documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    )
    return found.select(
        "doc_id",
        "item_id",
        "item_tokens",
        "tiled_tokens",
        "coverage",
        F.size("tiles").cast("long").alias("n_tiles"),
        (F.col("coverage") >= decontamination.COVERAGE).alias("contaminated"),
    )


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_packing.pack(documents(spark, sf_dir))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_duplicates(
        documents(spark, sf_dir), shingle_words=4, max_bits=4
    )


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.mine(documents(spark, sf_dir))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(documents(spark, sf_dir), tail=periodic_runs.periodic_tail)
    # By start, then period, so the first of several with the greatest exponent is kept.
    best = F.aggregate(
        "runs",
        F.get("runs", F.lit(0)),
        lambda best, r: F.when(r["length"] * best["period"] > best["length"] * r["period"], r).otherwise(best),
    )
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.call_function("div", F.lit(1000) * F.col("best.length"), F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = language_id.train(docs.where(~language_id.held_out()))
    held = F.coalesce(language_id.held_out(), F.lit(False)).alias("held_out")
    return language_id.predict(docs, model).select("doc_id", held, "lang_pred", "score")


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_orc": op1_token_orc,
    "op2_toxicity": op2_toxicity,
    "op3_kneser_ney": op3_kneser_ney,
    "op4_repeated_bytes": op4_repeated_bytes,
    "op5_line_dedup": op5_line_dedup,
    "op6_html_extraction": op6_html_extraction,
    "op7_embedding_dedup": op7_embedding_dedup,
    "op8_decontamination": op8_decontamination,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_simhash": op10_simhash,
    "op11_phrases": op11_phrases,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_language_id": op13_language_id,
}


def _shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


QUERIES = {name: _shipped(query) for name, query in _QUERIES.items()}
