"""The registered queries of the operators, over whole tables, and their SQL."""

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starflow.llm import ann, bpe, centroids, chat, decontam, line_dedup, oracles, pii, quality, substring_dedup, token_count, url_filter, whitening
from starflow.llm.near_dup import near_duplicates

#: Verdicts that need no model.
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)


def tokenizer(name: str) -> str:
    """The public vocabulary file of this name."""
    import public_tokenizers

    return os.path.abspath(public_tokenizers.path(name))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_line_dedup(spark, sf_dir):
    """Per document: lines, lines deleted, and the digest of the text that stays."""
    docs = line_dedup.without_repeats(read(spark, sf_dir, "documents").select("doc_id", "text"), grow=True)
    return docs.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op2_pii(spark, sf_dir):
    docs = pii.with_spans(read(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    of = lambda *kinds: F.filter("spans", lambda s: s["kind"].isin(*kinds))
    return docs.select(
        "doc_id",
        *[F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in pii.BASE],
        F.sha2(pii.joined(of(*pii.BASE)), 256).alias("base_sha256"),
        pii.joined(F.col("spans")).alias("spans"),
    )


def op3_decontamination(spark, sf_dir):
    """A row for each document and benchmark item that it holds."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontam.with_matches(docs, read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.inline("matches"))


def op4_nearest(spark, sf_dir):
    vectors = read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return ann.nearest(vectors, vectors.where("vec_id % 100 = 0"))


def op5_chat(spark, sf_dir):
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    words = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-1, 0, "user", words), (-1, 1, "assistant", words)], turns.schema)
    made = chat.windows(turns.unionByName(own))
    new = F.slice(chat.turns_of(F.col("formatted")), F.col("context") + 1, F.size(chat.turns_of(F.col("formatted"))))
    made = made.select("conv_id", "window", F.length("formatted").alias("chars"), new.alias("turns"), chat.losses_of(F.col("formatted"), F.col("loss")).alias("losses"))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    made = made.select("conv_id", "chars", F.size("turns").alias("n"), F.struct("window", told.alias("told"), F.array_join("losses", "").alias("lost")).alias("part"))
    read_back = made.groupBy("conv_id").agg(F.sort_array(F.collect_list("part")).alias("parts"), F.sum("n").alias("n"), F.sum("chars").alias("chars"))
    lost = F.array_join(F.transform("parts", lambda p: p["lost"]), "")
    return read_back.select(
        "conv_id",
        F.col("n").alias("n_turns"),
        F.sha2(F.array_join(F.transform("parts", lambda p: p["told"]), ""), 256).alias("turns_sha256"),
        F.length(lost).cast("long").alias("loss_chars"),
        F.sha2(lost, 256).alias("loss_sha256"),
        F.col("chars").alias("formatted_chars"),
    )


def op6_url_filter(spark, sf_dir):
    """The model learns from the pages that a rule decides, a bounded number of them."""
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    rule, verdict = url_filter.rule_of(RULES, url_filter.host(F.col("url")), url_filter.path(F.col("url")))
    weights = url_filter.train(pages.select("url", (verdict == "block").cast("int").alias("blocked")).where("blocked is not null"))
    return url_filter.judged(pages, RULES, weights).select("page_id", "host", "path", "rule", "verdict", F.round("score", 6).alias("score"))


def op7_quality(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, read(spark, sf_dir, "labels"))
    out = quality.scored(docs, model)
    return out.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op8_minhash_near_dedup(spark, sf_dir):
    return near_duplicates(read(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_token_count(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return token_count.counted(docs, tokenizer("piece_bpe_32k.model")).select("doc_id", "n_tokens")


def op10_bpe(spark, sf_dir):
    path = tokenizer("byte_bpe_50k.json")
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.round_trip(docs, path).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(bpe.joined(F.col("ids")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op11_substring_dedup(spark, sf_dir):
    made = substring_dedup.without_repeats(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return made.select("doc_id", "n_words", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op12_centroid_clustering(spark, sf_dir):
    made = centroids.clustered(read(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return made.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", centroids.digest(F.col("centroid")).alias("centroid_sha256"))


def op13_embedding_whitening(spark, sf_dir):
    """A row for each vector and component."""
    table, told = whitening.whitened(read(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    each = table.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    told = told.select((F.col("component") - 1).alias("at"), "component", "n", "explained", "identity_error")
    # eight rows
    rows = each.join(F.broadcast(told), "at")
    return rows.select("vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error")


QUERIES = {
    f.__name__: f
    for f in (
        op1_line_dedup,
        op2_pii,
        op3_decontamination,
        op4_nearest,
        op5_chat,
        op6_url_filter,
        op7_quality,
        op8_minhash_near_dedup,
        op9_token_count,
        op10_bpe,
        op11_substring_dedup,
        op12_centroid_clustering,
        op13_embedding_whitening,
    )
}
ORACLES: dict[str, str] = {
    "op11_substring_dedup": oracles.SUBSTRING_DEDUP,
    "op12_centroid_clustering": oracles.CENTROID_CLUSTERING,
}
