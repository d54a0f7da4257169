"""The pN_ queries with their production parameters, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pliego.llm import bodies, budget, encode, neardup, overlap, pack, privacy, sentences

BYTE_BPE = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"
#: Tokens of a container (problem 7).
CAPACITY = 2048


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# -- problem 1 ------------------------------------------------------------------------------------


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of hf rows, one of train and one of validation or test, with like texts or equal JSON."""
    made = overlap.overlap(table(spark, sf_dir, "hf"))
    return overlap.pairs(made["rows"], made["links"]).select(F.least("train", "eval").alias("row_a"), F.greatest("train", "eval").alias("row_b"))


def p1_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The overlaps by evaluation split and source."""
    hf = table(spark, sf_dir, "hf")
    return overlap.report(hf, **overlap.overlap(hf))


# -- problem 2 ------------------------------------------------------------------------------------


def p2_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every row of boe_documents and documents by piece_bpe_32k."""
    boe, docs = table(spark, sf_dir, "boe_documents"), table(spark, sf_dir, "documents")
    a = budget.sliced(boe, "boe_documents", "id", "texto", boe.seccion, F.lit(budget.GAZETTE_LANG), boe.tipo, boe.subtipo, boe.n_tokens)
    b = budget.sliced(docs, "documents", "doc_id", "text", docs.source, docs.lang, docs.tipo, docs.subtipo, docs.n_tokens)
    return budget.token_counts(a.unionByName(b), encode.tokenizer_path(PIECES))


def p2_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Their totals by source, language and domain."""
    return budget.token_budget(p2_tokens(spark, sf_dir))


# -- problem 3 ------------------------------------------------------------------------------------


def _names(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = (("boe_documents", "departamento"), ("convocatoria", "organismo"), ("licitacion", "organo_contratacion"))
    return bodies.names_of(*[(table(spark, sf_dir, t), f) for t, f in fields])


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of spellings of one public body."""
    return bodies.variant_pairs(_names(spark, sf_dir))


def p3_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every spelling with its body."""
    return bodies.linked(_names(spark, sf_dir))


# -- problem 4 ------------------------------------------------------------------------------------


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of ids of boe_documents with like title and text."""
    return neardup.near_duplicates(table(spark, sf_dir, "boe_documents"))["pairs"]


def p4_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document, its class of equal word runs, and how many other classes that one is linked with."""
    made = neardup.near_duplicates(table(spark, sf_dir, "boe_documents"))
    ends = made["links"].select(F.explode(F.array("same_a", "same_b")).alias("same")).groupBy("same").agg(F.count(F.lit(1)).alias("enlaces"))
    return made["members"].join(ends, "same", "left").select("id", F.col("same").alias("clase"), F.coalesce("enlaces", F.lit(0)).alias("enlaces"))


# -- problem 5 ------------------------------------------------------------------------------------


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal information in the texts of boe_documents."""
    return privacy.personal_data(table(spark, sf_dir, "boe_documents"))


def p5_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The texts with typed placeholders."""
    return privacy.sanitised(table(spark, sf_dir, "boe_documents"))


# -- problem 6 ------------------------------------------------------------------------------------


def p6_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids of every document by byte_bpe_50k."""
    return encode.encode_ids(table(spark, sf_dir, "documents"), encode.tokenizer_path(BYTE_BPE))


# -- problem 7 ------------------------------------------------------------------------------------


def p7_packs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's container of CAPACITY tokens by byte_bpe_50k."""
    sizes = encode.count_tokens(table(spark, sf_dir, "documents"), encode.tokenizer_path(BYTE_BPE))
    return pack.pack(sizes, CAPACITY)


def p7_waste(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much room the containers leave."""
    return pack.waste(p7_packs(spark, sf_dir), CAPACITY)


# -- problem 8 ------------------------------------------------------------------------------------


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sentence units of every document."""
    return sentences.sentences(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (p1_found, p1_report, p2_tokens, p2_budget, p3_found, p3_bodies, p4_found, p4_classes, p5_found, p5_text, p6_ids, p7_packs, p7_waste, p8_found)}
ORACLE_SQL: dict[str, str] = {}
