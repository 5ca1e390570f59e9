"""The corpus pipeline: five operators over the documents, one after another.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of ``docs``. A stage's result is written as Parquet and
read again as the next one's documents.

1. toxicity: documents with a score of 0.7 and more go.
2. SimHash near-duplicates: of each component one row stays, the smallest doc_id.
3. benchmark decontamination: the removal spans are cut from the texts.
4. secret scans: every found span is replaced by a mark.
5. byte-level BPE: the texts are encoded, and decoded again as a check.

Stages 3 and 4 keep every document; where they change a text, ``n_chars``
becomes its new length. Null and empty texts pass all stages; they are near-duplicates of
each other, so stage 2 keeps one of them. Null ids and repeated
rows are kept by all stages but the second, which keeps one of equal rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetscope.llm import bpe, decontaminate, secret_scan, simhash, toxicity
from fleetscope.llm.common import written
from fleetscope.session import prepare
from fleetscope.sources.tables import read_table


def _numbered(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """``docs`` with columns of neutral names (c0, c1, ...) in their order: no name
    can clash with what an operator adds."""
    return docs.toDF(*[f"c{i}" for i in range(len(docs.columns))]), [f"c{i}" for i in range(len(docs.columns))]


def _name(docs: DataFrame, column: str) -> str:
    return f"c{docs.columns.index(column)}"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels", "doc_id", "toxic"))
    plain, names = _numbered(docs)
    scored = toxicity.score(plain, model, _name(docs, "doc_id"), _name(docs, "text"), carry=names)
    return scored.where("predicted = 0").select(*names).toDF(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    plain, names = _numbered(docs)
    rows = written(plain.withColumn("row", F.monotonically_increasing_id()), "rows")
    found = simhash.near_duplicates(rows, "row", _name(docs, "text"), shingle=3, max_bits=3)
    ids = rows.select("row", F.col(_name(docs, "doc_id")).alias("id"))
    kept = (found.select("row", "component_id").join(ids, "row").groupBy("component_id")
            .agg(F.min(F.struct(F.col("id").isNull(), "id", "row")).alias("first")).select("first.row"))
    return rows.join(kept.hint("shuffle_hash"), "row", "left_semi").select(*names).toDF(*docs.columns)


def _resized(docs: DataFrame, changed: DataFrame) -> DataFrame:
    """``n_chars`` as the length of the text where that is no longer what it says."""
    if "n_chars" not in docs.columns:
        return changed
    kind = docs.schema["n_chars"].dataType
    return changed.withColumn("n_chars", F.when(F.col("__cut"), F.length("text").cast(kind)).otherwise(
        F.col("n_chars"))).drop("__cut")


def _changing(docs: DataFrame, change) -> DataFrame:
    """Apply ``change`` to the texts; note in ``__cut`` whether the length of a text changed."""
    longer = change(docs.withColumn("__length", F.length("text")))
    changed = longer.withColumn("__cut", ~F.col("__length").eqNullSafe(F.length("text"))).drop("__length")
    return _resized(docs, changed) if "n_chars" in docs.columns else changed.drop("__cut")


def cut_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    benchmark = read_table(spark, sf_dir, "benchmark", "item_id", "text")
    return _changing(docs, lambda d: decontaminate.remove(d, benchmark)).select(*docs.columns)


def mark_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return _changing(docs, secret_scan.redact).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers as P

    prepare(spark)
    return bpe.round_trip(docs, P.path("byte_bpe_50k.tiktoken"), P.PATTERN, with_ids=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", cut_benchmarks),
    ("secret_scans", mark_secrets),
    ("byte_bpe", encode),
]

#: SQL can express neither the model nor the encoding: tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table of ``sf_dir``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
