"""Secret scans over an incremental blob ledger (native).

Every version of a path is content-addressed: its blob id is the SHA-256 of
its text. The ledger is a folder with two tables: ``findings`` (blob, rule,
rule version, span) and ``scanned`` (blob, rule, rule version). A run scans
only the (blob, rule version) pairs that ``scanned`` lacks, once for each blob
however many paths and versions hold it, appends to the ledger, and joins the
findings back to all paths.

Only DataFrame and SQL functions run. Texts cross the network once, joined to
the (blob, first holder) pairs by a hash join that streams the texts; copies
are dropped there. A blob with a third of all paths is one row of the ledger,
and the join back has one findings row for it. Findings are written before
their pairs are marked, so a run that dies in between repeats those scans, and
duplicates are removed on reading.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from fleetscope.llm.common import shared_path


@dataclass(frozen=True)
class SecretRule:
    """Matches of ``regex``, leftmost and not overlapping; those whose
    ``group`` has fewer than ``least`` characters are dropped. Raise
    ``version`` whenever the rule changes: it is then scanned anew."""

    kind: str
    regex: str
    group: int = 0
    least: int = 1
    version: int = 1


# The three base kinds, in their listed order.
BASE_RULES = (
    SecretRule("assign", "(?i)(password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?"
               "([A-Za-z0-9+/_.=-]+)", 2, 8),
    SecretRule("access", "AKIA[A-Z0-9]+", 0, 16),
    # a run of 32 and more is the whole run: the same spans as `[0-9a-f]+` of 32+ characters
    SecretRule("hex", "[0-9a-f]{32,}", 0, 32),
)
#: Added by this scanner.
MORE_RULES = (
    SecretRule("pem", "-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    SecretRule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    SecretRule("github", "gh[pousr]_[A-Za-z0-9]{36,}"),
)
RULES = BASE_RULES + MORE_RULES

_FINDINGS = T.StructType([
    T.StructField("blob", T.BinaryType()), T.StructField("kind", T.StringType()),
    T.StructField("version", T.IntegerType()), T.StructField("start", T.LongType()),
    T.StructField("stop", T.LongType())])
_SCANNED = T.StructType(_FINDINGS.fields[:3])


def blob_id(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text.cast("string"), F.lit("")), 256))


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _ledger(spark: SparkSession, ledger: str, table: str, schema: T.StructType) -> DataFrame:
    path = f"{ledger}/{table}"
    if not _exists(spark, path):
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name)
                                       for f in schema.fields])
    return spark.read.schema(schema).parquet(path)


def _spans(texts: DataFrame, rules) -> DataFrame:
    """(blob, kind, version, start, stop) of the passing matches in
    (blob, text, todo): rules named in ``todo``, code points, end exclusive."""
    def matches(r: SecretRule) -> Column:
        due = F.array_contains("todo", f"{r.kind}@{r.version}")
        hit = F.regexp_extract_all("text", F.lit(r.regex), F.lit(0))
        kept = F.regexp_extract_all("text", F.lit(r.regex), F.lit(r.group)) if r.group else hit
        some = due & F.col("text").rlike(r.regex)
        none = F.array().cast("array<string>")
        return F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version"),
                        F.lit(r.least).alias("least"),
                        F.when(some, hit).otherwise(none).alias("hits"),
                        F.when(some, kept).otherwise(none).alias("kept"),
                        F.when(some, F.split("text", r.regex, -1)).otherwise(none).alias("gaps"))
    each = texts.select("blob", F.inline(F.array(*map(matches, rules)))).where("size(hits) > 0")
    one = each.select("blob", "kind", "version", "least",
                      F.posexplode(F.arrays_zip("gaps", "hits", "kept"))).where("col.hits is not null")
    sized = one.select("blob", "kind", "version", "least", "pos",
                       F.length("col.gaps").cast("long").alias("gap"),
                       F.length("col.hits").cast("long").alias("len"),
                       F.length("col.kept").alias("judged")).distinct()  # equal rows may hold the text
    # the start of a match: all gaps up to it and all matches before it
    upto = Window.partitionBy("blob", "kind").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    ends = sized.withColumn("stop", F.sum(F.col("gap") + F.col("len")).over(upto))
    return (ends.where("judged >= least")
            .select("blob", "kind", "version", (F.col("stop") - F.col("len")).alias("start"), "stop"))


def update_ledger(df: DataFrame, path: str = "doc_id", text: str = "text", rules=RULES,
                  ledger: str | None = None) -> DataFrame:
    """Scan what the ledger lacks; return (blob, findings) for the blobs with
    findings under ``rules``: arrays of (start, rank, kind, stop) sorted by
    start, then by the place of the kind in ``rules``.

    ``ledger``: folder of the ledger, kept between runs; default: a new one in
    the shared checkpoint folder. A null text is the empty text.
    """
    spark = df.sparkSession
    ledger = ledger or shared_path(spark, "secret-ledger")
    names = [f"{r.kind}@{r.version}" for r in rules]
    rows = df.select(F.col(path).alias("path"),
                     F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("blob", blob_id(F.col("text")))

    blobs = rows.groupBy("blob").agg(F.min("path").alias("path"))
    done = (_ledger(spark, ledger, "scanned", _SCANNED)
            .groupBy("blob").agg(F.collect_set(F.concat_ws("@", "kind", "version")).alias("done")))
    todo = (blobs.join(done, "blob", "left")
            .withColumn("todo", F.array_except(F.array(*map(F.lit, names)),
                                               F.coalesce("done", F.array().cast("array<string>"))))
            .where("size(todo) > 0").select("blob", "path", "todo"))
    # the texts stream past the hashed (path, blob) pairs: no sort of texts
    fetched = (rows.alias("r").join(todo.hint("shuffle_hash").alias("t"),
                                    F.col("r.path").eqNullSafe(F.col("t.path"))
                                    & (F.col("r.blob") == F.col("t.blob")))
               .select("r.blob", "r.text", "t.todo"))
    (_spans(fetched, rules).write.mode("append").option("compression", "zstd")
     .parquet(f"{ledger}/findings"))
    # every pair that this run owed is scanned now
    pair = F.split(F.col("pair"), "@")
    (todo.select("blob", F.explode("todo").alias("pair"))
     .select("blob", pair[0].alias("kind"), pair[1].cast("int").alias("version"))
     .write.mode("append").option("compression", "zstd").parquet(f"{ledger}/scanned"))

    rank = F.coalesce(*[F.when((F.col("kind") == r.kind) & (F.col("version") == r.version), i)
                        for i, r in enumerate(rules)])
    return (_ledger(spark, ledger, "findings", _FINDINGS).withColumn("rank", rank)
            .where("rank is not null").select("blob", "start", "rank", "kind", "stop").distinct()
            .groupBy("blob").agg(F.array_sort(F.collect_list(
                F.struct("start", "rank", "kind", "stop"))).alias("findings")))


def scan(df: DataFrame, path: str = "doc_id", text: str = "text", rules=RULES,
         ledger: str | None = None) -> DataFrame:
    """One row for each row of ``df``: ``path``, ``blob`` (binary) and
    ``findings`` as in :func:`update_ledger`, empty where nothing was found.

    Null paths and repeated rows are kept, each with its findings. Other
    columns are ignored. An empty table gives an empty result.
    """
    found = update_ledger(df, path, text, rules, ledger)
    held = df.select(F.col(path).alias("path"), blob_id(F.col(text)).alias("blob"))
    return held.join(found, "blob", "left").select(
        F.col("path").alias(path), "blob", F.coalesce(
            "findings", F.array().cast("array<struct<start:bigint,rank:int,kind:string,stop:bigint>>")).alias("findings"))


def redact(df: DataFrame, path: str = "doc_id", text: str = "text", rules=RULES,
           ledger: str | None = None, mark: str = "[SECRET]") -> DataFrame:
    """``df`` with every found span of ``text`` replaced by ``mark``; overlapping
    spans become one. Rows and other columns stay as they are; null stays null."""
    found = update_ledger(df, path, text, rules, ledger).select(
        F.col("blob").alias("__blob"), F.col("findings").alias("__found"))
    rows = df.withColumn("__blob", blob_id(F.col(text))).join(found, "__blob", "left")
    fixed = F.when(F.col("__found").isNull(), F.col(text)).otherwise(
        _redacted(F.col(text), F.col("__found"), mark))
    return rows.withColumn(text, fixed).select(*[F.col(c) for c in df.columns])


def listed(findings: str, kinds=None) -> Column:
    """``kind:start:stop`` of the findings, comma-joined."""
    chosen = F.col(findings) if kinds is None else F.filter(findings, lambda x: x.kind.isin(*kinds))
    return F.array_join(F.transform(chosen, lambda x: F.concat_ws(":", x.kind, x.start, x.stop)), ",")


def _redacted(text: Column, findings: Column, mark: str) -> Column:
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        gap = F.substr(text, (acc.at + 1).cast("int"), (x.start - acc.at).cast("int"))
        return F.struct(
            F.greatest(acc.at, x.stop).alias("at"),
            F.when(x.start >= acc.at, F.concat(acc.out, gap, F.lit(mark)))
            .otherwise(acc.out).alias("out"))
    folded = F.aggregate(findings, zero, step)
    return F.concat(folded["out"], F.substr(text, (folded["at"] + 1).cast("int")))
