"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Every query starts from the given tables and is a lazy plan; the caller runs
it. Computed doubles are published rounded (see fleetscope.functions.numeric)
and instants as zone-less UTC timestamps so results compare across engines.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetscope.operators import rollup as A
from fleetscope.operators import validate as V
from fleetscope.plans import frames
from fleetscope.plans.frames import ntz
from fleetscope import session

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    """Register ``fn`` under ``name``; the session settings are pinned first."""
    def deco(fn: Query) -> Query:
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            session.prepare(spark)
            return fn(spark, sf_dir)
        QUERIES[name] = run
        return fn
    return deco


# --- parse, validate, route -------------------------------------------------

@query("parse_events")
def parse_events(spark, sf_dir):
    d = frames.decoded(spark, sf_dir)
    return d.select("partition", "offset", "snapshot_id", "event_id",
                    ntz("timestamp").alias("timestamp"), "device_id", "metric_name",
                    "value", "unit", "location", "raw_value")


@query("validate_route")
def validate_route(spark, sf_dir):
    return V.route_labels(frames.validated(spark, sf_dir))


@query("clean_events")
def clean_events(spark, sf_dir):
    c = frames.clean(spark, sf_dir)
    return c.withColumn("timestamp", ntz("timestamp"))


@query("dead_letter")
def dead_letter(spark, sf_dir):
    return frames.dead(spark, sf_dir)


@query("rejection_summary")
def rejection_summary(spark, sf_dir):
    return V.rejection_summary(frames.validated(spark, sf_dir))


@query("raw_anomaly_flags")
def raw_anomaly_flags(spark, sf_dir):
    return V.raw_anomaly_flags(frames.messages(spark, sf_dir))


@query("raw_anomaly_summary")
def raw_anomaly_summary(spark, sf_dir):
    return V.raw_anomaly_summary(V.raw_anomaly_flags(frames.messages(spark, sf_dir)))


# --- hourly rollup ----------------------------------------------------------

def _hourly(spark, sf_dir):
    return A.hourly_aggregates(frames.clean(spark, sf_dir))


@query("hourly_aggregates")
def hourly_aggregates(spark, sf_dir):
    return _hourly(spark, sf_dir).withColumn("hour_window", ntz("hour_window"))


@query("hourly_sample")
def hourly_sample(spark, sf_dir):
    return A.hourly_sample(_hourly(spark, sf_dir)).withColumn("hour_window", ntz("hour_window"))


# --- quality ----------------------------------------------------------------

from fleetscope.operators import quality as Q  # noqa: E402
from fleetscope.sources.idindex import IdIndex  # noqa: E402


@query("check_row_count")
def check_row_count(spark, sf_dir):
    return Q.check_row_count(frames.clean(spark, sf_dir))


@query("check_null_rates")
def check_null_rates(spark, sf_dir):
    return Q.check_null_rates(frames.clean(spark, sf_dir))


@query("check_value_ranges")
def check_value_ranges(spark, sf_dir):
    return Q.check_value_ranges(frames.clean(spark, sf_dir))


@query("check_duplicates")
def check_duplicates(spark, sf_dir):
    return Q.check_duplicates(frames.clean(spark, sf_dir))


@query("check_duplicates_indexed")
def check_duplicates_indexed(spark, sf_dir):
    """Q4 over an id index that takes the snapshots one by one; only their own ids are shuffled."""
    root = session.shared_folder(spark, "id-index")
    clean = frames.clean(spark, sf_dir)
    index = IdIndex(spark, root, buckets=int(spark.conf.get("spark.sql.shuffle.partitions")))
    for (snapshot,) in sorted(clean.select("snapshot_id").distinct().collect()):
        index.add(clean.where(F.col("snapshot_id") == snapshot), snapshot)
    found = session.written(index.check_duplicates(), "duplicates")
    index.drop()
    return found


@query("quality_report")
def quality_report(spark, sf_dir):
    return Q.quality_report(frames.clean(spark, sf_dir))


@query("quality_gate")
def quality_gate(spark, sf_dir):
    return Q.gate(Q.quality_report(frames.clean(spark, sf_dir)))


# --- features ---------------------------------------------------------------

import numpy as np  # noqa: E402

from fleetscope.functions.numeric import r6  # noqa: E402
from fleetscope.operators import autoencoder as AE  # noqa: E402
from fleetscope.operators import features as FT  # noqa: E402
from fleetscope.operators import scoring as M  # noqa: E402
from fleetscope.operators import sketches as K  # noqa: E402
from fleetscope.plans import evaluation as EV  # noqa: E402
from fleetscope.plans.dataset import prepare  # noqa: E402
from fleetscope.schema import METRICS, THRESHOLD_QUANTILES  # noqa: E402


def _prepared(spark, sf_dir, **kw):
    return prepare(frames.clean(spark, sf_dir), **kw)


def _publish(df, metrics=METRICS):
    return df.select(ntz("time_window").alias("time_window"),
                     *[r6(F.col(m)).alias(m) for m in metrics])


@query("snapshot_scan")
def snapshot_scan(spark, sf_dir):
    """S4 + F1: the four feature inputs as of snapshot 2, from a table of one directory for each
    snapshot (written to the shared folder): later snapshots are not scanned."""
    path = session.shared_folder(spark, "snapshots")
    clean = frames.clean(spark, sf_dir)
    clean.write.partitionBy("snapshot_id").parquet(path)
    ev = FT.load_events(spark.read.schema(clean.schema).parquet(path), snapshot_id=2)
    return ev.withColumn("timestamp", ntz("timestamp"))


@query("pivot_minutes")
def pivot_minutes(spark, sf_dir):
    return _publish(_prepared(spark, sf_dir).pivoted)


@query("feature_matrix")
def feature_matrix(spark, sf_dir):
    return _publish(_prepared(spark, sf_dir).features)


@query("scaler_params")
def scaler_params(spark, sf_dir):
    s = _prepared(spark, sf_dir).scaler
    return s.select("feature_index", "feature_name", r6(F.col("data_min")).alias("data_min"),
                    r6(F.col("data_max")).alias("data_max"))


@query("normalized_features")
def normalized_features(spark, sf_dir):
    return _publish(_prepared(spark, sf_dir).normalized)


@query("apply_scaler")
def apply_scaler(spark, sf_dir):
    """F8: the scaler fitted as of snapshot 1 applied to the latest features."""
    old = _prepared(spark, sf_dir, snapshot_id=1)
    latest = _prepared(spark, sf_dir, scaler=old.scaler)
    return _publish(latest.normalized)


@query("time_split")
def time_split(spark, sf_dir):
    s = _prepared(spark, sf_dir).split
    return s.select(ntz("time_window").alias("time_window"), "position", "split")


@query("device_time_split")
def device_time_split(spark, sf_dir):
    """F3 with keys: one vector per (minute, device), split in (time, device) order."""
    s = _prepared(spark, sf_dir, keys=("device_id",)).split
    return s.select(ntz("time_window").alias("time_window"), "device_id", "position", "split")


@query("split_sizes")
def split_sizes(spark, sf_dir):
    return _prepared(spark, sf_dir).sizes()


# --- scoring with the fixed mean reconstructor -------------------------------

def _scored(spark, sf_dir):
    p = _prepared(spark, sf_dir)
    recon = M.mean_reconstructor(p.part("train"))
    errors = M.reconstruction_errors(p.split, recon)
    limits = M.thresholds(errors.where(F.col("split") == "train"))
    return p, recon, errors, limits


@query("reconstruction_error")
def reconstruction_error(spark, sf_dir):
    _, _, errors, _ = _scored(spark, sf_dir)
    return errors.select(ntz("time_window").alias("time_window"), "split",
                         r6(F.col("error")).alias("error"))


@query("error_thresholds")
def error_thresholds(spark, sf_dir):
    _, _, _, limits = _scored(spark, sf_dir)
    return limits.select(r6(F.col("p95")).alias("p95"), r6(F.col("p99")).alias("p99"))


@query("threshold_sketch")
def threshold_sketch(spark, sf_dir):
    """M7 from kept sketches: one for each day of the training errors, merged over all days. A sketch is
    random within its rank error, so what is published is whether the exact ranks bear it out."""
    _, _, errors, _ = _scored(spark, sf_dir)
    train = errors.where(F.col("split") == "train")
    kept = session.written(K.kept_sketches(train, [F.to_date("time_window").alias("day")]), "sketches")
    names = [f"p{round(p * 100)}" for p in THRESHOLD_QUANTILES]
    q = K.merged_quantiles(kept, THRESHOLD_QUANTILES, names).first()
    spans = K.rank_spans(train, "error", {name: q[name] for name in names})
    within = lambda name, p: ((F.col(f"{name}_below") <= p + K.RANK_ERROR)
                              & (F.col(f"{name}_upto") >= p - K.RANK_ERROR)).alias(f"{name}_within")
    return spans.select("n", F.lit(kept.count()).cast("long").alias("sketches"),
                        *[within(name, p) for name, p in zip(names, THRESHOLD_QUANTILES)])


@query("error_stats")
def error_stats(spark, sf_dir):
    _, _, errors, _ = _scored(spark, sf_dir)
    s = M.error_stats(errors)
    return s.select(*[r6(F.col(c)).alias(c) for c in s.columns])


@query("anomaly_flags")
def anomaly_flags(spark, sf_dir):
    _, _, errors, limits = _scored(spark, sf_dir)
    f = M.flag(errors.where(F.col("split") == "test"), limits)
    return f.select(ntz("time_window").alias("time_window"), r6(F.col("error")).alias("error"),
                    "flag_p95", "flag_p99")


def _synthetic(spark, sf_dir):
    p, recon, errors, limits = _scored(spark, sf_dir)
    n_test = p.size_of("test")
    lim = M.threshold_values(limits)
    syn = M.synthetic_anomalies(spark, n_test)
    syn_flags = M.flag(M.reconstruction_errors(syn, recon), lim)
    test_flags = M.flag(errors.where(F.col("split") == "test"), lim)
    return syn_flags, test_flags


@query("synthetic_anomalies")
def synthetic_anomalies(spark, sf_dir):
    syn, _ = _synthetic(spark, sf_dir)
    return syn.select("syn_id", *[r6(F.col(m)).alias(m) for m in METRICS],
                      r6(F.col("error")).alias("error"), "flag_p95")


@query("confusion_matrix")
def confusion_matrix(spark, sf_dir):
    syn, test = _synthetic(spark, sf_dir)
    return M.confusion(test, syn)


@query("detection_metrics")
def detection_metrics(spark, sf_dir):
    syn, test = _synthetic(spark, sf_dir)
    d = M.detection_metrics(M.confusion(test, syn))
    return d.select(*[r6(F.col(c)).alias(c) for c in d.columns])


# --- catalog ----------------------------------------------------------------

from fleetscope.operators import catalog as C  # noqa: E402
from fleetscope.operators import experiments as E  # noqa: E402
from fleetscope.operators import health as H  # noqa: E402
from fleetscope.plans import derived  # noqa: E402
from fleetscope.schema import TABLES  # noqa: E402
from fleetscope.sources.fixtures import TOPIC  # noqa: E402


def _tables(spark, sf_dir):
    report = Q.quality_report(frames.clean(spark, sf_dir))
    return C.dataset_list(derived.commits(spark, sf_dir), report)


@query("dataset_list")
def dataset_list(spark, sf_dir):
    return _tables(spark, sf_dir)


@query("table_detail")
def table_detail(spark, sf_dir):
    """C2 for every table: the columns with their types, and the table's summary."""
    tables = _tables(spark, sf_dir)
    return functools.reduce(DataFrame.unionByName, [
        C.table_detail(name, schema, tables) for name, schema in TABLES.items()])


@query("snapshot_list")
def snapshot_list(spark, sf_dir):
    return C.snapshot_list(derived.commits(spark, sf_dir))


@query("table_sample")
def table_sample(spark, sf_dir):
    c = frames.clean(spark, sf_dir).withColumn("timestamp", ntz("timestamp"))
    return C.table_sample(c, ["timestamp", "event_id"], snapshot_id=2)


@query("dataset_totals")
def dataset_totals(spark, sf_dir):
    return C.dataset_totals(_tables(spark, sf_dir))


@query("quality_band")
def quality_band(spark, sf_dir):
    return C.quality_bands(_tables(spark, sf_dir))


def _fresh(spark, sf_dir):
    """Freshness at the data's own "now": the newest commit of the three tables."""
    newest = F.max("last_updated").over(Window.partitionBy())  # three rows
    tables = _tables(spark, sf_dir).withColumn("_now", newest)
    return C.freshness(tables, F.col("_now"))


@query("freshness")
def freshness(spark, sf_dir):
    return _fresh(spark, sf_dir)


@query("storage_status")
def storage_status(spark, sf_dir):
    return C.storage_status(_fresh(spark, sf_dir))


# --- health -----------------------------------------------------------------

@query("run_status")
def run_status(spark, sf_dir):
    runs = derived.dag_runs(spark, sf_dir).withColumn(
        "run_hour", F.date_trunc("hour", "execution_date").cast("timestamp_ntz"))
    return H.run_rollup(runs, ["dag_id", "run_hour"])


@query("run_timeline")
def run_timeline(spark, sf_dir):
    return H.run_timeline(derived.dag_runs(spark, sf_dir))


@query("consumer_lag")
def consumer_lag(spark, sf_dir):
    return H.consumer_lag(*derived.topic_offsets(spark, sf_dir))


@query("ingest_health")
def ingest_health(spark, sf_dir):
    return H.ingest_health(H.consumer_lag(*derived.topic_offsets(spark, sf_dir)), TOPIC)


# --- experiments ------------------------------------------------------------

def _logs(spark, sf_dir):
    return derived.run_logs(spark, sf_dir), derived.evaluations(spark, sf_dir)


@query("experiment_list")
def experiment_list(spark, sf_dir):
    lst = E.experiment_list(*_logs(spark, sf_dir))
    return lst.select("experiment_id", "timestamp", r6(F.col("best_val_loss")).alias("best_val_loss"),
                      "epochs_completed", "device",
                      *[r6(F.col(c)).alias(c) for c in ("precision", "recall", "f1")])


@query("experiment_detail")
def experiment_detail(spark, sf_dir):
    """E2 for the first run that has an evaluation, flattened."""
    logs, evals = _logs(spark, sf_dir)
    d = E.experiment_detail(logs, evals, evals.agg(F.min("experiment_id")).first()[0])
    flat = d.select("experiment_id", "timestamp", "hyperparameters.*", "results.*", "evaluation.metrics.*",
                    F.size("losses.train").cast("long").alias("train_losses"),
                    F.size("losses.val").cast("long").alias("val_losses"),
                    F.array_join("scaler_params.feature_names", ",").alias("feature_names"))
    return _rounded(flat)


@query("latest_model")
def latest_model(spark, sf_dir):
    m = E.latest_model(*_logs(spark, sf_dir))
    return m.select("experiment_id", "model_path", r6(F.col("best_val_loss")).alias("best_val_loss"),
                    *[r6(F.col(c)).alias(c) for c in ("precision", "recall", "f1")])


@query("loss_curve")
def loss_curve(spark, sf_dir):
    c = E.loss_curve(derived.run_logs(spark, sf_dir))
    return c.select("experiment_id", "epoch", r6(F.col("train")).alias("train"),
                    r6(F.col("validation")).alias("validation"))


@query("evaluation_summary")
def evaluation_summary(spark, sf_dir):
    """M13 flattened, for the fixed mean reconstructor: thresholds, error
    statistics, confusion counts, metrics and sizes in one row."""
    p = _prepared(spark, sf_dir)
    out = EV.summary(spark, EV.measure(spark, p, M.mean_reconstructor(p.part("train"))))
    return _rounded(out)


def _rounded(df):
    """Doubles at the published scale; integer columns as they are."""
    return df.select(*[r6(F.col(c)).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


# --- the network with weights from a formula (checked by SQL) ------------------

def formula_weights():
    """5,973 weights that any engine can compute."""
    k = np.arange(AE.parameter_count())
    return (k * 7919 % 2003) / 2003.0 - 0.5


@query("network_scores")
def network_scores(spark, sf_dir):
    """M1 + M6: errors of the network."""
    p = _prepared(spark, sf_dir)
    e = M.reconstruction_errors(p.split, AE.reconstructor(spark, formula_weights()))
    return e.select(ntz("time_window").alias("time_window"), "split", r6(F.col("error")).alias("error"))


@query("network_latent")
def network_latent(spark, sf_dir):
    """M2: the latent vector, a row for each dimension."""
    p = _prepared(spark, sf_dir)
    z = AE.latent(spark, p.split, formula_weights(), ["time_window", "split"])
    return z.select(ntz("time_window").alias("time_window"), "split",
                    F.posexplode("latent").alias("dim", "value")).withColumn("value", r6(F.col("value")))


@query("network_report")
def network_report(spark, sf_dir):
    """The report of the network."""
    p = _prepared(spark, sf_dir)
    numbers = EV.measure(spark, p, AE.reconstructor(spark, formula_weights()))
    return _rounded(EV.summary(spark, numbers))


# --- autoencoder (rows-only: training is iterative) ---------------------------

from fleetscope.plans import training as TR  # noqa: E402


def _trained(spark, sf_dir):
    """Prepared features and a full training run on them: up to 50 epochs,
    patience 5. Each query trains its own; nothing is kept between queries."""
    p = _prepared(spark, sf_dir)
    return p, TR.train(spark, p.part("train"), p.part("val"))


@query("training_history")
def training_history(spark, sf_dir):
    p, res = _trained(spark, sf_dir)
    hist = F.array(*[F.struct(F.lit(i + 1).alias("epoch"), F.lit(t).alias("train_loss"),
                              F.lit(v).alias("val_loss"))
                     for i, (t, v) in enumerate(zip(res.train_losses, res.val_losses))])
    return (p.sizes().agg(F.sum("rows").alias("vectors"))
            .select("vectors", F.inline(hist))
            .withColumn("is_best", F.col("epoch") == res.best_epoch))


@query("autoencoder_scores")
def autoencoder_scores(spark, sf_dir):
    p, res = _trained(spark, sf_dir)
    e = M.reconstruction_errors(p.split, AE.reconstructor(spark, res.theta))
    return e.select(ntz("time_window").alias("time_window"), "split", "error")


@query("autoencoder_latent")
def autoencoder_latent(spark, sf_dir):
    p, res = _trained(spark, sf_dir)
    return AE.latent(spark, p.split, res.theta, ["time_window", "split"]) \
        .withColumn("time_window", ntz("time_window"))


@query("evaluation_report")
def evaluation_report(spark, sf_dir):
    p, res = _trained(spark, sf_dir)
    return EV.evaluate(spark, p, res.theta, "exp_query")
