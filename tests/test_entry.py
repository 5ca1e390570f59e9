"""The driver contract: entry(), queries(), oracle_sql() -- every registered
query is run at sf0.001 and compared with its DuckDB oracle, or held to the
properties that its docstring promises."""

import os
from collections import Counter

import duckdb
import numpy as np
import pytest

from conftest import SF001

import __spark_entry__ as ENTRY
from fleetscope.plans.registry import QUERIES
from tools.check_oracle import TABLES, rows_of

ZONE = "spark.sql.session.timeZone"


def test_entry_runs(spark):
    df = ENTRY.entry(spark)
    assert df.count() > 0
    assert {"hour_window", "avg_value", "event_count"} <= set(df.columns)


def test_oracle_keys_are_registered():
    assert set(ENTRY.oracle_sql()) <= set(ENTRY.queries())
    assert set(QUERIES) <= set(ENTRY.queries())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF001, f"{t}.parquet")
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def history_holds(pdf):
    """Real training: ends at 50 epochs or five after the best, the loss falls,
    one best epoch, and it is that of the least validation loss."""
    assert list(pdf["epoch"]) == list(range(1, len(pdf) + 1))
    best = int(pdf.loc[pdf["is_best"], "epoch"].iloc[0])
    assert pdf["is_best"].sum() == 1 and best == int(pdf["val_loss"].idxmin()) + 1
    assert len(pdf) == 50 or len(pdf) == best + 5
    assert pdf["train_loss"].iloc[-1] < 0.5 * pdf["train_loss"].iloc[0]
    assert pdf["vectors"].nunique() == 1 and pdf["vectors"].iloc[0] > 500


def scores_hold(pdf):
    """One error for each vector; far below that of an untrained network."""
    assert pdf["time_window"].is_unique and (pdf["error"] >= 0).all()
    assert set(pdf["split"]) == {"train", "val", "test"} and pdf["error"].median() < 0.02


def latent_holds(pdf):
    z = np.array(pdf["latent"].tolist())
    assert pdf["time_window"].is_unique and z.shape[1] == 16 and (z >= 0).all() and z.std() > 0


def report_holds(pdf):
    r = pdf.iloc[0]
    cm, sizes = r["confusion_matrix"], r["dataset"]
    assert len(pdf) == 1 and r["thresholds"]["p95"] <= r["thresholds"]["p99"]
    assert cm["true_positives"] + cm["false_negatives"] == sizes["synthetic_anomalies"] == max(sizes["test_size"], 5)
    assert cm["false_positives"] + cm["true_negatives"] == sizes["test_size"]
    assert r["metrics"]["precision"] == pytest.approx(
        cm["true_positives"] / max(cm["true_positives"] + cm["false_positives"], 1))


#: Iterative training: no SQL, these properties instead.
PROPERTIES = {"training_history": history_holds, "autoencoder_scores": scores_hold,
              "autoencoder_latent": latent_holds, "evaluation_report": report_holds}


def test_every_query_has_an_oracle_or_properties():
    assert set(QUERIES) - set(ENTRY.oracle_sql()) == set(PROPERTIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    spark.conf.set(ZONE, "America/New_York")  # another user's session
    df = ENTRY.queries()[name](spark, SF001)
    assert spark.conf.get(ZONE) == "UTC"
    if name in PROPERTIES:
        PROPERTIES[name](df.toPandas() if name != "evaluation_report" else
                         __import__("pandas").DataFrame([r.asDict(recursive=True) for r in df.collect()]))
        return
    scols, srows = rows_of(df.toPandas())
    ocols, orows = rows_of(con.execute(ENTRY.oracle_sql()[name]).df())
    assert scols == ocols
    assert Counter(srows) == Counter(orows)
