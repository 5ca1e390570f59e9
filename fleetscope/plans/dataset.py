"""load -> pivot -> impute -> scale -> split, as one lazy composition.

Stages are built on first use and then reused, so a caller asking for the
pivot alone never runs the fits (means, min/max, row count) of later stages.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetscope.operators import features as FT
from fleetscope.schema import METRICS
from fleetscope.session import written


class Prepared:
    """Compose F1-F10 over clean events.

    ``fit_on="all"`` keeps the reference behaviour (scaler fitted on every row
    before the split, a leak, and likewise the imputation means);
    ``fit_on="train"`` fits both on the training part only. A given ``scaler`` (F8) is applied as is. ``min_rows`` raises when
    fewer vectors exist (F6) -- an early ``limit(n).count()``, not a full count.
    What several fits read -- the pivot, the split -- is written once to the shared folder
    (bounded by the number of windows x keys, not by the event volume), and nothing is
    cached, so a dropped query leaves no memory behind. All default fits
    (imputation means, scaler min/max, the vector count) come from one job.
    """

    def __init__(self, clean: DataFrame, snapshot_id: int | None = None,
                 grain: str = "1 minute", keys: tuple[str, ...] = (),
                 fit_on: str = "all", scaler: DataFrame | None = None,
                 min_rows: int | None = None):
        self.clean, self.snapshot_id, self.grain = clean, snapshot_id, grain
        self.keys, self.fit_on, self._scaler, self.min_rows = tuple(keys), fit_on, scaler, min_rows

    @cached_property
    def events(self) -> DataFrame:
        return FT.load_events(self.clean, self.snapshot_id)

    @cached_property
    def pivoted(self) -> DataFrame:
        return FT.pivot_metrics(self.events, self.grain, self.keys)

    @cached_property
    def _kept(self) -> DataFrame:
        """The pivot, written for the fits and all that follows them."""
        return written(self.pivoted, "pivot")

    @cached_property
    def ordered(self) -> DataFrame:
        """The pivot with positions and split (its row count does not change later)."""
        return FT.chronological_split(self.pivoted, self.keys)

    @cached_property
    def stats(self) -> dict:
        """Means, min/max and the vector count from one job over the pivot; with
        ``fit_on="train"`` means and min/max of its training part only."""
        if self.fit_on == "train":
            fitted = FT.pivot_stats(self.ordered.where(F.col("split") == "train"))
            return fitted | {"n": self.ordered.count()}
        return FT.pivot_stats(self._kept)

    @property
    def n(self) -> int:
        return self.stats["n"]

    def size_of(self, part: str) -> int:
        """Rows in a split part, known from n without another job."""
        t_end, v_end = FT.split_bounds(self.n)
        return {"train": t_end, "val": v_end - t_end, "test": self.n - v_end}[part]

    @cached_property
    def features(self) -> DataFrame:
        f = FT.impute(self.ordered if self.fit_on == "train" else self._kept, means=self.stats["means"])
        if self.min_rows is not None:
            have = f.limit(self.min_rows).count()
            if have < self.min_rows:
                raise ValueError(f"Only {have} complete feature vectors after pivoting; "
                                 f"need at least {self.min_rows}")
        return f

    @cached_property
    def scaler(self) -> DataFrame:
        if self._scaler is not None:
            return self._scaler
        f = self.features
        return FT.fit_scaler(f.where(F.col("split") == "train") if self.fit_on == "train" else f)

    @cached_property
    def normalized(self) -> DataFrame:
        if self._scaler is None:
            return FT.apply_scaler(self.features, params=self.stats["scaler"])
        return FT.apply_scaler(self.features, self.scaler)

    @cached_property
    def split(self) -> DataFrame:
        # The positions come from a checkpoint: what reads the split again starts there.
        if self.fit_on == "train":
            return self.normalized
        return FT.chronological_split(self.normalized, self.keys, n=self.n)

    def part(self, name: str) -> DataFrame:
        return self.split.where(F.col("split") == name)

    def sizes(self) -> DataFrame:
        return FT.split_sizes(self.split)


def prepare(clean: DataFrame, **kw) -> Prepared:
    return Prepared(clean, **kw)

