"""Order-free sums of doubles, and the mean and deviation that follow from them.

A sum of doubles depends on the order of its terms in the last bits, and so on
partitions and retries. Here every value is cut, without any error, into
integer limbs on the grid of its exponent bin (32 binary exponents a bin), and
so is its square, given by two doubles, the rounded square and the rounding's error. Long
sums of limbs are exact and associative: the states of any partitions, runs or snapshots,
merged in any order, are equal. Only the last step turns the limbs back into pairs of
doubles, and adds a key's bins from the largest down.

All of it is column expressions, written as SQL text (one parse instead of hundreds of
calls); a state row is a key, a bin and a dozen numbers, and partial aggregation
collapses a hot key in each task. A limb has 30 bits, so a state counts up to 2**33 rows of
one key and bin.

Domain: values below 2**-448 count as zero. Beyond 2**511 the squares overflow and
the deviation is infinite. NaN and infinities give what Spark's own ``avg`` and
``stddev_samp`` give. The mean is the exact sum, rounded once, by the count; the deviation is
good to some 2**-100 of the mean square.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

#: Binary exponents in a bin, and the bins of the domain; squares are kept up to ``SQUARED``.
WIDTH, LOWEST, HIGHEST, SQUARED = 32, -14, 31, 15
#: Binary places of the limbs: of the value from a bin's lowest exponent, of the square from twice
#: that. 30 places apart.
VALUE_PLACES, SQUARE_PLACES = (2, -28, -58), (34, 4, -26, -56, -86, -116)
LIMBS = [f"s{i}" for i in range(len(VALUE_PLACES))] + [f"q{i}" for i in range(len(SQUARE_PLACES))]
STATE = ["bin", "n_rows", "n_values", *LIMBS, "low", "high"]
_SPLIT = "134217729D"  # 2**27 + 1: halves a double's digits


class _Layers:
    """Nested selects as one SQL text over a frame: analysed once, not select by select."""

    def __init__(self, df: DataFrame):
        self.df, self.sql = df, "{source}"

    def selectExpr(self, *exprs: str) -> "_Layers":
        return self._wrap(", ".join(exprs))

    def grouped(self, keys: Sequence[str], *exprs: str) -> "_Layers":
        return self._wrap(", ".join([*keys, *exprs]), f" GROUP BY {', '.join(keys)}" if keys else "")

    def _wrap(self, what: str, tail: str = "") -> "_Layers":
        source = self.sql if self.sql == "{source}" else f"({self.sql})"
        self.sql = f"SELECT {what} FROM {source}{tail}"
        return self

    def frame(self) -> DataFrame:
        return self.df.sparkSession.sql(self.sql, source=self.df)


def _power(exponent: int) -> str:
    return f"{2.0 ** exponent!r}D"


def _limb(x: str, place: int, first: bool) -> str:
    """The part of ``x`` that is rounded to ``place`` beyond what is rounded to the place before, as
    a whole number; both are doubles without error."""
    here = f"rint({x} * {_power(-place)})"
    return here if first else f"({here} - rint({x} * {_power(-place - 30)}) * {_power(30)})"


def states(df: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    """One row for each key and exponent bin: the columns ``STATE``, to be merged by
    :func:`merged` and read by :func:`statistics`. ``n_rows`` counts nulls, too."""
    k = [f"`{c}`" for c in keys]
    size = f"abs(_v) >= {_power(WIDTH * LOWEST)} AND abs(_v) < double('infinity')"   # NaN is above all
    rows = _Layers(df).selectExpr(*k, f"CAST(`{value}` AS DOUBLE) AS _v").selectExpr(*k, "_v", f"CASE WHEN {size} THEN _v ELSE 0D END AS _x")
    rows = rows.selectExpr(*k, "_v", "_x", "CASE WHEN _x = 0 THEN 0 ELSE CAST(greatest(%d, least(%d, floor(log2(abs(_x)) / %d))) AS INT) END AS bin"
                           % (LOWEST, HIGHEST, WIDTH))
    rows = rows.selectExpr(*k, "_v", "bin", f"_x * pow(2D, -{WIDTH} * bin) AS _s", f"CASE WHEN bin <= {SQUARED} THEN _x ELSE 0D END AS _y",
                           f"CASE WHEN bin <= {SQUARED} THEN pow(2D, -{2 * WIDTH} * bin) ELSE 0D END AS _u")
    rows = rows.selectExpr(*k, "_v", "bin", "_s", "_y", "_u", f"_y * {_SPLIT} - (_y * {_SPLIT} - _y) AS _t")
    rows = rows.selectExpr(*k, "_v", "bin", "_s", "_y * _y * _u AS _q",
                           "(((_t * _t - _y * _y) + 2D * _t * (_y - _t)) + (_y - _t) * (_y - _t)) * _u AS _e")
    cut = [_limb("_s", p, i == 0) for i, p in enumerate(VALUE_PLACES)]
    for i, p in enumerate(SQUARE_PLACES):
        parts = ([_limb("_q", p, i == 0)] if p >= -56 else []) + ([_limb("_e", p, i == 1)] if i else [])
        cut.append(" + ".join(parts))
    rows = rows.selectExpr(*k, "_v", "bin", *[f"CAST({c} AS BIGINT) AS {name}" for name, c in zip(LIMBS, cut)])
    return rows.grouped([*k, "bin"], "count(1) AS n_rows", "count(_v) AS n_values", *[f"sum({c}) AS {c}" for c in LIMBS],
                        "min(_v) AS low", "max(_v) AS high").frame()


def merged(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """States of several parts as those of the whole; the order does not matter."""
    return _Layers(parts).grouped([*[f"`{c}`" for c in keys], "bin"], *[f"sum({c}) AS {c}" for c in ("n_rows", "n_values", *LIMBS)],
                                  "min(low) AS low", "max(high) AS high").frame()


def _carried(name: str, n: int) -> list[str]:
    """The limbs, last first, with what exceeds 30 bits carried to the one before; the first takes all."""
    out, carry = [], "0L"
    for i in range(n - 1, -1, -1):
        whole = f"({name}{i} + {carry})"
        out.append(whole if i == 0 else f"({whole} & 1073741823L)")
        carry = f"shiftright({whole}, 30)"
    return out[::-1]


def _pairs(parts: DataFrame, kept: list[str]) -> _Layers:
    """The sum and the sum of squares of each state row as pairs of doubles: ``sh + sl``, ``qh + ql``."""
    s, q = _carried("s", 3), _carried("q", 6)
    # the first limb, then two limbs a number: 60 bits, of which a double takes 53
    whole = {"s0": s[0], "s1": f"{s[1]} * 1073741824L + {s[2]}", "q0": q[0], "q1": f"{q[1]} * 1073741824L + {q[2]}",
             "q2": f"{q[3]} * 1073741824L + {q[4]}", "q3": q[5]}
    g = _Layers(parts).selectExpr(*kept, "bin", *[f"{e} AS _{c}" for c, e in whole.items()])
    unit = {"s0": 2, "s1": -58, "q0": 34, "q1": -26, "q2": -86, "q3": -116}
    g = g.selectExpr(*kept, "bin", *[f"CAST(_{c} AS DOUBLE) * {_power(u)} AS {c}" for c, u in unit.items()],
                     *[f"CAST(_{c} - CAST(CAST(_{c} AS DOUBLE) AS BIGINT) AS DOUBLE) * {_power(unit[c])} AS {c}r" for c in ("s0", "s1", "q0", "q1", "q2")])
    g = g.selectExpr(*kept, "bin", "s0 + s1 AS s", f"{_missing('s0', 's1')} + (s0r + s1r) AS sr",
                     "q0 + q1 AS q", f"{_missing('q0', 'q1')} AS e", "q2", "(q0r + q1r) + (q2r + q3) AS qr")
    g = g.selectExpr(*kept, "bin", "s", "sr", "q + q2 AS q", f"(e + {_missing('q', 'q2')}) + qr AS qr")
    value, square = f"pow(2D, {WIDTH} * bin)", f"CASE WHEN bin <= {SQUARED} THEN pow(2D, {2 * WIDTH} * bin) ELSE 0D END"
    return g.selectExpr(*kept, "bin", f"(s + sr) * {value} AS sh", f"(sr - ((s + sr) - s)) * {value} AS sl",
                        f"(q + qr) * {square} AS qh", f"(qr - ((q + qr) - q)) * {square} AS ql")


def _missing(a: str, b: str) -> str:
    """What the rounded a + b lacks."""
    return f"(({a} - (({a} + {b}) - (({a} + {b}) - {a}))) + ({b} - (({a} + {b}) - {a})))"


def _product_error(a: str, b: str, ta: str, tb: str) -> str:
    """What the rounded a * b lacks, from the upper halves of both."""
    return f"((({ta} * {tb} - {a} * {b}) + {ta} * ({b} - {tb}) + ({a} - {ta}) * {tb}) + ({a} - {ta}) * ({b} - {tb}))"


def statistics(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys, ``n_rows``, ``n_values``, ``mean``, ``deviation`` (of the sample), ``low`` and ``high``.

    ``parts``: states, one row for each key and bin. The mean is null without values, the
    deviation for fewer than two; it is exactly zero where all are equal."""
    k = [f"`{c}`" for c in keys]
    rows = _pairs(parts, [*k, "n_rows", "n_values", "low", "high"])
    # a key has each bin once; most keys have one
    add = lambda h, l: (f"named_struct('h', (acc.h + x.{h}), 'l', acc.l + x.{l} + "
                        + _missing("acc.h", f"x.{h}") + ")")
    over = lambda h, l: (f"CASE WHEN size(bins) = 1 THEN named_struct('h', bins[0].{h}, 'l', bins[0].{l}) ELSE "  # noqa: E731
                         f"aggregate(bins, named_struct('h', 0D, 'l', 0D), (acc, x) -> {add(h, l)}) END")
    g = rows.grouped(k, "sum(n_rows) AS n_rows", "sum(n_values) AS n_values", "min(low) AS low", "max(high) AS high",
                     "sort_array(collect_list(struct(bin, sh, sl, qh, ql)), false) AS bins")
    kept = [*k, "n_rows", "n_values", "low", "high"]
    g = g.selectExpr(*kept, "CAST(n_values AS DOUBLE) AS n", "bins[0].bin AS top", f"{over('sh', 'sl')} AS s", f"{over('qh', 'ql')} AS q")
    kept += ["n", "top"]
    g = g.selectExpr(*kept, "s.h + s.l AS sh", "s.l - ((s.h + s.l) - s.h) AS sl", "q.h + q.l AS qh", "q.l - ((q.h + q.l) - q.h) AS ql")
    # n * (sum of squares) - (sum)**2, in pairs of doubles
    half = lambda x: f"{x} * {_SPLIT} - ({x} * {_SPLIT} - {x})"
    g = g.selectExpr(*kept, "sh", "sl", "qh", "ql", f"{half('sh')} AS st", f"{half('qh')} AS qt", f"{half('n')} AS nt")
    g = g.selectExpr(*kept, "sh", "n * qh AS a", "sh * sh AS b",
                     f"({_product_error('n', 'qh', 'nt', 'qt')} + n * ql) - ({_product_error('sh', 'sh', 'st', 'st')} + 2D * sh * sl) AS r")
    spread = f"greatest(0D, (a - b) + (((a - ((a - b) - ((a - b) - a))) + (-b - ((a - b) - a))) + r))"
    inf = "double('infinity')"
    return g.selectExpr(
        *k, "n_rows", "n_values",
        f"CASE WHEN n_values = 0 THEN NULL WHEN isnan(high) OR (high = {inf} AND low = -{inf}) THEN double('NaN') "
        f"WHEN high = {inf} OR low = -{inf} THEN CASE WHEN high = {inf} THEN high ELSE low END ELSE sh / n END AS mean",
        f"CASE WHEN n_values < 2 THEN NULL WHEN isnan(high) OR high = {inf} OR low = -{inf} THEN double('NaN') WHEN low = high THEN 0D "
        f"WHEN top > {SQUARED} THEN {inf} ELSE nanvl(sqrt({spread} / (n * (n - 1))), {inf}) END AS deviation",
        "low", "high").frame()
