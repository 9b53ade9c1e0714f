"""Feature transform: value to its quantile in the training data, then to a standard normal value."""

from __future__ import annotations

from functools import reduce

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citypulse.operators import ranks

MAX_KNOTS = 1000
# Fixed value: quantiles are kept this far from 0 and 1, so the ends map to about -5.2 and 5.2.
TAIL = 1e-7

# Rational approximation of the inverse normal distribution (relative error 1.2e-9),
# centre numerator and denominator, tail numerator and denominator, and where the tail begins.
_CENTRE_TOP = [
    -3.969683028665376e01, 2.209460984245205e02, -2.759285104469687e02,
    1.383577518672690e02, -3.066479806614716e01, 2.506628277459239e00,
]
_CENTRE_BOTTOM = [
    -5.447609879822406e01, 1.615858368580409e02, -1.556989798598866e02,
    6.680131188771972e01, -1.328068155288572e01, 1.0,
]
_TAIL_TOP = [
    -7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e00,
    -2.549732539343734e00, 4.374664141464968e00, 2.938163982698783e00,
]
_TAIL_BOTTOM = [7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e00, 3.754408661907416e00, 1.0]
_TAIL_FROM = 0.02425


def _polynomial(coefficients: list[float], x: Column) -> Column:
    return reduce(lambda total, c: total * x + F.lit(c), coefficients[1:], F.lit(coefficients[0]))


def inverse_normal(p: Column) -> Column:
    """Standard normal value below which a share ``p`` of the distribution lies."""

    def tail(q: Column) -> Column:
        r = F.sqrt(F.lit(-2.0) * F.log(q))
        return _polynomial(_TAIL_TOP, r) / _polynomial(_TAIL_BOTTOM, r)

    d = p - F.lit(0.5)
    centre = _polynomial(_CENTRE_TOP, d * d) * d / _polynomial(_CENTRE_BOTTOM, d * d)
    return F.when(p < _TAIL_FROM, tail(p)).when(p > 1 - _TAIL_FROM, -tail(F.lit(1.0) - p)).otherwise(centre)


def share_below(x: Column, knots: list[float]) -> Column:
    """Place of ``x`` among equally spaced quantiles, 0 to 1; the middle of a run of equal ones.

    Two binary searches, each a fold over the powers of two below the number of knots.
    """
    count = len(knots)
    if count == 1:
        return F.when(x < knots[0], 0.0).when(x > knots[0], 1.0).otherwise(0.5)
    # One text constant, folded to an array when the plan is optimised: a thousand literals would slow planning.
    array = F.split(F.lit(",".join(repr(float(k)) for k in knots)), ",").cast("array<double>")
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(count.bit_length()))])

    def search(before) -> Column:
        """Number of knots for which ``before(knot)`` holds."""

        def step(found: Column, size: Column) -> Column:
            last = F.get(array, found + size - 1)
            return F.when(F.coalesce(before(last), F.lit(False)), found + size).otherwise(found)

        return F.aggregate(steps, F.lit(0), step)

    def place(pair: Column) -> Column:
        under, upto = pair["under"], pair["upto"]
        last = F.lit(float(count - 1))
        low, high = F.get(array, upto - 1), F.get(array, upto)
        on_knots = (under + upto - 1) / F.lit(2.0) / last
        between = (upto - 1 + (x - low) / (high - low)) / last
        return (
            F.when((x <= knots[0]), 0.0).when(x >= knots[-1], 1.0).when(upto > under, on_knots).otherwise(between)
        )

    counts = F.struct(search(lambda k: k < x).alias("under"), search(lambda k: k <= x).alias("upto"))
    return F.transform(F.array(counts), place)[0]


def normal_score(x: Column, knots: list[float]) -> Column:
    share = F.transform(
        F.array(share_below(x, knots)),
        lambda p: inverse_normal(F.least(F.greatest(p, F.lit(TAIL)), F.lit(1.0 - TAIL))),
    )[0]
    return F.when(x.isNotNull(), share)


class _QuantileParams(Params):
    inputCols = Param(Params._dummy(), "inputCols", "columns to transform", TypeConverters.toListString)
    outputCols = Param(Params._dummy(), "outputCols", "result columns", TypeConverters.toListString)
    maxKnots = Param(Params._dummy(), "maxKnots", "largest number of quantiles kept", TypeConverters.toInt)


class QuantileToNormal(Estimator, _QuantileParams, DefaultParamsReadable, DefaultParamsWritable):
    """Learns quantiles of columns; see :class:`QuantileToNormalModel`."""

    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None, outputCols: list[str] | None = None, maxKnots: int = MAX_KNOTS):
        super().__init__()
        self._setDefault(maxKnots=MAX_KNOTS)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> QuantileToNormalModel:
        names = self.getOrDefault(self.inputCols)
        known = ranks.sizes(dataset, names)
        counts = {n: max(min(self.getOrDefault(self.maxKnots), known[n]), 1) for n in names}
        # At most maxKnots exact quantiles a column, whatever the data size.
        quantiles = ranks.quantiles(dataset, counts)
        if any(not quantiles[n] for n in names):
            raise ValueError("a column without values has no quantiles")
        model = QuantileToNormalModel()
        model._set(inputCols=names, outputCols=self.getOrDefault(self.outputCols))
        model._set(knots=[list(quantiles[n]) for n in names])
        return model


class QuantileToNormalModel(Model, _QuantileParams, DefaultParamsReadable, DefaultParamsWritable):
    """Adds a normal score per column, as column arithmetic (no Python on the executors)."""

    knots = Param(Params._dummy(), "knots", "quantiles per input column")

    def _transform(self, dataset: DataFrame) -> DataFrame:
        pairs = zip(
            self.getOrDefault(self.inputCols), self.getOrDefault(self.outputCols), self.getOrDefault(self.knots)
        )
        return dataset.withColumns({out: normal_score(F.col(n).cast("double"), k) for n, out, k in pairs})
