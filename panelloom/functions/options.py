"""European option prices."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Hart's rational approximation of the normal tail, from the highest power down.
UPPER = (0.0352624965998911, 0.700383064443688, 6.37396220353165, 33.912866078383, 112.079291497871, 221.213596169931, 220.206867912376)
LOWER = (0.0883883476483184, 1.75566716318264, 16.064177579207, 86.7807322029461, 296.564248779674, 637.333633378831, 793.826512519948,
         440.413735824752)
FAR = 7.07106781186547  # beyond it a continued fraction is used
ROOT_TWO_PI = 2.506628274631


def normal_cdf(x: Column) -> Column:
    """Standard normal distribution function to about 1e-15, as column arithmetic; Spark has no erf of its own."""
    a = F.abs(x)

    def polynomial(values: tuple[float, ...]) -> Column:
        return reduce(lambda total, c: total * a + c, values[1:], F.lit(values[0]))

    fraction = reduce(lambda rest, k: a + k / rest, (F.lit(4.0), F.lit(3.0), F.lit(2.0), F.lit(1.0)), a + 0.65)
    tail = F.exp(-a * a / 2) * F.when(a < FAR, polynomial(UPPER) / polynomial(LOWER)).otherwise(1 / (fraction * ROOT_TWO_PI))
    return F.when(x > 0, 1 - tail).otherwise(tail)


def option_price(rate: Column, spot: Column, strike: Column, years: Column, vol: Column, kind: Column) -> Column:
    """Price of a European call ("C") or put ("P") to 3 decimals; maturity is in years."""
    sd = vol * F.sqrt(years)
    d1 = (F.log(spot / strike) + (rate + vol * vol / 2) * years) / sd
    # a put mirrors a call: both signs flip
    sign = F.when(kind == "C", 1.0).when(kind == "P", -1.0)
    value = sign * (spot * normal_cdf(sign * d1) - strike * F.exp(-rate * years) * normal_cdf(sign * (d1 - sd)))
    return F.round(value, 3)


def option_chain(underlyings: DataFrame, *, rate: float, vol: float, moneyness: list[float], years: list[float]) -> DataFrame:
    """Price every listed option of each underlying (series, spot)."""
    chain = (
        underlyings.withColumn("m", F.explode(F.array(*[F.lit(float(m)) for m in moneyness])))
        .withColumn("years", F.explode(F.array(*[F.lit(float(t)) for t in years])))
        .withColumn("kind", F.explode(F.array(F.lit("C"), F.lit("P"))))
        .withColumn("strike", F.col("spot") * F.col("m"))
    )
    price = option_price(F.lit(rate), F.col("spot"), F.col("strike"), F.col("years"), F.lit(vol), F.col("kind"))
    return chain.withColumn("price", price).drop("m")
