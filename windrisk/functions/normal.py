"""Quantile of the standard normal distribution as a column expression."""

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The coefficients of the published rational approximations AS 241 (16 digits), highest power first.
CENTRAL = ([2509.0809287301226727, 33430.575583588128105, 67265.770927008700853, 45921.953931549871457,
            13731.693765509461125, 1971.5909503065514427, 133.14166789178437745, 3.3871328727963666080],
           [5226.4952788528545610, 28729.085735721942674, 39307.895800092710610, 21213.794301586595867,
            5394.1960214247511077, 687.18700749205790830, 42.313330701600911252, 1.0])
MIDDLE = ([7.74545014278341407640e-4, 2.27238449892691845833e-2, 0.241780725177450611770, 1.27045825245236838258,
           3.64784832476320460504, 5.76949722146069140550, 4.63033784615654529590, 1.42343711074968357734],
          [1.05075007164441684324e-9, 5.47593808499534494600e-4, 1.51986665636164571966e-2, 0.148103976427480074590,
           0.689767334985100004550, 1.67638483018380384940, 2.05319162663775882187, 1.0])
FAR = ([2.01033439929228813265e-7, 2.71155556874348757815e-5, 1.24266094738807843860e-3, 2.65321895265761230930e-2,
        0.296560571828504891230, 1.78482653991729133580, 5.46378491116411436990, 6.65790464350110377720],
       [2.04426310338993978564e-15, 1.42151175831644588870e-7, 1.84631831751005468180e-5, 7.86869131145613259100e-4,
        1.48753612908506148525e-2, 0.136929880922735805310, 0.599832206555887937690, 1.0])


def _polynomial(choices: Sequence[Sequence[float]], region: Column, x: Column) -> Column:
    """The polynomial of the region; the choices have equal degrees."""
    value, *rest = [F.get(F.array(*map(F.lit, coefficients)), region) for coefficients in zip(*choices)]
    for coefficient in rest:
        value = value * x + coefficient
    return value


def normal_quantile(p: Column) -> Column:
    """The z with P(Z <= z) = p; NULL outside of (0, 1).

    One ratio with the coefficients of the region, not one ratio per region: code for all of them is too long for the JVM to compile.
    """
    q = p - F.lit(0.5)
    tail = F.sqrt(-F.log(F.least(p, F.lit(1.0) - p)))
    central = F.abs(q) <= 0.425
    region = F.when(central, F.lit(0)).when(tail <= 5.0, F.lit(1)).otherwise(F.lit(2))
    x = F.when(central, F.lit(0.180625) - q * q).when(tail <= 5.0, tail - 1.6).otherwise(tail - 5.0)
    numerators, denominators = zip(CENTRAL, MIDDLE, FAR)
    ratio = _polynomial(numerators, region, x) / _polynomial(denominators, region, x)
    # Not the ratio is conditional but its factor, q or the sign of q: what only some rows need is not shared by the generated code.
    return ratio * F.when((p > 0.0) & (p < 1.0), F.when(central, q).when(q < 0, F.lit(-1.0)).otherwise(F.lit(1.0)))
