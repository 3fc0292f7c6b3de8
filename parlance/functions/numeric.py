"""Distribution functions Spark SQL lacks.

The normal distribution is a Column expression, as it is applied to every distinct value
of a sample.
"""
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def normal_cdf(z: Column) -> Column:
    """Standard normal distribution function, by Hart's rational approximation."""
    x = F.abs(z)
    density = F.exp(-x * x / 2)
    # Coefficients of the approximation, highest power first.
    above = [3.52624965998911e-02, 0.700383064443688, 6.37396220353165, 33.912866078383,
             112.079291497871, 221.213596169931, 220.206867912376]
    below = [8.83883476483184e-02, 1.75566716318264, 16.064177579207, 86.7807322029461,
             296.564248779674, 637.333633378831, 793.826512519948, 440.413735824752]

    def polynomial(coefficients):
        return reduce(lambda sum_, c: sum_ * x + F.lit(c), coefficients[1:], F.lit(coefficients[0]))

    fraction = reduce(lambda f, k: x + F.lit(float(k)) / f, [4, 3, 2, 1], x + 0.65)
    tail = F.when(x > 37, F.lit(0.0)).when(
        x < 7.07106781186547, density * polynomial(above) / polynomial(below)
    ).otherwise(density / fraction / F.lit(2.506628274631))
    return F.when(z > 0, 1 - tail).otherwise(tail)
