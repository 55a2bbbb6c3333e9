"""Null-safe arithmetic that behaves the same with ANSI mode on or off."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def div(a: Column, b: Column) -> Column:
    """a / b, null when b is zero or null (no ANSI divide-by-zero error)."""
    return F.when(b != 0, a / b)


def sqrt_pos(a: Column) -> Column:
    return F.when(a >= 0, F.sqrt(a))


def ln_pos(a: Column) -> Column:
    return F.when(a > 0, F.log(a))


def same_keys(a: DataFrame, b: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """``a`` joined with ``b`` on ``keys``, a null key being a key like any
    other; without keys ``b`` is a one-row frame."""
    if not keys:
        return a.crossJoin(F.broadcast(b))
    r = b.select(*[F.col(k).alias(f"_same_{i}") for i, k in enumerate(keys)], *[c for c in b.columns if c not in keys])
    cond = [a[k].eqNullSafe(r[f"_same_{i}"]) for i, k in enumerate(keys)]
    return a.join(r, cond, how).drop(*[f"_same_{i}" for i in range(len(keys))])


# Hart's rational approximation of the normal tail (double precision).
_HART_NUM = (0.0352624965998911, 0.700383064443688, 6.37396220353165, 33.912866078383, 112.079291497871, 221.213596169931,
             220.206867912376)
_HART_DEN = (0.0883883476483184, 1.75566716318264, 16.064177579207, 86.7807322029461, 296.564248779674, 637.333633378831,
             793.826512519948, 440.413735824752)


def norm_cdf(z: Column) -> Column:
    """Standard normal CDF as a column expression (absolute error below 1e-14)."""
    x = F.abs(z)

    def poly(coefs):
        e = F.lit(coefs[0])
        for c in coefs[1:]:
            e = e * x + F.lit(c)
        return e
    build = x
    for k in (0.65, 4.0, 3.0, 2.0, 1.0):
        build = x + (F.lit(k) if k == 0.65 else F.lit(k) / build)
    bell = F.exp(-x * x / 2.0)
    tail = F.when(x > 37, F.lit(0.0)).when(x < 7.07106781186547, bell * poly(_HART_NUM) / poly(_HART_DEN)).otherwise(
        bell / build / 2.506628274631)
    return F.when(z > 0, 1.0 - tail).otherwise(tail)
