"""Exact decimal digits of doubles, as Spark expressions.

A double is m * 2^e with whole m.  For e >= 0 its value is a whole number; for e < 0 it is
m * 5^(-e) over a power of ten.  Either way its decimal expansion is the whole number's
digits, found here by multiplying an array of nine-digit limbs by powers of 2 or 5 with
carry.  From all digits, any number of significant digits follows by exact rounding,
ties to even, which is what C's ``%.Ng`` prints.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LIMB = 10**9


def double_bits(x: Column) -> Column:
    """The 64 bits of a double as a long."""
    return F.reflect(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), x).cast("long")


def bits_double(bits: Column) -> Column:
    return F.reflect(F.lit("java.lang.Double"), F.lit("longBitsToDouble"), bits).cast("double")


def let(value: Column, body) -> Column:
    """``body`` of a value worked out once, however often ``body`` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _times(limbs: Column, factor: Column) -> Column:
    """``limbs`` (least first) times ``factor`` < 10^9, with carry."""
    start = F.struct(F.array().cast("array<bigint>").alias("done"), F.lit(0).cast("bigint").alias("carry"))
    def step(acc: Column, limb: Column) -> Column:
        return let(limb * factor + acc["carry"], lambda v: F.struct(
            F.concat(acc["done"], F.array(v % LIMB)).alias("done"), F.floor(v / F.lit(LIMB).cast("decimal(20,0)")).cast("bigint").alias("carry")))

    return F.aggregate(limbs, start, step, lambda acc: F.when(acc["carry"] > 0, F.concat(acc["done"], F.array(acc["carry"]))).otherwise(acc["done"]))


def _power_product(whole: Column, base: int, chunk: int, power: Column) -> Column:
    """Limbs of ``whole * base^power``; ``base^chunk`` stays below 10^9."""
    start = F.array(whole % LIMB, F.floor(whole / F.lit(LIMB).cast("decimal(20,0)")).cast("bigint"))
    rest = (power % chunk).cast("int")
    tail = F.element_at(F.array(*[F.lit(base**k).cast("bigint") for k in range(chunk)]), rest + 1)
    big = (power / chunk).cast("int")
    steps = F.concat(F.array(tail), F.array_repeat(F.lit(base**chunk).cast("bigint"), big))
    return F.aggregate(steps, start, _times)


def exact_digits(x: Column) -> Column:
    """struct(d, e): all decimal digits of |x| without leading zeros, and the power of ten of the first; '0' for zero."""
    bits = double_bits(F.abs(x))
    field = F.shiftright(bits, 52)
    mantissa = bits.bitwiseAND(F.lit((1 << 52) - 1))
    m = F.when(field > 0, mantissa + F.lit(1 << 52)).otherwise(mantissa)
    power = F.greatest(field, F.lit(1)) - 1075

    def text(v: Column) -> Column:
        limbs = F.when(v["p"] >= 0, _power_product(v["m"], 2, 29, v["p"])).otherwise(_power_product(v["m"], 5, 12, -v["p"]))
        joined = F.array_join(F.transform(F.reverse(limbs), lambda k: F.lpad(k.cast("string"), 9, "0")), "")
        return let(F.regexp_replace(joined, "^0+(?=.)", ""), lambda d: F.struct(
            d.alias("d"), (F.length(d) - 1 + F.least(v["p"], F.lit(0))).cast("int").alias("e")))

    return let(F.struct(m.alias("m"), power.alias("p")), text)


def round_digits(all_digits: Column, digits: Column) -> Column:
    """struct(n, e): the number of ``digits`` digits nearest to the expansion, ties to even, and the power of ten of its first digit."""
    def cut(v: Column) -> Column:
        head = F.rpad(F.substring(v["d"], F.lit(1), digits), digits, "0").cast("bigint")
        rest = F.substring(v["d"], digits + 1, F.length(v["d"]))
        tie = F.regexp_like(rest, F.lit("^50*$"))
        up = F.when(tie, head % 2 == 1).otherwise(F.coalesce(F.substring(rest, F.lit(1), F.lit(1)) >= "5", F.lit(False)))
        n = head + F.when(up, 1).otherwise(0)
        return let(n, lambda r: F.when(F.length(r.cast("string")) > digits, F.struct((r / 10).cast("bigint").alias("n"), (v["e"] + 1).alias("e")))
                   .otherwise(F.struct(r.alias("n"), v["e"].alias("e"))))

    return let(all_digits, cut)
