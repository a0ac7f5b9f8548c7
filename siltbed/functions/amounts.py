"""Whole amounts beyond 38 digits, as limbs.

An amount of at most 78 digits (256 bits) is kept as text of digits and computed with as ``LIMBS`` numbers of
nine digits each, the lowest first. Limbs are added apart, as BIGINT, which holds 9 * 10**9 amounts of one
group and raises beyond; carrying is done once, on sums. So sums are exact, and what one side gains the other
loses to the last digit.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LIMBS, LIMB_DIGITS, MOST_DIGITS = 9, 9, 78
BASE = 10**LIMB_DIGITS
NAMES = [f"limb{i}" for i in range(LIMBS)]


def canonical(text: Column) -> Column:
    """Digits without leading zeros; NULL for what is no whole number of at most 78 digits."""
    trimmed = F.trim(text)
    return F.when(trimmed.rlike(f"^0*[0-9]{{1,{MOST_DIGITS}}}$"), F.regexp_replace(trimmed, "^0+(?=[0-9])", ""))


def limbs(digits: Column) -> list[Column]:
    """The limbs of canonical digits, named as ``NAMES``. Most amounts are short and are cut as numbers."""
    short = F.when(F.length(digits) <= 2 * LIMB_DIGITS, digits).cast("bigint")
    padded = F.lpad(digits, LIMBS * LIMB_DIGITS, "0")
    low = [short % BASE, F.floor(short / F.lit(BASE).cast("DECIMAL(10,0)")).cast("bigint")]
    out = []
    for i, name in enumerate(NAMES):
        cut = F.substring(padded, (LIMBS - 1 - i) * LIMB_DIGITS + 1, LIMB_DIGITS).cast("bigint")
        quick = low[i] if i < 2 else F.lit(0).cast("bigint")
        out.append(F.when(F.length(digits) <= 2 * LIMB_DIGITS, quick).otherwise(cut).alias(name))
    return out


def _carried(sums: Sequence[Column]) -> Column:
    """(carry, low): limbs brought below the base, and what is left above the highest."""
    start = F.struct(F.lit(0).cast("bigint").alias("carry"), F.array().cast("array<bigint>").alias("low"))

    def step(state: Column, limb: Column) -> Column:
        total = state["carry"] + limb
        rest = F.pmod(total, F.lit(BASE).cast("bigint"))
        above = F.floor((total - rest) / F.lit(BASE)).cast("bigint")
        return F.struct(above.alias("carry"), F.concat(state["low"], F.array(rest)).alias("low"))

    return F.aggregate(F.array(*sums), start, step)


def _spelled(sums: Sequence[Column]) -> Column:
    signed = F.struct(_carried(sums).alias("plain"), _carried([-s for s in sums]).alias("turned"))

    def digits_of(both: Column) -> Column:
        below = both["plain"]["carry"] < 0
        state = F.when(below, both["turned"]).otherwise(both["plain"])
        high = F.concat(F.array(state["carry"]), F.reverse(state["low"]))
        digits = F.array_join(F.transform(high, lambda x: F.lpad(x.cast("string"), LIMB_DIGITS, "0")), "")
        return F.concat(F.when(below, "-").otherwise(""), F.regexp_replace(digits, "^0+(?=[0-9])", ""))

    # One element, so that both carries are computed once each.
    return F.transform(F.array(signed), digits_of)[0]


def _cases(sums: Sequence[Column]) -> tuple[Column, Column, Column, Column, Column]:
    """Whether all limbs are known, whether BIGINT or DECIMAL(38,0) surely hold the sum, and it as either."""
    known = sums[0].isNotNull()
    two = four = F.abs(sums[0]) < BASE
    for i, s in enumerate(sums[1:], 1):
        known = known & s.isNotNull()
        two = two & (s == 0 if i >= 2 else F.abs(s) < 9 * BASE - 9)
        four = four & (s == 0 if i >= 4 else F.abs(s) < BASE)
    short, scale = sums[0] + sums[1] * BASE, F.lit(str(BASE * BASE)).cast("DECIMAL(19,0)")
    above = (sums[2] + sums[3] * BASE).cast("DECIMAL(19,0)") * scale
    middle = (short.cast("DECIMAL(19,0)") + above.cast("DECIMAL(38,0)")).cast("DECIMAL(38,0)")
    return known, two, four, short, middle


def text(sums: Sequence[Column]) -> Column:
    """The decimal digits of summed limbs, with a minus sign below zero; NULL if a limb is.

    Sums that BIGINT or DECIMAL(38,0) surely hold need no carrying limb by limb."""
    known, two, four, short, middle = _cases(sums)
    return F.when(known, F.when(two, short.cast("string")).when(four, middle.cast("string")).otherwise(_spelled(sums)))


def number(sums: Sequence[Column]) -> Column:
    """Summed limbs as DECIMAL(38,0), NULL beyond 38 digits."""
    known, two, four, short, middle = _cases(sums)
    return F.when(known, F.when(two, short.cast("DECIMAL(38,0)")).when(four, middle).otherwise(decimal(_spelled(sums))))


def totals(rows: DataFrame, limbs: Sequence[str], name: str) -> DataFrame:
    """``rows`` with ``number`` and ``text`` of the summed limbs in place of these columns, as ``name`` and
    ``<name>_digits``.

    Three limbs at a time are one DECIMAL(38,0), whatever BIGINTs they are. Steps are projections: each is
    computed once, and all of them make a method short enough for the JVM to compile.
    """
    sums, others = [F.col(n) for n in limbs], [c for c in rows.columns if c not in limbs]
    lit = lambda x, p: F.lit(str(x)).cast(f"DECIMAL({p},0)")
    wide = lambda x: x.cast("DECIMAL(38,0)")
    group = BASE**3
    three = lambda i: wide(wide(sums[i] + sums[i + 1] * lit(BASE, 10)) + sums[i + 2] * lit(BASE**2, 19))
    above = lambda x: F.call_function("div", x, lit(group, 28))
    rest = lambda x: x % lit(group, 28)
    known, two, four, short, middle = _cases(sums)
    case = F.when(~known, 0).when(two, 1).when(four, 2).otherwise(3)
    out = rows.withColumn("_case", case)
    long = lambda x: F.when(F.col("_case") == 3, x)
    out = out.withColumns({"_a": long(three(0)), "_b": long(three(3)), "_c": long(three(6))})
    out = out.withColumns({"_b": wide(F.col("_b") + above(F.col("_a"))), "_a": rest(F.col("_a"))})
    out = out.withColumns({"_c": wide(F.col("_c") + above(F.col("_b"))), "_b": rest(F.col("_b"))})
    # Division cuts towards zero, so parts may differ in sign; the highest that is not zero has the amount's.
    below = F.when(F.col("_c") != 0, F.col("_c") < 0).when(F.col("_b") != 0, F.col("_b") < 0).otherwise(F.col("_a") < 0)
    out = out.withColumn("_below", below)
    # Unary minus would round a DECIMAL to 34 digits; a difference is exact.
    out = out.withColumns({p: F.when(F.col("_below"), wide(lit(0, 1) - F.col(p))).otherwise(F.col(p)) for p in ("_a", "_b", "_c")})
    out = out.withColumn("_b", wide(F.col("_b") - (F.col("_a") < 0).cast("int")))
    out = out.withColumn("_c", wide(F.col("_c") - (F.col("_b") < 0).cast("int")))
    low = [F.lpad(F.pmod(F.col(p), lit(group, 28)).cast("string"), 3 * LIMB_DIGITS, "0") for p in ("_b", "_a")]
    digits = F.regexp_replace(F.concat(F.col("_c").cast("string"), *low), "^0+(?=[0-9])", "")
    out = out.withColumn("_long", F.concat(F.when(F.col("_below"), "-").otherwise(""), digits))
    pick = lambda *x: F.when(F.col("_case") == 1, x[0]).when(F.col("_case") == 2, x[1]).when(F.col("_case") == 3, x[2])
    number_ = pick(short.cast("DECIMAL(38,0)"), middle, decimal(F.col("_long")))
    text_ = pick(short.cast("string"), middle.cast("string"), F.col("_long"))
    return out.select(*others, number_.alias(name), text_.alias(f"{name}_digits"))


def parts(digits: Column, low: int = 18) -> tuple[Column, Column]:
    """(whole, rest) of signed digits: all but the last ``low`` of them, and those, both with the sign. The
    whole is NULL beyond 38 digits."""
    sign = F.when(digits.startswith("-"), F.lit(-1)).otherwise(F.lit(1))
    size = F.regexp_replace(digits, "^-", "")
    above = F.when(F.length(size) > low, F.substring(size, F.lit(1), F.length(size) - low)).otherwise("0")
    whole = F.when(F.length(above) <= 38, above.cast("DECIMAL(38,0)")) * sign.cast("DECIMAL(1,0)")
    rest = F.right(size, F.lit(low)).cast("DECIMAL(18,0)") * sign.cast("DECIMAL(1,0)")
    return whole.cast("DECIMAL(38,0)"), rest.cast("DECIMAL(18,0)")


def decimal(digits: Column) -> Column:
    """Signed digits as DECIMAL(38,0), NULL beyond 38 of them."""
    return F.when(F.length(F.regexp_replace(digits, "^-", "")) <= 38, digits.cast("DECIMAL(38,0)"))
