"""Numbers as they are written: exact decimals of any size, as (minus, digits, exponent)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

FORM = r"^([-+]?)([0-9]+)(?:\.([0-9]*))?(?:[eE]([-+]?[0-9]+))?$"
LIMB = 9  # digits that are added at once
MOST_DIGITS = 5_000  # of a difference; what would need more is null


def let(value: Column, use) -> Column:
    """use(value), with value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _shortened(minus: Column, digits: Column, exponent: Column) -> Column:
    """(minus, digits, exponent) without outer zeros; zero has no digits, no sign and exponent 0."""

    def cut(d: Column) -> Column:
        short = F.rtrim(d, F.lit("0"))
        power = F.try_add(exponent, (F.length(d) - F.length(short)).cast("long"))
        zero = d == ""
        return F.struct((minus & ~zero).alias("minus"), short.alias("digits"), F.when(zero, F.lit(0).cast("long")).otherwise(power).alias("exponent"))

    return let(F.ltrim(digits, F.lit("0")), cut)


def decimal(text: Column) -> Column:
    """A written number (commas are left out) as a decimal; null if it is none."""

    def read(t: Column) -> Column:
        part = lambda k: F.regexp_extract(t, FORM, k)
        raw = F.struct(part(1).alias("sign"), part(2).alias("whole"), part(3).alias("fraction"), part(4).alias("power"))
        power = lambda r: F.coalesce(F.nullif(r["power"], F.lit("")), F.lit("0")).try_cast("long")
        whole = lambda r: _shortened(r["sign"] == "-", F.concat(r["whole"], r["fraction"]), F.try_subtract(power(r), F.length(r["fraction"]).cast("long")))
        return F.when(t.rlike(FORM), let(raw, whole))

    return let(F.replace(F.trim(text), F.lit(","), F.lit("")), read)


def key(number: Column) -> Column:
    """A decimal in one form, so that equal numbers have equal keys."""
    return F.when(number["digits"] == "", "0").otherwise(
        F.concat(F.when(number["minus"], "-").otherwise(""), number["digits"], F.lit("e"), number["exponent"].cast("string")))


def number_key(text: Column) -> Column:
    """The key of a written number; null if it is none."""
    return let(decimal(text), key)


def forms(key: Column) -> Column:
    """Some texts whose `number_key` this is: as plain decimals of up to four places, and as a double shows it."""
    texts = F.array(*[key.try_cast(t).cast("string") for t in (*[f"decimal(38,{k})" for k in range(5)], "double")])
    return F.filter(F.array_distinct(texts), lambda t: F.coalesce(number_key(t) == key, F.lit(False)))


def as_double(number: Column) -> Column:
    """The double nearest to a decimal."""
    sign = F.when(number["minus"], "-").otherwise("")
    return F.concat(sign, F.when(number["digits"] == "", "0").otherwise(number["digits"]), F.lit("E"), number["exponent"].cast("string")).try_cast("double")


def difference(a: Column, b: Column) -> Column:
    """a - b of two decimals, exactly; null if either is, or if it would have more than MOST_DIGITS digits.

    Both are written out to the smaller exponent and to one length, and added or
    subtracted limb by limb, least one first, with a carry.
    """

    def aligned(x: Column) -> Column:
        low = F.least(x["a"]["exponent"], x["b"]["exponent"])
        out = lambda n: F.rpad(n["digits"], (F.length(n["digits"]) + n["exponent"] - low).cast("int"), "0")
        high = F.greatest(*[F.length(x[c]["digits"]) + x[c]["exponent"] for c in "ab"])
        wide = ((F.ceil((high - low + 1) / LIMB)) * LIMB).cast("int")
        both = F.struct(F.lpad(out(x["a"]), wide, "0").alias("a"), F.lpad(out(x["b"]), wide, "0").alias("b"), low.alias("low"), wide.alias("wide"))
        return F.when(high - low < MOST_DIGITS, let(both, lambda d: total(x, d)))

    def total(x: Column, d: Column) -> Column:
        add = x["a"]["minus"] != x["b"]["minus"]
        swap = ~add & (d["a"] < d["b"])
        first, second = F.when(swap, d["b"]).otherwise(d["a"]), F.when(swap, d["a"]).otherwise(d["b"])
        at = F.transform(F.sequence(F.lit(1), (d["wide"] / LIMB).cast("int")), lambda i: d["wide"] - i * LIMB + 1)
        limb = lambda text, i: F.substring(text, i, F.lit(LIMB)).cast("long")
        limbs = F.transform(at, lambda i: limb(first, i) + F.when(add, 1).otherwise(-1) * limb(second, i))
        state = "struct<carry:bigint,digits:string>"

        def carry(done: Column, v: Column) -> Column:
            return let(v + done["carry"], lambda s: F.struct(
                F.floor(s / F.lit(10**LIMB)).alias("carry"), F.concat(F.lpad(F.pmod(s, F.lit(10**LIMB)).cast("string"), LIMB, "0"), done["digits"]).alias("digits")).cast(state))

        digits = F.aggregate(limbs, F.struct(F.lit(0).cast("long").alias("carry"), F.lit("").alias("digits")).cast(state), carry, lambda s: s["digits"])
        return _shortened(x["a"]["minus"] != swap, digits, d["low"])

    return let(F.struct(a.alias("a"), b.alias("b")), lambda x: F.when(x["a"].isNotNull() & x["b"].isNotNull(), aligned(x)))


def subtracted(a: Column, b: Column) -> Column:
    """a - b of two doubles as the decimals that they are written as: 0.3 - 0.1 is 0.2, whatever the magnitude."""
    return let(difference(decimal(a.cast("string")), decimal(b.cast("string"))), as_double)
