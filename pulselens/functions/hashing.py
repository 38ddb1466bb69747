"""Reproducible pseudo-randomness from hashes (same numbers in Spark and SQL).

u = first 13 hex digits of md5(key) / 2^52 is uniform on [0, 1), and exact as
a double.  Poisson(1) weights come from inverting the CDF on u; the thresholds
are generated from the Poisson formula below, not typed in, as far as u can
tell them from 1, so no weight is cut off.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

U_BITS = 52
U_DIGITS = U_BITS // 4


def poisson1_cdf() -> list[float]:
    """P(X <= k) for X ~ Poisson(1), k = 0, 1, ... until the rest is below the resolution of u."""
    out, k = [], 0
    while True:
        # the tail is summed from its small end, so that 1 - tail is as exact as a double can be
        tail = math.fsum(math.exp(-1.0) / math.factorial(j) for j in range(k + 40, k, -1))
        if tail < 2.0 ** -U_BITS:
            return out
        out.append(1.0 - tail)
        k += 1


def md5_key(*cols) -> Column:
    return F.concat_ws("-", *[F.col(c).cast("string") if isinstance(c, str) else c.cast("string") for c in cols])


def md5_uniform(*cols) -> Column:
    """Uniform [0,1) from md5 of the '-'-joined key."""
    digits = F.substring(F.md5(md5_key(*cols)), 1, U_DIGITS)
    return F.conv(digits, 16, 10).cast("bigint").cast("double") / F.lit(2.0 ** U_BITS)


def xxhash_uniform(*cols, seed: int = 42) -> Column:
    """Uniform [0,1) from ``xxhash64`` (codegen'd, no string building): the
    fast choice for very large replicate explosions; not reproducible in
    other engines."""
    h = F.xxhash64(*[F.col(c) if isinstance(c, str) else c for c in cols], F.lit(seed))
    return F.pmod(h, F.lit(2 ** U_BITS)).cast("double") / F.lit(2.0 ** U_BITS)


def uniform(*cols, method: str = "md5") -> Column:
    return xxhash_uniform(*cols) if method == "xxhash64" else md5_uniform(*cols)


def md5_uniform_sql(*exprs: str) -> str:
    key = "concat_ws('-', " + ", ".join(f"CAST({e} AS VARCHAR)" for e in exprs) + ")"
    return f"(CAST(('0x' || substr(md5({key}), 1, {U_DIGITS})) AS BIGINT) / CAST({2 ** U_BITS} AS DOUBLE))"


def poisson1_from_uniform(u: Column) -> Column:
    w = F.lit(0)
    for c in poisson1_cdf():
        w = w + F.when(u >= F.lit(c), F.lit(1)).otherwise(F.lit(0))
    return w


def poisson1_from_uniform_sql(u: str) -> str:
    return "(" + " + ".join(f"(CASE WHEN {u} >= {c!r} THEN 1 ELSE 0 END)" for c in poisson1_cdf()) + ")"


# ---- XXH64 of integers, as other engines give it ------------------------------------------------

# fixed values of the hash: its five primes
XXH_PRIMES = (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261)
_WORD = 1 << 64
#: The seed that Spark's ``xxhash64`` starts from.
SPARK_SEED = 42


def _rotl(x: int, r: int) -> int:
    return ((x << r) | (x >> (64 - r))) % _WORD


def _unshift(x: int, r: int) -> int:
    """The y of which x = y ^ (y >> r)."""
    y = x
    for _ in range(64 // r):
        y = x ^ (y >> r)
    return y


def long_with_hash(target: int, seed: int = SPARK_SEED) -> int:
    """The 64-bit integer (signed) whose XXH64 under ``seed`` is ``target``: every step of the hash of eight bytes can be
    undone, so there is exactly one."""
    p1, p2, p3, p4, p5 = XXH_PRIMES
    inv = lambda p: pow(p, -1, _WORD)
    x = _unshift(target % _WORD, 32)
    x = _unshift(x * inv(p3) % _WORD, 29)
    x = _unshift(x * inv(p2) % _WORD, 33)
    x = _rotl((x - p4) * inv(p1) % _WORD, 64 - 27)
    x ^= (seed + p5 + 8) % _WORD
    x = _rotl(x * inv(p1) % _WORD, 64 - 31) * inv(p2) % _WORD
    return x - _WORD if x >= _WORD // 2 else x


def xxh64_int(value: Column, width: int = 8, seed: int = 0) -> Column:
    """XXH64 of an integer's ``width`` bytes (4 or 8, little-endian) under ``seed``, as a signed bigint; NULL for NULL.

    Spark's ``xxhash64`` of several values takes the hash of the earlier ones as the seed of the next, so a first value
    whose hash is ``seed`` gives that seed to the second.  Everything stays one codegen'd expression.  Four bytes hold
    -2**31 to 2**32 - 1 (a value from 2**31 on is unsigned); others give NULL.
    """
    start = F.lit(long_with_hash(seed)).cast("bigint")
    v = value.cast("bigint")
    if width == 4:
        low = F.when(v.between(-2**31, 2**31 - 1), v).when(v.between(2**31, 2**32 - 1), v - F.lit(2**32))
        v = low.cast("int")
    elif width != 8:
        raise ValueError("width must be 4 or 8")
    return F.when(v.isNotNull(), F.xxhash64(start, v))


def unsigned_mod(h: Column, n: int) -> Column:
    """The remainder of a bigint taken as an unsigned 64-bit number."""
    r = F.pmod(h, F.lit(n).cast("bigint"))
    return F.when(h >= 0, r).otherwise(F.pmod(r + F.lit(_WORD % n).cast("bigint"), F.lit(n).cast("bigint")))


def xxh64_int_sql(value: str, width: int = 8, seed: int = 0) -> str:
    """XXH64 as unsigned arithmetic in SQL on UHUGEINT (for values from 0 on)."""
    p1, p2, p3, p4, p5 = (f"{p}::UHUGEINT" for p in XXH_PRIMES)
    word = f"{_WORD}::UHUGEINT"
    rot = lambda x, r: f"list_transform([{x}], lambda q: (q * {2 ** r}::UHUGEINT) % {word} + q // {2 ** (64 - r)}::UHUGEINT)[1]"
    shift = lambda x, r: f"list_transform([{x}], lambda q: xor(q, q // {2 ** r}::UHUGEINT))[1]"
    begin = f"{(seed + XXH_PRIMES[4] + width) % _WORD}::UHUGEINT"
    v = f"CAST({value} AS UHUGEINT)"
    if width == 8:
        mixed = rot(f"({v} * {p2}) % {word}", 31)
        h = f"(({rot(f'xor({begin}, ({mixed} * {p1}) % {word})', 27)} * {p1}) % {word} + {p4}) % {word}"
    else:
        h = f"(({rot(f'xor({begin}, ({v} * {p1}) % {word})', 23)} * {p2}) % {word} + {p3}) % {word}"
    h = f"({shift(h, 33)} * {p2}) % {word}"
    h = f"({shift(h, 29)} * {p3}) % {word}"
    return shift(h, 32)


def user_bucket(user: Column, n: int = 50, method: str = "md5") -> Column:
    """Hash bucket of a user.  ``md5`` is reproducible in SQL oracles; ``xxhash64`` is Spark's own hash (seed 42);
    ``xxh64_4`` and ``xxh64_8`` are the unsigned XXH64 with seed 0 of the id's four or eight bytes, bit-equal to
    engines that hash 32-bit or 64-bit ids that way, at the cost of ``xxhash64``."""
    if method == "xxhash64":
        return F.pmod(F.xxhash64(user), F.lit(n)).cast("int")
    if method in ("xxh64_4", "xxh64_8"):
        return unsigned_mod(xxh64_int(user, int(method[-1])), n).cast("int")
    if method != "md5":
        raise ValueError(f"unknown method {method!r}")
    hex8 = F.substring(F.md5(user.cast("string")), 1, 8)
    return F.pmod(F.conv(hex8, 16, 10).cast("bigint"), F.lit(n)).cast("int")


def user_bucket_sql(user: str, n: int = 50, method: str = "md5") -> str:
    if method in ("xxh64_4", "xxh64_8"):
        return f"CAST({xxh64_int_sql(user, int(method[-1]))} % {n}::UHUGEINT AS INTEGER)"
    return f"CAST(CAST(('0x' || substr(md5(CAST({user} AS VARCHAR)), 1, 8)) AS BIGINT) % {n} AS INTEGER)"


# ---- sums of many Poisson(1) weights ---------------------------------------------------------------

#: Binary digits up to this one have a table; Poisson(2**b) of a higher one is close enough to normal for an expansion.
TABLE_BITS = 10


def poisson_table(bit: int) -> tuple[int, list[float]]:
    """For X ~ Poisson(2**bit): the smallest value that u can tell from impossible, and P(X <= k) from there on, until the
    rest is below the resolution of u."""
    lam = float(2 ** bit)
    p = lambda k: math.exp(k * math.log(lam) - lam - math.lgamma(k + 1))
    wide = int(9 * math.sqrt(lam)) + 30
    low = max(0, int(lam) - wide)
    total, first, out = 0.0, None, []
    for k in range(low, int(lam) + wide):
        total += p(k)
        if first is None and total >= 2.0 ** -U_BITS:
            first = k
        if first is not None:
            out.append(min(total, 1.0))
        if 1.0 - total < 2.0 ** -U_BITS:
            break
    return first, out


def _normal_quantile(u: Column) -> Column:
    """The inverse of the normal distribution function by Acklam's rational approximation (relative error 1.2e-9)."""
    # fixed values of the approximation
    a = (-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02, 1.383577518672690e+02, -3.066479806614716e+01, 2.506628277459239e+00)
    b = (-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02, 6.680131188771972e+01, -1.328068155288572e+01, 1.0)
    c = (-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00, -2.549732539343734e+00, 4.374664141464968e+00, 2.938163982698783e+00)
    d = (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00, 3.754408661907416e+00, 1.0)

    def poly(x: Column, co) -> Column:
        out = F.lit(co[0])
        for v in co[1:]:
            out = out * x + F.lit(v)
        return out

    v = F.least(F.greatest(u, F.lit(2.0 ** -(U_BITS + 1))), F.lit(1.0 - 2.0 ** -(U_BITS + 1)))
    side = F.least(v, F.lit(1.0) - v)
    r = F.sqrt(F.lit(-2.0) * F.log(side))
    tail = poly(r, c) / poly(r, d) * F.when(v < 0.5, F.lit(1.0)).otherwise(F.lit(-1.0))
    m = v - F.lit(0.5)
    return F.when(side < 0.02425, tail).otherwise(poly(m * m, a) * m / poly(m * m, b))


def poisson_power_from_uniform(u: Column, bit: Column) -> Column:
    """X ~ Poisson(2**bit) from u: by table up to ``TABLE_BITS``, beyond by the Cornish-Fisher expansion, whose mean and
    variance are right to a few parts in a million there."""
    out = None
    for b in range(TABLE_BITS + 1):
        first, cdf = poisson_table(b)
        draw = F.size(F.filter(F.array(*[F.lit(c) for c in cdf]), lambda c: c <= u)) + F.lit(first)
        out = F.when(bit == b, draw) if out is None else out.when(bit == b, draw)
    lam = F.pow(F.lit(2.0), bit.cast("double"))
    z, s = _normal_quantile(u), F.sqrt(lam)
    wide = F.floor(lam + s * z + (z * z - 1) / 6 - (z * z * z - z) / (F.lit(72.0) * s) + F.lit(0.5))
    return out.otherwise(F.greatest(wide, F.lit(0))).cast("bigint")


def poisson_power_from_uniform_sql(u: str, bit: str) -> str:
    """The same for the digits that have a table."""
    arms = []
    for b in range(TABLE_BITS + 1):
        first, cdf = poisson_table(b)
        arms.append(f"WHEN {b} THEN {first} + len(list_filter([{', '.join(f'{c!r}::DOUBLE' for c in cdf)}], lambda c: c <= {u}))")
    return f"(CASE {bit} {' '.join(arms)} END)"
