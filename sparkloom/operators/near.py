"""Near-duplicates by Hamming distance of 64-bit hashes."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import hamming


def sign_hash(vector: str, width: int = 63) -> Column:
    """Bits of a vector's signs, the first component in the lowest bit."""
    return F.aggregate(
        F.transform(F.slice(F.col(vector), 1, width), lambda x, i: F.when(x > 0, F.expr("1L")).otherwise(F.expr("0L"))),
        F.struct(F.lit(0).cast("long").alias("v"), F.lit(1).cast("long").alias("p")),
        lambda t, x: F.struct((t["v"] + x * t["p"]).alias("v"), F.shiftleft(t["p"], 1).alias("p")),
        lambda t: t["v"],
    )


def _bands(most: int, bits: int, widest: int = 16) -> list[tuple[int, int, int]]:
    """(from, to, radius): bands of at most `widest` bits, and the changes to look for in each. As the radii and one for
    each band but the first sum up to `most`, two hashes that differ in `most` bits are within the radius of some band."""
    n = max(1, min(most + 1, -(-bits // widest)))
    cuts = [bits * k // n for k in range(n + 1)]
    spare = most - (n - 1)
    return [(a, b, spare // n + (k < spare % n)) for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True))]


def close_pairs(hashes: DataFrame, most: int, *, bits: int = 64) -> DataFrame:
    """(a, b, distance) of all pairs of distinct hashes, a < b by key, that differ in 1 to `most` bits.

    hashes: key, hash, one row for each hash. Hashes are cut into wide bands; one side of the join is put under all bands
    that differ in up to the band's radius of bits from its own, so a join on bands finds all pairs, and few others. Each
    pair is kept in the first band that can find it.
    """
    cuts = _bands(most, bits)
    value = lambda x, a, b: f"(shiftrightunsigned({x}, {a}) & {(1 << (b - a)) - 1 if b - a < 64 else -1}L)"
    flips = [[sum(1 << i for i in at) for r in range(radius + 1) for at in combinations(range(b - a), r)] for a, b, radius in cuts]
    own = F.array(*(F.expr(value("hash", a, b)) for a, b, _ in cuts))

    def around(band: tuple[int, int, int], flip: list[int]) -> Column:
        here = F.expr(value("hash", band[0], band[1]))
        return F.transform(F.array(*map(F.lit, flip)).cast("array<long>"), lambda x: here.bitwiseXOR(x))

    near = F.array(*map(around, cuts, flips))
    left = hashes.select(F.col("key").alias("a"), F.col("hash").alias("hash_a"), F.posexplode(near).alias("band", "parts")).select("a", "hash_a", "band", F.explode("parts").alias("part"))
    right = hashes.select(F.col("key").alias("b"), F.col("hash").alias("hash_b"), F.posexplode(own).alias("band", "part"))
    pairs = left.join(right, ["band", "part"]).filter("a < b").withColumn("distance", hamming(F.col("hash_a"), F.col("hash_b")))
    pairs = pairs.filter((F.col("distance") > 0) & (F.col("distance") <= most))
    first = " ".join(f"when bit_count({value('hash_a ^ hash_b', a, b)}) <= {radius} then {k}" for k, (a, b, radius) in enumerate(cuts))
    return pairs.filter(F.col("band") == F.expr(f"case {first} end")).select("a", "b", F.col("distance").cast("int").alias("distance"))


def marked_near(files: DataFrame, most: int) -> DataFrame:
    """file_pk, dupe_of: a file with an earlier file's hash goes to the first file of that hash; the first file of a
    hash goes to the earliest file whose hash is close. Not transitive. Files without either have a null."""
    first = files.groupBy("hash").agg(F.min("file_pk").alias("key"))
    near = close_pairs(first, most).groupBy("b").agg(F.min("a").alias("near"))
    rows = files.join(first, "hash").join(near, F.col("key") == F.col("b"), "left")
    return rows.select("file_pk", F.when(F.col("file_pk") != F.col("key"), F.col("key")).otherwise(F.col("near")).alias("dupe_of"))
