"""The catalogue of files: scans with change detection, exact duplicates, buckets, missing derivatives."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .keys import numbered

#: Files from which a digest is hot, and the parts that its rows are dealt to.
HOT, SALTS = 1_000_000, 64


def listing_changes(listing: DataFrame, catalog: DataFrame) -> DataFrame:
    """path with change: 'new', 'changed' (size or time differ) or 'same'. Files that are gone are not looked at."""
    old = catalog.select("path", F.col("size").alias("old_size"), F.col("mtime").alias("old_mtime"), F.lit(True).alias("known"))
    both = listing.join(old, "path", "left")
    same = F.col("size").eqNullSafe(F.col("old_size")) & F.col("mtime").eqNullSafe(F.col("old_mtime"))
    return both.select("path", "size", "mtime", F.when(F.col("known").isNull(), "new").when(same, "same").otherwise("changed").alias("change"))


def merged_catalog(listing: DataFrame, catalog: DataFrame, *, suffixes: list[str] | None = None, most: int | None = None) -> DataFrame:
    """The catalogue (file_pk, path, size, mtime, status, content_hash) after a scan.

    New paths get keys after the largest one, by path; changed ones are reset to status 0 without a hash; the others,
    and paths that were not listed, stay. `most` files are seen at most, by path, those with other suffixes included.
    """
    from ..functions.scalars import suffix

    seen = listing if most is None else listing.orderBy("path").limit(most)
    seen = seen if suffixes is None else seen.filter(suffix(F.col("path")).isin(suffixes))
    changes = listing_changes(seen.dropDuplicates(["path"]), catalog)
    moved = changes.filter("change = 'changed'").select("path", F.col("size").alias("new_size"), F.col("mtime").alias("new_mtime"))
    reset = F.col("new_mtime").isNotNull() | F.col("new_size").isNotNull()
    kept = catalog.join(moved, "path", "left").select(
        "file_pk",
        "path",
        F.coalesce("new_size", "size").alias("size"),
        F.coalesce("new_mtime", "mtime").alias("mtime"),
        F.when(reset, 0).otherwise(F.col("status")).cast("int").alias("status"),
        F.when(~reset, F.col("content_hash")).alias("content_hash"),
    )
    top = catalog.agg(F.coalesce(F.max("file_pk"), F.lit(0)).alias("top"))  # one row
    new = numbered(changes.filter("change = 'new'"), "path", "n").crossJoin(F.broadcast(top))
    new = new.select((F.col("top") + F.col("n") + 1).alias("file_pk"), "path", "size", "mtime", F.lit(0).alias("status"), F.lit(None).cast("string").alias("content_hash"))
    return kept.unionByName(new)


def without_dependents(dependents: DataFrame, changes: DataFrame, catalog: DataFrame) -> DataFrame:
    """Derived rows, but for those of files that have changed."""
    gone = changes.filter("change = 'changed'").join(catalog, "path").select("file_pk")
    return dependents.join(gone, "file_pk", "left_anti")


def exact_duplicates(files: DataFrame, key: str = "file_pk", digest: str = "content_hash") -> DataFrame:
    """Add canonical_pk (smallest key with that content) and is_exact_dupe. Files without a digest have neither.

    Digests are dealt with one of SALTS numbers, so that neither the files without a digest nor those of one that a third
    of all files share meet in one task.
    """
    salts = F.array(*map(F.lit, range(SALTS)))
    first = files.filter(F.col(digest).isNotNull()).groupBy(digest).agg(F.min(key).alias("canonical_pk"), F.count("*").alias("copies_"))
    # a digest with few files needs one row, a hot one a row for each salt
    first = first.withColumn("salt_", F.explode(F.when(F.col("copies_") > HOT, salts).otherwise(F.array(F.lit(-1)))))
    hot = first.filter("salt_ = 0").select(digest, F.lit(True).alias("hot_"))
    marked = files.join(F.broadcast(hot), digest, "left")  # at most one in HOT files has such a digest
    salt = F.when(F.col("hot_"), F.pmod(F.xxhash64(key), F.lit(SALTS)).cast("int")).otherwise(-1)
    joined = marked.withColumn("salt_", salt).drop("hot_").join(first.drop("copies_"), [digest, "salt_"], "left")
    return joined.drop("salt_").withColumn("is_exact_dupe", F.coalesce(F.col(key) != F.col("canonical_pk"), F.lit(False)))


def duplicate_totals(files: DataFrame) -> DataFrame:
    """One row: candidates, uniques and dupes of what exact_duplicates() gives."""
    hashed = F.col("content_hash").isNotNull()
    n = lambda c: F.count(F.when(c, 1)).cast("long")
    return files.agg(n(hashed).alias("candidates"), n(hashed & ~F.col("is_exact_dupe")).alias("uniques"), n(F.col("is_exact_dupe")).alias("dupes"))


def claim_faults(claims: DataFrame, files: DataFrame) -> DataFrame:
    """content_hash with fault: 'stale' (the claiming file is gone or has other content) or 'missing' (unclaimed)."""
    own = files.select(F.col("file_pk").alias("canonical_file_pk"), F.col("content_hash").alias("now"))
    stale = claims.join(own, "canonical_file_pk", "left").filter(~F.col("now").eqNullSafe(F.col("content_hash")))
    missing = files.filter("content_hash is not null").select("content_hash").distinct().join(claims, "content_hash", "left_anti")
    return stale.select("content_hash", F.lit("stale").alias("fault")).unionByName(missing.select("content_hash", F.lit("missing").alias("fault")))


def canonical(files: DataFrame) -> DataFrame:
    return files.filter(F.col("content_hash").isNotNull() & ~F.coalesce("is_exact_dupe", F.lit(False)) & (F.col("status") == 1))


def rebuilt_claims(claims: DataFrame, files: DataFrame) -> DataFrame:
    """(content_hash, canonical_file_pk): claims without stale ones, and one for each content that lacks it, by the
    smallest key that has it."""
    faults = claim_faults(claims, files)
    good = claims.join(faults.filter("fault = 'stale'").select("content_hash"), "content_hash", "left_anti").select("content_hash", "canonical_file_pk")
    lacking = files.filter("content_hash is not null").groupBy("content_hash").agg(F.min("file_pk").alias("canonical_file_pk")).join(good, "content_hash", "left_anti")
    return good.unionByName(lacking)


def bucketed(files: DataFrame, bucket_rows: int, *, key: str = "file_pk") -> DataFrame:
    """ok_index (dense, by key), bucket_id and bucket_pos. Where the files have an ok_index column, numbers that are set
    stay, and the others go on from the largest."""
    if "ok_index" in files.columns:
        old = files.filter("ok_index is not null")
        top = old.agg((F.coalesce(F.max("ok_index"), F.lit(-1)) + 1).alias("top_"))  # one row
        new = numbered(files.filter("ok_index is null").drop("ok_index"), key, "n_").crossJoin(F.broadcast(top))
        rows = old.unionByName(new.withColumn("ok_index", (F.col("top_") + F.col("n_")).cast("long")).drop("n_", "top_"))
    else:
        rows = numbered(files, key, "ok_index")
    return rows.withColumn("bucket_id", F.expr(f"ok_index div {bucket_rows}")).withColumn("bucket_pos", F.col("ok_index") % bucket_rows)


def missing_presets(files: DataFrame, presets: DataFrame, done: DataFrame) -> DataFrame:
    """(file_pk, preset) pairs with no finished derivative. presets is a short list of names."""
    every = presets.agg(F.collect_set("preset").alias("every_"))  # one row
    have = done.filter("status = 1").groupBy("file_pk").agg(F.collect_set("preset").alias("have_"))
    rows = files.select("file_pk").join(have, "file_pk", "left").crossJoin(F.broadcast(every))
    return rows.select("file_pk", F.explode(F.array_except("every_", F.coalesce("have_", F.array().cast("array<string>")))).alias("preset"))


def preset_progress(files: DataFrame, done: DataFrame, wanted: list[str]) -> DataFrame:
    """Files that lack a preset, with those they have: file_pk, have (sorted), n_have."""
    good = F.when((F.col("status") == 1) & F.col("preset").isin(wanted), F.col("preset"))
    out = files.select("file_pk").join(done, "file_pk", "left").groupBy("file_pk").agg(F.array_sort(F.collect_set(good)).alias("have"))
    return out.withColumn("n_have", F.size("have").cast("long")).filter(F.col("n_have") < len(wanted))
