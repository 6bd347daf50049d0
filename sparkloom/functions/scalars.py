"""Column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Suffixes of images in scans, those of each kind of file and of archives, and output formats.
IMAGE_SUFFIXES = [".jpg", ".jpeg", ".png", ".bmp", ".tif", ".tiff", ".webp", ".pdf"]
KIND_SUFFIXES = {
    "images": [".jpg", ".jpeg", ".png", ".tif", ".tiff", ".bmp", ".webp", ".gif", ".heic"],
    "pdfs": [".pdf"],
    "docs": [".txt", ".csv", ".tsv", ".json", ".xml", ".html", ".md", ".rtf", ".doc", ".docx", ".xls", ".xlsx", ".ppt", ".pptx"],
}
ARCHIVE_PATTERN = r"(\.zip|\.7z|\.rar|\.tar|\.tgz|\.tbz|\.tbz2|\.txz|\.tar\.gz|\.tar\.bz2|\.tar\.xz)$"
OUTPUT_FORMATS = {".jpg": "jpeg", ".jpeg": "jpeg", ".png": "png", ".webp": "webp", ".tif": "tiff", ".tiff": "tiff"}
FORMAT_SUFFIXES = {"jpeg": ".jpg", "png": ".png", "webp": ".webp", "tiff": ".tif"}


def suffix(path: Column) -> Column:
    """Lower-case suffix with its dot, or the empty text."""
    return F.lower(F.regexp_extract(path, r"[^/](\.[^./]+)$", 1))


def file_kind(path: Column) -> Column:
    out = F.lit("other")
    for kind, own in KIND_SUFFIXES.items():
        out = F.when(suffix(path).isin(own), kind).otherwise(out)
    return out


def is_archive(path: Column) -> Column:
    return F.lower(path).rlike(ARCHIVE_PATTERN)


def output_format(path: Column, preset_format: Column, preserve: bool) -> Column:
    """struct(format, suffix): the preset's, or the source's own if it is kept and known."""
    own = F.create_map(*(F.lit(x) for pair in OUTPUT_FORMATS.items() for x in pair))[suffix(path)]
    ends = F.create_map(*(F.lit(x) for pair in FORMAT_SUFFIXES.items() for x in pair))[preset_format]
    plain = F.struct(preset_format.alias("format"), ends.alias("suffix"))
    kept = F.struct(own.alias("format"), F.regexp_extract(path, r"(\.[^./]+)$", 1).alias("suffix"))
    return F.when(own.isNotNull(), kept).otherwise(plain) if preserve else plain


def output_path(top: str, bucket: Column, position: Column, file_pk: Column, ending: Column, transform: Column | None = None) -> Column:
    parts = [F.lit(top)] + ([F.format_string("t%06d", transform)] if transform is not None else [])
    return F.concat_ws("/", *parts, F.format_string("b%06d", bucket), F.concat(F.format_string("%06d_%012d", position, file_pk), ending))


def collision_suffix(rel: Column, hint: Column) -> Column:
    return F.concat(F.lit("__"), F.substring(F.sha1(F.concat_ws("|", rel, hint)), 1, 10))


def safe_relative(root: str, path: Column) -> Column:
    """The path below `root`, or null if it lies outside or climbs out."""
    top = root.rstrip("/") + "/"
    rel = F.substring(path, len(top) + 1, 1 << 30)
    return F.when(F.startswith(path, F.lit(top)) & ~rel.rlike(r"(^|/)\.\.(/|$)"), rel)


def download_name(url: Column) -> Column:
    """Last segment before the query, or download.bin, with ten hex digits of the URL's digest."""
    last = F.trim(F.regexp_extract(F.regexp_replace(F.substring_index(url, "?", 1), r"/+$", ""), r"([^/]*)$", 1))
    return F.concat(F.when(last == "", "download.bin").otherwise(last), F.lit("__"), F.substring(F.sha1(url), 1, 10))


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def hex_hamming(a: Column, b: Column) -> Column:
    """Differing bits of two hex texts of up to 16 digits; four for each digit of the first if either is no hex."""
    number = lambda x: F.conv(x, 16, -10).cast("long")
    valid = a.rlike("^[0-9a-fA-F]{1,16}$") & b.rlike("^[0-9a-fA-F]{1,16}$")
    return F.when(valid, F.bit_count(number(a).bitwiseXOR(number(b)))).otherwise(4 * F.length(a)).cast("int")


def rectangle(raw: Column) -> Column:
    """array<double> of four: from a JSON list of eight (four corners) or of at least four; else zeros."""
    v = F.from_json(raw, "array<double>")
    at = lambda *k: F.array(*(F.element_at(v, i) for i in k))
    xs, ys = at(1, 3, 5, 7), at(2, 4, 6, 8)
    corners = F.array(F.array_min(xs), F.array_min(ys), F.array_max(xs), F.array_max(ys))
    return F.when(F.size(v) == 8, corners).when(F.size(v) >= 4, F.slice(v, 1, 4)).otherwise(F.array(*(F.lit(0.0),) * 4))


def backoff_seconds(attempt: Column, base: float, factor: float, most: float) -> Column:
    return F.least(F.lit(base) * F.pow(F.lit(factor), attempt - 1), F.lit(most))


def run_status(pending: Column, processing: Column, error: Column) -> Column:
    return F.when(processing > 0, "processing").when(pending > 0, "pending").when(error > 0, "error").otherwise("done")


def colour(value: Column, green: float, yellow: float) -> Column:
    return F.when(value < green, "green").when(value < yellow, "yellow").otherwise("red")


def word_count(text: Column) -> Column:
    return F.size(F.filter(F.split(text, r"(?U)\s+"), lambda x: x != ""))


def without_fence(raw: Column) -> Column:
    """JSON from a reply that may stand in a code fence."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.trim(raw), r"^```[A-Za-z]*\s*", ""), r"\s*```$", ""))


def path_bytes(path: Column) -> Column:
    """A path as the bytes that a catalogue keeps: UTF-8."""
    return F.encode(path, "UTF-8")


def path_text(data: Column) -> Column:
    """The path of path_bytes(); bytes that are no UTF-8 are refused as null."""
    return F.try_validate_utf8(data.cast("string"))
