"""Text tables in: any Spark file source becomes (source, doc_id, text)."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from blockmill.config import SourceSpec


def _format_of(path: str) -> str:
    tail = path.rstrip("/").rsplit("/", 1)[-1].lower()
    tail = tail.removesuffix(".gz").removesuffix(".zst").removesuffix(".bz2")
    for suffix, name in ((".json", "json"), (".jsonl", "json"), (".csv", "csv"),
                         (".orc", "orc"), (".txt", "text")):
        if tail.endswith(suffix):
            return name
    return "parquet"


# Reader settings under which every record is one whole text.
_READER_OPTIONS = {
    "text": {"wholetext": True},
    "csv": {"header": True, "multiLine": True, "escape": '"'},
}


_WHOLE_NUMBERS = ("tinyint", "smallint", "int", "bigint")


def _path_below(path: str) -> Column:
    """A file's path below its dataset, which stays the same when the dataset moves."""
    fixed = [part for part in path.split("/") if part and not set(part) & set("*?[{")]
    name = fixed[-1] if fixed else ""
    found = F.instr(F.col("_metadata.file_path"), f"/{name}/")
    inside = F.substr(F.col("_metadata.file_path"), found + F.lit(len(name) + 2))
    return F.when(found > 0, inside).otherwise(F.col("_metadata.file_name"))


def scan_text(
    spark: SparkSession,
    spec: SourceSpec,
    base: str = "",
    doc_id: str | Column | None = None,
    file_format: str | None = None,
) -> DataFrame:
    """Read one source. ``config`` names a sub-folder of ``dataset``.

    ``doc_id`` is a column or expression, unique in the source, that keys the
    order of the mix; ids that are no whole numbers are hashed, a null id is
    replaced by a hash of the text. Without ``doc_id`` a row gets a hash of its
    place: path below the dataset and row number in Parquet, path and whole record
    in other formats (equal records of one file then share an id, and still are
    two documents). Plain text is one document per file; it and CSV, whose fields
    may hold line breaks, are read file by file, not in splits. Text that is no
    string, or a missing column, reads as null and is dropped later.

    JSON lines are read as text, in splits, and only the wanted fields are taken from
    them; no pass looks for a schema, unless ``doc_id`` is a Column. The fields of an
    id expression are strings there.
    """
    path = "/".join(p for p in (base.rstrip("/"), spec.dataset, spec.config) if p)
    file_format = file_format or _format_of(path)
    if file_format == "json" and not isinstance(doc_id, Column):
        return _scan_json(spark, spec, path, doc_id)
    raw = spark.read.format(file_format).options(**_READER_OPTIONS.get(file_format, {})).load(path)
    below = _path_below(path)
    if file_format == "parquet":
        place = F.xxhash64(below, F.col("_metadata.row_index"))
    else:
        place = F.xxhash64(below, *[F.col(f"`{c}`").cast("string") for c in raw.columns])
    if doc_id is None:
        key = place
    else:
        key = F.expr(doc_id) if isinstance(doc_id, str) else doc_id
        whole = raw.select(key.alias("key")).dtypes[0][1] in _WHOLE_NUMBERS
        key = key.cast("long") if whole else F.when(key.isNotNull(), F.xxhash64(key))
    column = "value" if file_format == "text" else spec.text_col
    is_text = dict(raw.dtypes).get(column, "").startswith(("string", "varchar", "char"))
    text = F.col(column) if is_text else F.lit(None).cast("string")
    return raw.select(
        F.lit(spec.name).alias("source"),
        # Rows whose id is null would all share one place in the order.
        F.coalesce(key.cast("long"), F.xxhash64(text)).alias("doc_id"),
        text.alias("text"),
    )


_NAME = r"`([^`]+)`|([A-Za-z_]\w*)"


def _scan_json(spark: SparkSession, spec: SourceSpec, path: str, doc_id: str | None) -> DataFrame:
    """One source of JSON lines. Blank lines are no records; broken ones have no text."""
    lines = spark.read.text(path).filter(F.trim("value") != "")
    # Names of functions in the expression become fields that are always null.
    names = {a or b for a, b in re.findall(_NAME, doc_id or "")} - {spec.text_col}
    fields = [T.StructField(spec.text_col, T.VariantType())]
    fields += [T.StructField(n, T.StringType()) for n in sorted(names)]
    row = F.from_json("value", T.StructType(fields), {"mode": "PERMISSIVE"})
    parsed = lines.select("value", _path_below(path).alias("below"), row.alias("row"))
    found = F.col("row").getField(spec.text_col)
    text = F.when(F.schema_of_variant(found) == "STRING", F.variant_get(found, "$", "string"))
    key = F.xxhash64("below", "value")
    if doc_id is not None:
        named = parsed.select("value", "below", "row", *[F.col("row").getField(n).alias(n) for n in sorted(names)])
        key = F.expr(doc_id)
        if named.select(key.alias("key")).dtypes[0][1] not in _WHOLE_NUMBERS:
            # A field may hold whole numbers; only their plain form stands for one.
            number = key.cast("string").try_cast("long")
            key = F.when(number.cast("string") == key.cast("string"), number).when(key.isNotNull(), F.xxhash64(key))
        parsed = named
    return parsed.select(
        F.lit(spec.name).alias("source"), F.coalesce(key.cast("long"), F.xxhash64(text)).alias("doc_id"), text.alias("text")
    )


def union_sources(tables: Iterable[DataFrame]) -> DataFrame:
    """Many sources in one table; rows keep their source name."""
    return reduce(lambda a, b: a.unionByName(b), tables)


def scan_sources(
    spark: SparkSession,
    specs: Iterable[SourceSpec],
    base: str = "",
    doc_ids: Mapping[str, str] | None = None,
    formats: Mapping[str, str] | None = None,
) -> DataFrame:
    """All sources of a build with a positive weight.

    ``doc_ids`` and ``formats`` give id expressions and file formats by source
    name, where the defaults of ``scan_text`` do not fit.
    """
    doc_ids, formats = doc_ids or {}, formats or {}
    return union_sources(
        scan_text(spark, s, base, doc_ids.get(s.name), formats.get(s.name))
        for s in specs if s.weight > 0
    )
