"""Discovery and reading of document trees."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom import fixed_values as fv
from docloom.functions.paths import extension, raw_extension
from docloom.operators.convert import Converter, convert_by_hook, convert_native, decode_documents
from docloom.session import path_kind, qualified, work_dir
from docloom.sources import stores

#: What the converter of a file that needs no hook is called.
NATIVE = "native"
#: Bytes of files that a task reads, about.
READ_BYTES = 64 * 1024 * 1024


def _roots(spark: SparkSession, inputs: Sequence[str]) -> dict[str, list[str]]:
    """The named inputs by kind, each once; a folder below another named one
    is read through that one only."""
    roots: dict[str, list[str]] = {"file": [], "directory": [], "missing": []}
    for path in dict.fromkeys(qualified(spark, item) for item in inputs):
        roots[path_kind(spark, path)].append(path)
    folders = roots["directory"]

    def inside_another(path: str) -> bool:
        return any(path != folder and path.startswith(folder.rstrip("/") + "/") for folder in folders)

    roots["directory"] = [path for path in folders if not inside_another(path)]
    return roots


def list_trees(spark: SparkSession, folders: Sequence[str]) -> DataFrame:
    """``path, kind, modificationTime, length, hidden`` of all that lies below
    the folders, as a written table.

    Each level of the trees is listed by tasks from the table of the level
    above it; no list of files goes through the driver.  One folder is listed
    by one task.  Names that start with ``.`` are ``hidden``, and so is all
    below such a folder.
    """
    base = work_dir(spark, "listing")
    level = spark.createDataFrame([(path, False) for path in folders], "path string, hidden boolean")
    waiting, depth = len(folders), 0
    while waiting:
        tasks = min(waiting, 2 * spark.sparkContext.defaultParallelism)
        place = f"{base}/level={depth}"
        level.repartition(tasks, "path").mapInArrow(stores.list_folders, stores.ENTRY).write.parquet(place)
        level = spark.read.schema(stores.ENTRY).parquet(place).where("kind = 'folder'").select("path", "hidden")
        waiting, depth = level.count(), depth + 1
    if depth == 0:
        return spark.createDataFrame([], stores.ENTRY)
    return spark.read.schema(stores.ENTRY).option("basePath", base).parquet(base).drop("level")


def discover_documents(
    spark: SparkSession,
    inputs: Sequence[str],
    extensions: Sequence[str] = fv.SUPPORTED_EXTENSIONS,
    ignore_case: bool = False,
) -> DataFrame:
    """``path, status, modificationTime, length`` of every file named or found
    below a named folder, each once.

    ``supported`` files are those that :func:`read_documents` reads.  The
    extension of a named file is compared without case and its name may start
    with anything; in folders the case counts unless ``ignore_case``, and names
    that start with ``.`` are ``hidden``.  Other files are ``unsupported``,
    named inputs that do not exist ``missing``; links to nowhere are no files.
    Inputs named twice, or below another named folder, count once.
    """
    roots = _roots(spark, inputs)
    named = spark.createDataFrame([(path, False) for path in roots["file"]], "path string, hidden boolean")
    in_folders = list_trees(spark, roots["directory"]).where("kind IN ('file', 'other')")
    ext = raw_extension(F.col("path"))
    fits = (F.lower(ext) if ignore_case else ext).isin(*extensions)
    fits = (F.col("kind") == "file") & fits
    status = F.when(F.col("hidden"), "hidden").when(fits, "supported").otherwise("unsupported")
    found = in_folders.select("path", status.alias("status"), "modificationTime", "length")
    of_named = named.mapInArrow(stores.describe, stores.ENTRY)
    named_status = F.when(extension(F.col("path")).isin(*extensions), "supported").otherwise("unsupported")
    named_rows = of_named.select("path", named_status.alias("status"), "modificationTime", "length")
    absent = spark.createDataFrame([(path, "missing", None, None) for path in roots["missing"]], found.schema)
    return found.join(named, "path", "left_anti").unionByName(named_rows).unionByName(absent)


def read_files(listed: DataFrame) -> DataFrame:
    """``path, modificationTime, length, content`` of the files in
    ``listed(path, modificationTime, length)``, dealt out to tasks by their
    size; one file is read whole by one task."""
    spark = listed.sparkSession
    total = listed.agg(F.sum("length").alias("bytes"), F.count(F.lit(1)).alias("files")).first()
    wanted = max(spark.sparkContext.defaultParallelism, -(-(total["bytes"] or 0) // READ_BYTES))
    tasks = max(1, min(total["files"], wanted))
    dealt = listed.select("path", "modificationTime").repartition(tasks, "path")
    return dealt.mapInArrow(stores.read_contents, stores.CONTENT)


def _supported(spark, inputs, extensions, ignore_case) -> DataFrame:
    return discover_documents(spark, inputs, extensions, ignore_case).where("status = 'supported'")


def read_documents(
    spark: SparkSession,
    inputs: Sequence[str],
    extensions: Sequence[str] = fv.SUPPORTED_EXTENSIONS,
    ignore_case: bool = False,
) -> DataFrame:
    """``path, modificationTime, length, content`` of every document that
    :func:`discover_documents` finds supported.

    The listing is made when this is called, the contents are read by what is
    done with the result.  A store that Arrow does not open is an error.
    """
    return read_files(_supported(spark, inputs, extensions, ignore_case))


def discovery_report(spark: SparkSession, inputs: Sequence[str], ignore_case: bool = False) -> DataFrame:
    """``path, status``: what is read, and what is not and why."""
    return discover_documents(spark, inputs, ignore_case=ignore_case).select("path", "status")


def convert_tree(
    spark: SparkSession,
    inputs: Sequence[str],
    converters: Mapping[str, Converter] | None = None,
    ignore_case: bool = False,
    done: DataFrame | None = None,
    shared: DataFrame | None = None,
) -> DataFrame:
    """Documents of a tree as ``path, md, error``, but for those in
    ``done(path)``.  ``shared(name, value)`` are attributes of all AsciiDoc
    documents.

    Files for the converters and files for the native conversion are listed
    apart by their extension, so every file is read once.
    """
    converters = dict(converters or {})
    native = tuple(ext for ext in fv.SUPPORTED_EXTENSIONS if ext not in converters)
    listed = _supported(spark, inputs, (*native, *converters), ignore_case)
    if done is not None:
        listed = listed.join(done.select("path"), "path", "left_anti")

    def files(extensions: tuple[str, ...]) -> DataFrame:
        return read_files(listed.where(extension(F.col("path")).isin(*extensions)))

    converted = convert_native(files(native), shared) if native else None
    if not converters:
        return converted
    by_hook = convert_by_hook(files(tuple(converters)), converters)
    return by_hook if converted is None else converted.unionByName(by_hook)


def list_files(
    spark: SparkSession,
    inputs: Sequence[str],
    converters: Mapping[str, Converter] | None = None,
    ignore_case: bool = False,
    shared: DataFrame | None = None,
) -> DataFrame:
    """``path, length, modified, converter`` of the files ``convert_tree``
    reads; no content is read.  The four together say whether a conversion
    would see the same again: with shared attributes the native converter's
    name tells their digest."""
    names = {ext: f"{f.__module__}.{getattr(f, '__qualname__', type(f).__qualname__)}" for ext, f in (converters or {}).items()}
    extensions = tuple(dict.fromkeys([*fv.SUPPORTED_EXTENSIONS, *names]))
    found = _supported(spark, inputs, extensions, ignore_case)
    native = NATIVE
    if shared is not None:
        digest = F.sum(F.xxhash64("name", "value").cast("decimal(38,0)"))
        native = f"{NATIVE} " + ":".join(map(str, shared.agg(F.count(F.lit(1)), digest).first()))
    name = F.lit(native)
    for ext, converter in names.items():
        name = F.when(extension(F.col("path")) == ext, F.lit(converter)).otherwise(name)
    return found.select("path", "length", F.col("modificationTime").alias("modified"), name.alias("converter"))


def read_texts(spark: SparkSession, inputs: Sequence[str], **options) -> DataFrame:
    """Documents as text: ``path, text, error``."""
    return decode_documents(read_documents(spark, inputs, **options).select("path", "content"))


def read_markdown(spark: SparkSession, inputs: Sequence[str]) -> DataFrame:
    """Markdown documents as ``path, md``; bytes that are not UTF-8 are an
    error here, because no later step would report them."""
    texts = read_texts(spark, inputs, extensions=(".md",))
    checked = F.when(F.col("error").isNull(), F.col("text")).otherwise(
        F.raise_error(F.concat_ws(": ", "path", "error")).cast("string")
    )
    return texts.select("path", checked.alias("md"))
