"""Report texts from a tree of files, and what their paths tell."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import ascii_compact, contains_any
from ..operators.intent import MAX_YEAR, MIN_YEAR

SUFFIX = "_extracted.txt"
#: Files that are picked by name, their names on the driver as those of a listing are.
PICKED_FILES = 10_000
#: Kind of report by compact document name.
CONSOLIDATED_NAMES = ("consolidated", "hopnhat", "bctchn")
SEPARATE_NAMES = ("separate", "rieng", "congtyme")
AGGREGATED_NAMES = ("aggregated",)


def doc_name_of(path: Column) -> Column:
    """File name without ``_extracted.txt``, else without its last extension."""
    name = F.element_at(F.split(path, "/"), -1)
    return F.when(name.endswith(SUFFIX), F.left(name, F.length(name) - len(SUFFIX))).otherwise(F.regexp_replace(name, "(?<=.)\\.[^.]*$", ""))


def ticker_of(path: Column, root: str) -> Column:
    """First folder below the root, in capitals."""
    return F.upper(F.element_at(F.split(F.substr(path, F.lit(len(root.rstrip("/")) + 2)), "/"), 1))


def year_of(path: Column, doc_name: Column) -> Column:
    """Deepest folder that is a year in range, else the last year in range in the name, else null."""
    valid = lambda years: F.filter(F.transform(years, lambda y: y.cast("int")), lambda y: y.between(MIN_YEAR, MAX_YEAR))
    folders = valid(F.filter(F.split(path, "/"), lambda p: p.rlike("^20\\d{2}$")))
    named = valid(F.regexp_extract_all(doc_name, F.lit("(20\\d{2})"), 1))
    return F.coalesce(F.try_element_at(folders, F.lit(-1)), F.try_element_at(named, F.lit(-1)))


def scope_of_name(doc_name: Column) -> Column:
    """aggregated wins; consolidated or separate if the name says just one of them; else null."""
    compact = ascii_compact(doc_name)
    consolidated, separate = contains_any(compact, CONSOLIDATED_NAMES), contains_any(compact, SEPARATE_NAMES)
    return (
        F.when(contains_any(compact, AGGREGATED_NAMES), F.lit("aggregated"))
        .when(consolidated & ~separate, F.lit("consolidated")).when(separate & ~consolidated, F.lit("separate"))
    )


def decode(content: Column) -> Column:
    """Bytes as UTF-8 text, wrong bytes replaced, every line end a line feed."""
    return F.regexp_replace(F.make_valid_utf8(content.cast("string")), "\\r\\n?", "\n")


def _files(spark: SparkSession, root: str, glob: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(root)


def list_documents(spark: SparkSession, root: str, glob: str = "*.txt") -> DataFrame:
    """Metadata of the files below root, without their contents: uri, path, size, modified, doc_name, ticker, year, scope.

    Of files with one document name the first by path counts. uri is the file's name to Spark, path is plain.
    """
    plain = F.regexp_replace("path", "^file:/+", "/")
    base = root.removeprefix("file://")
    named = _files(spark, root, glob).select(
        F.col("_metadata.file_path").alias("uri"), plain.alias("path"), F.col("length").alias("size"), F.col("modificationTime").alias("modified")
    ).withColumn("doc_name", doc_name_of(F.col("path")))
    first = named.withColumn("_n", F.row_number().over(W.partitionBy("doc_name").orderBy("path"))).where("_n = 1").drop("_n")
    return first.select("uri", "path", "size", "modified", "doc_name", ticker_of(F.col("path"), base).alias("ticker"), year_of(F.col("path"), F.col("doc_name")).alias("year"), scope_of_name(F.col("doc_name")).alias("scope"))


def read_texts(spark: SparkSession, root: str, chosen: DataFrame, glob: str = "*.txt") -> DataFrame:
    """chosen (with uri) and the text of each file.

    Up to PICKED_FILES files are picked by name when the scan is planned, so contents of others aren't read. More
    are most of the tree: then the files that aren't chosen are taken out, or those that are kept, whichever are fewer.
    """
    files = _files(spark, root, glob)
    uri = F.col("_metadata.file_path")
    picked = [r.uri for r in chosen.select("uri").limit(PICKED_FILES + 1).collect()]
    if len(picked) <= PICKED_FILES:
        texts = files.where(uri.isin(picked)).select(uri.alias("uri"), decode(F.col("content")).alias("text"))
        return texts.join(F.broadcast(chosen), "uri")
    texts = files.select(uri.alias("uri"), decode(F.col("content")).alias("text"))
    others = files.select(uri.alias("uri")).join(chosen.select("uri"), "uri", "left_anti")
    if others.limit(PICKED_FILES + 1).count() <= PICKED_FILES:
        texts = texts.join(F.broadcast(others), "uri", "left_anti")
    return texts.join(chosen, "uri")


def scan_documents(spark: SparkSession, root: str, glob: str = "*.txt") -> DataFrame:
    """list_documents with the text."""
    return read_texts(spark, root, list_documents(spark, root, glob), glob).select("doc_name", "ticker", "year", "scope", "path", "size", "modified", "text")


def sorted_documents(docs: DataFrame) -> DataFrame:
    """The stable order of a listing: ticker, year (unknown first), name."""
    return docs.orderBy("ticker", F.coalesce("year", F.lit(0)), "doc_name")


def changed_documents(docs: DataFrame, seen: DataFrame | None) -> DataFrame:
    """Documents whose (doc_name, size, modified) isn't among those seen: what an incremental run reads."""
    return docs if seen is None else docs.join(seen.select("doc_name", "size", "modified"), ["doc_name", "size", "modified"], "left_anti")
