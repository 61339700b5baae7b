"""Reading tables, files and packs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from callsift import fixed_values as fv
from callsift.functions.regex import geo_pattern


def read_text(spark: SparkSession, path: str) -> str:
    """A small file as one string, from wherever Spark reads."""
    return spark.read.text(path, wholetext=True).first()["value"]


def run_sql(
    spark: SparkSession,
    sql: str | None = None,
    path: str | None = None,
    args: Mapping | None = None,
) -> DataFrame:
    """Run a statement given as text or as a file; values are bound, not pasted."""
    if sql is None and path is None:
        raise ValueError("give the text of a statement or the path of a file")
    text = sql if sql is not None else read_text(spark, path)
    return spark.sql(text, args=dict(args or {}))


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    sep: str = ",",
    blank: bool = False,
    multi_line: bool = False,
) -> DataFrame:
    """Files with a header.

    ``multi_line`` is for files whose quoted fields hold line ends; such a file
    is read by one task, others are split.  ``blank`` turns missing strings
    into empty ones.
    """
    rows = (
        spark.read.schema(schema)
        .option("header", True)
        .option("sep", sep)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
        .csv(path)
    )
    return rows.na.fill("") if blank else rows


def area_codes(spark: SparkSession, path: str) -> DataFrame:
    """(code, prvnce), the code as text; each code once.  For ``with_province_by_join``."""
    rows = read_csv(spark, path, "code string, prvnce string")
    return rows.groupBy("code").agg(F.min("prvnce").alias("prvnce"))


def read_area_codes(spark: SparkSession, path: str) -> dict[str, str]:
    """Code -> province, for use in expressions.  There are at most 1,000 codes of three digits."""
    return {r["code"]: r["prvnce"] for r in area_codes(spark, path).collect()}


def stopwords(
    spark: SparkSession, path: str | None = None, others: Sequence[str] = ()
) -> DataFrame:
    """Words of a file, one per line, and further words; each once, none empty."""
    extra = spark.createDataFrame([(w,) for w in others], "word string")
    if path is None:
        lines = extra
    else:
        lines = spark.read.text(path).select(F.col("value").alias("word")).union(extra)
    return lines.filter(F.length("word") > 0).distinct()


def stopword_list(spark: SparkSession, path: str | None = None, others: Sequence[str] = ()) -> list[str]:
    """The same words, sorted, for use in expressions.

    They come to the driver; ``lexicon.drop_words_by_join`` takes the table of
    ``stopwords`` as it is.
    """
    return sorted(r["word"] for r in stopwords(spark, path, others).collect())


def read_pack(path: str | None = None) -> tuple[dict[str, list[str]], list[str], list[str]]:
    """(families, words to remove, tags) of the shipped pack or a YAML file."""
    if path is None:
        return dict(fv.PATTERNS), list(fv.FILLER_WORDS), list(fv.TAGS)
    import yaml

    content = yaml.safe_load(read_text(SparkSession.active(), path))
    families = {
        k.removeprefix("regex_"): v for k, v in content.items() if k.startswith("regex_")
    }
    return families, list(content["to_remove"]), list(content["tags"])


def pack_table(spark: SparkSession, families: Mapping[str, Sequence[str]] = fv.PATTERNS) -> DataFrame:
    """S8 as a table ``(family, ord, pattern)``."""
    rows = [(f, i, p) for f, patterns in families.items() for i, p in enumerate(patterns)]
    return spark.createDataFrame(rows, "family string, ord int, pattern string")


def geo_pack(countries: DataFrame, regions: DataFrame) -> DataFrame:
    """``(family, pattern)`` of country, nationality, language, region and
    region_people names.

    Country fields hold several names between slashes; region fields hold one
    and keep their repeats.
    """
    wrap = F.format_string(geo_pattern("%s"), F.col("name"))

    def several(column: str) -> DataFrame:
        names = countries.select(F.explode(F.split(F.coalesce(column, F.lit("")), "/")).alias("raw"))
        clean = names.select(F.trim(F.lower("raw")).alias("name")).filter(F.length("name") > 0)
        return clean.distinct().select(F.lit(column).alias("family"), wrap.alias("pattern"))

    def single(column: str, family: str) -> DataFrame:
        clean = regions.select(F.trim(F.lower(column)).alias("name")).filter(F.length("name") > 0)
        return clean.select(F.lit(family).alias("family"), wrap.alias("pattern"))

    out = several("country")
    for part in (
        several("nationality"),
        several("language"),
        single("name", "region"),
        single("population", "region_people"),
    ):
        out = out.unionByName(part)
    return out


def read_json(spark: SparkSession, path: str, must_exist: bool = False) -> DataFrame | None:
    """A JSON document; a missing one is None, or an error on request."""
    try:
        return spark.read.json(path, multiLine=True)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        if must_exist:
            raise FileNotFoundError(path) from error
        return None


def read_table(spark: SparkSession, name_or_path: str) -> DataFrame:
    """A stored table, by catalog name or by path."""
    if "/" in name_or_path:
        return spark.read.parquet(name_or_path)
    return spark.table(name_or_path)


def read_training(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    stopword_path: str | None = None,
    pack_path: str | None = None,
    multi_line: bool = False,
) -> tuple[DataFrame, list[str], list[str]]:
    """(rows, stopwords with the pack's words to remove, tags)."""
    _, fillers, tags = read_pack(pack_path)
    words = stopword_list(spark, stopword_path, fillers)
    return read_csv(spark, path, schema, multi_line=multi_line), words, tags
