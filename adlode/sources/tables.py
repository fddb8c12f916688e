"""Reading tables: listings, pages, taxonomy, result files."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from adlode import constants as C
from adlode.operators.ingest import with_hash
from adlode.schema import RAW, TAXONOMY, VERSIONS

SEED_ROWS = 20


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def spread(rows: DataFrame, key: str) -> DataFrame:
    """A scan that Spark would read in fewer tasks than there are cores, spread over all of them.

    For work that costs far more than moving the rows. Tables with enough files
    are left as they are.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores, key) if rows.rdd.getNumPartitions() < cores else rows


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table, or an empty one of the same layout where nothing has been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_version(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """The current version of a table written by versions, or an empty one of the same layout."""
    folder = folder.rstrip("/")
    name = read_or_empty(spark, f"{folder}/versions", VERSIONS).agg(F.max_by("name", F.struct("number", "name"))).first()[0]
    return spark.read.schema(schema).parquet(f"{folder}/{name}") if name else spark.createDataFrame([], schema)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return (
        spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    )


def read_taxonomy(spark: SparkSession, path: str) -> DataFrame:
    """(canonical, aliases, category, line); blank where the file has nothing.

    A taxonomy is one hand-kept file, so its rows come in file order.
    """
    return read_csv(spark, path, TAXONOMY).fillna("").withColumn("line", F.monotonically_increasing_id())


def seed_listings(spark: SparkSession) -> DataFrame:
    """Demonstration listings, all under the demo url that cleaning leaves out."""
    stack = F.element_at(F.array(*map(F.lit, ("Python", "Java", "Linux", "SQL", "React"))), (F.col("id") % 5 + 1).cast("int"))
    rows = spark.range(1, SEED_ROWS + 1).select(
        F.col("id"),
        F.concat(F.lit("Poste "), F.col("id"), F.lit(" - "), stack).alias("title"),
        F.concat(F.lit("Société "), F.col("id") % 7).alias("company"),
        F.when(F.col("id") % 2 == 0, "Douala").otherwise("Yaoundé").alias("city"),
        F.concat(F.col("id") % 6, F.lit(" ans")).alias("experience"),
        stack.alias("skills_raw"),
        F.concat(F.lit("Nous recherchons un profil "), stack).alias("description"),
        F.concat(F.lit(f"https://{C.DEMO_URL}/job/"), F.col("id")).alias("url"),
        F.lit("").alias("date_posted"),
        F.lit("emploi_cm").alias("source"),
        F.current_timestamp().alias("scraped_at"),
    )
    return with_hash(rows).select(RAW.fieldNames())


def seed_if_empty(listings: DataFrame) -> DataFrame:
    return seed_listings(listings.sparkSession) if listings.isEmpty() else listings
