"""Files of records: registries, passages, logs, manifests, seeds and samples, written and read with their own rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

# Types of entities of the seed, and the group in which each is looked up.
ENTITY_TYPES = {"person": "person", "org": "org", "acronym": "org", "place": "place", "role": "role"}


def json_lines(spark: SparkSession, path: str, schema: str | T.StructType, glob: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, bad): the lines of JSON files as rows with ``_order``, their place in file and line order; and the lines that are no JSON of the schema."""
    r = spark.read.option("pathGlobFilter", glob) if glob else spark.read
    lines = r.text(path).select(F.struct(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"), F.monotonically_increasing_id().alias("i")).alias("_order"), F.trim("value").alias("value")).where("value <> ''")
    kind = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    with_bad = T.StructType([*kind.fields, T.StructField("_bad", T.StringType())])
    parsed = lines.withColumn("r", F.from_json("value", with_bad, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}))
    good = parsed.where("r is not null and r._bad is null").select("r.*", "_order").drop("_bad")
    return good, parsed.where("r is null or r._bad is not null").select("value", "_order")


def last_per_key(rows: DataFrame, key: list[str], order: str = "_order") -> DataFrame:
    """Of each key the row that comes last."""
    return rows.withColumn("_rn", F.row_number().over(Window.partitionBy(*key).orderBy(F.desc(order)))).where("_rn = 1").drop("_rn", order)


def first_per_key(rows: DataFrame, key: list[str], order: list[str | Column]) -> DataFrame:
    """Of each key the row that comes first."""
    return rows.withColumn("_rn", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where("_rn = 1").drop("_rn")


def registry_scan(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """A registry in JSON lines: invalid lines are passed over, the last line of a url counts."""
    return last_per_key(json_lines(spark, path, schema)[0].where("url is not null"), ["url"])


def passage_scan(spark: SparkSession, folder: str, schema: str | T.StructType) -> DataFrame:
    """Passages in JSON lines, one file per document, but for files whose names begin with an underscore; with ``file``."""
    rows = json_lines(spark, folder, schema, "[!_]*.json*")[0]
    return rows.withColumn("file", F.substring_index(F.col("_order")["f"], "/", -1)).drop("_order")


def manifest_total(spark: SparkSession, path: str, without: DataFrame) -> DataFrame:
    """One row: documents and passages of a manifest, without the documents (sha256) named; a missing number counts 0, the last line of a document counts."""
    m = last_per_key(json_lines(spark, path, "sha256 string, status string, n_chunks long")[0], ["sha256"])
    m = m.join(without.select("sha256").distinct(), "sha256", "left_anti")
    return m.agg(F.count("*").alias("documents"), F.coalesce(F.sum("n_chunks"), F.lit(0).cast("long")).alias("chunks"))


def seed_faults(seed: DataFrame) -> DataFrame:
    """What is wrong with a seed of entities: (fault, entity_id) for ids given twice and unknown types. Empty for a good seed."""
    twice = seed.groupBy("entity_id").agg(F.count("*").alias("n")).where("n > 1 or entity_id is null").select(F.lit("duplicate id").alias("fault"), "entity_id")
    odd = seed.where(~F.coalesce(F.col("entity_type"), F.lit("")).isin(*ENTITY_TYPES)).select(F.lit("unknown type").alias("fault"), "entity_id")
    return twice.unionByName(odd).distinct()


def alias_collisions(forms: DataFrame) -> DataFrame:
    """Forms (type_group, form, entity_id) that two entities of a group share."""
    return forms.groupBy("type_group", "form").agg(F.countDistinct("entity_id").alias("owners")).where("owners > 1")


def role_map(spark: SparkSession, roles: dict[str, str]) -> DataFrame:
    """A reviewed map of labels to roles, as a table of one row a label."""
    return spark.createDataFrame(sorted(roles.items()) or [], "speaker string, role string")


def sample_scan(spark: SparkSession, path: str) -> DataFrame:
    """A frozen sample: chunk_id and stratum, separated by tabs; lines that begin with # are notes."""
    return spark.read.option("sep", "\t").option("comment", "#").schema("chunk_id string, stratum string").csv(path)


def cached(spark: SparkSession, path: str, model: str, prompt_version: str) -> DataFrame:
    """Answers kept for one model and prompt version; the others are never read, being other partitions."""
    return spark.read.parquet(path).where((F.col("model") == model) & (F.col("prompt_version") == prompt_version))


def url_faults(registry: DataFrame, slugs: list[str], source_types: list[str]) -> DataFrame:
    """(url, fault) of records outside the vocabularies or with an URL that is not of the web."""
    tests = [(~F.col("commission_slug").isin(*slugs), "unknown commission"), (~F.col("source_type").isin(*source_types), "unknown source type"), (~F.lower("url").rlike("^https?://"), "not of the web")]
    faults = F.filter(F.array(*[F.when(F.coalesce(t, F.lit(True)), F.lit(n)) for t, n in tests]), lambda x: x.isNotNull())
    return registry.select("url", F.explode(faults).alias("fault")).distinct()
