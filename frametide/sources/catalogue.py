"""Catalogue of saved models (O5 with M6, M7, T3): which versions a model
folder holds and which of them are whole.

A save that was cut short, or a folder that is still being copied, must not be
picked as the newest model. Every version's files are listed by one scan that
reads names only; the pipeline's own record says how many stages there should
be, and the metadata record must hold its required keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from frametide.operators.sampling import latest_version
from frametide.operators.validate import REQUIRED_METADATA_KEYS

# Fixed value: the timestamped name of a saved model.
VERSION_NAME = r"ensemble_v\d{8}_\d{6}"
LATEST = "latest"
CATALOGUE = "version string, n_files bigint, n_stages bigint, n_stages_found bigint, required_keys boolean, complete boolean"


def _version(path: str):
    return F.regexp_extract(path, f"/({VERSION_NAME})/", 1)


def model_catalogue(spark: SparkSession, root: str, required: Sequence[str] = REQUIRED_METADATA_KEYS) -> DataFrame:
    """version, n_files, n_stages, n_stages_found, required_keys and complete,
    a row per saved version under ``root``; no rows where there is none."""
    pattern = f"{root.rstrip('/')}/ensemble_v*"
    try:
        listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(pattern).select("path", _version("path").alias("version"))
        records = spark.read.option("recursiveFileLookup", True).option("wholetext", True).option("pathGlobFilter", "part-0000*").text(pattern)
    except AnalysisException as err:
        if "PATH_NOT_FOUND" not in str(err):
            raise
        return spark.createDataFrame([], CATALOGUE)
    # A stage is there when its record is and, unless it only assembles columns, its data too.
    stage = F.regexp_extract("path", r"/model/stages/([^/]+)/", 1)
    kept = listed.where(stage != "").groupBy("version", stage.alias("stage")).agg(
        F.bool_or(F.col("path").rlike(r"/metadata/part-")).alias("record"),
        (F.bool_or(F.col("path").rlike(r"/data/")) | F.bool_or(F.col("path").contains("VectorAssembler"))).alias("data"),
    )
    found = kept.groupBy("version").agg(F.count_if(F.col("record") & F.col("data")).alias("n_stages_found"))
    files = listed.groupBy("version").agg(F.count(F.lit(1)).alias("n_files"))
    at = F.col("_metadata.file_path")
    text = records.select(_version("_metadata.file_path").alias("version"), at.alias("path"), "value").where(at.rlike(rf"/{VERSION_NAME}/(model/)?metadata/"))
    keys = F.lit(True)
    for key in required:
        keys = keys & F.get_json_object("value", f"$.{key}").isNotNull()
    own = F.col("path").contains("/model/metadata/")
    stages = F.json_array_length(F.get_json_object("value", "$.paramMap.stageUids"))
    told = text.groupBy("version").agg(F.max(F.when(own, stages)).cast("bigint").alias("n_stages"), F.coalesce(F.bool_or(F.when(~own, keys)), F.lit(False)).alias("required_keys"))
    joined = files.where("version <> ''").join(told, "version", "left").join(found, "version", "left")
    out = joined.select("version", "n_files", "n_stages", F.coalesce("n_stages_found", F.lit(0)).alias("n_stages_found"), F.coalesce("required_keys", F.lit(False)).alias("required_keys"))
    return out.withColumn("complete", F.coalesce(F.col("required_keys") & (F.col("n_stages") == F.col("n_stages_found")), F.lit(False)))


def newest_model(spark: SparkSession, root: str) -> str:
    """Path of the newest version under ``root`` that is whole."""
    whole = model_catalogue(spark, root).where("complete")
    version = latest_version(whole, "version", VERSION_NAME).first()["latest"]
    if version is None:
        raise FileNotFoundError(f"no complete model under {root}")
    return f"{root.rstrip('/')}/{version}"


def resolve_model(spark: SparkSession, path: str) -> str:
    """``path``, or for ``<root>/latest`` the newest whole model under ``root``."""
    root, _, name = path.rstrip("/").rpartition("/")
    return newest_model(spark, root or ".") if name == LATEST else path
