"""Documents from jobs: profile, content and dissemination look-ups with per-job failures.

Every builder keeps all jobs and carries ``error_message``, and ``failed`` where there may be no message; ``split_failures`` parts them at
the end. The run never stops for one document.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions import ids
from shelfmark.functions.text import extract_text

# Declared types of user properties -> Spark types.
PROPERTY_TYPES = {
    "string": "string", "integer": "int", "long": "bigint", "short": "smallint", "byte": "tinyint", "float": "float",
    "double": "double", "boolean": "boolean", "date": "timestamp",
}


def build_objects(jobs: DataFrame, profiles: DataFrame) -> DataFrame:
    """Object document per job; a missing profile is a failure."""
    profile = profiles.select(
        F.col("pid").alias("PID"), F.col("state").alias("STATE"), F.col("label").alias("LABEL"),
        F.col("owner_id").alias("OWNER_ID"), F.col("create_date").alias("CREATED_DATE"),
        F.col("last_modified_date").alias("LAST_MODIFIED_DATE"),
    )
    left = jobs.withColumnRenamed("pid", "_pid")
    built = left.join(profile, F.col("_pid") == F.col("PID"), "left")
    missing = F.when(F.col("PID").isNull(), F.concat(F.lit("no profile of object "), F.coalesce(F.col("_pid"), F.lit("(no pid)"))))
    return built.select(
        F.col("_pid").alias("pid"), *[c for c in jobs.columns if c != "pid"],
        F.struct("PID", "STATE", "LABEL", "OWNER_ID", "CREATED_DATE", "LAST_MODIFIED_DATE").alias("doc"),
        missing.alias("error_message"),
    )


def build_datastreams(jobs: DataFrame, profiles: DataFrame) -> DataFrame:
    """Datastream document per job without its content; a missing profile is a failure."""
    profile = profiles.select(
        F.col("pid").alias("PID"), F.col("ds_id").alias("DSID"), F.col("ds_label").alias("LABEL"),
        F.col("ds_version_id").alias("VERSION_ID"), F.col("ds_create_date").alias("CREATED_DATE"),
        F.col("ds_state").alias("STATE"), F.col("ds_mime").alias("MIMETYPE"),
        F.col("ds_control_group").alias("CONTROL_GROUP"), F.col("ds_size").alias("SIZE"),
        ids.versionable(F.col("ds_versionable")).alias("VERSIONABLE"),
        F.col("ds_checksum_type").alias("CHECKSUM_TYPE"), F.col("ds_checksum").alias("CHECKSUM"),
    )
    fields = profile.columns
    left = jobs.withColumnRenamed("pid", "_pid").withColumnRenamed("dsid", "_dsid")
    built = left.join(profile, (F.col("_pid") == F.col("PID")) & (F.col("_dsid") == F.col("DSID")), "left")
    # A profile without a versionable mark cannot be read either.
    failure = F.when(
        F.col("PID").isNull(), F.format_string("no profile of datastream %s of object %s", "_dsid", "_pid")
    ).when(F.col("VERSIONABLE").isNull(), F.format_string("incomplete profile of datastream %s of %s", "_dsid", "_pid"))
    return built.select(
        F.col("_pid").alias("pid"), F.col("_dsid").alias("dsid"),
        *[c for c in jobs.columns if c not in ("pid", "dsid")],
        F.struct(*fields).alias("doc"), failure.alias("error_message"),
    )


def attach_content(built: DataFrame, contents: DataFrame) -> DataFrame:
    """Add ``CONTENT`` (address and plain text) to datastream documents.

    An address that is no URI, missing content and any status but 200 are failures. Text is extracted only for documents
    that are still good.
    """
    content = contents.select(
        F.col("pid").alias("_c_pid"), F.col("ds_id").alias("_c_dsid"), F.col("status").alias("_status"), "content"
    )
    joined = built.join(
        content, (F.col("pid") == F.col("_c_pid")) & (F.col("dsid") == F.col("_c_dsid")), "left"
    )
    uri = ids.content_uri(F.col("pid"), F.col("dsid"))
    failure = F.coalesce(
        F.col("error_message"),
        F.when(
            ~ids.is_valid_uri(ids.raw_content_uri(F.col("pid"), F.col("dsid"))),
            F.concat(F.lit("not a valid content address: "), ids.raw_content_uri(F.col("pid"), F.col("dsid"))),
        ),
        F.when(F.col("_c_pid").isNull(), F.lit("no content")),
        F.when(
            F.coalesce(F.col("_status"), F.lit(0)) != 200,
            F.concat(F.lit("content not available, status "), F.coalesce(F.col("_status").cast("string"), F.lit("?"))),
        ),
    )
    text = F.when(F.col("error_message").isNull(), extract_text(F.col("content"), F.col("doc.MIMETYPE")))
    with_failure = joined.withColumn("error_message", failure)
    return with_failure.withColumn(
        "doc", F.col("doc").withField("CONTENT", F.struct(uri.alias("_uri"), text.alias("_content")))
    ).select(*built.columns)


def attach_dissemination(
    built: DataFrame,
    disseminations: DataFrame | None,
    sdef_pid: str | None,
    method: str | None,
    transform: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Add ``_dissemination`` to object documents.

    Rows come from ``disseminations`` or from ``transform``, a function from the good object rows to
    ``pid, status, json``. Without service or method nothing is attached and nothing is joined. Status 200 attaches the
    parsed JSON, or fails on JSON that cannot be read; a null status (the request itself failed) is a failure; any other
    status, or no row, leaves the document as it is.
    """
    absent = F.lit(None).cast("struct<_sdef_pid: string, _method: string, _content: variant>")
    if transform is None and (not sdef_pid or not method or disseminations is None):
        return built.withColumn("doc", F.col("doc").withField("_dissemination", absent))
    if transform is not None:
        results = transform(built.where(F.col("error_message").isNull()))
    else:
        results = disseminations.where((F.col("sdef_pid") == sdef_pid) & (F.col("method") == method))
    results = results.select(F.col("pid").alias("_d_pid"), F.col("status").alias("_status"), "json")
    joined = built.join(results, F.col("pid") == F.col("_d_pid"), "left")
    found = F.col("_d_pid").isNotNull()
    content = F.try_parse_json(F.col("json"))
    failure = F.coalesce(
        F.col("error_message"),
        F.when(found & F.col("_status").isNull(), F.lit("dissemination request failed")),
        F.when(found & (F.col("_status") == 200) & content.isNull(), F.lit("dissemination is not valid JSON")),
    )
    attached = F.when(
        found & (F.col("_status") == 200),
        F.struct(F.lit(sdef_pid).alias("_sdef_pid"), F.lit(method).alias("_method"), content.alias("_content")),
    ).otherwise(absent)
    return (
        joined.withColumn("error_message", failure)
        .withColumn("doc", F.col("doc").withField("_dissemination", attached))
        .select(*built.columns)
    )


def property_type(declared: object) -> str:
    name = declared.get("type", "string") if isinstance(declared, dict) else str(declared)
    return PROPERTY_TYPES.get(name, name)


def property_columns(properties: dict[str, object], content: str = "_dissemination._content") -> dict[str, Column]:
    """One typed value per configured property of the dissemination; null where it is absent or of another type."""
    return {
        name: F.try_variant_get(F.col(content), f"$['{name}']", property_type(declared))
        for name, declared in properties.items()
    }


def typed_properties(docs: DataFrame, properties: dict[str, object], content: str = "_dissemination._content") -> DataFrame:
    """One typed column per configured property."""
    columns = property_columns(properties, content)
    return docs.withColumns(columns) if columns else docs


def nested_properties(docs: DataFrame, properties: dict[str, object], into: str = "properties", content: str = "_dissemination._content") -> DataFrame:
    """The typed properties as fields of one struct: none can meet a column of the document, and each is a leaf of its own in the files."""
    columns = [value.alias(name) for name, value in property_columns(properties, content).items()]
    return docs.withColumn(into, F.struct(*columns)) if columns else docs


def is_failure(built: DataFrame) -> Column:
    """A message means failure. Builders that may fail without one say so in a boolean column ``failed``."""
    told = F.col("error_message").isNotNull()
    return told | F.coalesce(F.col("failed"), F.lit(False)) if "failed" in built.columns else told


def split_failures(built: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(documents, failures)."""
    failure = is_failure(built)
    return built.where(~failure), built.where(failure)
