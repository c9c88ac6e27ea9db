"""Schemas of inputs, jobs and index tables as DDL. Times are UTC wall-clock ``TIMESTAMP_NTZ``."""

MESSAGES = "msg_id BIGINT, topic STRING, pid STRING, method_name STRING, body STRING, arrival TIMESTAMP_NTZ"

HARVEST_PAGES = "source STRING, page_no BIGINT, request_at TIMESTAMP_NTZ, http_status INT, body STRING"

# Only the parts of a message body or a page that are read; the XML reader skips the rest.
ATOM_BODY = "category ARRAY<STRUCT<_term: STRING, _scheme: STRING>>, _corrupt_record STRING"
HARVEST_BODY = (
    "ListIdentifiers STRUCT<"
    "header: ARRAY<STRUCT<_status: STRING, identifier: STRING>>, "
    "resumptionToken: STRUCT<_VALUE: STRING, _expirationDate: STRING>>, "
    "_corrupt_record STRING"
)

LAST_RUN_RAW = "source STRING, ts STRING, expiration_date STRING, resumption_token STRING"
LAST_RUN = "source STRING, ts TIMESTAMP_NTZ, expiration_date TIMESTAMP_NTZ, resumption_token STRING"

# Order of jobs with equal times, compared field by field: jobs of a fan-out (one generation on) follow those of the feeds.
SEQ = "STRUCT<generation: INT, feed: INT, source: STRING, number: BIGINT, position: BIGINT>"
JOBS = (
    "kind STRING, op STRING, pid STRING, dsid STRING, doc_id STRING, "
    f"arrival TIMESTAMP_NTZ, delay_s INT, ready_at TIMESTAMP_NTZ, seq {SEQ}"
)
JOB_COLUMNS = ("kind", "op", "pid", "dsid", "doc_id", "arrival", "delay_s", "ready_at", "seq")

OBJECT_PROFILES = (
    "pid STRING, state STRING, label STRING, owner_id STRING, "
    "create_date TIMESTAMP_NTZ, last_modified_date TIMESTAMP_NTZ"
)
DATASTREAM_PROFILES = (
    "pid STRING, ds_id STRING, ds_label STRING, ds_version_id STRING, ds_create_date TIMESTAMP_NTZ, ds_state STRING, "
    "ds_mime STRING, ds_format_uri STRING, ds_control_group STRING, ds_size BIGINT, ds_versionable STRING, "
    "ds_info_type STRING, ds_location STRING, ds_location_type STRING, ds_checksum_type STRING, ds_checksum STRING"
)
CONTENTS = "pid STRING, ds_id STRING, status INT, content BINARY"
DISSEMINATIONS = "pid STRING, sdef_pid STRING, method STRING, status INT, json STRING"

OBJECTS = (
    "PID STRING, STATE STRING, LABEL STRING, OWNER_ID STRING, "
    "CREATED_DATE TIMESTAMP_NTZ, LAST_MODIFIED_DATE TIMESTAMP_NTZ, "
    "_dissemination STRUCT<_sdef_pid: STRING, _method: STRING, _content: VARIANT>, doc_id STRING, _version BIGINT"
)
DATASTREAMS = (
    "PID STRING, DSID STRING, LABEL STRING, VERSION_ID STRING, CREATED_DATE TIMESTAMP_NTZ, STATE STRING, "
    "MIMETYPE STRING, CONTROL_GROUP STRING, SIZE BIGINT, VERSIONABLE BOOLEAN, CHECKSUM_TYPE STRING, CHECKSUM STRING, "
    "CONTENT STRUCT<_uri: STRING, _content: STRING>, doc_id STRING, _version BIGINT"
)
ERRORS = "doc_id STRING, PID STRING, DSID STRING, job STRING, message STRING, timestamp TIMESTAMP_NTZ"
# Search terms of the analysed fields; the field is named with its table.
POSTINGS = "field STRING, term STRING, doc_id STRING, n BIGINT"
# Messages that could not be used, and why.
MALFORMED = "msg_id BIGINT, topic STRING, pid STRING, method_name STRING, body STRING, arrival TIMESTAMP_NTZ, reason STRING"

OBJECT_COLUMNS = ("PID", "STATE", "LABEL", "OWNER_ID", "CREATED_DATE", "LAST_MODIFIED_DATE")
DATASTREAM_COLUMNS = (
    "PID", "DSID", "LABEL", "VERSION_ID", "CREATED_DATE", "STATE", "MIMETYPE", "CONTROL_GROUP", "SIZE", "VERSIONABLE",
    "CHECKSUM_TYPE", "CHECKSUM",
)
ERROR_COLUMNS = ("doc_id", "PID", "DSID", "job", "message", "timestamp")
