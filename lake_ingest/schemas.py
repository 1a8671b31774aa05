"""Schemas of the control tables."""

LISTING = "key string, bucket string, size bigint, last_modified timestamp"

STATE = (
    "source_key string, status string, proposal_id string, source_bucket string, etag string, "
    "source_size bigint, source_modified timestamp, processed_at timestamp, raw_bucket string, "
    "raw_location string, artifacts map<string,string>, target_table string, "
    "dependencies array<string>, execution_performed boolean"
)

# A record as found inside an imported state document.
STATE_RECORD = (
    "struct<status:string,proposal_id:string,source_bucket:string,source:string,etag:string,"
    "processed_at:string,raw_bucket:string,raw_location:string,artifacts:map<string,string>,"
    "target_table:string,dependencies:array<string>,execution_performed:boolean>"
)

RAW_PARTS = (
    "ingestion_id string, source_key string, raw_location string, part bigint, start_byte bigint, "
    "content binary, bytes bigint, part_md5 string"
)

ARTIFACTS = "ingestion_id string, kind string, key string, content_type string, body string"

RUN_LOG = (
    "run_id string, source_key string, target_table string, status string, rows_in bigint, "
    "rows_written bigint, rows_rejected bigint, started_at timestamp, finished_at timestamp, "
    "message string"
)
