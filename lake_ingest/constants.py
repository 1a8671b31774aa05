"""Texts, names and limits that results must reproduce exactly."""

# Statuses under which an unchanged object is not ingested again.
DONE_STATUSES = ("success", "artifacts_saved")
SAVED_STATUS = "artifacts_saved"
SUCCESS_STATUS = "success"
# Not among the done ones: such an object is offered again.
FAILED_STATUS = "failed"

# Sampling limits.
MAX_READ_BYTES = 65536
DEFAULT_READ_BYTES = 65536
FIRST_READ_BYTES = 32768
MAX_READS = 5

# Raw area layout: (kind, file name inside the ingestion's folder, content type).
RAW_PREFIX = "raw/"
ARTIFACT_FILES = (
    ("source_loader", "source_loader.py", "text/x-python"),
    ("profile", "profile.json", "application/json"),
    ("prompt", "prompt.md", "text/markdown"),
    ("proposal", "proposal.md", "text/markdown"),
    ("semantic_metadata", "semantic-metadata.md", "text/markdown"),
    ("execution_log", "execution.log", "text/plain"),
)
SOURCE_COPY_KIND = "source"
SOURCE_COPY_TYPE = "application/octet-stream"
NOT_EXECUTED_LOG = (
    "Status: NOT EXECUTED\n"
    "The source loader was generated and saved for review. "
    "No Spark job was submitted.\n"
)

# A dependency is a bare package name.
PACKAGE_NAME = r"\A[A-Za-z0-9][A-Za-z0-9._-]*\z"

# Tool log.
FAILURE_PREFIXES = ("error:", "exception:", "failed:")
SHORTENED_VALUE = "-content-"
SHORTEN_ABOVE = 120

# Read request errors, in the order in which they are tested.
ERR_KEY = "source_key must be a relative object key"
ERR_START = "start_byte must be non-negative"
ERR_READS = (
    "a single file can be read max. 5 times. "
    "please proceed with the next step in the instructions"
)
ERR_BUCKET = "Bucket is not permitted"
ERR_UNREADABLE = "Unable to read object"

# Goes with every read that returned bytes.
READ_NOTE = (
    "Content is a raw byte-range sample decoded as UTF-8. "
    "A range may begin or end partway through a line or multibyte character. "
    "Use the returned byte offset to continue reading."
)

# Own choices, not given values: objects are hashed and preserved in parts so that one large object
# is spread over many tasks. The digests of 10,000 parts are joined into one, and so on upwards.
PART_BYTES = 8 * 1024 * 1024
BLOCK_PARTS = 10_000
