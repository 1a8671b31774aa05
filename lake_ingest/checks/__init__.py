"""The operators applied to the given tables, each with the SQL that gives the same rows."""

from lake_ingest.checks import conforming, discovery, pipelines, sampling, validation

MODULES = (discovery, sampling, conforming, validation, pipelines)
