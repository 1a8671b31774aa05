"""Profiles, dependency lists, required texts, sources, and the tool log."""

from __future__ import annotations

from pyspark.sql import functions as F

from lake_ingest.checks.fixtures import DOCUMENT_KEY
from lake_ingest.checks.registry import query, table
from lake_ingest.functions import documents as docs
from lake_ingest.functions.text import has_text
from lake_ingest.operators import artifacts, validate
from lake_ingest.plans.save_batch import orphaned_artifacts

# Profile texts by document; %s stands for the document's key.
PROFILES = (
    ('{"source_key": "%s", "dependencies": ["astropy", "numpy"], "observations": []}', "OK"),
    ('{"source_key": "%s"}', "OK"),
    ('{"source_key": "%s", "dependencies": []}', "OK"),
    ('{"source_key": "%s", "dependencies": ["a-b", "a_b"]}', "OK"),
    ('{"source_key": "%s"', "INVALID_JSON"),
    ('{"source_key": "%s"} {"more": 1}', "INVALID_JSON"),
    ('["%s"]', "NOT_OBJECT"),
    ('"%s"', "NOT_OBJECT"),
    ('{"source_key": "x%s"}', "SOURCE_KEY_MISMATCH"),
    ('{"source_key": null, "key": "%s"}', "SOURCE_KEY_MISMATCH"),
    ('{"source_key": 1, "key": "%s"}', "SOURCE_KEY_MISMATCH"),
    ('{"source_key": "%s", "dependencies": null}', "DEPENDENCIES_NOT_LIST"),
    ('{"source_key": "%s", "dependencies": "numpy"}', "DEPENDENCIES_NOT_LIST"),
    ('{"source_key": "%s", "dependencies": {}}', "DEPENDENCIES_NOT_LIST"),
    ('{"source_key": "%s", "dependencies": ["numpy>=1"]}', "INVALID_PACKAGE"),
    ('{"source_key": "%s", "dependencies": ["a", 1]}', "INVALID_PACKAGE"),
    ('{"source_key": "%s", "dependencies": ["a", null]}', "INVALID_PACKAGE"),
    ('{"source_key": "%s", "dependencies": ["ok\\n"]}', "INVALID_PACKAGE"),
    ('{"source_key": "%s", "dependencies": ["Numpy", "numpy"]}', "DUPLICATE_DEPENDENCY"),
)


def document_profiles(spark, sf_dir):
    """Every document with one of the profile texts."""
    texts = F.array(*[F.lit(text) for text, _ in PROFILES])
    shape = (F.col("doc_id") % len(PROFILES)).cast("int")
    documents = table(spark, sf_dir, "documents").withColumn("source_key", F.expr(DOCUMENT_KEY))
    return documents.select(
        "source_key", F.replace(texts[shape], F.lit("%s"), F.col("source_key")).alias("profile")
    )


def _sql_text(text):
    return "'" + text.replace("'", "''") + "'"


SQL_PROFILES = f"""
profiles AS (
  SELECT source || '/' || lang || '/' || doc_id || '.txt' AS source_key,
         replace(list_extract([{', '.join(_sql_text(t) for t, _ in PROFILES)}],
                              doc_id % {len(PROFILES)} + 1), '%s', source_key) AS profile
  FROM documents)"""

# Computed from the JSON itself, by other means than the engine's own.
SQL_VERDICTS = f"""{SQL_PROFILES},
typed AS (
  SELECT *, json_valid(profile) AS valid, CASE WHEN json_valid(profile) THEN profile END AS doc FROM profiles),
fields AS (
  SELECT *, json_type(doc) AS kind, json_extract(doc, '$.source_key') AS k, json_extract(doc, '$.dependencies') AS d,
         json_type(doc, '$.dependencies') AS d_kind,
         CASE WHEN json_type(doc, '$.dependencies') = 'ARRAY'
              THEN CAST(json_extract(doc, '$.dependencies') AS JSON[]) ELSE [] END AS items
  FROM typed),
verdicts AS (
  SELECT source_key, CASE
    WHEN NOT valid THEN 'INVALID_JSON'
    WHEN kind <> 'OBJECT' THEN 'NOT_OBJECT'
    WHEN coalesce(json_type(k) <> 'VARCHAR' OR (k ->> '$') <> source_key, TRUE) THEN 'SOURCE_KEY_MISMATCH'
    WHEN d_kind <> 'ARRAY' THEN 'DEPENDENCIES_NOT_LIST'
    WHEN len(list_filter(items, lambda x: NOT coalesce(json_type(x) = 'VARCHAR'
           AND regexp_matches(x ->> '$', '\\A[A-Za-z0-9][A-Za-z0-9._-]*\\z'), FALSE))) > 0 THEN 'INVALID_PACKAGE'
    WHEN len(list_distinct(list_transform(items, lambda x: lower(x ->> '$')))) < len(items) THEN 'DUPLICATE_DEPENDENCY'
    ELSE 'OK' END AS verdict,
    CASE WHEN len(items) > 0 THEN array_to_string(list_transform(items, lambda x: x ->> '$'), ',') ELSE '' END AS names
  FROM fields)"""


@query(
    "validate_profiles",
    f"""WITH {SQL_VERDICTS}
    SELECT source_key, verdict, CASE WHEN verdict = 'OK' THEN names END AS dependencies FROM verdicts""",
)
def validate_profiles(spark, sf_dir):
    checked = validate.validate_profiles(document_profiles(spark, sf_dir), "profile", "source_key")
    return checked.select(
        "source_key", "verdict", F.array_join("dependencies", ",").alias("dependencies")
    )


@query(
    "dependency_check",
    """WITH listed AS (
      SELECT doc_id, CASE lang WHEN 'en' THEN [source, 'numpy', source || '.io']
                               WHEN 'de' THEN [source, upper(source)]
                               WHEN 'fr' THEN [source || '>=1']
                               ELSE ['_' || lang, source] END AS names
      FROM documents)
    SELECT doc_id, CASE
      WHEN len(list_filter(names, lambda n: NOT regexp_matches(n, '\\A[A-Za-z0-9][A-Za-z0-9._-]*\\z'))) > 0 THEN 'INVALID_PACKAGE'
      WHEN len(list_distinct(list_transform(names, lambda n: lower(n)))) < len(names) THEN 'DUPLICATE_DEPENDENCY'
      ELSE 'OK' END AS verdict
    FROM listed""",
)
def dependency_check(spark, sf_dir):
    source, lang = F.col("source"), F.col("lang")
    names = (
        F.when(lang == "en", F.array(source, F.lit("numpy"), F.concat(source, F.lit(".io"))))
        .when(lang == "de", F.array(source, F.upper(source)))
        .when(lang == "fr", F.array(F.concat(source, F.lit(">=1"))))
        .otherwise(F.array(F.concat(F.lit("_"), lang), source))
    )
    listed = table(spark, sf_dir, "documents").select("doc_id", names.alias("names"))
    return listed.select("doc_id", validate.package_verdict("names").alias("verdict"))


@query(
    "required_text",
    """WITH artifact AS (
      SELECT conv_id, turn, text AS prompt,
             CASE role WHEN 'system' THEN chr(9) || chr(160) || chr(8195) || chr(31) || chr(10) WHEN 'user' THEN text ELSE ' ' || text END AS proposal,
             CASE WHEN length(text) > 1500 THEN NULL WHEN length(text) < 30 THEN '' ELSE 'x' END AS metadata
      FROM conversations)
    SELECT conv_id, turn,
           coalesce(regexp_matches(prompt, '[^\\s\\x0b\\x1c-\\x1f\\x{85}\\p{Z}]'), FALSE)
           AND coalesce(regexp_matches(proposal, '[^\\s\\x0b\\x1c-\\x1f\\x{85}\\p{Z}]'), FALSE)
           AND coalesce(regexp_matches(metadata, '[^\\s\\x0b\\x1c-\\x1f\\x{85}\\p{Z}]'), FALSE) AS complete
    FROM artifact""",
)
def required_text(spark, sf_dir):
    """Turns as artifact texts; blanks of several kinds, empty and missing ones among them."""
    role, text = F.col("role"), F.col("text")
    artifact = table(spark, sf_dir, "conversations").select(
        "conv_id",
        "turn",
        text.alias("prompt"),
        F.when(role == "system", "\t  \x1f\n").when(role == "user", text).otherwise(F.concat(F.lit(" "), text)).alias("proposal"),
        F.when(F.length(text) > 1500, None).when(F.length(text) < 30, "").otherwise("x").alias("metadata"),
    )
    return artifact.select(
        "conv_id", "turn", has_text("prompt", "proposal", "metadata").alias("complete")
    )


@query(
    "source_exists",
    """SELECT d.doc_id, l.doc_id IS NOT NULL AS present
    FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l ON l.doc_id = d.doc_id""",
)
def source_exists(spark, sf_dir):
    """Proposals for all documents, with the labelled ones as the sources still listed."""
    proposals = table(spark, sf_dir, "documents").select("doc_id")
    listing = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("key"))
    present, gone = validate.split_by_source(proposals, listing, "doc_id")
    return present.withColumn("present", F.lit(True)).unionByName(
        gone.withColumn("present", F.lit(False))
    )



SQL_DESTINATIONS = f"""
named AS (
  SELECT page_id, url AS source_key, md5(url || ':' || md5(html)) AS ingestion_id,
         regexp_replace(url, '(/\\.?)+$', '') AS trimmed FROM pages),
folders AS (
  SELECT *, regexp_extract(trimmed, '[^/]*$') AS name,
         'raw/' || ingestion_id || '-' || regexp_extract(trimmed, '[^/]*$') || '/' AS folder FROM named),
destinations AS (
  SELECT page_id, ingestion_id, source_key, kind, folder || coalesce(file, name) AS key, content_type
  FROM folders, (VALUES ('source', NULL, 'application/octet-stream'),
    ('source_loader', 'source_loader.py', 'text/x-python'), ('profile', 'profile.json', 'application/json'),
    ('prompt', 'prompt.md', 'text/markdown'), ('proposal', 'proposal.md', 'text/markdown'),
    ('semantic_metadata', 'semantic-metadata.md', 'text/markdown'),
    ('execution_log', 'execution.log', 'text/plain')) v(kind, file, content_type))"""


def page_saves(spark, sf_dir):
    identity = F.md5(F.concat("url", F.lit(":"), F.md5("html")))
    return table(spark, sf_dir, "pages").select(
        "page_id", F.col("url").alias("source_key"), identity.alias("ingestion_id")
    )


@query(
    "artifact_keys",
    f"WITH {SQL_DESTINATIONS} SELECT ingestion_id, source_key, kind, key, content_type FROM destinations",
)
def artifact_keys(spark, sf_dir):
    return artifacts.expected_keys(page_saves(spark, sf_dir))


@query(
    "verify_saved",
    f"""WITH {SQL_DESTINATIONS}
    SELECT d.source_key, d.kind, d.key FROM destinations d JOIN pages p ON p.page_id = d.page_id
    WHERE octet_length(encode(p.html)) < 4000 AND d.kind IN ('prompt', 'source')""",
)
def verify_saved(spark, sf_dir):
    """Stored are all keys but two of each small page's."""
    saves = page_saves(spark, sf_dir)
    expected = artifacts.expected_keys(saves)
    small = table(spark, sf_dir, "pages").select(
        F.col("url").alias("source_key"), (F.octet_length("html") < 4000).alias("small")
    )
    lost = F.col("small") & F.col("kind").isin("prompt", "source")
    stored = expected.join(small, "source_key").where(~lost)
    return validate.missing_keys(expected, stored).select("source_key", "kind", "key")


@query(
    "orphaned_artifacts",
    f"""WITH {SQL_DESTINATIONS}
    SELECT d.ingestion_id, d.kind, d.key FROM destinations d JOIN pages p ON p.page_id = d.page_id
    WHERE d.kind <> 'source' AND octet_length(encode(p.html)) < 4000""",
)
def orphaned(spark, sf_dir):
    """Artifacts of all pages, of which the small ones' saves never reached the state."""
    saves = page_saves(spark, sf_dir)
    large = table(spark, sf_dir, "pages").where(F.octet_length("html") >= 4000)
    state = saves.join(large.select(F.col("url").alias("source_key")), "source_key", "left_semi")
    stored = artifacts.expected_keys(saves).where("kind <> 'source'").select("ingestion_id", "kind", "key")
    return orphaned_artifacts(stored, state.withColumnRenamed("ingestion_id", "proposal_id"))


# Loader texts by document, and whether they have the interface; %s stands for the document's source.
LOADERS = (
    ("def load_data(spark, source_path):\n    return spark.read.text(source_path)  # %s\n", True),
    ('"""%s"""\nimport json\n\ndef load_data(spark, source_path: str = ""):\n    pass\n', True),
    ("def load_data(spark, path):\n    return '%s'\n", False),
    ("def load_data(spark, source_path)  # %s", False),
    ("def load_%s(spark, source_path): pass\n", False),
    ("def load_data(spark, source_path, *, name='%s'): pass\n", False),
    ("# %s\n", False),
)


@query(
    "loader_scripts",
    f"""SELECT doc_id, list_extract([{', '.join(str(ok).upper() for _, ok in LOADERS)}],
                                    doc_id % {len(LOADERS)} + 1) AS accepted FROM documents""",
)
def loader_scripts(spark, sf_dir):
    """A loader text per document; the SQL knows the forms and not the language."""
    texts = F.array(*[F.lit(text) for text, _ in LOADERS])
    form = texts[(F.col("doc_id") % len(LOADERS)).cast("int")]
    scripts = table(spark, sf_dir, "documents").select(
        "doc_id", F.replace(form, F.lit("%s"), F.col("source")).alias("script")
    )
    return scripts.select("doc_id", validate.is_loader_script("script").alias("accepted"))


@query(
    "tool_status",
    """WITH outputs AS (
      SELECT conv_id, turn, CASE turn % 8
        WHEN 0 THEN '{"ok": false, "turn": ' || turn || '}'
        WHEN 1 THEN '{"success": false, "ok": true}'
        WHEN 2 THEN '  Error: ' || text
        WHEN 3 THEN '{"error": "x", "ok": 0}'
        WHEN 4 THEN 'FAILED:' || text
        WHEN 5 THEN '[' || turn || ']'
        WHEN 6 THEN text
        ELSE '{"ok": false} ' || text END AS output
      FROM conversations),
    parsed AS (SELECT *, CASE WHEN json_valid(output) THEN output END AS doc FROM outputs)
    SELECT conv_id, turn, CASE
      WHEN coalesce(CAST(json_extract(doc, '$.ok') AS VARCHAR) = 'false', FALSE)
        OR coalesce(CAST(json_extract(doc, '$.success') AS VARCHAR) = 'false', FALSE)
        OR regexp_matches(output, '(?i)^\\s*(error:|exception:|failed:)') THEN 'FAILED' ELSE 'SUCCESS' END AS status
    FROM parsed""",
)
def tool_status(spark, sf_dir):
    """Turns as tool outputs, in eight forms."""
    text, turn = F.col("text"), F.col("turn").cast("string")
    forms = F.array(
        F.concat(F.lit('{"ok": false, "turn": '), turn, F.lit("}")),
        F.lit('{"success": false, "ok": true}'),
        F.concat(F.lit("  Error: "), text),
        F.lit('{"error": "x", "ok": 0}'),
        F.concat(F.lit("FAILED:"), text),
        F.concat(F.lit("["), turn, F.lit("]")),
        text,
        F.concat(F.lit('{"ok": false} '), text),
    )
    outputs = table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", forms[(F.col("turn") % 8).cast("int")].alias("output")
    )
    return docs.with_tool_status(outputs, "output").drop("output")


@query(
    "shorten_args",
    """WITH arguments AS (
      SELECT conv_id, turn, json_object('source_key', role || '/' || conv_id, 'turn', turn, 'text', text) AS body
      FROM conversations),
    entries AS (
      SELECT conv_id, turn, unnest(['source_key', 'turn', 'text']) AS name,
             unnest([json_extract(body, '$.source_key'), json_extract(body, '$.turn'), json_extract(body, '$.text')]) AS value
      FROM arguments)
    SELECT conv_id, turn, name,
           CASE WHEN json_type(value) = 'VARCHAR' AND length(CAST(value AS VARCHAR)) > 120 THEN '"-content-"'
                ELSE CAST(value AS VARCHAR) END AS value
    FROM entries""",
)
def shorten_args(spark, sf_dir):
    """Turns as tool arguments; texts over 120 characters of JSON are replaced."""
    body = F.to_json(
        F.struct(
            F.concat("role", F.lit("/"), F.col("conv_id").cast("string")).alias("source_key"),
            "turn",
            "text",
        )
    )
    arguments = table(spark, sf_dir, "conversations").select("conv_id", "turn", body.alias("body"))
    return docs.with_short_arguments(arguments, "body").select(
        "conv_id", "turn", F.explode_outer("short_arguments").alias("name", "value")
    )
