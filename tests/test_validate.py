import pytest

from lake_ingest.operators import validate
from tests.conftest import rows

VERDICTS = [
    ('{"source_key":"k","dependencies":["astropy","numpy"],"x":1}', "OK"),
    ('{"source_key":"k"}', "OK"),
    ('{"source_key":"k","dependencies":[]}', "OK"),
    ('{"source_key":"k","dependencies":["a-b","a_b"]}', "OK"),
    ("{bad", "INVALID_JSON"),
    ("", "INVALID_JSON"),
    ('{"source_key":"k"} x', "INVALID_JSON"),
    ("[1]", "NOT_OBJECT"),
    ('"s"', "NOT_OBJECT"),
    ("null", "NOT_OBJECT"),
    ('{"dependencies":[]}', "SOURCE_KEY_MISMATCH"),
    ('{"source_key":"z"}', "SOURCE_KEY_MISMATCH"),
    ('{"source_key":1}', "SOURCE_KEY_MISMATCH"),
    ('{"source_key":null}', "SOURCE_KEY_MISMATCH"),
    ('{"source_key":"k","dependencies":null}', "DEPENDENCIES_NOT_LIST"),
    ('{"source_key":"k","dependencies":"numpy"}', "DEPENDENCIES_NOT_LIST"),
    ('{"source_key":"k","dependencies":{}}', "DEPENDENCIES_NOT_LIST"),
    ('{"source_key":"k","dependencies":["numpy>=1"]}', "INVALID_PACKAGE"),
    ('{"source_key":"k","dependencies":[""]}', "INVALID_PACKAGE"),
    ('{"source_key":"k","dependencies":["_x"]}', "INVALID_PACKAGE"),
    ('{"source_key":"k","dependencies":[1]}', "INVALID_PACKAGE"),
    ('{"source_key":"k","dependencies":["ok\\n"]}', "INVALID_PACKAGE"),
    ('{"source_key":"k","dependencies":["a",null]}', "INVALID_PACKAGE"),
    ('{"source_key":"k","dependencies":["a","A"]}', "DUPLICATE_DEPENDENCY"),
    # Repeated keys and NaN are no errors to a lenient parser.
    ('{"source_key":"k","a":1,"a":2}', "OK"),
    ('{"source_key":"k","a":NaN}', "OK"),
    ('{"source_key":"z","source_key":"k"}', "OK"),
    ('{"source_key":"k","dependencies":NaN}', "DEPENDENCIES_NOT_LIST"),
]


def test_profile_verdicts(spark):
    df = spark.createDataFrame([(i, "k", p) for i, (p, _) in enumerate(VERDICTS)], "i int, key string, p string")
    found = validate.validate_profiles(df, "p", "key").orderBy("i").collect()
    assert [(r.p, r.verdict) for r in found] == VERDICTS
    assert found[0].dependencies == ["astropy", "numpy"]
    assert found[1].dependencies == [] and found[4].dependencies is None


LOADERS = [
    ("def load_data(spark, source_path):\n    return 1", True),
    ("import x\ndef load_data(spark: object, source_path='p') -> int:\n    return 1\ndef other(): pass", True),
    ("", False),
    (None, False),
    ("def load_data(spark, source_path)", False),
    ("def load_data(spark, path): pass", False),
    ("def load_data(spark, source_path, /): pass", False),
    ("def load_data(spark, source_path, *rest): pass", False),
    ("def load_data(spark, source_path, *, more=1): pass", False),
    ("def load_data(spark, source_path, **more): pass", False),
    ("async def load_data(spark, source_path): pass", False),
    ("class A:\n    def load_data(spark, source_path): pass", False),
    ("def load_data(spark, source_path): pass\n" * 2, False),
    ("load_data = lambda spark, source_path: 1", False),
]


def test_loader_scripts(spark):
    df = spark.createDataFrame([(i, s) for i, (s, _) in enumerate(LOADERS)], "i int, script string")
    found = df.select("i", validate.is_loader_script("script").alias("ok")).orderBy("i").collect()
    assert [r.ok for r in found] == [ok for _, ok in LOADERS]


def test_split_by_source_keeps_every_proposal_once(spark):
    proposals = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "source_key string, n int")
    listing = spark.createDataFrame([("a",), ("a",), ("c",)], "key string")
    present, gone = validate.split_by_source(proposals, listing)
    assert rows(present) == [("a", 1), ("a", 2)] and rows(gone) == [("b", 3)]


def test_check_dataset(spark):
    empty = spark.createDataFrame([], "a int")
    assert validate.check_dataset(empty) is empty
    with pytest.raises(TypeError):
        validate.check_dataset([1])
    with pytest.raises(ValueError):
        validate.check_dataset(empty.select())
