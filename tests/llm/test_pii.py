import pytest

from lake_ingest.llm import pii
from tests.llm.helpers import documents

TEXT = (
    "Mr. John Smith (john.smith@mail.com) and Mrs Anna Smith; JOHN.SMITH@MAIL.COM, +1 (743) 555-3824 / "
    "+17435553824, 743-555-3824, 4785380592391139 4785 3805 9239 1139 10.0.0.1 1.2.3.999 123-45-6789 "
    "DE89 3704 0044 0532 0130 00 г-жа Ольга Иванова 12345678901234567 el.00@mail8.example.com&&& "
    "233.233.171.252!! v1.2.3.4.5 2123465659789240 +1 (826) 555-4081 190.137.223.204"
)
KINDS = ["given m", "surname", "email", "given f", "surname", "email", "phone", "phone", "phone", "card", "card", "ip"]
KINDS += ["ssn", "iban", "given f", "surname", "email", "ip", "phone", "ip"]


def test_entities():
    found = list(pii.entities(TEXT))
    assert [k for _, _, k, _ in found] == KINDS
    assert all(a[1] <= b[0] for a, b in zip(found, found[1:]))
    assert found[2][3] == found[5][3] and found[6][3] == found[7][3] and found[9][3] == found[10][3]


@pytest.mark.parametrize("text", ["", "plain prose, 12 of 2024", "Version 2.0 of 4.0.", "Mr and Mrs", "0007687199101951"])
def test_clean_texts(text):
    assert list(pii.entities(text)) == []


@pytest.mark.parametrize("attempt", [0, 1, 9])
def test_surrogates_keep_kind_and_format(attempt):
    for start, end, kind, value in pii.entities(TEXT):
        surface = TEXT[start:end]
        new = pii.rendered(surface, kind, pii.surrogate(b"k", kind, value, attempt))
        if kind == "surname" or kind.startswith("given"):
            assert new[0].isupper() and pii._script(new) == pii._script(surface)
            continue
        ((a, b, same, _),) = pii.entities(new)
        assert (a, b, same) == (0, len(new), kind)
        if kind in ("phone", "ssn", "iban", "card"):
            assert [c if not c.isalnum() else "x" for c in new] == [c if not c.isalnum() else "x" for c in surface]


def test_corpus(spark):
    rows = [(1, TEXT, "en", "s"), (1, TEXT, "en", "s"), (2, None, None, None), (3, "", "en", None)]
    rows += [(10 + i, f"write to a{i % 60}@b.org or 10.1.{i % 9}.{i % 7}", "en", "s") for i in range(80)]
    rows += [(200 + i, f"Mr Name{chr(97 + i % 26)}{chr(97 + i // 26)} Other came", "en", "s") for i in range(60)]
    docs = documents(spark, rows)
    got = pii.surrogates(docs, key=b"secret")
    assert got.columns == [*docs.columns, "n_entities"]
    new = sorted(((r.doc_id, r.text, r.n_entities) for r in got.collect()), key=repr)
    assert len(new) == len(rows)
    real, seen, back = set(), {}, {}
    for (_, text, _, _), (_, text_new, n) in zip(sorted(rows, key=repr), new):
        old = list(pii.entities(text or ""))
        assert n == len(old) and (old or text == text_new)
        real |= {(k, v) for _, _, k, v in old}
        for (_, _, kind, value), (_, _, same, other) in zip(old, pii.entities(text_new or ""), strict=True):
            assert kind == same
            assert seen.setdefault((kind, value), other) == other
            assert back.setdefault((kind, other), value) == value
    assert not {(k, v) for k, v in back} & real
    again = sorted(((r.doc_id, r.text, r.n_entities) for r in pii.surrogates(docs.repartition(5), key=b"secret").collect()), key=repr)
    other = sorted(((r.doc_id, r.text, r.n_entities) for r in pii.surrogates(docs, key=b"other").collect()), key=repr)
    assert again == new != other
    assert pii.surrogates(docs.limit(0)).count() == 0


def test_scarce_values_get_different_surrogates(spark):
    values = spark.createDataFrame([("email", f"{c}@x.org") for c in "abcdefghijklmnopqrstuvwxyz"], "kind string, value string")
    made = [r.surrogate for r in pii.assigned(values, b"k").collect()]
    assert len(set(made)) == 26
